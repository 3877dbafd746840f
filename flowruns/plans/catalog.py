"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (``events`` -> readings -> runs). ``oracle_sql.build()`` holds the DuckDB twin
of each. Floating columns are rounded identically on both sides by ``present``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import epoch_seconds, seam_bounds
from flowruns.operators import extents as X
from flowruns.operators import repair as P
from flowruns.operators.late import late_intervals
from flowruns.operators.merge import merge_fragments, summarize_parts
from flowruns.operators.runs import island_bounds, island_ids, neighbours, nonzero_readings, prune_readings, resolve_chunks, zero_flag
from flowruns.operators.summary import summarize_runs, summarize_view
from flowruns.plans import jobs, runner
from flowruns.sources import fixtures as FX
from flowruns.session import ensure_checkpoint_dir
from flowruns.sources import sinks, versions
from flowruns.sources.readers import read_source
from flowruns.sources.readers import readings as load_readings
from flowruns.sources.scans import extent_bounds, scan_after, scan_closed_devices, scan_extent_buckets, scan_half_open, scan_seam, scan_seam_windows

Query = Callable[[SparkSession, str], DataFrame]

# Rounding moves the half-way point by a thousandth of the last digit kept: a mean such
# as 1705.21 / 32 = 53.2878125 sits exactly on a tie, and sums added in another order
# land one ulp either side of it. The nudge is far above that error and far below the
# data's own resolution, so equal values round equally on both engines.
TIE_NUDGE = 1e-3

# The streamed copy of events: deliveries, the least files of each, and rows of a file. A file of parquet's default
# settings is one split however long it is, so the files must grow in number, not in size.
STREAM_STEPS = 3
STREAM_FILES = 2
STREAM_FILE_ROWS = 250_000
CAP_DAYS = 2.0


def _round_sql(c: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"floor(`{c}` * {scale!r}D + {0.5 + TIE_NUDGE!r}D) / {scale!r}D AS `{c}`"


def present(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Select ``cols`` and round floating aggregates (sums to 4, means and spreads to 6
    digits) so engines that add in different orders compare equal. One projection,
    written as SQL expressions (one call into the JVM instead of one per operator)."""
    out = []
    for c in cols or df.columns:
        if c.startswith("SUM_"):
            out.append(_round_sql(c, 4))
        elif c.startswith(("AVG_", "SD_")) or c == "DAY_DIFF":
            out.append(_round_sql(c, 6))
        else:
            out.append(f"`{c}`")
    return df.selectExpr(*out)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, each as often: one grouping over both, so that each is computed once."""
    n = F.sum("_N")
    both = a.withColumn("_N", F.lit(1)).unionByName(b.withColumn("_N", F.lit(-1)))
    return both.groupBy(*a.columns).agg(n.alias("_N")).where(F.col("_N") != 0).isEmpty()


KEYS = [S.DEVICE_ID, S.START, S.END]
R = [S.DEVICE_ID, S.TIMESTAMP, S.FLOW_RATE, S.PRESSURE, S.TEMPERATURE, S.MODE, S.VALVE_STATE]


def stored(runs: DataFrame) -> DataFrame:
    """A destination fixture as the jobs meet it: a materialized table, not a plan that
    recomputes it for each of its readers."""
    return jobs.materialize(runs)


def _folder(spark, what: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/flowruns-{what}-{uuid.uuid4().hex}"


def _cut_ts():
    return FX.ts(FX.CUT)


def _seam_start(daily: DataFrame):
    """The first START on or after the cut: the batch start of the seam queries (settled
    with a one-row action, so the seam filters are literals)."""
    return daily.where(F.col(S.START) >= _cut_ts()).agg(F.min(S.START)).first()[0]


def _seam_extents(spark, sf):
    daily = stored(FX.runs_daily(load_readings(spark, sf)))
    return X.device_extents(scan_seam(daily, _seam_start(daily), FX.SEAM_SECONDS))


def _cut_extents(rd):
    return X.consolidate_extents(FX.runs_cut(rd), FX.CUT)


def _recomputed_closed(rd):
    ext = stored(_cut_extents(rd))
    return P.extent_join(summarize_runs(scan_closed_devices(rd, ext, *extent_bounds(ext))), ext)


def build() -> dict[str, Query]:
    q: dict[str, Query] = {}

    # Flagship and per-statistic views of the run summary
    q["island_summary"] = lambda spark, sf: present(summarize_runs(load_readings(spark, sf)))
    stats = {
        "flow_stats": ["MAX_FLOW_RATE", "AVG_FLOW_RATE", "SUM_FLOW_RATE"],
        "temperature_stats": ["MIN_TEMPERATURE", "MAX_TEMPERATURE", "AVG_TEMPERATURE"],
        "pressure_stats": ["MIN_PRESSURE", "MAX_PRESSURE", "AVG_PRESSURE"],
        "spread_single_reading": ["RECORDS", "SD_PRESSURE", "SD_FLOW_RATE"],
        "mode_counts": ["SYSTEM_MODE_2", "SYSTEM_MODE_3", "SYSTEM_MODE_5"],
        "run_duration": ["DURATION"],
    }
    for name, cols in stats.items():
        q[name] = (lambda c: lambda spark, sf: present(summarize_runs(load_readings(spark, sf)), KEYS + c))(cols)
    q["island_sql_view"] = lambda spark, sf: present(summarize_view(spark, island_ids(load_readings(spark, sf))))
    q["ordered_runs"] = lambda spark, sf: present(summarize_runs(load_readings(spark, sf))).orderBy(S.DEVICE_ID, S.START)

    # Reading-level operators
    q["neighbour_flow"] = lambda spark, sf: neighbours(load_readings(spark, sf), [S.FLOW_RATE]).select(
        S.DEVICE_ID, S.TIMESTAMP, S.FLOW_RATE, "PREV_FLOW_RATE", "NEXT_FLOW_RATE")
    q["neighbour_time"] = lambda spark, sf: neighbours(nonzero_readings(load_readings(spark, sf)), [S.TIMESTAMP]).select(
        S.DEVICE_ID, S.TIMESTAMP, "PREV_TIMESTAMP", "NEXT_TIMESTAMP")
    q["zero_flag"] = lambda spark, sf: zero_flag(load_readings(spark, sf)).select(
        S.DEVICE_ID, S.TIMESTAMP, S.FLOW_RATE, S.IDLE)
    q["nonzero_readings"] = lambda spark, sf: nonzero_readings(load_readings(spark, sf)).select(*R)
    q["prune_readings"] = lambda spark, sf: prune_readings(load_readings(spark, sf))
    q["ordered_readings"] = lambda spark, sf: prune_readings(load_readings(spark, sf)).orderBy(S.DEVICE_ID, S.TIMESTAMP)
    q["island_ids"] = lambda spark, sf: island_ids(load_readings(spark, sf)).select(
        S.DEVICE_ID, S.TIMESTAMP, S.FLOW_RATE, S.RUN_ID)
    q["island_bounds"] = lambda spark, sf: island_bounds(load_readings(spark, sf)).select(
        S.DEVICE_ID, S.TIMESTAMP, S.START, S.END)

    # Scans
    q["scan_half_open"] = lambda spark, sf: scan_half_open(load_readings(spark, sf), FX.BACKFILL_FROM, FX.BACKFILL_TO)

    def scan_after_checkpoint(spark, sf):
        rd = load_readings(spark, sf)
        before = FX.runs_before(rd)
        ckpt = before.agg(F.max(S.END).alias(S.TIMESTAMP))  # the checkpoint row batch 1 wrote
        value = X.checkpoint_lookup(spark, ckpt, FX.runs_cut(rd)).first()[0]
        return scan_after(rd, value)
    q["scan_after_checkpoint"] = scan_after_checkpoint
    def _scan_closed_devices(spark, sf):
        rd = load_readings(spark, sf)
        ext = stored(_cut_extents(rd))
        return scan_closed_devices(rd, ext, *extent_bounds(ext))
    q["scan_closed_devices"] = _scan_closed_devices

    def _scan_seam(spark, sf):
        daily = stored(FX.runs_daily(load_readings(spark, sf)))
        return present(scan_seam(daily, _seam_start(daily), FX.SEAM_SECONDS))
    q["scan_seam"] = _scan_seam

    def _seam_bounds(spark, sf):
        daily = FX.runs_daily(load_readings(spark, sf))
        b = seam_bounds(_seam_start(daily), FX.SEAM_SECONDS)
        return spark.range(1).select(*[b[k].alias(k) for k in ("S", "S1", "E", "E1")])
    q["seam_bounds"] = _seam_bounds

    def _scan_seam_windows(spark, sf):
        daily = stored(FX.runs_daily(load_readings(spark, sf)))
        return present(scan_seam_windows(daily, *FX.SEAM_WINDOWS))
    q["scan_seam_windows"] = _scan_seam_windows

    # Any Spark source; the filter reaches it
    q["source_filtered"] = lambda spark, sf: read_source(spark, "parquet", f"{sf.rstrip('/')}/events.parquet").where(
        (F.col("event_type") != "error") & (F.col("ts") >= _cut_ts())).select("event_id", "ts", "user_id", "event_type")

    # Extents
    q["device_extents"] = _seam_extents
    q["global_extent"] = lambda spark, sf: X.global_extent(_seam_extents(spark, sf))
    q["seam_devices"] = lambda spark, sf: X.seam_devices(_seam_extents(spark, sf))
    q["batch_extent"] = lambda spark, sf: X.batch_extent(FX.runs_from(load_readings(spark, sf)))
    q["first_run_after"] = lambda spark, sf: X.first_run_after(FX.runs_cut(load_readings(spark, sf)), _cut_ts())
    q["last_run_before"] = lambda spark, sf: X.last_run_before(FX.runs_cut(load_readings(spark, sf)), _cut_ts())
    q["consolidate_extents"] = lambda spark, sf: _cut_extents(load_readings(spark, sf))
    q["capped_extent"] = lambda spark, sf: present(X.capped_extent(_cut_extents(load_readings(spark, sf)), 2.0))
    q["checkpoint_lookup"] = lambda spark, sf: X.checkpoint_lookup(
        spark, FX.empty_checkpoints(spark), FX.runs_before(load_readings(spark, sf)))

    def checkpoint_after_batch(spark, sf):
        rd = load_readings(spark, sf)
        ck = FX.empty_checkpoints(spark)
        for batch in (FX.runs_before(rd), FX.runs_from(rd)):
            ck = ck.unionByName(batch.agg(F.max(S.END).alias(S.TIMESTAMP)))
        return ck
    q["checkpoint_after_batch"] = checkpoint_after_batch

    # Repair
    q["extent_join"] = lambda spark, sf: _recomputed_closed(load_readings(spark, sf)).select(
        *KEYS, S.RECORDS, S.ACT_START, S.ACT_END)
    q["extent_exact"] = lambda spark, sf: present(P.extent_exact(_recomputed_closed(load_readings(spark, sf))), S.RUN_COLUMNS)

    def bridge_islands(spark, sf):
        rd = load_readings(spark, sf)
        cut = stored(FX.runs_cut(rd))
        return present(jobs.bridge_islands(rd, cut, X.consolidate_extents(cut, FX.CUT)))
    q["bridge_islands"] = bridge_islands

    def range_delete(spark, sf):
        rd = load_readings(spark, sf)
        cut = stored(FX.runs_cut(rd))
        return present(P.range_delete(cut, X.consolidate_extents(cut, FX.CUT)))
    q["range_delete"] = range_delete
    q["duplicate_starts"] = lambda spark, sf: P.duplicate_starts(FX.runs_cut_with_bridges(load_readings(spark, sf))).select(
        S.DEVICE_ID, S.START, "N", S.END)
    q["duplicate_ends"] = lambda spark, sf: P.duplicate_ends(FX.runs_cut_with_bridges(load_readings(spark, sf))).select(
        S.DEVICE_ID, S.END, "N", S.START)
    q["dedupe_same_start"] = lambda spark, sf: present(P.dedupe_same_start(stored(FX.runs_cut_with_bridges(load_readings(spark, sf)))))
    q["dedupe_same_end"] = lambda spark, sf: present(P.dedupe_same_end(stored(FX.runs_cut_with_bridges(load_readings(spark, sf)))))

    def append_by_name(spark, sf):
        rd = load_readings(spark, sf)
        after = FX.runs_from(rd)
        permuted = after.select(*reversed(after.columns))
        return present(FX.runs_before(rd).unionByName(permuted), S.RUN_COLUMNS)
    q["append_by_name"] = append_by_name

    def append_by_name_sink(spark, sf):
        """S6 through the sink: two batches, the second with its columns in another order, read back."""
        rd, path = load_readings(spark, sf), _folder(spark, "append")
        after = FX.runs_from(rd)
        sinks.append_by_name(FX.runs_before(rd), path)
        sinks.append_by_name(after.select(*reversed(after.columns)), path)
        return present(read_source(spark, "parquet", path), S.RUN_COLUMNS)
    q["append_by_name_sink"] = append_by_name_sink

    def checkpoint_sink(spark, sf):
        """S7 through the sink: the checkpoint rows of two batches, read back."""
        rd, path = load_readings(spark, sf), _folder(spark, "checkpoints")
        for batch in (FX.runs_before(rd), FX.runs_from(rd)):
            sinks.append_checkpoint(batch.agg(F.max(S.END).alias(S.TIMESTAMP)), path)
        return sinks.read_checkpoints(spark, path)
    q["checkpoint_sink"] = checkpoint_sink

    # Jobs
    q["job_backfill"] = lambda spark, sf: present(jobs.backfill(load_readings(spark, sf), FX.BACKFILL_FROM, FX.BACKFILL_TO))

    def job_consolidate(spark, sf):
        rd = load_readings(spark, sf)
        return present(jobs.consolidate(rd, stored(FX.runs_cut(rd)), FX.CUT))
    q["job_consolidate"] = job_consolidate

    def job_consolidate_daily(spark, sf):
        """G4 over all daily cuts at once: a table loaded day by day becomes whole."""
        rd = load_readings(spark, sf)
        daily = stored(FX.runs_daily(rd))
        lo, hi = extent_bounds(daily)
        if lo is None:
            return present(daily)
        return present(jobs.consolidate_range(rd, daily, lo, hi + dt.timedelta(seconds=1)))
    q["job_consolidate_daily"] = job_consolidate_daily

    def job_repair_seam(spark, sf):
        rd = load_readings(spark, sf)
        cut = stored(FX.runs_cut(rd))
        s = cut.where(F.col(S.START) >= _cut_ts()).agg(F.min(S.START)).first()[0]
        return present(jobs.repair_seam(rd, cut, s, FX.SEAM_SECONDS))
    q["job_repair_seam"] = job_repair_seam

    def job_repair_seam_windows(spark, sf):
        rd = load_readings(spark, sf)
        return present(jobs.repair_seam_windows(rd, stored(FX.runs_cut(rd)), *FX.SEAM_WINDOWS))
    q["job_repair_seam_windows"] = job_repair_seam_windows

    def job_consolidate_heal(spark, sf):
        """G4 on a table that holds both the fragments and the whole of every run the cut split."""
        rd = load_readings(spark, sf)
        return present(jobs.consolidate(rd, stored(FX.runs_cut_with_bridges(rd)), FX.CUT))
    q["job_consolidate_heal"] = job_consolidate_heal

    def job_consolidate_capped(spark, sf):
        """G4 with a cap: only devices whose extent spans at most two days are repaired."""
        rd = load_readings(spark, sf)
        return present(jobs.consolidate(rd, stored(FX.runs_cut(rd)), FX.CUT, cap_days=CAP_DAYS))
    q["job_consolidate_capped"] = job_consolidate_capped

    def job_publish_recovery(spark, sf):
        """A consolidation stops after it wrote its rows, before it took a version; the next job does it all."""
        rd = load_readings(spark, sf)
        root = _folder(spark, "recovery")
        base = sinks.write_runs(FX.runs_cut(rd), f"{root}/runs")
        table, changed = jobs.consolidate_delta(rd, sinks.read_runs(spark, f"{root}/runs"), FX.CUT, version=base)
        if changed is not None:
            rows = sinks.dated(table).join(changed, sinks.PART, "left_semi")
            versions.write_publish(rows.select(*S.RUN_COLUMNS, sinks.PART), f"{root}/runs", base.number + 1)
        runner.run_consolidate(spark, rd, f"{root}/runs", FX.CUT)
        return present(sinks.read_runs(spark, f"{root}/runs"), S.RUN_COLUMNS)
    q["job_publish_recovery"] = job_publish_recovery

    def job_concurrent_publish(spark, sf):
        """A load overtakes a consolidation of the same table: the load publishes while the consolidation
        computes, which then starts again from the newer version, so that no row of either is lost."""
        rd, root = load_readings(spark, sf), _folder(spark, "overlap")
        sinks.write_runs(FX.runs_daily(rd.where(F.col(S.TIMESTAMP) < _cut_ts())), f"{root}/runs")
        loads = []

        def consolidation(runs, version):
            table, changed = jobs.consolidate_range_delta(rd, runs, FX.DAILY_FROM, FX.DAILY_TO, version=version)
            changed = None if changed is None else jobs.materialize(changed)
            if not loads:
                loads.append(runner.run_incremental(spark, rd, f"{root}/runs", f"{root}/checkpoints"))
            return table, changed

        versions.commit(spark, f"{root}/runs", consolidation, heals=True)
        return present(sinks.read_runs(spark, f"{root}/runs"), S.RUN_COLUMNS)
    q["job_concurrent_publish"] = job_concurrent_publish

    def zone_map_scan(spark, sf):
        """S5's END arm on the stored table: the zone map chooses the folders."""
        rd, path = load_readings(spark, sf), f"{_folder(spark, 'zones')}/runs"
        version = sinks.write_runs(FX.runs_cut(rd), path)
        return present(scan_seam_windows(sinks.read_runs(spark, path), *FX.SEAM_WINDOWS, version), S.RUN_COLUMNS)
    q["zone_map_scan"] = zone_map_scan

    def job_range_delete(spark, sf):
        """S8 as a job on the stored table."""
        rd, path = load_readings(spark, sf), f"{_folder(spark, 'delete')}/runs"
        sinks.write_runs(FX.runs_cut(rd), path)
        stored_runs = sinks.read_runs(spark, path)
        runner.run_delete(spark, X.consolidate_extents(stored_runs, FX.CUT), path)
        return present(sinks.read_runs(spark, path), S.RUN_COLUMNS)
    q["job_range_delete"] = job_range_delete

    def _merge_fragments(spark, sf):
        """The fragments of a load day by day, merged without a second look at their readings."""
        rd = load_readings(spark, sf)
        parts = stored(summarize_parts(rd.withColumn("_BATCH", F.to_date(S.TIMESTAMP)), batch_cols=["_BATCH"]))
        return present(merge_fragments(rd, parts), S.RUN_COLUMNS)
    q["merge_fragments"] = _merge_fragments

    def extent_bucket_join(spark, sf):
        """J5 by time buckets, as for extents too many to broadcast."""
        rd = load_readings(spark, sf)
        ext = stored(_cut_extents(rd))
        return scan_extent_buckets(rd, ext, *extent_bounds(ext))
    q["extent_bucket_join"] = extent_bucket_join

    def checkpoint_observed(spark, sf):
        """The checkpoint row of a load, observed while its runs are written."""
        rd = load_readings(spark, sf)
        return jobs.incremental(rd, stored(FX.runs_before(rd)), FX.empty_checkpoints(spark))[1]
    q["checkpoint_observed"] = checkpoint_observed

    def _late_intervals(spark, sf):
        """What the late tenth of the readings can change in the runs of the others."""
        rd = load_readings(spark, sf)
        late = epoch_seconds(S.TIMESTAMP) % FX.LATE_EVERY == 0
        return late_intervals(stored(FX.runs_whole(rd.where(~late))), rd.where(late)).select(S.DEVICE_ID, S.START, S.END)
    q["late_intervals"] = _late_intervals

    def streamed(spark, sf, step, keep_state=False) -> DataFrame:
        """The run table after streaming the events in ``STREAM_STEPS`` deliveries (``step``: a column from 0);
        after each, the table must equal a full recompute of what was delivered."""
        from flowruns.sources.readers import readings_from_events, table
        from flowruns.streaming.incremental import start_stream

        root = _folder(spark, "stream")
        events = table(spark, sf, "events")
        delivery = step(events)
        files = max(STREAM_FILES, -(-events.count() // (STREAM_STEPS * STREAM_FILE_ROWS)))
        chunks = resolve_chunks(readings_from_events(events))  # of all events, so they also hold for those delivered so far
        for k in range(STREAM_STEPS):
            events.where(delivery == k).repartition(files).write.mode("append").parquet(f"{root}/source")
            start_stream(spark, f"{root}/source", events.schema, f"{root}/runs", f"{root}/_stream",
                         to_readings=readings_from_events, keep_state=keep_state).awaitTermination()
            full = summarize_runs(readings_from_events(spark.read.schema(events.schema).parquet(f"{root}/source")), chunks)
            now, want = (df.select(*KEYS, S.RECORDS) for df in (sinks.read_runs(spark, f"{root}/runs"), full))
            if not same_rows(now, want):
                raise AssertionError(f"the streamed table differs from a full recompute after step {k}")
        return present(sinks.read_runs(spark, f"{root}/runs"), S.RUN_COLUMNS)

    def by_time(events):
        lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
        cuts = [lo + (hi - lo) * k / STREAM_STEPS for k in range(1, STREAM_STEPS)] if lo else []
        return sum((F.when(F.col("ts") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))

    def incremental_equals_full(spark, sf):
        """The events arrive in time order, one micro-batch a delivery."""
        return streamed(spark, sf, by_time)
    q["incremental_equals_full"] = incremental_equals_full

    def incremental_state(spark, sf):
        """T1 by the state of open runs: the events arrive in time order, but for every seventh, which comes a delivery late."""
        def mostly_by_time(events):
            return F.least(by_time(events) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0), F.lit(STREAM_STEPS - 1))
        return streamed(spark, sf, mostly_by_time, keep_state=True)
    q["incremental_state"] = incremental_state

    def incremental_late_rows(spark, sf):
        """Every delivery holds readings from the whole time range, so most are late."""
        return streamed(spark, sf, lambda events: F.pmod(F.col("event_id"), F.lit(STREAM_STEPS)))
    q["incremental_late_rows"] = incremental_late_rows

    def job_incremental(spark, sf):
        rd = load_readings(spark, sf)
        out, _ = jobs.incremental(rd, stored(FX.runs_before(rd)), FX.empty_checkpoints(spark))
        return present(out)
    q["job_incremental"] = job_incremental
    return q
