"""Keep the run table current as reading files arrive, with Structured Streaming.

``readStream`` over the reading files, ``trigger(availableNow=True)`` (or a processing
time trigger), and ``foreachBatch``: each micro-batch only says *which devices got
readings at which times*. The stored runs they can change become disjoint intervals per device
(``operators.late``), each interval is recomputed from the source table (so late rows are
handled exactly, with no lateness bound, and cost the runs beside them), and only the start dates
that changed are published. Spark's stream checkpoint records which files were done,
in place of a checkpoint table; a replayed micro-batch recomputes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowruns import schema as S
from flowruns.operators.late import Spans, known_spans, late_intervals
from flowruns.operators.merge import summarize_parts
from flowruns.operators.runs import DEFAULT_CHUNK_SECONDS, clean, resolve_chunks
from flowruns.operators.summary import summarize_runs
from flowruns.plans.jobs import start_dates
from flowruns.session import materialize, small_side, small_table
from flowruns.sources import sinks, versions
from flowruns.sources.scans import scan_closed, scan_extents, scan_started
from flowruns.sources.versions import Version
from flowruns.streaming import state


class Recomputed(NamedTuple):
    """``kept``: the stored runs outside the touched intervals; ``dropped``: those inside; ``new``: what takes their place."""

    kept: DataFrame
    dropped: DataFrame
    new: DataFrame


def recompute_touched(readings: DataFrame, runs: DataFrame, new_readings: DataFrame | Spans,
                      chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (),
                      version: Version | None = None, summarize: Callable[..., DataFrame] = summarize_runs) -> Recomputed | None:
    """Recompute each interval that ``new_readings`` touch (``operators.late``) from its own readings; None if they touch none."""
    touched, seen = small_table(late_intervals(runs, new_readings, version), lo=F.min(S.START), hi=F.max(S.END))
    if not seen.n:
        return None
    lo, hi = seen.lo, seen.hi
    reread = scan_extents(readings, touched, lo, hi, seen.fits)
    # too many intervals to broadcast: the chunks of all readings in these bounds also hold for those inside the intervals
    chunk_seconds = resolve_chunks(reread if seen.fits else scan_closed(readings, lo, hi), chunk_seconds)
    new_runs = materialize(summarize(reread, chunk_seconds, tiebreak, batch_cols=["_INTERVAL"]))

    near = scan_started(runs, lo, hi)
    x = touched.select(F.col(S.DEVICE_ID).alias("_xd"), F.col(S.START).alias("_xs"), F.col(S.END).alias("_xe"))
    inside = lambda r: (r[S.DEVICE_ID] == x["_xd"]) & (r[S.START] >= x["_xs"]) & (r[S.END] <= x["_xe"])
    return Recomputed(runs.join(x, inside(runs), "left_anti"), near.join(x, inside(near), "left_semi"), new_runs)


def in_table(new_runs: DataFrame, runs: DataFrame) -> DataFrame:
    """``new_runs`` with the columns of the run table ``runs``."""
    return new_runs.withColumn(S.START_DATE, F.to_date(S.START)).select(*runs.columns)


def apply_new_readings(readings: DataFrame, runs: DataFrame, new_readings: DataFrame | Spans,
                       chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (),
                       version: Version | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The run table after ``new_readings`` (already part of ``readings``; their spans are enough) arrived.

    Each interval they touch (``operators.late``) is recomputed from its own readings, and takes the place of the stored
    runs inside it. ``version`` is the stored version that ``runs`` was read from. Returns
    ``(new run table, changed start dates or None)``.
    """
    x = recompute_touched(readings, runs, new_readings, chunk_seconds, tiebreak, version)
    if x is None:
        return runs, None
    return x.kept.unionByName(in_table(x.new, runs)), start_dates(x.dropped, x.new)


def apply_with_state(source: Callable[[], DataFrame], runs: DataFrame, batch: DataFrame, version: Version,
                     chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = ()
                     ) -> tuple[DataFrame, DataFrame | None, tuple[str, ...]]:
    """The run table after ``batch``, its changed start dates, and the state's folders, by the state of ``version`` (see
    ``streaming.state``).

    Devices whose readings in the batch are all after their last known one need the state alone; ``source()`` is only
    called for devices with a late reading (whose touched intervals are recomputed), or where the stored runs have no state.
    """
    spark = batch.sparkSession
    if version.state is None and version.dates:  # another job published the table: the state comes from the source again
        table, changed = apply_new_readings(source(), runs, batch, chunk_seconds, tiebreak, version)
        return table, changed, state.write_state(state.build_state(source(), chunk_seconds, tiebreak), version)

    marks = materialize(state.last_readings(batch))
    known = marks.join(state.read_state(spark, version, small_side(marks)), S.DEVICE_ID, "left")
    known, seen = small_table(known.withColumn("_LATE", F.coalesce(F.col("_FIRST") <= F.col("LAST"), F.lit(False))),
                              late=F.coalesce(F.sum(F.col("_LATE").cast("int")), F.lit(0)))
    late = known.where("_LATE")
    in_order = batch if not seen.late else batch.join(late, S.DEVICE_ID, "left_anti")
    parts, continued = state.continue_runs(in_order, known.where(~F.col("_LATE")), chunk_seconds, tiebreak)
    rows = state.state_rows(known.where(~F.col("_LATE")), parts)
    dropped, table = continued, runs.join(continued, [S.DEVICE_ID, S.START], "left_anti")

    if seen.late:
        x = recompute_touched(source(), runs, batch.join(late, S.DEVICE_ID, "left_semi"), chunk_seconds, tiebreak, version, summarize_parts)
        # of equal last times one idle reading closes the run; a run that no interval touched stays as it is
        last, before, now = F.greatest("LAST", "_LAST"), F.col("LAST"), F.col("_LAST")
        closed = (before >= now) & F.col("PART").isNull() | (now >= before) & ~F.col("_OPEN")
        late = late.select(S.DEVICE_ID, last.alias("_LAST"), (~closed).alias("_OPEN"), F.col("PART").alias("_BEFORE"))
        if x is None:
            rows = rows.unionByName(late.select(S.DEVICE_ID, F.col("_LAST").alias("LAST"), F.when(F.col("_OPEN"), F.col("_BEFORE")).alias("PART")))
        else:
            again = state.state_rows(late, x.new).join(late.select(S.DEVICE_ID, "_OPEN", "_BEFORE"), S.DEVICE_ID)
            rows = rows.unionByName(again.select(S.DEVICE_ID, "LAST", F.when(F.col("_OPEN"), F.coalesce("PART", "_BEFORE")).alias("PART")))
            table = x.kept.join(continued, [S.DEVICE_ID, S.START], "left_anti")
            dropped = dropped.unionByName(x.dropped.select(S.DEVICE_ID, S.START))
            parts = parts.unionByName(x.new)
    return table.unionByName(in_table(parts, runs)), start_dates(dropped, parts), state.write_state(rows, version)


def process_batch(spark: SparkSession, batch: DataFrame, source: Callable[[], DataFrame], dest_path: str,
                  chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, keep_state: bool = False) -> None:
    """foreachBatch body: fold one micro-batch of readings into the stored run table."""
    if batch.isEmpty():
        return
    if keep_state:  # the batch's runs come from the batch, with all their columns
        batch = materialize(clean(batch).select(*[c for c in S.READINGS_SCHEMA.names if c in batch.columns]))
    else:  # of the batch only its spans are needed; a repeat reads the files no second time
        spans = known_spans(batch.select(S.DEVICE_ID, S.TIMESTAMP, S.FLOW_RATE))

    def job(runs, version):
        if keep_state:
            table, changed, folders = apply_with_state(source, runs, batch, version, chunk_seconds)
            return sinks.dated(table), None if changed is None else materialize(changed), folders
        table, changed = apply_new_readings(source(), runs, spans, chunk_seconds, version=version)
        return sinks.dated(table), None if changed is None else materialize(changed)

    versions.commit(spark, dest_path, job)


def start_stream(spark: SparkSession, source_path: str, source_schema, dest_path: str, checkpoint_location: str,
                 to_readings: Callable[[DataFrame], DataFrame] = lambda df: df,
                 max_files_per_trigger: int | None = None, available_now: bool = True,
                 chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, keep_state: bool = False) -> StreamingQuery:
    """Start the incremental stream over the reading files at ``source_path``.

    With ``keep_state`` the stream keeps its devices' open runs and last readings (``streaming.state``), so that readings
    in time order are folded in without a second read of the source or of the stored runs.

    ``to_readings`` maps the raw files to the readings schema (for the test data: the
    ``events`` -> readings view); it is applied to the micro-batch and to the re-read of
    the whole source alike.
    """
    reader = spark.readStream.schema(source_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source_path)

    def source() -> DataFrame:
        return to_readings(spark.read.schema(source_schema).parquet(source_path))

    writer = (stream.writeStream
              # mapped in the batch: a micro-batch comes as rows, so columns mapped before would be computed though nothing reads them
              .foreachBatch(lambda df, epoch: process_batch(spark, to_readings(df), source, dest_path, chunk_seconds, keep_state))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
