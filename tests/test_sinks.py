"""Sinks: append by name, checkpoint append, partition replacement through staging."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowruns import schema as S
from flowruns.plans import jobs
from flowruns.sources import fixtures as FX
from flowruns.sources import sinks
from flowruns.sources.readers import readings


def _keys(df):
    return sorted(tuple(r) for r in df.select(S.DEVICE_ID, S.START, S.END).collect())


def test_append_by_name_and_checkpoint(spark):
    d = tempfile.mkdtemp(prefix="flowruns-test-")
    rd = readings(spark, SF_SMALL)
    before, after = FX.runs_before(rd), FX.runs_from(rd)
    sinks.append_by_name(before, f"{d}/runs")
    sinks.append_by_name(after.select(*reversed(after.columns)), f"{d}/runs")
    back = spark.read.parquet(f"{d}/runs")
    assert back.columns == S.RUN_COLUMNS
    assert _keys(back) == _keys(FX.runs_cut(rd))
    sinks.append_checkpoint(before.agg(F.max(S.END).alias(S.TIMESTAMP)), f"{d}/ck")
    sinks.append_checkpoint(after.agg(F.max(S.END).alias(S.TIMESTAMP)), f"{d}/ck")
    assert sinks.read_checkpoints(spark, f"{d}/ck").count() == 2


def test_consolidate_written_through_staging(spark):
    d = tempfile.mkdtemp(prefix="flowruns-test-")
    rd = readings(spark, SF_SMALL)
    sinks.write_runs(FX.runs_cut(rd), f"{d}/runs")
    stored = sinks.read_runs(spark, f"{d}/runs")
    new = jobs.materialize(jobs.consolidate(rd, stored, FX.CUT))
    k = [S.DEVICE_ID, S.START, S.END]
    changed = (new.select(*k).exceptAll(stored.select(*k))
               .unionByName(stored.select(*k).exceptAll(new.select(*k)))
               .select(F.to_date(S.START).alias(sinks.PART)).distinct())
    sinks.replace_dates(new, f"{d}/runs", changed)
    assert _keys(sinks.read_runs(spark, f"{d}/runs")) == _keys(FX.runs_whole(rd))


def test_runners_load_stitch_and_consolidate(spark):
    from flowruns.plans import runner

    d = tempfile.mkdtemp(prefix="flowruns-test-")
    rd = readings(spark, SF_SMALL)
    whole = _keys(FX.runs_whole(rd))
    # three loads as the data arrives, each stitched to what is stored
    for until in ("2024-01-08 00:00:00", "2024-01-20 00:00:00", "2024-02-01 00:00:00"):
        runner.run_incremental(spark, rd.where(F.col(S.TIMESTAMP) < FX.ts(until)), f"{d}/runs", f"{d}/ck")
    assert _keys(sinks.read_runs(spark, f"{d}/runs")) == whole
    assert sinks.read_checkpoints(spark, f"{d}/ck").count() == 3
    # a back-filled table with one cut, consolidated in place
    runner.run_backfill(spark, rd, f"{d}/bf", "2024-01-01 00:00:00", FX.CUT)
    runner.run_backfill(spark, rd, f"{d}/bf", FX.CUT, "2024-02-01 00:00:00")
    runner.run_consolidate(spark, rd, f"{d}/bf", FX.CUT)
    assert _keys(sinks.read_runs(spark, f"{d}/bf")) == whole


def test_append_by_name_raises_when_columns_differ(spark):
    import pytest

    d = tempfile.mkdtemp(prefix="flowruns-test-")
    sinks.append_by_name(spark.range(2).selectExpr("id a", "id b"), f"{d}/t")
    for other in ("id a, id b, id c", "id a"):
        with pytest.raises(ValueError):
            sinks.append_by_name(spark.range(2).selectExpr(*other.split(", ")), f"{d}/t")


def test_backfill_can_be_repeated(spark):
    from flowruns.plans import runner

    d = tempfile.mkdtemp(prefix="flowruns-test-")
    rd = readings(spark, SF_SMALL)
    for _ in range(2):
        runner.run_backfill(spark, rd, f"{d}/bf", "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    assert _keys(sinks.read_runs(spark, f"{d}/bf")) == _keys(FX.runs_whole(rd))


def test_repairs_read_only_the_dates_they_can_change(spark):
    d = tempfile.mkdtemp(prefix="flowruns-test-")
    rd = readings(spark, SF_SMALL)
    sinks.write_runs(FX.runs_cut(rd), f"{d}/runs")
    stored = sinks.read_runs(spark, f"{d}/runs")
    day = F.lit("2024-01-15").cast("date")
    table, changed = jobs.repair_seam_windows_delta(rd, stored, *FX.SEAM_WINDOWS)
    assert sinks.PART in table.columns and changed.count() > 0

    def filters(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        return [line.split("PartitionFilters: ")[1].split("],")[0]
                for line in text.splitlines() if "PartitionFilters: " in line and f"{d}/runs" in line]

    for df in (sinks.dated(table).where(F.col(sinks.PART).isin([day])), changed):
        got = filters(df)
        assert got and all(sinks.PART in f for f in got), got


def test_consolidation_heals_duplicates_and_lists_their_dates(spark):
    rd = readings(spark, SF_SMALL)
    both = jobs.materialize(FX.runs_cut_with_bridges(rd).unionByName(FX.runs_cut(rd).limit(7)))
    table, changed = jobs.consolidate_delta(rd, both, FX.CUT)
    whole = FX.runs_whole(rd)
    assert _keys(table) == _keys(whole)
    k = [S.DEVICE_ID, S.START, S.END]
    gone = both.select(*k).exceptAll(whole.select(*k)).select(F.to_date(S.START)).distinct()
    assert gone.exceptAll(changed).isEmpty()
    assert jobs.heal_duplicates(whole)[1] is None
