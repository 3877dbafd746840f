"""The stream on larger deliveries: files that can be read by many tasks, neighbours looked up once for a device, one read of
readings that lie in one time bucket."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowruns import schema as S
from flowruns.operators import late
from flowruns.operators.runs import LEVELS_US, resolve_chunks
from flowruns.operators.summary import summarize_runs
from flowruns.plans import catalog, jobs
from flowruns.sources import fixtures as FX
from flowruns.sources import sinks
from flowruns.sources.readers import readings
from flowruns.streaming import incremental

T0 = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    """(device, minutes, flow) rows as readings."""
    return spark.createDataFrame([(d, T0 + dt.timedelta(minutes=m), f, 1.5, 20, 2, 0) for d, m, f in rows], S.READINGS_SCHEMA)


class Stop(Exception):
    pass


@pytest.mark.parametrize("name", ["incremental_equals_full", "incremental_state", "incremental_late_rows"])
def test_files_of_a_delivery_grow_in_number(spark, monkeypatch, name):
    root = tempfile.mkdtemp(prefix="flowruns-test-")

    def stop(*a, **k):
        raise Stop

    monkeypatch.setattr(catalog, "STREAM_FILE_ROWS", 50, raising=False)
    monkeypatch.setattr(catalog, "_folder", lambda spark, what: root)
    monkeypatch.setattr(incremental, "start_stream", stop)
    with pytest.raises(Stop):
        catalog.build()[name](spark, SF_SMALL)
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert len([f for f in os.listdir(f"{root}/source") if f.endswith(".parquet")]) == -(-events // 150)


def test_far_neighbours_are_looked_up_once_for_a_device(spark, monkeypatch):
    """Device a has runs on the first and the last of 40 dates, device b on the last alone, device z on each."""
    rows = [("a", 0, 1.0), ("a", 5, 0.0), ("a", 39 * 1440 - 9, 0.0), ("a", 39 * 1440, 1.0), ("b", 39 * 1440, 1.0)]
    rows += [("z", k * 1440 + j, float(j == 7)) for k in range(40) for j in (6, 7, 8)]
    path = f"{tempfile.mkdtemp(prefix='flowruns-test-')}/runs"
    version = sinks.write_runs(summarize_runs(frame(spark, rows)), path)
    calls, found = [], late.neighbour_runs
    monkeypatch.setattr(late, "neighbour_runs", lambda *a: calls.append(1) or found(*a))
    new = [("a", 20 * 1440 + 60 * h, 1.0) for h in range(5)] + [("b", 20 * 1440, 1.0), ("c", 20 * 1440, 2.0), ("z", 20 * 1440, 0.0)]
    got = late.late_intervals(sinks.read_runs(spark, path), frame(spark, new), version)
    ends = sorted((r[0], (r[1] - T0).days, (r[2] - T0).days) for r in got.collect())
    assert ends == [("a", 0, 39), ("b", 20, 39), ("c", 20, 20)]
    assert len(calls) == 1


def test_tables_are_compared_row_by_row(spark):
    a, b = (spark.createDataFrame(r, "k string, v int") for r in ([("x", None), ("x", None), ("y", 2)], [("x", None), ("y", 2), ("y", 2)]))
    assert catalog.same_rows(a, a) and catalog.same_rows(a.limit(0), b.limit(0))
    assert not catalog.same_rows(a, b) and not catalog.same_rows(a, a.distinct()) and not catalog.same_rows(a.limit(0), a)


#: Minutes from T0 to a bound of the widest time buckets.
BOUND = next(m for m in range(0, 366 * 1440, 1440) if (T0 + dt.timedelta(minutes=m) - dt.datetime(1970, 1, 1)) % dt.timedelta(microseconds=LEVELS_US[0]) == dt.timedelta(0))


def rows_of(df):
    return sorted(((r[0], *((t - T0) // dt.timedelta(minutes=1) for t in r[1:3]), r[3]) for r in df.select(S.DEVICE_ID, S.START, S.END, S.RECORDS).collect()))


def test_readings_of_one_bucket_are_read_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = summarize_runs(readings(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("FileScan parquet") == 1 and "Join" not in p


def test_runs_across_the_bound_of_two_buckets(spark):
    one = [("a", m, f) for m, f in ((1, 1.0), (2, 0.0), (3, 1.0), (4, 1.0))]
    two = [("a", BOUND - 20, 1.0), ("a", BOUND - 10, 0.0), ("a", BOUND - 5, 2.0), ("a", BOUND + 5, 1.0), ("b", BOUND + 1, 1.0)]
    assert resolve_chunks(frame(spark, one)).single and resolve_chunks(frame(spark, one).limit(0)).single
    assert not resolve_chunks(frame(spark, two)).single and not resolve_chunks(frame(spark, one), target_rows=3).single
    assert rows_of(summarize_runs(frame(spark, one))) == [("a", 1, 1, 1), ("a", 3, 4, 2)]
    assert rows_of(summarize_runs(frame(spark, two))) == [("a", BOUND - 20, BOUND - 20, 1), ("a", BOUND - 5, BOUND + 5, 2), ("b", BOUND + 1, BOUND + 1, 1)]


def test_a_load_in_one_bucket_is_stitched_to_runs_of_the_one_before(spark):
    first = [("a", BOUND - 20, 1.0), ("a", BOUND - 10, 0.0), ("b", BOUND - 20, 1.0), ("b", BOUND - 10, 2.0)]
    every = frame(spark, first + [("a", BOUND + 10, 1.0), ("b", BOUND + 10, 1.0)])
    out, _ = jobs.incremental(every, jobs.materialize(summarize_runs(frame(spark, first))), FX.empty_checkpoints(spark))
    assert rows_of(out) == rows_of(summarize_runs(every)) == [("a", BOUND - 20, BOUND - 20, 1), ("a", BOUND + 10, BOUND + 10, 1), ("b", BOUND - 20, BOUND + 10, 3)]


def test_runs_in_one_bucket_are_shuffled_once(spark):
    """The window's partitions hold whole runs, so grouping by the run needs no second shuffle."""
    one = frame(spark, [("a", m, float(m % 3)) for m in range(20)]).repartition(3)
    chunks = resolve_chunks(one)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = summarize_runs(one.withColumn("_BATCH", F.lit(1)), chunks, batch_cols=["_BATCH"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") == 1


def test_columns_that_a_batch_does_not_need_are_not_computed(spark):
    """Only device, time and flow of a micro-batch are read, so a column that cannot be computed for it does no harm."""
    root, seen = tempfile.mkdtemp(prefix="flowruns-test-"), []
    rows = frame(spark, [("a", 1, 1.0), ("a", 2, 0.0), ("a", 3, 2.0)])
    rows.coalesce(1).write.parquet(f"{root}/source")

    def mapped(df):
        seen.append(df.isStreaming)
        return df.withColumn(S.PRESSURE, F.when(F.input_file_name() == "", F.raise_error(F.lit("computed"))).otherwise(F.col(S.PRESSURE)))

    incremental.start_stream(spark, f"{root}/source", rows.schema, f"{root}/runs", f"{root}/_s", to_readings=mapped).awaitTermination()
    assert rows_of(sinks.read_runs(spark, f"{root}/runs")) == [("a", 1, 1, 1), ("a", 3, 3, 1)]
    assert seen and not any(seen)


def test_many_spans_have_the_neighbours_that_few_have(spark):
    rows = [("a", m, float(m % 4)) for m in range(0, 300, 7)] + [("b", m, 1.0 if m % 50 else 0.0) for m in range(0, 400, 10)] + [("c", 5, 1.0)]
    runs = jobs.materialize(summarize_runs(frame(spark, rows)))
    new = [(d, m, float(m % 3)) for d in "abd" for m in (3, 59, 61, 62, 130, 200, 201, 390, 500)]
    spans = jobs.materialize(late.touched_spans(frame(spark, new)))
    few, many = (sorted(map(repr, late.neighbour_runs(runs, spans, few).collect())) for few in (True, False))
    assert few == many and len(many) == spans.count()
    none = [sorted(map(repr, late.neighbour_runs(runs.limit(0), spans, few).collect())) for few in (True, False)]
    assert none[0] == none[1] and len(none[0]) == len(many)
