"""Merged summaries, bucket joins of extents, two-level sums over chunks, observed tables."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowruns import schema as S
from flowruns.operators.merge import COUNTS, PART_COLUMNS, merge_fragments, merge_rows, summarize_parts
from flowruns.operators.runs import chunk_neighbours, chunk_offsets, island_ids, neighbours
from flowruns.operators.summary import summarize_runs
from flowruns.plans.jobs import materialize
from flowruns.session import measured, small_table
from flowruns.sources import fixtures as FX
from flowruns.sources.readers import readings
from flowruns.sources.scans import bucket_width, scan_extent_buckets, scan_per_extent

T0 = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def same_rows(a, b):
    a, b = (sorted(map(tuple, df.select(*S.RUN_COLUMNS).collect()), key=lambda r: r[:3]) for df in (a, b))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(map(near, x, y)), (x, y)


def test_daily_fragments_merge_to_whole_runs(spark):
    rd = readings(spark, SF_SMALL)
    parts = materialize(summarize_parts(rd.withColumn("_B", F.to_date(S.TIMESTAMP)), batch_cols=["_B"]))
    assert parts.columns == PART_COLUMNS and parts.count() == 407
    merged = merge_fragments(rd, parts)
    same_rows(merged, FX.runs_whole(rd))
    whole = summarize_parts(rd)
    assert merged.select(S.DEVICE_ID, S.START, *COUNTS.values()).exceptAll(whole.select(S.DEVICE_ID, S.START, *COUNTS.values())).isEmpty()
    same_rows(merge_fragments(rd, materialize(merged)), FX.runs_whole(rd))  # whole runs stay as they are


def test_only_idle_readings_are_read_again(spark):
    rd = readings(spark, SF_SMALL)
    parts = materialize(summarize_parts(rd))
    text = plan(merge_fragments(rd, parts))
    scans = [line for line in text.splitlines() if "FileScan" in line or "PushedFilters" in line]
    assert any("GreaterThanOrEqual(ts" in line and "LessThanOrEqual(ts" in line for line in scans)
    assert not any("props" in line.split("ReadSchema")[-1] for line in scans)  # neither temperature nor mode


@pytest.mark.parametrize("seed", range(3))
def test_odd_values_merge_like_a_recompute(spark, seed):
    rng = random.Random(seed)
    flow = lambda: rng.choice([0.0, None, 1e9 + rng.random(), 1e9 + rng.random(), rng.random(), float("nan") if seed == 2 else 5.0])
    rows = [("ab"[i % 2], T0 + dt.timedelta(minutes=i * 37), flow(), rng.choice([None, 1e7, 1e7 + 1e-3 * rng.random()]), rng.choice([None, 1, 90]), rng.choice([2, 3, 5, 9]), 0)
            for i in range(200)]
    rd = spark.createDataFrame(rows, S.READINGS_SCHEMA)
    parts = summarize_parts(rd.withColumn("_B", F.hour(S.TIMESTAMP)).withColumn("_B", F.concat(F.to_date(S.TIMESTAMP).cast("string"), F.lit("-"), "_B")), batch_cols=["_B"])
    merged, whole = (sorted(df.collect(), key=lambda r: (r[S.DEVICE_ID], r[S.START])) for df in (merge_fragments(rd, materialize(parts)), summarize_runs(rd)))
    assert len(merged) == len(whole)
    for x, y in zip(merged, whole):
        for c in S.RUN_COLUMNS:
            if c.startswith("SD_") and None not in (x[c], y[c]):
                assert math.isclose(x[c], y[c], rel_tol=1e-4, abs_tol=1e-6), (c, x, y)
            else:
                assert near(x[c], y[c]), (c, x, y)


def test_merging_nothing(spark):
    none = spark.createDataFrame([], S.READINGS_SCHEMA)
    assert merge_fragments(none, summarize_parts(none)).count() == 0
    assert merge_rows(summarize_parts(none), [S.DEVICE_ID]).count() == 0


def test_bucket_join_equals_range_join_and_deals_a_hot_device_out(spark):
    rows = spark.range(30_000).selectExpr("if(id < 10000, 'hot', concat('d', id % 40)) AS DEVICE_ID",
                                          "timestampadd(MINUTE, int(id % 10000), timestamp_ntz'2024-01-01 00:00:00') AS TIMESTAMP", "1.0D AS FLOW_RATE")
    ext = spark.createDataFrame([("hot", T0, T0 + dt.timedelta(days=6)), ("hot", T0 + dt.timedelta(days=6, hours=1), T0 + dt.timedelta(days=9)),
                                 ("d1", T0 + dt.timedelta(hours=5), T0 + dt.timedelta(hours=5)), ("d2", T0, T0 + dt.timedelta(days=40)), ("none", T0, T0)], S.EXTENT_SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        want = sorted(map(tuple, scan_per_extent(rows, ext).collect()))
        for width in (None, 3_600_000_000, 86_400_000_000):
            out = scan_extent_buckets(rows, ext, width_us=width)
            assert "SortMergeJoin" in plan(out) and out.columns == rows.columns
            assert sorted(map(tuple, out.collect())) == want
        tasks = scan_extent_buckets(rows, ext).where("DEVICE_ID = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) == 8 and max(r["count"] for r in tasks) < 0.3 * 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert bucket_width(ext) == 3_600_000_000
    assert bucket_width(ext, spare_rows=60) == 86_400_000_000 and bucket_width(ext, spare_rows=0) == 32 * 86_400_000_000


def test_a_device_with_a_million_chunks_is_summed_in_two_levels(spark):
    n = 1_000_000
    chunks = spark.range(n).selectExpr("'a' AS DEVICE_ID", "id * 60000000 AS _CHUNK", "id % 3 AS _N_IDLE")
    out = chunk_offsets(chunks, [S.DEVICE_ID])
    text = plan(out)
    assert "_BLOCK" in text and out.count() == n
    wrong = out.withColumn("i", F.expr("_CHUNK div 60000000")).where("_OFFSET <> (i div 3) * 3 + if(i % 3 = 2, 1, 0)")
    assert wrong.isEmpty()
    # the largest window partition: the minutes of a day, or the days
    days = chunks.groupBy(F.expr("_CHUNK div 86400000000")).count()
    assert days.agg(F.max("count")).first()[0] == 1440 and days.count() < 700
    ends = chunks.withColumn("_HEAD", F.struct(F.col("_CHUNK").alias("v"))).withColumn("_TAIL", F.struct((F.col("_CHUNK") + 1).alias("v")))
    beside = chunk_neighbours(ends)
    assert beside.where("_PREV_TAIL IS NULL").count() == 1 and beside.where("_NEXT_HEAD IS NULL").count() == 1
    assert beside.where("_PREV_TAIL.v <> _CHUNK - 59999999 OR _NEXT_HEAD.v <> _CHUNK + 60000000").isEmpty()


def test_two_levels_equal_one_over_many_days(spark):
    rng = random.Random(4)
    rows = [("ab"[i % 2], T0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 30)), rng.choice([0.0, 1.0]), 1.0, 1, 2, 0) for i in range(300)]
    rows += [("c", dt.datetime(1969, 12, 31, 23, 59, 58) + dt.timedelta(seconds=i), float(i % 2), 1.0, 1, 2, 0) for i in range(5)]
    rd = materialize(spark.createDataFrame(rows, S.READINGS_SCHEMA).dropDuplicates([S.DEVICE_ID, S.TIMESTAMP]))
    for make in (lambda c: island_ids(rd, c), lambda c: neighbours(rd, [S.FLOW_RATE], c)):
        want = sorted(map(repr, make("auto").collect()))
        assert all(sorted(map(repr, make(c).collect())) == want for c in (600, 7200, 3 * 86_400))


def test_tables_are_measured_as_they_are_written(spark):
    df = spark.createDataFrame([("ab", T0), ("c", None)], f"{S.DEVICE_ID} string, {S.START} timestamp_ntz")
    out, seen = small_table(df, first=F.min(S.START))
    assert (seen.n, seen.ids, seen.first, seen.fits) == (2, 3, T0, True) and out.count() == 2
    assert not small_table(df, max_bytes=10)[1].fits
    assert measured(df.where("false"), n=F.count("*"), first=F.min(S.START))[1] == (0, None)
