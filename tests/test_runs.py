"""Run detection and summary on hand-made readings, against the plain-Python statement."""

import datetime as dt
import math
import random

import pytest

from brute import runs as brute_runs
from flowruns import schema as S
from flowruns.operators.runs import island_bounds, island_ids, neighbours
from flowruns.operators.summary import summarize_runs

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _r(dev, sec, flow, pressure=1.0, temp=20, mode=2):
    return {"DEVICE_ID": dev, "TIMESTAMP": T0 + dt.timedelta(seconds=sec), "FLOW_RATE": flow,
            "PRESSURE": pressure, "TEMPERATURE": temp, "MODE": mode, "VALVE_STATE": 0}


def _df(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in S.READINGS_SCHEMA.fields) for r in rows], S.READINGS_SCHEMA)


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def _check(spark, rows, chunk_seconds=3600):
    got = [r.asDict() for r in summarize_runs(_df(spark, rows), chunk_seconds).collect()]
    want = brute_runs(rows)
    key = lambda r: (r["DEVICE_ID"], r["START_TIMESTAMP"])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want), (got, want)
    for g, w in zip(got, want):
        for k, v in w.items():
            assert _close(g[k], v), (k, g, w)
    return got


def test_all_zero_device_has_no_run(spark):
    assert _check(spark, [_r("a", i, 0.0) for i in range(5)]) == []


def test_single_reading_run(spark):
    got = _check(spark, [_r("a", 0, 0.0), _r("a", 1, 3.0, pressure=2.0), _r("a", 2, 0.0)])
    assert got[0]["RECORDS"] == 1 and got[0]["SD_PRESSURE"] == 0.0 and got[0]["SD_FLOW_RATE"] == 0.0
    assert got[0]["DURATION"] == 0


def test_null_flow_neither_starts_nor_ends_a_run(spark):
    rows = [_r("a", 0, 1.0), _r("a", 1, None), _r("a", 2, 2.0), _r("a", 3, 0.0), _r("a", 4, None)]
    got = _check(spark, rows)
    assert [g["RECORDS"] for g in sorted(got, key=lambda g: g["START_TIMESTAMP"])] == [3, 1]


def test_run_of_only_null_flow(spark):
    got = _check(spark, [_r("a", 0, 0.0), _r("a", 1, None), _r("a", 2, None), _r("a", 3, 0.0)])
    assert got[0]["AVG_FLOW_RATE"] is None and got[0]["SD_FLOW_RATE"] is None


def test_zeros_at_both_ends_and_negative_zero(spark):
    rows = [_r("a", 0, 0.0), _r("a", 1, 1.0), _r("a", 2, -0.0), _r("a", 3, 2.0), _r("a", 4, 0.0)]
    assert len(_check(spark, rows)) == 2


def test_pressure_counts_zero_one_two(spark):
    rows = [_r("a", 0, 1.0, None), _r("a", 1, 0.0),
            _r("a", 2, 1.0, 5.0), _r("a", 3, 0.0),
            _r("a", 4, 1.0, 5.0), _r("a", 5, 1.0, 7.0)]
    got = sorted(_check(spark, rows), key=lambda g: g["START_TIMESTAMP"])
    assert got[0]["SD_PRESSURE"] is None
    assert got[1]["SD_PRESSURE"] == 0.0
    assert math.isclose(got[2]["SD_PRESSURE"], math.sqrt(2.0))


def test_nan_flow_is_not_idle_and_spread_becomes_zero(spark):
    rows = [_r("a", 0, float("nan")), _r("a", 1, 1.0)]
    got = [r.asDict() for r in summarize_runs(_df(spark, rows)).collect()]
    assert len(got) == 1 and got[0]["RECORDS"] == 2 and got[0]["SD_FLOW_RATE"] == 0.0


def test_sub_second_duration_uses_whole_seconds(spark):
    rows = [_r("a", 0.9, 1.0), _r("a", 1.1, 1.0)]
    got = _check(spark, rows)
    assert got[0]["DURATION"] == 1


def test_runs_across_many_chunks_equal_one_chunk(spark):
    rnd = random.Random(7)
    rows = []
    for dev in ("a", "b", "c"):
        for i in range(400):
            flow = 0.0 if rnd.random() < 0.1 else (None if rnd.random() < 0.05 else rnd.uniform(0, 9))
            rows.append(_r(dev, i * 37 + rnd.random(), flow, rnd.choice([None, 1.5, 2.5, 4.0]),
                           rnd.randint(1, 40), rnd.choice([1, 2, 3, 5])))
    for chunk in (60, 600, 86400 * 30):
        _check(spark, rows, chunk)


def test_neighbours_cross_chunk_boundaries(spark):
    rows = [_r("a", i * 50, float(i)) for i in range(40)] + [_r("b", 7, None), _r("b", 9000, 1.0)]
    out = {(r[S.DEVICE_ID], r[S.TIMESTAMP]): r for r in neighbours(_df(spark, rows), [S.FLOW_RATE], 120).collect()}
    for i in range(40):
        r = out[("a", T0 + dt.timedelta(seconds=i * 50))]
        assert r["PREV_FLOW_RATE"] == (float(i - 1) if i else None)
        assert r["NEXT_FLOW_RATE"] == (float(i + 1) if i < 39 else None)
    assert out[("b", T0 + dt.timedelta(seconds=7))]["NEXT_FLOW_RATE"] == 1.0
    assert out[("b", T0 + dt.timedelta(seconds=9000))]["PREV_FLOW_RATE"] is None


def test_run_ids_count_idle_readings(spark):
    rows = [_r("a", 0, 1.0), _r("a", 1, 0.0), _r("a", 2, 0.0), _r("a", 3, 1.0)]
    ids = sorted((r[S.TIMESTAMP], r[S.RUN_ID]) for r in island_ids(_df(spark, rows), 2).collect())
    assert [i for _, i in ids] == [0, 2]


def test_tiebreak_orders_equal_timestamps(spark):
    rows = [_r("a", 0, 1.0), _r("a", 1, 0.0), _r("a", 1, 2.0)]
    rows[1]["VALVE_STATE"], rows[2]["VALVE_STATE"] = 1, 2
    got = summarize_runs(_df(spark, rows), tiebreak=[S.VALVE_STATE]).collect()
    assert sorted(r[S.RECORDS] for r in got) == [1, 1]


@pytest.mark.parametrize("tz", ["America/New_York", "Asia/Kolkata"])
def test_epoch_seconds_do_not_depend_on_session_zone(spark, tz):
    from pyspark.sql import functions as F

    from flowruns.functions import epoch_seconds
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        row = spark.sql("SELECT timestamp_ntz'2024-03-10 01:30:00.9' a, timestamp_ntz'2024-03-10 03:30:00.1' b") \
            .select(epoch_seconds("a").alias("a"), epoch_seconds("b").alias("b"), F.lit(1)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert row["b"] - row["a"] == 7200
    assert row["a"] == 1710034200


def test_session_zone_timestamps_are_accepted(spark):
    from pyspark.sql import functions as F
    rows = [_r("a", 0, 1.0), _r("a", 1, 0.0), _r("a", 2, 2.0), _r("a", 3, 3.0)]
    ntz = _df(spark, rows)
    ltz = ntz.withColumn(S.TIMESTAMP, F.col(S.TIMESTAMP).cast("timestamp"))
    a = sorted(tuple(r) for r in summarize_runs(ntz).select(S.START, S.END, S.RECORDS).collect())
    b = sorted(tuple(r) for r in summarize_runs(ltz).select(S.START, S.END, S.RECORDS).collect())
    assert a == b and len(a) == 2


@pytest.mark.parametrize("chunk", [7, 60, 600, 86400 * 30])
def test_bounds_across_chunks_equal_those_of_the_runs(spark, chunk):
    rnd = random.Random(11)
    rows = []
    for dev, idle in (("a", 0.02), ("b", 0.3), ("c", 0.9), ("d", 0.0), ("e", 1.0)):
        for i in range(200):  # repeated and equal timestamps among them
            flow = 0.0 if rnd.random() < idle else rnd.choice([None, 1.0, 2.0])
            rows.append(_r(dev, rnd.choice([i * 37, 37 * rnd.randrange(200)]), flow))
    df = _df(spark, rows)
    want = summarize_runs(df, 86400 * 30).select(S.DEVICE_ID, S.START, S.END, S.RECORDS)
    got = island_bounds(df, chunk)
    assert got.columns == [*df.columns, S.START, S.END]
    per_run = got.groupBy(S.DEVICE_ID, S.START, S.END).count()
    # runs of one device may share both bounds only when they lie in one instant
    merged = want.groupBy(S.DEVICE_ID, S.START, S.END).sum(S.RECORDS)
    assert sorted(map(tuple, per_run.collect())) == sorted(map(tuple, merged.collect()))
