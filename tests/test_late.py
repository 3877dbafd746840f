"""Intervals of late readings, against full recomputes and by hand."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from brute import runs as brute_runs
from flowruns import schema as S
from flowruns.operators.late import late_intervals
from flowruns.operators.summary import summarize_runs
from flowruns.plans.jobs import materialize
from flowruns.sources import sinks, versions
from flowruns.streaming.incremental import apply_new_readings, process_batch

T0 = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    """(device, minutes, flow) rows as readings."""
    return spark.createDataFrame([(d, T0 + dt.timedelta(minutes=m), f, 1.5, 20, 2, 0) for d, m, f in rows], S.READINGS_SCHEMA)


def table(df):
    return sorted((r[0], r[1], r[2], r[3]) for r in df.select(S.DEVICE_ID, S.START, S.END, S.RECORDS).collect())


def plain(rows):
    recs = [{"DEVICE_ID": d, "TIMESTAMP": T0 + dt.timedelta(minutes=m), "FLOW_RATE": f, "PRESSURE": 1.5, "TEMPERATURE": 20, "MODE": 2, "VALVE_STATE": 0} for d, m, f in rows]
    return sorted((r["DEVICE_ID"], r["START_TIMESTAMP"], r["END_TIMESTAMP"], r["RECORDS"]) for r in brute_runs(recs))


def minutes(df):
    return sorted((r[0], int((r[1] - T0).total_seconds() // 60), int((r[2] - T0).total_seconds() // 60)) for r in df.select(S.DEVICE_ID, S.START, S.END).collect())


# three runs of device a: 0-20, 200-220, 5000-5020, with idle readings between
BASE = [("a", m, 1.0) for k in (0, 200, 5000) for m in (k, k + 10, k + 20)] + [("a", m, 0.0) for m in (30, 190, 230, 4990, 5030)] + [("b", 7, 2.0)]


@pytest.mark.parametrize("late,want", [
    ([("a", 5, 1.0)], [("a", 0, 20)]),                    # inside a run: that run alone
    ([("a", 15, 0.0)], [("a", 0, 20)]),                   # idle, splits a run
    ([("a", 220, 0.0)], [("a", 200, 220)]),               # on a run's end
    ([("a", 100, 0.0), ("c", 3, 0.0)], []),               # idle in a gap, or on a device without runs
    ([("a", 100, 1.0)], [("a", 0, 220)]),                 # flows in a gap: both neighbours
    ([("a", 6000, 1.0)], [("a", 5000, 6000)]),            # flows after the last run
    ([("a", -60, 1.0)], [("a", -60, 20)]),                # flows before the first
    ([("a", 5, 1.0), ("a", 5005, 0.0)], [("a", 0, 20), ("a", 5000, 5020)]),  # apart from each other
    ([("c", 3, 1.0), ("c", 300, 1.0)], [("c", 3, 300)]),  # a new device: its readings may be one run
    ([("c", 3, None)], [("c", 3, 3)]),                    # NULL is not idle
])
def test_intervals_by_hand(spark, late, want):
    runs = materialize(summarize_runs(frame(spark, BASE)))
    got = late_intervals(runs, frame(spark, late))
    assert minutes(got) == want
    now, _ = apply_new_readings(frame(spark, BASE + late), runs, frame(spark, late))
    assert table(now) == plain(BASE + late)
    assert got.count() == got.select(S.DEVICE_ID, "_INTERVAL").distinct().count()


def test_one_late_reading_rereads_one_run(spark):
    rows = [("a", m, 0.0 if m % 50 == 49 else 1.0) for m in range(5000)]
    late = [("a", 2525, 0.0)]
    spans = late_intervals(materialize(summarize_runs(frame(spark, rows))), frame(spark, late))
    r = frame(spark, rows)
    x = spans.first()
    assert r.where(F.col(S.TIMESTAMP).between(F.lit(x[S.START]).cast("timestamp_ntz"), F.lit(x[S.END]).cast("timestamp_ntz"))).count() == 49
    assert spans.count() == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_random_deliveries_to_a_stored_table_equal_a_recompute(spark, seed):
    rng = random.Random(seed)
    rows = [(d, m, rng.choice([0.0, 0.0, 1.0, 2.0, None])) for d in "abc" for m in rng.sample(range(60 * 24 * 40), 90 if d == "a" else 25)]
    rng.shuffle(rows)
    path = f"{tempfile.mkdtemp(prefix='flowruns-test-')}/runs"
    cuts = [0, 60, 75, 76, 110, len(rows)]
    for a, b in zip(cuts, cuts[1:]):
        process_batch(spark, frame(spark, rows[a:b]), lambda: frame(spark, rows[:b]), path)
        assert table(sinks.read_runs(spark, path)) == plain(rows[:b])


def test_neighbours_far_away_are_found_step_by_step(spark):
    """Device a has runs 300 dates apart, device z one on every date between."""
    far = 300 * 1440
    rows = [("a", 0, 1.0), ("a", far, 1.0), ("a", 5, 0.0), ("a", far - 5, 0.0)] + [("z", k * 1440 + j, float(j == 7)) for k in range(301) for j in (6, 7, 8)]
    path = f"{tempfile.mkdtemp(prefix='flowruns-test-')}/runs"
    version = sinks.write_runs(summarize_runs(frame(spark, rows)), path)
    assert len(version.dates) == 301
    late = [("a", far // 2, 1.0)]
    assert minutes(late_intervals(sinks.read_runs(spark, path), frame(spark, late), version)) == [("a", 0, far)]
    process_batch(spark, frame(spark, late), lambda: frame(spark, rows + late), path)
    assert table(sinks.read_runs(spark, path)) == plain(rows + late)
    assert len(versions.latest(spark, path).changed_since(1)) == 3


def test_no_new_readings(spark):
    runs = summarize_runs(frame(spark, BASE))
    assert late_intervals(runs, frame(spark, BASE).limit(0)).count() == 0
    assert apply_new_readings(frame(spark, BASE), runs, frame(spark, BASE).limit(0))[1] is None
