"""The stream's state of open runs, against full recomputes and by hand."""

import datetime as dt
import random
import tempfile

import pytest

from brute import runs as brute_runs
from flowruns import schema as S
from flowruns.sources import sinks, versions
from flowruns.streaming.incremental import process_batch
from flowruns.streaming.state import COMPACT_AFTER, build_state, read_state

T0 = dt.datetime(2024, 1, 1)
FIGURES = ["RECORDS", "SUM_FLOW_RATE", "AVG_FLOW_RATE", "SD_FLOW_RATE", "SD_PRESSURE", "MIN_PRESSURE", "MAX_TEMPERATURE", "SYSTEM_MODE_2", "DURATION"]


def record(d, m, f):
    t = None if m is None else T0 + dt.timedelta(minutes=m)
    return {"DEVICE_ID": d, "TIMESTAMP": t, "FLOW_RATE": f, "PRESSURE": None if (m or 0) % 3 == 0 else (m or 0) / 7, "TEMPERATURE": (m or 0) % 50,
            "MODE": (m or 0) % 4, "VALVE_STATE": 0}


def frame(spark, rows):
    return spark.createDataFrame([tuple(record(*r).values()) for r in rows], S.READINGS_SCHEMA)


def shown(values):
    return tuple((str(v) if v != v else round(v, 6)) if isinstance(v, float) else v for v in values)


def plain(rows):
    return sorted(shown(r[c] for c in ["DEVICE_ID", "START_TIMESTAMP", "END_TIMESTAMP", *FIGURES]) for r in brute_runs([record(*r) for r in rows]))


def table(spark, path):
    return sorted(shown(r) for r in sinks.read_runs(spark, path).select(S.DEVICE_ID, S.START, S.END, *FIGURES).collect())


def never():
    raise AssertionError("readings in time order must not read the source")


def folder():
    return f"{tempfile.mkdtemp(prefix='flowruns-test-')}/runs"


def deliver(spark, path, batches, source=None):
    seen = []
    for rows in batches:
        seen += rows
        process_batch(spark, frame(spark, rows), source or (lambda: frame(spark, seen)), path, keep_state=True)
        assert table(spark, path) == plain(seen)
    return versions.latest(spark, path)


def state_of(spark, v):
    return sorted((r[0], int((r[1] - T0).total_seconds() // 60), r[2] and int((r[2][S.START] - T0).total_seconds() // 60))
                  for r in read_state(spark, v).collect())


def test_in_order_needs_neither_source_nor_other_dates(spark):
    path, day = folder(), 1440
    v = deliver(spark, path, [
        [("a", 0, 1.0), ("a", 5, 2.0), ("b", 1, 0.0)],            # a is open, b has no run
        [("a", day, 3.0), ("a", day + 1, 0.0), ("a", day + 2, 4.0)],  # continues a's run, closes it, opens another
        [("b", 2 * day, 1.0)],
        [("a", 2 * day, 0.0), ("b", 2 * day + 1, None)],          # closes a without any run; NULL is not idle
        [("a", 3 * day, 5.0), ("c", 3 * day, 1.0)],
    ], never)
    assert state_of(spark, v) == [("a", 3 * day, 3 * day), ("b", 2 * day + 1, 2 * day), ("c", 3 * day, 3 * day)]
    assert v.changed_since(v.number - 1) == [dt.date(2024, 1, 4)]  # the last delivery wrote its own date alone


def test_only_folders_of_changed_dates_are_read(spark, monkeypatch):
    path = folder()
    deliver(spark, path, [[("a", d * 1440 + k, float(k > 0)) for k in range(4)] for d in range(6)], never)
    plans, publish = [], versions.publish

    def watched(base, rows, *more):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return publish(base, rows, *more)

    monkeypatch.setattr(versions, "publish", watched)
    process_batch(spark, frame(spark, [("a", 5 * 1440 + 10, 2.0)]), never, path, keep_state=True)
    scans = [line for line in plans[0].splitlines() if "Scan parquet" in line and "PUBLISH=" in line]
    assert scans and all("PartitionFilters: [" in s and "START_DATE" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_ties_nulls_and_repeats(spark):
    deliver(spark, folder(), [
        [("a", 0, 1.0), ("a", 0, 1.0), (None, 3, 1.0), ("a", None, 1.0)],
        [("a", 0, 0.0)],                       # idle at the last time: closes the run
        [("a", 7, 1.0), ("a", 7, 0.0)],        # a run and its end at one time
        [("a", 8, float("nan")), ("a", 9, 2.0)],
        [("a", 9, 2.0), ("a", 9, 2.0)],        # repeats of the last reading
        [("a", 10, -0.0)],
    ])


@pytest.mark.parametrize("late,open_from", [
    ([("a", 15, 0.0)], 20),                       # splits the open run
    ([("a", -5, 3.0)], -5),                       # lengthens it to the left
    ([("a", 30, 0.0)], None),                     # idle at the last time
    ([("a", 25, 0.0), ("a", 40, 1.0)], 30),       # late and in order at once
    ([("a", -50, 0.0)], 0),                       # an idle reading in a gap changes nothing
    ([("a", 40, 0.0), ("a", 12, 1.0)], None),
])
def test_late_readings(spark, late, open_from):
    path = folder()
    first = [("a", m, 1.0) for m in (0, 10, 20, 30)] + [("z", 30, 1.0)]
    v = deliver(spark, path, [first, late])
    assert state_of(spark, v)[0] == ("a", max(30, *(m for _, m, _ in late)), open_from)
    seen = first + late
    more = [("a", 50, 2.0), ("z", 60, 0.0)]
    process_batch(spark, frame(spark, more), never, path, keep_state=True)
    assert table(spark, path) == plain(seen + more)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_deliveries(spark, seed):
    rng = random.Random(seed)
    rows = sorted(((d, m, rng.choice([0.0, 1.0, 2.0, None])) for d in "abc" for m in rng.sample(range(60 * 24 * 5), 60 if d == "a" else 20)), key=lambda r: r[1])
    for _ in range(6):  # some come late
        rows.insert(rng.randrange(len(rows)), rows.pop(rng.randrange(len(rows))))
    cuts = [0, 30, 45, 46, 80, len(rows)]
    v = deliver(spark, folder(), [rows[a:b] for a, b in zip(cuts, cuts[1:])])
    assert read_state(spark, v).count() == 3


def test_replay_other_job_compaction_and_vacuum(spark):
    path = folder()
    batches = [[("a", 10 * k, 1.0), ("b", 10 * k, float(k % 3))] for k in range(COMPACT_AFTER + 3)]
    v = deliver(spark, path, batches, never)
    assert 1 <= len(v.state) < COMPACT_AFTER
    seen = [r for b in batches for r in b]
    process_batch(spark, frame(spark, batches[-1]), lambda: frame(spark, seen), path, keep_state=True)  # a replayed micro-batch
    assert table(spark, path) == plain(seen)

    # a job without state publishes the same rows: the next micro-batch builds the state again
    base = versions.latest(spark, path)
    days = sorted(base.dates)
    versions.publish(base, versions.read_version(spark, base), days)
    assert versions.latest(spark, path).state is None
    more = [("a", 500, 0.0), ("b", 500, 1.0)]
    process_batch(spark, frame(spark, more), lambda: frame(spark, seen + more), path, keep_state=True)
    assert table(spark, path) == plain(seen + more)
    assert state_of(spark, versions.latest(spark, path)) == state_by_rows(spark, seen + more)
    process_batch(spark, frame(spark, [("b", 510, 2.0)]), never, path, keep_state=True)
    assert table(spark, path) == plain(seen + more + [("b", 510, 2.0)])
    gone = versions.vacuum(spark, path, keep=1, older_than_seconds=-5)
    assert any(g.startswith("_state/") for g in gone)
    assert table(spark, path) == plain(seen + more + [("b", 510, 2.0)])
    assert read_state(spark, versions.latest(spark, path)).count() == 2


def state_by_rows(spark, rows):
    return sorted((r[0], int((r[1] - T0).total_seconds() // 60), r[2] and int((r[2][S.START] - T0).total_seconds() // 60))
                  for r in build_state(frame(spark, rows)).collect())


def test_nothing(spark):
    path = folder()
    process_batch(spark, frame(spark, []), never, path, keep_state=True)
    assert versions.latest(spark, path).number == 0
    process_batch(spark, frame(spark, [(None, 3, 1.0)]), never, path, keep_state=True)
    assert sinks.read_runs(spark, path).count() == 0
    assert build_state(frame(spark, [])).count() == 0
