"""Repair properties on the driver's data: batches + repair = whole-history runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowruns import schema as S
from flowruns.operators.repair import dedupe_same_end, dedupe_same_start
from flowruns.operators.runs import nonzero_readings
from flowruns.plans import jobs
from flowruns.plans.jobs import materialize
from flowruns.sources import fixtures as FX
from flowruns.sources.readers import readings
from flowruns.streaming.incremental import apply_new_readings

KEYS = [S.DEVICE_ID, S.START, S.END, S.RECORDS]


def keyset(df):
    return sorted(tuple(r) for r in df.select(*KEYS).collect())


@pytest.fixture(scope="module")
def rd(spark):
    return readings(spark, SF_SMALL)


@pytest.fixture(scope="module")
def whole(rd):
    return keyset(FX.runs_whole(rd))


def test_fixture_sizes(rd, whole):
    assert len(whole) == 170
    assert FX.runs_daily(rd).count() == 407


def test_records_add_up_to_flowing_readings(rd):
    total = FX.runs_whole(rd).agg(F.sum(S.RECORDS)).first()[0]
    assert total == nonzero_readings(rd).count()


def test_consolidate_one_cut(rd, whole):
    assert keyset(jobs.consolidate(rd, FX.runs_cut(rd), FX.CUT)) == whole


def test_consolidate_is_idempotent(rd, whole):
    assert keyset(jobs.consolidate(rd, FX.runs_whole(rd), FX.CUT)) == whole


def test_daily_batches_repaired_cut_by_cut(rd, whole):
    runs = materialize(FX.runs_daily(rd))
    day = dt.datetime(2024, 1, 2)
    while day <= dt.datetime(2024, 1, 31):
        runs = materialize(jobs.consolidate(rd, runs, day.strftime("%Y-%m-%d %H:%M:%S")))
        day += dt.timedelta(days=1)
    assert keyset(runs) == whole


def test_capped_consolidation_repairs_the_devices_within_the_cap_and_names_the_others(rd, whole):
    cut = FX.runs_cut(rd)
    late = {r[S.DEVICE_ID] for r in jobs.deferred_extents(cut, FX.CUT, 2.0).collect()}
    out = set(keyset(jobs.consolidate(rd, cut, FX.CUT, cap_days=2.0)))
    want = {k for k in whole if k[0] not in late} | {k for k in keyset(cut) if k[0] in late}
    assert out == want and late and set(keyset(cut)) != out


def test_wide_seam_repair_equals_whole(rd, whole):
    cut = FX.runs_cut(rd)
    s = cut.where(F.col(S.START) >= FX.ts(FX.CUT)).select(F.min(S.START)).first()[0]
    assert keyset(jobs.repair_seam(rd, cut, s, seam_seconds=40 * 86400)) == whole


def test_seam_keeps_fragments_separated_by_a_zero(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(minutes=i), f, 1.0, 20, 2, 0)
            for i, f in enumerate([1.0, 2.0, 0.0, 3.0, 4.0])]
    rdf = spark.createDataFrame(rows, S.READINGS_SCHEMA)
    cut = "2024-01-01 00:02:30"  # after the zero: fragments are real runs
    runs = FX.runs_cut(rdf, cut)
    out = jobs.repair_seam(rdf, runs, FX.ts(cut), seam_seconds=3600)
    assert keyset(out) == keyset(runs) and len(keyset(out)) == 2
    cut2 = "2024-01-01 00:00:30"  # inside the first run: bridged
    out2 = jobs.repair_seam(rdf, FX.runs_cut(rdf, cut2), FX.ts("2024-01-01 00:01:00"), seam_seconds=3600)
    assert keyset(out2) == keyset(FX.runs_whole(rdf))


def test_dedupe_leaves_unique_keys(rd, whole):
    out = dedupe_same_end(dedupe_same_start(FX.runs_cut_with_bridges(rd)))
    ks = keyset(out)
    assert len({(d, s) for d, s, _, _ in ks}) == len(ks)
    assert len({(d, e) for d, _, e, _ in ks}) == len(ks)
    assert ks == whole


def test_incremental_from_nothing_and_with_lateness(spark, rd, whole):
    empty = FX.empty_checkpoints(spark)
    out, ck = jobs.incremental(rd, spark.createDataFrame([], S.RUNS_SCHEMA), empty)
    assert keyset(out) == whole and ck.count() == 1
    out, _ = jobs.incremental(rd, FX.runs_before(rd), empty, lateness_seconds=2 * 86400)
    assert keyset(out) == whole


def test_incremental_two_batches_with_checkpoint_table(spark, rd, whole):
    first = rd.where(F.col(S.TIMESTAMP) < FX.ts("2024-01-10 00:00:00"))
    runs, ck = jobs.incremental(first, spark.createDataFrame([], S.RUNS_SCHEMA), FX.empty_checkpoints(spark))
    runs, ck = materialize(runs), materialize(ck)
    second = rd.where(F.col(S.TIMESTAMP) < FX.ts("2024-01-20 00:00:00"))
    runs, ck2 = jobs.incremental(second, runs, ck)
    runs = materialize(runs)
    runs, _ = jobs.incremental(rd, runs, ck.unionByName(ck2))
    assert keyset(runs) == whole


def test_late_readings_are_folded_in_exactly(rd, whole):
    late = F.xxhash64(S.DEVICE_ID, S.TIMESTAMP) % 10 == 0  # a tenth of the readings arrive late
    on_time = rd.where(~late)
    runs = materialize(FX.runs_whole(on_time))
    table, changed = apply_new_readings(rd, runs, rd.where(late))
    assert keyset(table) == whole
    assert changed.count() > 0


@pytest.mark.parametrize("tz", ["America/Los_Angeles", "Asia/Tokyo"])
def test_jobs_do_not_depend_on_session_zone(spark, rd, whole, tz):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        assert keyset(jobs.consolidate(rd, materialize(FX.runs_cut(rd)), FX.CUT)) == whole
        out, _ = jobs.incremental(rd, materialize(FX.runs_before(rd)), FX.empty_checkpoints(rd.sparkSession))
        assert keyset(out) == whole
        table, _ = apply_new_readings(rd, materialize(FX.runs_before(rd)),
                                      rd.where(F.col(S.TIMESTAMP) >= FX.ts(FX.CUT)))
        assert keyset(table) == whole
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_consolidate_range_equals_cut_by_cut(rd, whole):
    daily = materialize(FX.runs_daily(rd))
    assert keyset(jobs.consolidate_range(rd, daily, FX.DAILY_FROM, FX.DAILY_TO)) == whole
    # a narrower range joins only the cuts inside it
    part = keyset(jobs.consolidate_range(rd, daily, "2024-01-10 00:00:00", "2024-01-12 00:00:00"))
    assert len(whole) < len(part) < daily.count()
