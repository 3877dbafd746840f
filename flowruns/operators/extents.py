"""Which parts of the run table a repair has to recompute.

All results stay DataFrames; single values (global bounds, checkpoints) are one-row
aggregates used as scalar subqueries, never collected into driver-side strings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import add_seconds, day_diff, next_day, ntz, trunc_day
from flowruns.session import materialize, small_side
from flowruns.sources.versions import Version


def _ts(v) -> Column:
    return ntz(v)


def device_extents(runs: DataFrame) -> DataFrame:
    """Per device, ``min(START)`` and ``max(END)`` of the given runs."""
    return runs.groupBy(S.DEVICE_ID).agg(F.min(S.START).alias(S.START), F.max(S.END).alias(S.END))


def global_extent(extents: DataFrame) -> DataFrame:
    """``min(START)``, ``max(END)`` over all rows (exactly one row)."""
    return extents.agg(F.min(S.START).alias(S.START), F.max(S.END).alias(S.END))


batch_extent = global_extent


def seam_devices(extents: DataFrame) -> DataFrame:
    """The distinct devices to repair."""
    return extents.select(S.DEVICE_ID).distinct()


def first_run_after(runs: DataFrame, at) -> DataFrame:
    """Per device, ``min(END)`` of the runs starting at or after ``at``."""
    return runs.where(F.col(S.START) >= _ts(at)).groupBy(S.DEVICE_ID).agg(F.min(S.END).alias(S.END))


def last_run_before(runs: DataFrame, at) -> DataFrame:
    """Per device, ``max(START)`` of the runs ending before ``at``."""
    return runs.where(F.col(S.END) < _ts(at)).groupBy(S.DEVICE_ID).agg(F.max(S.START).alias(S.START))


def adjacent_extents(runs: DataFrame, before: Column, after: Column) -> DataFrame:
    """J2 in one pass: per device, from the last run on the ``before`` side to the first
    run on the ``after`` side.

    The two grouped aggregates and their inner join become one conditional aggregate:
    one scan of the run table and one (partially aggregated) shuffle.
    """
    agg = runs.groupBy(S.DEVICE_ID).agg(
        F.max(F.when(before, F.col(S.START))).alias(S.START),
        F.min(F.when(after, F.col(S.END))).alias(S.END))
    return agg.where(F.col(S.START).isNotNull() & F.col(S.END).isNotNull())


def last_starts(runs: DataFrame, devices: DataFrame, version: Version | None = None) -> DataFrame:
    """(DEVICE_ID, START): the latest START among the ``runs`` of each of the ``devices``.

    ``version`` is the stored version that ``runs`` was read from: its dates are then read from the newest back, in
    steps that double, for the devices not found yet; most have a run on the newest few."""
    def latest(rows: DataFrame, left: DataFrame) -> DataFrame:
        return rows.join(left, S.DEVICE_ID, "left_semi").groupBy(S.DEVICE_ID).agg(F.max(S.START).alias(S.START))

    if version is None:
        return latest(runs, devices)
    days, step, left, found = sorted(version.dates, reverse=True), 4, small_side(materialize(devices)), []
    while days and not left.isEmpty():
        found.append(materialize(latest(runs.where(version.on(days[:step])), left)))
        left = small_side(materialize(left.join(found[-1], S.DEVICE_ID, "left_anti")))
        days, step = days[step:], 2 * step
    return reduce(DataFrame.unionByName, found) if found else latest(runs, devices)


def consolidate_extents(runs: DataFrame, at) -> DataFrame:
    """The pair of runs on either side of the cut ``at`` of each device."""
    t = _ts(at)
    return adjacent_extents(runs, F.col(S.END) < t, F.col(S.START) >= t)


def capped_extent(extents: DataFrame, cap_days: float = 2.0, window_days: int | None = None) -> DataFrame:
    """The re-read window, capped when the extents span more than ``cap_days``.

    Within the cap the window is ``[min START, max END]``; beyond it, it becomes
    ``[day(min START - 1s), that day + window_days]`` (default: ``cap_days`` whole days).
    One row: ``FROM_TS``, ``TO_TS``, ``DAY_DIFF``, ``CAPPED``.
    """
    days = int(window_days if window_days is not None else max(1, int(cap_days)))
    g = global_extent(extents)
    diff = day_diff(S.START, S.END)
    capped = diff > F.lit(float(cap_days))
    start_day = trunc_day(add_seconds(S.START, -1))
    return g.select(
        F.when(capped, start_day).otherwise(F.col(S.START)).alias("FROM_TS"),
        F.when(capped, next_day(start_day, days)).otherwise(F.col(S.END)).alias("TO_TS"),
        diff.alias("DAY_DIFF"),
        capped.alias("CAPPED"))


def checkpoint_value(checkpoints: DataFrame, dest_runs: DataFrame) -> Column:
    """A12 as a scalar: the newest checkpoint, else the newest END of the destination.

    Both are one-row aggregates evaluated once as scalar subqueries; NULL checkpoints are
    skipped by ``max`` (the old string test against 'null' is not needed).
    """
    ck = checkpoints.select(F.max(S.TIMESTAMP)).scalar()
    de = dest_runs.select(F.max(S.END)).scalar()
    return F.coalesce(ck, de)


def checkpoint_lookup(spark: SparkSession, checkpoints: DataFrame, dest_runs: DataFrame) -> DataFrame:
    """A12 / P7 / O4 as a one-row DataFrame with column ``TIMESTAMP``."""
    return spark.range(1).select(checkpoint_value(checkpoints, dest_runs).alias(S.TIMESTAMP))
