"""Which parts of the stored runs a set of new readings can change, as disjoint intervals per device.

A new reading inside a stored run changes that run and no other. One in a gap between two runs does nothing if it is
idle, and may start a run, or lengthen either of its neighbours, if it is flowing. So the new readings of a device become
spans (one per hour in which it has any), each widened to the stored runs it touches, and where something flows to
the run before and the run after it; spans that then overlap are joined. Recomputing each interval from the source alone gives
exactly the runs of the whole history there: a late reading costs the runs beside it, not the device's later history.

The run before, around and after a span are looked up through a table of one row per device and hour (its first and
last run, by partial aggregates) and, inside an hour, by a join on (device, hour); spans too many to broadcast are put beside the
runs of their hour by one shuffle of both. No window holds more than a device's hours or an hour's runs of a device, and
no join more than the latter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions.timecols import US_SQL
from flowruns.operators.runs import clean
from flowruns.session import broadcast_if_small, materialize, measured, small_side, small_table
from flowruns.sources.versions import Version

HOUR_US = 3_600_000_000


def _hour(c: str) -> Column:
    us = US_SQL.format(c=c)
    return F.expr(f"({us} - pmod({us}, {HOUR_US})) div {HOUR_US}")


def touched_spans(new_readings: DataFrame) -> DataFrame:
    """(DEVICE_ID, _HOUR, _LO, _HI, _FLOWS): first and last new reading of a device in an hour, and whether any flows."""
    flows = F.coalesce(F.col(S.FLOW_RATE) != F.lit(0.0), F.lit(True))
    return (clean(new_readings).groupBy(S.DEVICE_ID, _hour(S.TIMESTAMP).alias("_HOUR"))
            .agg(F.min(S.TIMESTAMP).alias("_LO"), F.max(S.TIMESTAMP).alias("_HI"), F.bool_or(flows).alias("_FLOWS")))


class Spans(NamedTuple):
    """The ``touched_spans`` of some readings, written out, with the first ``_LO`` and the last ``_HI``."""

    table: DataFrame
    lo: Any
    hi: Any


def known_spans(new_readings: DataFrame) -> Spans:
    spans, seen = measured(touched_spans(new_readings), lo=F.min("_LO"), hi=F.max("_HI"))
    return Spans(spans, seen.lo, seen.hi)


def neighbour_runs(runs: DataFrame, spans: DataFrame, few: bool = False) -> DataFrame:
    """The spans with ``_P`` and ``_Q``, the last run that starts at or before ``_LO`` and before or at ``_HI``, and ``_N``, the
    first that starts after ``_HI`` (structs of START and END; null where ``runs`` has none). ``few`` spans are joined to the runs
    where these lie."""
    run = F.when(F.col(S.START).isNotNull(), F.struct(S.START, S.END))
    start = F.col(S.START)
    mine = runs.select(S.DEVICE_ID, S.START, S.END).join(spans.select(S.DEVICE_ID).distinct(), S.DEVICE_ID, "left_semi")
    mine = mine.withColumn("_HOUR", _hour(S.START))
    found = [F.min(run).alias("_HEAD"), F.max(run).alias("_TAIL"), F.max(F.when(start <= F.col("_LO"), run)).alias("_P"),
             F.max(F.when(start <= F.col("_HI"), run)).alias("_Q"), F.min(F.when(start > F.col("_HI"), run)).alias("_N")]
    if few:
        hours = mine.join(spans, [S.DEVICE_ID, "_HOUR"], "left").groupBy(S.DEVICE_ID, "_HOUR").agg(*found)
        every = hours.join(spans, [S.DEVICE_ID, "_HOUR"], "full")
    else:
        hour = Window.partitionBy(S.DEVICE_ID, "_HOUR")
        both = mine.unionByName(spans, allowMissingColumns=True)  # at most one span of an hour
        both = both.withColumns({c: f(c).over(hour) for c, f in (("_LO", F.max), ("_HI", F.max), ("_FLOWS", F.bool_or))})
        every = both.groupBy(S.DEVICE_ID, "_HOUR").agg(*found, F.max("_LO").alias("_LO"), F.max("_HI").alias("_HI"), F.bool_or("_FLOWS").alias("_FLOWS"))
    w = Window.partitionBy(S.DEVICE_ID).orderBy("_HOUR")
    before = F.last("_TAIL", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_HEAD", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return (every.withColumn("_P", F.coalesce("_P", before)).withColumn("_Q", F.coalesce("_Q", before))
            .withColumn("_N", F.coalesce("_N", after)).where(F.col("_LO").isNotNull())
            .select(S.DEVICE_ID, "_HOUR", "_LO", "_HI", "_FLOWS", "_P", "_Q", "_N"))


def _ends_inside() -> Column:
    """A stored run holds the end of the span."""
    return F.coalesce(F.col("_Q")[S.END] >= F.col("_HI"), F.lit(False))


def located(runs: DataFrame, known: Spans, version: Version) -> DataFrame:
    """``neighbour_runs`` over the whole table. Of a stored ``version`` only the folders are read that can hold a run inside or
    around the spans. A neighbour beyond those is the same run for all spans of a device that lack it, so it is looked up
    once for the device (``nearest_runs``)."""
    spans, lo, hi = known
    days = sorted(version.dates)
    if lo is None or not days:
        return neighbour_runs(runs.where(F.lit(False)), spans, few=True)
    inside = [i for i, d in enumerate(days) if lo.date() <= d <= hi.date()]
    first, last = (inside[0], inside[-1]) if inside else (sum(d < lo.date() for d in days),) * 2
    low, high = max(0, first - 1), min(len(days), last + 2)
    around = version.ending(lo) & (F.col(S.START_DATE) <= F.lit(hi.date()))  # runs that reach into the spans
    spans, few = broadcast_if_small(spans)
    found = neighbour_runs(runs.where(version.on(days[low:high]) | around), spans, few)
    if low == 0 and high == len(days):
        return found
    # what lies beyond the folders read cannot matter to an idle span, nor to one with both neighbours
    found, p = materialize(found), F.col("_P")
    far = F.lit(low > 0) & (p.isNull() | (p[S.END] < F.col("_LO")) & (F.to_date(p[S.START]) < F.lit(days[low])))
    open_end = F.lit(high < len(days)) & F.col("_N").isNull() & ~_ends_inside()
    lacking = materialize(found.where(F.col("_FLOWS") & (far | open_end)).groupBy(S.DEVICE_ID).agg(
        F.bool_or(far).alias("_FAR"), F.bool_or(open_end).alias("_OPEN")))
    before = nearest_runs(runs, lacking.where("_FAR"), version, days[:low][::-1], F.max)
    after = nearest_runs(runs, lacking.where("_OPEN"), version, days[high:], F.min)
    if before is not None:
        found = found.join(before.withColumnRenamed("_RUN", "_BEFORE"), S.DEVICE_ID, "left")
        found = found.withColumn("_P", F.greatest("_P", "_BEFORE")).withColumn("_Q", F.greatest("_Q", "_BEFORE"))
    if after is not None:
        found = found.join(after.withColumnRenamed("_RUN", "_AFTER"), S.DEVICE_ID, "left").withColumn("_N", F.coalesce("_N", "_AFTER"))
    return found.select(*spans.columns, "_P", "_Q", "_N")


def nearest_runs(runs: DataFrame, devices: DataFrame, version: Version, days: list, pick: Callable[[Column], Column]) -> DataFrame | None:
    """(DEVICE_ID, _RUN): the first or last run (``pick``: F.min or F.max of START and END) that each of the ``devices`` has on the
    ``days`` of a stored version, which come nearest first and are read in steps that double, for the devices not found yet."""
    step, found = 4, []
    left, seen = small_table(devices.select(S.DEVICE_ID))
    while days and seen.n:
        near = runs.where(version.on(days[:step])).join(left, S.DEVICE_ID, "left_semi")
        found.append(materialize(near.groupBy(S.DEVICE_ID).agg(pick(F.struct(S.START, S.END)).alias("_RUN"))))
        days, step = days[step:], 2 * step
        if days:
            left, seen = small_table(left.join(found[-1], S.DEVICE_ID, "left_anti"))
    return small_side(reduce(DataFrame.unionByName, found)) if found else None


def late_intervals(runs: DataFrame, new_readings: DataFrame | Spans, version: Version | None = None) -> DataFrame:
    """(DEVICE_ID, START, END, _INTERVAL): disjoint closed intervals outside which ``new_readings`` (or the readings of these
    spans) change no run.

    At most one row per device and hour with new readings. Every stored run lies inside one interval or outside all."""
    if version is None:
        x = neighbour_runs(runs, new_readings.table if isinstance(new_readings, Spans) else touched_spans(new_readings))
    else:
        x = located(runs, new_readings if isinstance(new_readings, Spans) else known_spans(new_readings), version)
    lo, hi, flows = F.col("_LO"), F.col("_HI"), F.col("_FLOWS")
    inside = F.coalesce(F.col("_Q")[S.END] >= lo, F.lit(False))  # a stored run meets the span
    device = Window.partitionBy(S.DEVICE_ID)
    lonely = flows & F.coalesce("_P", "_Q", "_N").isNull()  # a device without runs: its new readings may be one
    frm = F.when(lonely, F.min("_LO").over(device)).when(flows | (F.col("_P")[S.END] >= lo), F.col("_P")[S.START])
    to = F.greatest(F.col("_Q")[S.END], F.when(flows & ~_ends_inside(), F.col("_N")[S.END]), F.when(lonely, F.max("_HI").over(device)))
    x = x.select(S.DEVICE_ID, F.least(lo, frm).alias(S.START), F.greatest(hi, to).alias(S.END), (flows | inside).alias("_USED")).where("_USED")
    w = Window.partitionBy(S.DEVICE_ID).orderBy(S.START, S.END)
    reach = F.max(S.END).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_NEW", F.when(F.col(S.START) <= reach, 0).otherwise(1))
    x = x.withColumn("_INTERVAL", F.sum("_NEW").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(S.DEVICE_ID, "_INTERVAL").agg(F.min(S.START).alias(S.START), F.max(S.END).alias(S.END)).select(
        S.DEVICE_ID, S.START, S.END, "_INTERVAL")
