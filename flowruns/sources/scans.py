"""The range scans of the jobs, as plain filters and joins that reach the scan.

None of these collects anything to the driver: bounds and device sets stay DataFrames
(one-row aggregates become scalar subqueries, device sets become semi-joins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import epoch_micros, ntz, seam_bounds
from flowruns.sources.versions import Version

# Widths of the buckets of ``scan_extent_buckets`` in microseconds: hour, day, 32 days.
BUCKETS_US = (3_600_000_000, 86_400_000_000, 32 * 86_400_000_000)


def _lit_or_col(v) -> Column:
    return ntz(v)


def scan_half_open(readings: DataFrame, frm, to) -> DataFrame:
    """``frm <= TIMESTAMP < to`` (the back-fill read). Pushed to the parquet scan."""
    ts = F.col(S.TIMESTAMP)
    return readings.where((ts >= _lit_or_col(frm)) & (ts < _lit_or_col(to)))


def scan_after(readings: DataFrame, checkpoint) -> DataFrame:
    """S3: ``TIMESTAMP > checkpoint`` (strict). ``checkpoint`` is a value (pushed to the
    scan) or a Column such as a scalar subquery."""
    return readings.where(F.col(S.TIMESTAMP) > _lit_or_col(checkpoint))


def scan_closed(readings: DataFrame, lo, hi) -> DataFrame:
    """``lo <= TIMESTAMP <= hi``."""
    ts = F.col(S.TIMESTAMP)
    return readings.where((ts >= _lit_or_col(lo)) & (ts <= _lit_or_col(hi)))


def extent_bounds(extents: DataFrame) -> tuple:
    """``(min START, max END)`` of a (small, per-device) extent table: one one-row action,
    so the bounds can reach a scan as literal, pushed-down filters."""
    row = extents.agg(F.min(S.START), F.max(S.END)).first()
    return row[0], row[1]


def scan_closed_devices(readings: DataFrame, extents: DataFrame, lo=None, hi=None) -> DataFrame:
    """Readings of the extents' devices inside ``[min START, max END]`` of all extents.

    Pass the global bounds (``extent_bounds``) to have them pushed to the scan; left out,
    they are scalar subqueries. The device list is a left-semi join instead of a pasted
    IN list, so it can hold any number of devices and any device id.
    """
    lo = extents.select(F.min(S.START)).scalar() if lo is None else _lit_or_col(lo)
    hi = extents.select(F.max(S.END)).scalar() if hi is None else _lit_or_col(hi)
    ts = F.col(S.TIMESTAMP)
    devices = extents.select(S.DEVICE_ID).distinct()
    return readings.where((ts >= lo) & (ts <= hi)).join(devices, S.DEVICE_ID, "left_semi")


def scan_per_extent(readings: DataFrame, extents: DataFrame, lo=None, hi=None) -> DataFrame:
    """Readings of each device inside that device's own extent ``[START, END]``.

    An equi-join on the device with two range residuals. ``lo`` / ``hi`` (the global
    bounds of all extents) are added as plain filters so the scan skips row groups outside
    every extent: pass them as literals (they then appear in ``PushedFilters``), or leave
    them out to use scalar subqueries. Compared with S4 this re-reads no readings of a
    device outside its own extent.
    """
    lo = extents.select(F.min(S.START)).scalar() if lo is None else _lit_or_col(lo)
    hi = extents.select(F.max(S.END)).scalar() if hi is None else _lit_or_col(hi)
    ts = F.col(S.TIMESTAMP)
    more = [c for c in extents.columns if c not in (S.DEVICE_ID, S.START, S.END)]
    x = extents.select(F.col(S.DEVICE_ID).alias("_xd"), F.col(S.START).alias("_xs"),
                       F.col(S.END).alias("_xe"), *more)
    r = readings.where((ts >= lo) & (ts <= hi))
    cond = (r[S.DEVICE_ID] == x["_xd"]) & (ts >= x["_xs"]) & (ts <= x["_xe"])
    return r.join(x, cond, "inner").drop("_xd", "_xs", "_xe")


def extent_buckets(extents: DataFrame, width_us: int) -> DataFrame:
    """The extents with ``_BUCKET``, a row for each time bucket of the width that they meet."""
    first, last = (F.floor(epoch_micros(c) / width_us) for c in (S.START, S.END))
    return extents.withColumn("_BUCKET", F.explode(F.sequence(first, last)))


def bucket_width(extents: DataFrame, spare_rows: int = 10_000_000) -> int:
    """The narrowest bucket width of ``BUCKETS_US`` at which the extents meet at most ``spare_rows`` buckets, or four each."""
    counts = [F.sum(F.floor(epoch_micros(S.END) / w) - F.floor(epoch_micros(S.START) / w) + 1) for w in BUCKETS_US]
    row = extents.agg(F.count(F.lit(1)), *counts).first()
    fitting = [w for w, n in zip(BUCKETS_US, row[1:]) if (n or 0) <= max(spare_rows, 4 * row[0])]
    return fitting[0] if fitting else BUCKETS_US[-1]


def scan_extent_buckets(readings: DataFrame, extents: DataFrame, lo=None, hi=None, width_us: int | None = None) -> DataFrame:
    """J5 for extents too many to broadcast: an equi-join on (device, time bucket), so that the readings of a hot device
    are dealt over many tasks; the extents' own bounds then decide. Extents of a device must not overlap."""
    width_us = width_us or bucket_width(extents)
    x = extent_buckets(extents, width_us).withColumnsRenamed({S.DEVICE_ID: "_xd", S.START: "_xs", S.END: "_xe", "_BUCKET": "_xb"})
    lo = extents.select(F.min(S.START)).scalar() if lo is None else _lit_or_col(lo)
    hi = extents.select(F.max(S.END)).scalar() if hi is None else _lit_or_col(hi)
    ts = F.col(S.TIMESTAMP)
    r = readings.where((ts >= lo) & (ts <= hi)).withColumn("_BUCKET", F.floor(epoch_micros(S.TIMESTAMP) / width_us))
    cond = (r[S.DEVICE_ID] == x["_xd"]) & (r["_BUCKET"] == x["_xb"]) & (ts >= x["_xs"]) & (ts <= x["_xe"])
    return r.join(x, cond, "inner").drop("_xd", "_xs", "_xe", "_xb", "_BUCKET")


def scan_extents(readings: DataFrame, extents: DataFrame, lo, hi, broadcast: bool) -> DataFrame:
    """J5 by broadcast of the extents, or by time buckets where they are too many."""
    return (scan_per_extent if broadcast else scan_extent_buckets)(readings, extents, lo, hi)


def scan_seam(runs: DataFrame, batch_start, seam_seconds: int = 1, version: Version | None = None) -> DataFrame:
    """Runs that start just after or end just before ``batch_start``.

    ``START in [s, trunc(s)+seam)`` or ``END in [trunc(s)-seam, s)``; both arms reach the
    scan as one pushed OR filter when the bounds are literals.
    """
    b = seam_bounds(_lit_or_col(batch_start), seam_seconds)
    return scan_seam_windows(runs, b["S"], b["S1"], b["E"], b["E1"], version)


def scan_seam_windows(runs: DataFrame, start, start1, end, end1, version: Version | None = None) -> DataFrame:
    """S5 with two windows of their own: runs with START in ``[start, start1)`` or END in ``[end, end1)``.

    ``version`` is the stored version that ``runs`` was read from: only folders of dates in the first window, or
    whose zone meets the second, are then read."""
    st, en = F.col(S.START), F.col(S.END)
    bounds = [_lit_or_col(v) for v in (start, start1, end, end1)]
    out = runs.where(((st >= bounds[0]) & (st < bounds[1])) | ((en >= bounds[2]) & (en < bounds[3])))
    if version is None:
        return out
    s, s1, e, e1 = runs.sparkSession.range(1).select(*bounds).first()  # literals or one-row values
    return out.where(F.col(S.START_DATE).between(F.lit(s.date()), F.lit(s1.date())) | version.ending(e, e1))


def scan_started(runs: DataFrame, lo, hi) -> DataFrame:
    """Runs that start in ``[lo, hi]``. On the stored table the dates also choose the folders read."""
    lo, hi = _lit_or_col(lo), _lit_or_col(hi)
    out = runs.where((F.col(S.START) >= lo) & (F.col(S.START) <= hi))
    if S.START_DATE in runs.columns:
        out = out.where((F.col(S.START_DATE) >= F.to_date(lo)) & (F.col(S.START_DATE) <= F.to_date(hi)))
    return out
