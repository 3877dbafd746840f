"""Time arithmetic on ``timestamp_ntz`` columns that does not depend on the session time zone.

Every function returns a built-in Spark expression, so it stays inside whole-stage codegen.
``timestampdiff`` / ``timestampadd`` keep ``timestamp_ntz`` as wall-clock time, unlike a
cast to ``timestamp``, which would shift by the session zone (and break across DST).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(v) -> Column:
    """A ``timestamp_ntz`` value: a Column as is; a ``datetime`` or text as a literal.

    Python datetimes go through their ISO text: ``F.lit(datetime)`` would make a
    session-zone timestamp, and its cast to ``timestamp_ntz`` would move it by the zone.
    """
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        v = v.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(v, dt.date):
        v = v.isoformat()
    return F.lit(str(v)).cast("timestamp_ntz")


US_SQL = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)"


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00:00 of a ``timestamp_ntz``."""
    if isinstance(c, str):
        return F.expr(US_SQL.format(c=c))
    return F.timestamp_diff("MICROSECOND", _epoch(), c)


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since the epoch, floored (F1: 0.9 s and 1.1 s are 0 and 1)."""
    if isinstance(c, str):  # one SQL expression: one call into the JVM
        us = US_SQL.format(c=c)
        return F.expr(f"CAST(({us} - pmod({us}, 1000000)) / 1000000 AS BIGINT)")
    us = epoch_micros(c)
    return ((us - F.pmod(us, F.lit(1_000_000))) / F.lit(1_000_000)).cast("bigint")


def trunc_second(c: Column | str) -> Column:
    """Drop the fraction of a second, keeping ``timestamp_ntz``."""
    us = epoch_micros(c)
    return F.timestamp_add("MICROSECOND", -F.pmod(us, F.lit(1_000_000)), _c(c))


def add_seconds(c: Column | str, seconds: int | Column) -> Column:
    """``c + seconds`` as ``timestamp_ntz``."""
    n = seconds if isinstance(seconds, Column) else F.lit(int(seconds))
    return F.timestamp_add("SECOND", n, _c(c))


def trunc_day(c: Column | str) -> Column:
    """Midnight of the day of ``c``, as ``timestamp_ntz``."""
    return F.to_date(_c(c)).cast("timestamp_ntz")


def next_day(c: Column | str, days: int = 1) -> Column:
    """``days`` after the midnight of ``c``'s day."""
    return F.timestamp_add("DAY", F.lit(int(days)), trunc_day(c))


def day_diff(start: Column | str, end: Column | str) -> Column:
    """whole-second difference in days, as a double."""
    return (epoch_seconds(end) - epoch_seconds(start)).cast("double") / F.lit(86400.0)


def seam_bounds(batch_start, seam_seconds: int = 1) -> dict[str, Column]:
    """the two half-open windows around a batch start ``s``.

    Runs that start in ``[s, trunc(s) + seam)`` or end in ``[trunc(s) - seam, s)`` may be
    fragments of a run cut at ``s``. With ``seam_seconds=1`` these are exactly the
    one-second windows of the hourly job. ``batch_start``: a Column, a column name, or a
    ``datetime`` value.
    """
    s = ntz(batch_start) if isinstance(batch_start, (dt.datetime, dt.date)) else _c(batch_start)
    ts = trunc_second(s)
    return {
        "S": s,
        "S1": add_seconds(ts, seam_seconds),
        "E": add_seconds(ts, -seam_seconds),
        "E1": s,
    }
