"""Scalar column functions (time arithmetic on ``timestamp_ntz``)."""

from flowruns.functions.timecols import (
    add_seconds,
    day_diff,
    epoch_micros,
    epoch_seconds,
    next_day,
    ntz,
    seam_bounds,
    trunc_day,
    trunc_second,
)

__all__ = [
    "add_seconds",
    "day_diff",
    "epoch_micros",
    "epoch_seconds",
    "next_day",
    "ntz",
    "seam_bounds",
    "trunc_day",
    "trunc_second",
]
