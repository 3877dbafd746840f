"""Plain-Python statement of the run semantics, for small hand-made inputs."""

from __future__ import annotations

import math
import statistics


def _epoch_s(t):
    import datetime as dt
    return math.floor((t - dt.datetime(1970, 1, 1)).total_seconds())


def _sd(xs):
    xs = [x for x in xs if x is not None]
    if not xs:
        return None
    if len(xs) == 1 or any(math.isnan(x) for x in xs):
        return 0.0
    return statistics.stdev(xs)


def runs(readings):
    """readings: dicts with DEVICE_ID, TIMESTAMP, FLOW_RATE, PRESSURE, TEMPERATURE, MODE."""
    out = []
    by_dev = {}
    for r in readings:
        if r["DEVICE_ID"] is None or r["TIMESTAMP"] is None:
            continue
        by_dev.setdefault(r["DEVICE_ID"], []).append(r)
    for dev, rs in by_dev.items():
        rs.sort(key=lambda r: r["TIMESTAMP"])
        cur = []
        for r in rs + [None]:
            idle = r is None or (r["FLOW_RATE"] is not None and r["FLOW_RATE"] == 0.0)
            if not idle:
                cur.append(r)
                continue
            if cur:
                f = [x["FLOW_RATE"] for x in cur if x["FLOW_RATE"] is not None]
                p = [x["PRESSURE"] for x in cur if x["PRESSURE"] is not None]
                t = [x["TEMPERATURE"] for x in cur if x["TEMPERATURE"] is not None]
                out.append({
                    "DEVICE_ID": dev,
                    "START_TIMESTAMP": cur[0]["TIMESTAMP"],
                    "END_TIMESTAMP": cur[-1]["TIMESTAMP"],
                    "RECORDS": len(cur),
                    "MAX_FLOW_RATE": max(f) if f else None,
                    "SUM_FLOW_RATE": sum(f) if f else None,
                    "AVG_FLOW_RATE": sum(f) / len(f) if f else None,
                    "MIN_TEMPERATURE": min(t) if t else None,
                    "MAX_TEMPERATURE": max(t) if t else None,
                    "MIN_PRESSURE": min(p) if p else None,
                    "MAX_PRESSURE": max(p) if p else None,
                    "SD_PRESSURE": _sd(p),
                    "SD_FLOW_RATE": _sd(f),
                    "SYSTEM_MODE_2": sum(1 for x in cur if x["MODE"] == 2),
                    "SYSTEM_MODE_3": sum(1 for x in cur if x["MODE"] == 3),
                    "SYSTEM_MODE_5": sum(1 for x in cur if x["MODE"] == 5),
                    "DURATION": _epoch_s(cur[-1]["TIMESTAMP"]) - _epoch_s(cur[0]["TIMESTAMP"]),
                })
            cur = []
    return out
