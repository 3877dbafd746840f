"""Confirm runs that a batch boundary cut in two, and replace
their fragments in the run table.

Rule (ours): a recomputed run *bridges* fragments when it starts where a stored run
starts, ends where a stored run ends, and is not itself a stored run. Only such runs
replace anything, and they replace exactly the stored runs they cover. Two stored
fragments that a zero reading really separates recompute to themselves and stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import epoch_seconds
from flowruns.operators.runs import DEFAULT_CHUNK_SECONDS
from flowruns.operators.summary import summarize_runs
from flowruns.sources.scans import scan_extents


def extent_join(recomputed: DataFrame, extents: DataFrame) -> DataFrame:
    """Recomputed runs joined to the extents of their device, carrying ``ACT_*``."""
    x = extents.select(S.DEVICE_ID, F.col(S.START).alias(S.ACT_START), F.col(S.END).alias(S.ACT_END))
    return recomputed.join(x, S.DEVICE_ID, "inner")


def extent_exact(joined: DataFrame) -> DataFrame:
    """Keep recomputed runs whose START and END equal the extent's, in whole seconds."""
    same = ((epoch_seconds(S.ACT_START) == epoch_seconds(S.START))
            & (epoch_seconds(S.ACT_END) == epoch_seconds(S.END)))
    return joined.where(same).drop(S.ACT_START, S.ACT_END)


def recompute_extents(readings: DataFrame, extents: DataFrame,
                      chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (),
                      lo=None, hi=None, broadcast: bool = True) -> DataFrame:
    """Runs of each device recomputed from its readings inside its own extent."""
    return summarize_runs(scan_extents(readings, extents, lo, hi, broadcast), chunk_seconds, tiebreak)


def runs_within(runs: DataFrame, extents: DataFrame) -> DataFrame:
    """Stored runs of a device that overlap that device's extent (the only rows a repair
    inside the extent can touch)."""
    x = extents.select(F.col(S.DEVICE_ID).alias("_xd"), F.col(S.START).alias("_xs"), F.col(S.END).alias("_xe"))
    cond = (runs[S.DEVICE_ID] == x["_xd"]) & (runs[S.START] <= x["_xe"]) & (runs[S.END] >= x["_xs"])
    return runs.join(x, cond, "left_semi")


def confirm_bridges(recomputed: DataFrame, stored: DataFrame) -> DataFrame:
    """Recomputed runs that start at a stored START, end at a stored END, and are new."""
    keys = stored.select(S.DEVICE_ID, S.START, S.END)
    starts = keys.select(S.DEVICE_ID, S.START).distinct()
    ends = keys.select(S.DEVICE_ID, S.END).distinct()
    return (recomputed
            .join(starts, [S.DEVICE_ID, S.START], "left_semi")
            .join(ends, [S.DEVICE_ID, S.END], "left_semi")
            .join(keys, [S.DEVICE_ID, S.START, S.END], "left_anti"))


def replace_covered(runs: DataFrame, bridges: DataFrame) -> DataFrame:
    """Drop every stored run a bridge covers, then add the bridges (by column name)."""
    b = bridges.select(F.col(S.DEVICE_ID).alias("_bd"), F.col(S.START).alias("_bs"), F.col(S.END).alias("_be"))
    cond = (runs[S.DEVICE_ID] == b["_bd"]) & (runs[S.START] >= b["_bs"]) & (runs[S.END] <= b["_be"])
    kept = runs.join(b, cond, "left_anti")
    if S.START_DATE in runs.columns:
        bridges = bridges.withColumn(S.START_DATE, F.to_date(S.START))
    return kept.unionByName(bridges.select(*runs.columns))


def range_delete(runs: DataFrame, extents: DataFrame) -> DataFrame:
    """Delete the runs of a device with ``START >= xs`` and ``END < trunc(xe) + 1s``.

    An anti-join with range residuals, instead of one DELETE statement per extent.
    """
    x = extents.select(F.col(S.DEVICE_ID).alias("_xd"), F.col(S.START).alias("_xs"), F.col(S.END).alias("_xe"))
    cond = ((runs[S.DEVICE_ID] == x["_xd"]) & (runs[S.START] >= x["_xs"])
            & (epoch_seconds(runs[S.END]) <= epoch_seconds(x["_xe"])))
    return runs.join(x, cond, "left_anti")


def duplicate_starts(runs: DataFrame) -> DataFrame:
    """``(DEVICE_ID, START)`` held by more than one run, with the shortest END."""
    return (runs.groupBy(S.DEVICE_ID, S.START)
            .agg(F.count(F.lit(1)).alias("N"), F.min(S.END).alias(S.END))
            .where(F.col("N") > 1))


def duplicate_ends(runs: DataFrame) -> DataFrame:
    """``(DEVICE_ID, END)`` held by more than one run, with the latest START."""
    return (runs.groupBy(S.DEVICE_ID, S.END)
            .agg(F.count(F.lit(1)).alias("N"), F.max(S.START).alias(S.START))
            .where(F.col("N") > 1))


def _keep_first(runs: DataFrame, duplicates: DataFrame, keys: list[str], order) -> DataFrame:
    """One run, the first by ``order``, of each of the ``duplicates``' keys; all other runs as they are.

    Only the runs of duplicate keys are sorted; the others pass an anti-join on the keys."""
    dup = duplicates.select(*keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    first = (runs.join(dup, keys, "left_semi").withColumn("_rn", F.row_number().over(w))
             .where(F.col("_rn") == 1).drop("_rn"))
    return runs.join(dup, keys, "left_anti").unionByName(first)


def dedupe_same_start(runs: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """Of the runs sharing ``(DEVICE_ID, START)`` keep one, the longest.

    Exact duplicates keep one copy (a DELETE ... USING removes every copy). ``duplicates`` passes the
    result of ``duplicate_starts`` when the caller has it.
    """
    duplicates = duplicate_starts(runs) if duplicates is None else duplicates
    return _keep_first(runs, duplicates, [S.DEVICE_ID, S.START], [F.col(S.END).desc(), F.col(S.RECORDS).desc()])


def dedupe_same_end(runs: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """Of the runs sharing ``(DEVICE_ID, END)`` keep one, the earliest-starting."""
    duplicates = duplicate_ends(runs) if duplicates is None else duplicates
    return _keep_first(runs, duplicates, [S.DEVICE_ID, S.END], [F.col(S.START).asc(), F.col(S.RECORDS).desc()])
