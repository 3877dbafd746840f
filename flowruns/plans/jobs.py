"""The composite jobs.

Each returns the *new* run table as a DataFrame; ``flowruns.sources.sinks`` writes it.
Like any Spark driver program, a job first settles its few single values with one-row
actions (the checkpoint, the global bounds of the extents), so that they reach the
scans as literal, pushed-down filters. The small per-device tables it derives (at most
one row per device) are cut from lineage with a reliable ``checkpoint()`` to the shared
``spark.checkpoint.dir``; nothing else is brought to the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import day_diff, ntz
from flowruns.operators.extents import consolidate_extents, device_extents, last_starts
from flowruns.operators.repair import (
    confirm_bridges,
    dedupe_same_end,
    dedupe_same_start,
    duplicate_ends,
    duplicate_starts,
    range_delete,
    recompute_extents,
    replace_covered,
    runs_within,
)
from flowruns.operators.runs import DEFAULT_CHUNK_SECONDS, Chunks, resolve_chunks
from flowruns.operators.summary import summarize_runs
from flowruns.session import materialize, measured, small_table
from flowruns.sources.scans import scan_extents, scan_half_open, scan_seam, scan_seam_windows, scan_started
from flowruns.sources.versions import Version


def _ts(v) -> Column:
    return ntz(v)


def _settled(extents: DataFrame) -> tuple:
    """An extent table, materialized and marked for broadcast where it fits, and its rows, bounds and whether it
    fits; all in one job."""
    return small_table(extents, lo=F.min(S.START), hi=F.max(S.END))


def backfill(readings: DataFrame, frm, to, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
             tiebreak: Sequence[str] = ()) -> DataFrame:
    """G1: runs of the readings in ``[frm, to)``."""
    return summarize_runs(scan_half_open(readings, frm, to), chunk_seconds, tiebreak)


def bridge_islands(readings: DataFrame, runs: DataFrame, extents: DataFrame,
                   chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (),
                   lo=None, hi=None, broadcast: bool = True) -> DataFrame:
    """J5 + confirmation: recompute each extent from its own readings and keep the runs
    that join stored fragments."""
    recomputed = recompute_extents(readings, extents, chunk_seconds, tiebreak, lo, hi, broadcast)
    return confirm_bridges(recomputed, runs_within(runs, extents))


def repair_extents_delta(readings: DataFrame, runs: DataFrame, extents: DataFrame,
                         chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
                         tiebreak: Sequence[str] = ()) -> tuple[DataFrame, DataFrame | None]:
    """Recompute the given per-device extents and replace the fragments they join.

    Returns ``(new run table, changed start dates)``; the dates are those of the bridges
    and of the fragments they replace (``None`` when nothing could change).
    """
    extents, seen = _settled(extents)
    if not seen.n:
        return runs, None
    lo, hi = seen.lo, seen.hi
    if chunk_seconds == "auto":  # one estimate for the whole repair, from the re-read scope
        chunk_seconds = resolve_chunks(scan_extents(readings, extents, lo, hi, seen.fits))
    # a bridge and all it replaces start between the extents' bounds
    near = scan_started(runs, lo, hi)
    bridges, found = small_table(bridge_islands(readings, near, extents, chunk_seconds, tiebreak, lo, hi, seen.fits))
    if not found.n:
        return runs, None
    b = bridges.select(F.col(S.DEVICE_ID).alias("_bd"), F.col(S.START).alias("_bs"), F.col(S.END).alias("_be"))
    cond = (near[S.DEVICE_ID] == b["_bd"]) & (near[S.START] >= b["_bs"]) & (near[S.END] <= b["_be"])
    changed = start_dates(near.join(b, cond, "left_semi"), bridges)
    return replace_covered(runs, bridges), changed


def delete_delta(runs: DataFrame, extents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``(the runs without those inside their device's extents, changed start dates)``."""
    extents, seen = _settled(extents)
    if not seen.n:
        return runs, None
    lo, hi = seen.lo, seen.hi
    near = scan_started(runs, lo, hi + dt.timedelta(seconds=1))  # END is compared in whole seconds
    gone = near.join(range_delete(near, extents).select(S.DEVICE_ID, S.START, S.END), [S.DEVICE_ID, S.START, S.END], "left_anti")
    return range_delete(runs, extents), start_dates(gone)


def start_dates(*runs: DataFrame) -> DataFrame:
    """The distinct start dates of all the given runs."""
    starts = reduce(DataFrame.unionByName, [r.select(S.START) for r in runs])
    return starts.select(F.to_date(S.START).alias(S.START_DATE)).distinct()


def heal_duplicates(runs: DataFrame, version: Version | None = None, changed: DataFrame | None = None
                    ) -> tuple[DataFrame, DataFrame | None]:
    """S9 then S10 over the whole table: ``(table, changed start dates or None)``.

    Finding the duplicate keys reads three columns; with none, the table is returned as it is. ``version`` is the stored
    version that ``runs`` comes from, and ``changed`` the dates that differ from it: what the last healing left is
    without duplicates, so only the dates written since are searched, and for equal ENDs the dates whose zones meet theirs."""
    fresh = same_end = F.lit(True)
    if version is not None:
        days = set(version.changed_since(version.healed)) | ({r[0] for r in changed.collect()} if changed is not None else set())
        if not days:
            return runs, None
        fresh = version.on(days)
        lo, hi = runs.where(fresh).agg(F.min(S.END), F.max(S.END)).first()
        same_end = fresh if lo is None else fresh | version.ending(lo, hi)
    out = []
    for find, dedupe, keys, where in ((duplicate_starts, dedupe_same_start, [S.DEVICE_ID, S.START], fresh),
                                      (duplicate_ends, dedupe_same_end, [S.DEVICE_ID, S.END], same_end)):
        keyed, seen = small_table(find(runs.where(where)).select(*keys))
        if seen.n:
            out.append(start_dates(runs.where(where).join(keyed, keys, "left_semi")))
            runs = dedupe(runs, keyed)
    return runs, reduce(DataFrame.unionByName, out).distinct() if out else None


def _healed(repaired: tuple[DataFrame, DataFrame | None], version: Version | None) -> tuple[DataFrame, DataFrame | None]:
    table, changed = repaired
    changed = None if changed is None else materialize(changed)
    table, more = heal_duplicates(table, version, changed)
    both = [c for c in (changed, more) if c is not None]
    return table, reduce(DataFrame.unionByName, both).distinct() if both else None


def repair_extents(readings: DataFrame, runs: DataFrame, extents: DataFrame,
                   chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Recompute the given per-device extents and replace the fragments they join."""
    return repair_extents_delta(readings, runs, extents, chunk_seconds, tiebreak)[0]


def consolidate_delta(readings: DataFrame, runs: DataFrame, at, cap_days: float | None = None,
                      chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (), version: Version | None = None):
    extents = consolidate_extents(runs, at)
    if cap_days is not None:
        extents = extents.where(_within_cap(cap_days))
    return _healed(repair_extents_delta(readings, runs, extents, chunk_seconds, tiebreak), version)


def _within_cap(cap_days: float) -> Column:
    return day_diff(S.START, S.END) <= F.lit(float(cap_days))


def deferred_extents(runs: DataFrame, at, cap_days: float) -> DataFrame:
    """The devices, with their extents, that ``consolidate`` leaves alone under ``cap_days``."""
    return consolidate_extents(runs, at).where(~_within_cap(cap_days))


def consolidate(readings: DataFrame, runs: DataFrame, at, cap_days: float | None = None,
                chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Join the runs a cut at ``at`` split, per device, and replace their fragments; then keep one
    of the stored runs that share a device and START, or a device and END (``heal_duplicates``).

    With ``cap_days`` only devices whose own extent spans at most that many days are repaired, each
    fully; the others are what ``deferred_extents`` returns, for a job with a greater cap.
    """
    return consolidate_delta(readings, runs, at, cap_days, chunk_seconds, tiebreak)[0]


def consolidate_range_delta(readings: DataFrame, runs: DataFrame, frm, to,
                            chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (), version: Version | None = None):
    """G4 over every cut in ``[frm, to)`` at once (see ``consolidate_range``)."""
    st, en = F.col(S.START), F.col(S.END)
    overlapping = runs.where((st < _ts(to)) & (en >= _ts(frm)))
    if S.START_DATE in runs.columns:
        overlapping = overlapping.where(F.col(S.START_DATE) <= F.to_date(_ts(to)))
    if version is not None:
        overlapping = overlapping.where(version.ending(runs.sparkSession.range(1).select(_ts(frm)).first()[0]))
    return _healed(repair_extents_delta(readings, runs, device_extents(overlapping), chunk_seconds, tiebreak), version)


def consolidate_range(readings: DataFrame, runs: DataFrame, frm, to,
                      chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """G4 for many cuts in one pass: join every run that batch boundaries inside
    ``[frm, to)`` split, however many boundaries each crosses.

    Each device's stored runs overlapping the range give one extent; it is recomputed
    once, and a recomputed run replaces the fragments it spans when it starts at a stored
    START and ends at a stored END. Equal to consolidating cut by cut in time order, with
    one re-read instead of one per cut.
    """
    return consolidate_range_delta(readings, runs, frm, to, chunk_seconds, tiebreak)[0]


def repair_seam_delta(readings: DataFrame, runs: DataFrame, batch_start, seam_seconds: int = 1,
                      chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (), version: Version | None = None):
    extents = device_extents(scan_seam(runs, _ts(batch_start), seam_seconds, version))
    return repair_extents_delta(readings, runs, extents, chunk_seconds, tiebreak)


def repair_seam(readings: DataFrame, runs: DataFrame, batch_start, seam_seconds: int = 1,
                chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Find runs within ``seam_seconds`` of ``batch_start``, recompute each device's
    extent of them, and replace only fragments a recomputed run really joins."""
    return repair_seam_delta(readings, runs, batch_start, seam_seconds, chunk_seconds, tiebreak)[0]


def stitch_delta(readings: DataFrame, kept: DataFrame, new_runs: DataFrame,
                 chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (), version: Version | None = None):
    """``kept`` stored runs and later ``new_runs`` as one table, the last kept and the first new run of
    a device bridged where the readings show one run. Returns ``(table, changed start dates or None)``.

    Only devices with new runs, and only three columns of ``kept`` (of the newest dates of its ``version``, where
    the device has a run there), are read for the extents."""
    if S.START_DATE in kept.columns:
        new_runs = new_runs.withColumn(S.START_DATE, F.to_date(S.START))
    merged = kept.unionByName(new_runs.select(*kept.columns))
    first = new_runs.groupBy(S.DEVICE_ID).agg(F.min(S.END).alias(S.END))
    extents = last_starts(kept, first.select(S.DEVICE_ID), version).join(first, S.DEVICE_ID)
    return repair_extents_delta(readings, merged, extents, chunk_seconds, tiebreak)


def repair_seam_windows_delta(readings: DataFrame, runs: DataFrame, start, start1, end, end1,
                              chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (), version: Version | None = None):
    extents = device_extents(scan_seam_windows(runs, start, start1, end, end1, version))
    return repair_extents_delta(readings, runs, extents, chunk_seconds, tiebreak)


def repair_seam_windows(readings: DataFrame, runs: DataFrame, start, start1, end, end1,
                        chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
                        tiebreak: Sequence[str] = ()) -> DataFrame:
    """G3 with two windows of their own: the runs that start in ``[start, start1)`` or end in ``[end, end1)``."""
    return repair_seam_windows_delta(readings, runs, start, start1, end, end1, chunk_seconds, tiebreak)[0]


def incremental_delta(readings: DataFrame, runs: DataFrame, checkpoints: DataFrame, lateness_seconds: int = 0,
                      chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = (), version: Version | None = None):
    """``incremental`` returning ``(new run table, new checkpoint row, changed start dates)``."""
    cp = checkpoints.agg(F.max(S.TIMESTAMP)).first()[0]
    if cp is None:  # only then the destination is read for its newest END (A12)
        cp = runs.agg(F.max(S.END)).first()[0]
    ts, end = F.col(S.TIMESTAMP), F.col(S.END)

    def loaded(batch, chunks):
        """The new runs, and the checkpoint row (A11, S7): the batch's last END, observed as the runs are written."""
        new_runs, seen = measured(summarize_runs(batch, chunks, tiebreak), end=F.max(S.END))
        return new_runs, runs.sparkSession.createDataFrame([] if seen.end is None else [(seen.end,)], S.CHECKPOINT_SCHEMA)

    if cp is None:  # nothing loaded yet: everything is new
        new_runs, ckpt = loaded(readings, chunk_seconds)
        return new_runs, ckpt, start_dates(new_runs)

    lo = cp - dt.timedelta(seconds=int(lateness_seconds))
    touched_runs = runs.where(end > _ts(lo))
    if version is not None:  # the folders that hold such a run
        touched_runs = touched_runs.where(version.ending(lo))
    touched, seen = small_table(touched_runs.groupBy(S.DEVICE_ID).agg(F.min(S.START).alias("_FROM")), first=F.min("_FROM"))
    floor = lo if seen.first is None else min(lo, seen.first)

    batch = (readings.where(ts >= _ts(floor))
             .join(touched, S.DEVICE_ID, "left")
             .where((ts > _ts(lo)) | (F.col("_FROM").isNotNull() & (ts >= F.col("_FROM"))))
             .drop("_FROM"))
    chunk_seconds = resolve_chunks(batch, chunk_seconds)
    new_runs, ckpt = loaded(batch, chunk_seconds)
    if isinstance(chunk_seconds, Chunks):  # the bridges reach back before the batch
        chunk_seconds = chunk_seconds.elsewhere()

    out, bridged = stitch_delta(readings, runs.where(end <= _ts(lo)), new_runs, chunk_seconds, tiebreak, version)
    changed = start_dates(touched_runs, new_runs)
    if bridged is not None:
        changed = changed.unionByName(bridged).distinct()
    return out, ckpt, changed


def incremental(readings: DataFrame, runs: DataFrame, checkpoints: DataFrame, lateness_seconds: int = 0,
                chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
                tiebreak: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Load the readings after the checkpoint, and stitch them to the stored runs.

    * checkpoint: newest checkpoint row, else the newest stored END (A12);
    * ``lo = checkpoint - lateness``; stored runs ending after ``lo`` are recomputed from
      their own START, together with every reading after ``lo`` (late rows included);
    * the last kept stored run and the first new run of each device are bridged when the
      readings show they are one run (J2 extents per device, not a fixed-width seam).

    Returns ``(new run table, new checkpoint row)``.
    """
    out, checkpoint, _ = incremental_delta(readings, runs, checkpoints, lateness_seconds, chunk_seconds, tiebreak)
    return out, checkpoint
