"""Job entry points with I/O: read the source and the stored run table, run a job, and
rewrite only the start dates it changed (the reference's four jobs, as functions).

The stored run table is parquet by ``START_DATE``, in versions (see ``sources.versions``): jobs may
overlap, since a job that another one overtook starts again from the newer version. The
checkpoint table is a one-column parquet table of ``TIMESTAMP`` rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import ntz
from flowruns.operators.runs import DEFAULT_CHUNK_SECONDS
from flowruns.plans import jobs
from flowruns.sources import sinks, versions
from flowruns.sources.scans import scan_started


def _publish(spark: SparkSession, dest_path: str, job: Callable, **how) -> versions.Version:
    """Run ``job(runs, version)`` and publish the start dates it changed; only these are computed."""
    def dated(runs, version):
        table, changed = job(runs, version)
        return sinks.dated(table), None if changed is None else jobs.materialize(changed)

    return versions.commit(spark, dest_path, dated, **how)


def run_backfill(spark: SparkSession, readings: DataFrame, dest_path: str, frm, to,
                 chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> versions.Version:
    """G1: summarise ``[frm, to)`` and put the runs in place of those that start in that range, in one
    publish, so a repeated job does not double the table. The runs are computed once; jobs that
    publish other dates meanwhile do not matter."""
    new = jobs.materialize(jobs.backfill(readings, frm, to, chunk_seconds))
    inside = (F.col(S.START) >= ntz(frm)) & (F.col(S.START) < ntz(to))

    def job(stored, version):
        changed = jobs.start_dates(new, scan_started(stored, frm, to).where(inside))
        return stored.where(~inside).unionByName(sinks.dated(new)), changed

    reads = spark.range(1).select(F.to_date(ntz(frm)), F.to_date(ntz(to))).first()
    return _publish(spark, dest_path, job, reads=tuple(reads))


def run_incremental(spark: SparkSession, readings: DataFrame, dest_path: str, checkpoint_path: str,
                    lateness_seconds: int = 0, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> versions.Version:
    """Load after the checkpoint, stitch, rewrite changed dates, append the checkpoint."""
    checkpoint = []

    def job(runs, version):
        table, ckpt, changed = jobs.incremental_delta(
            readings, runs, sinks.read_checkpoints(spark, checkpoint_path), lateness_seconds, chunk_seconds, version=version)
        checkpoint[:] = [jobs.materialize(ckpt)]
        return table, changed

    out = _publish(spark, dest_path, job)
    if not checkpoint[0].isEmpty():
        sinks.append_checkpoint(checkpoint[0], checkpoint_path)
    return out


def run_repair_seam(spark: SparkSession, readings: DataFrame, dest_path: str, batch_start, seam_seconds: int = 1,
                    chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> versions.Version:
    """Repair the runs around ``batch_start``."""
    return _publish(spark, dest_path, lambda runs, version: jobs.repair_seam_delta(
        readings, runs, batch_start, seam_seconds, chunk_seconds, version=version))


def run_repair_seam_windows(spark: SparkSession, readings: DataFrame, dest_path: str, start, start1, end, end1,
                            chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> versions.Version:
    """Repair the runs that start in ``[start, start1)`` or end in ``[end, end1)``."""
    return _publish(spark, dest_path, lambda runs, version: jobs.repair_seam_windows_delta(
        readings, runs, start, start1, end, end1, chunk_seconds, version=version))


def run_consolidate(spark: SparkSession, readings: DataFrame, dest_path: str, at, cap_days: float | None = None,
                    chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> versions.Version:
    """Join the runs a cut at ``at`` split."""
    return _publish(spark, dest_path, lambda runs, version: jobs.consolidate_delta(
        readings, runs, at, cap_days, chunk_seconds, version=version), heals=True)


def run_consolidate_range(spark: SparkSession, readings: DataFrame, dest_path: str, frm, to,
                          chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> versions.Version:
    """G4 over every cut in ``[frm, to)`` in one pass."""
    return _publish(spark, dest_path, lambda runs, version: jobs.consolidate_range_delta(
        readings, runs, frm, to, chunk_seconds, version=version), heals=True)


def run_delete(spark: SparkSession, extents: DataFrame, dest_path: str) -> versions.Version:
    """Delete the stored runs inside the extents of their devices (``operators.repair.range_delete``)."""
    return _publish(spark, dest_path, lambda runs, version: jobs.delete_delta(runs, extents))
