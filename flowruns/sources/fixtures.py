"""Destination fixtures: run tables as a batch-by-batch load would have left them.

Each is computed from the readings by Spark in one pass: the batch a reading belongs to
is an extra partition key of the run detection, so a run crossing a batch boundary comes
out as one fragment per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import ntz
from flowruns.operators.runs import DEFAULT_CHUNK_SECONDS
from flowruns.operators.summary import summarize_runs

# Fixed values of the test fixtures (FIXTURES.md): the one cut, the seam width used in
# tests, and the back-fill window.
CUT = "2024-01-15 00:00:00"
SEAM_SECONDS = 6 * 3600
BACKFILL_FROM = "2024-01-08 00:00:00"
BACKFILL_TO = "2024-01-22 00:00:00"
# Two seam windows of their own, [start, start1) and [end, end1), of unequal widths.
SEAM_WINDOWS = ("2024-01-15 00:00:00", "2024-01-16 06:00:00", "2024-01-14 12:00:00", "2024-01-15 00:00:00")
# The span the daily fixture's cuts lie in (every day boundary of the data).
DAILY_FROM = "2024-01-01 00:00:00"
DAILY_TO = "2024-02-01 00:00:00"
# Readings whose whole seconds this divides arrive late.
LATE_EVERY = 10


def ts(v: str) -> Column:
    return ntz(v)


def runs_in_batches(readings: DataFrame, batch: Column, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Runs found in each batch alone (``batch`` is any expression of the reading)."""
    return summarize_runs(readings.withColumn("_BATCH", batch), chunk_seconds, batch_cols=["_BATCH"])


def runs_whole(readings: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    return summarize_runs(readings, chunk_seconds)


def runs_cut(readings: DataFrame, at: str = CUT, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Runs before ``at`` and runs from ``at`` on, each summarised alone."""
    return runs_in_batches(readings, F.col(S.TIMESTAMP) >= ts(at), chunk_seconds)


def runs_daily(readings: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Runs of each calendar day summarised alone."""
    return runs_in_batches(readings, F.to_date(S.TIMESTAMP), chunk_seconds)


def runs_before(readings: DataFrame, at: str = CUT, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    return summarize_runs(readings.where(F.col(S.TIMESTAMP) < ts(at)), chunk_seconds)


def runs_from(readings: DataFrame, at: str = CUT, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    return summarize_runs(readings.where(F.col(S.TIMESTAMP) >= ts(at)), chunk_seconds)


def crossing_runs(readings: DataFrame, at: str = CUT, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Whole-history runs that the cut splits (START before ``at``, END from ``at`` on)."""
    whole = runs_whole(readings, chunk_seconds)
    return whole.where((F.col(S.START) < ts(at)) & (F.col(S.END) >= ts(at)))


def runs_cut_with_bridges(readings: DataFrame, at: str = CUT,
                          chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """The cut fixture with the whole runs that cross the cut appended (before dedupe)."""
    return runs_cut(readings, at, chunk_seconds).unionByName(crossing_runs(readings, at, chunk_seconds))


def empty_checkpoints(spark) -> DataFrame:
    return spark.createDataFrame([], S.CHECKPOINT_SCHEMA)
