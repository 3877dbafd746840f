"""One summary row per run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowruns import schema as S
from flowruns.functions import epoch_seconds
from flowruns.operators.runs import DEFAULT_CHUNK_SECONDS, island_ids


def _sd(c: str) -> str:
    """Sample standard deviation; one value gives 0.0, none gives NULL, NaN gives 0.0.

    (Older Spark returned NaN for a single value and the job turned NaN into 0.0; Spark 4
    returns NULL there, so the single-value case is written out.)
    """
    return f"CASE WHEN count({c}) = 1 THEN 0.0D ELSE nanvl(stddev_samp({c}), 0.0D) END"


def _mode(k: int) -> str:
    """Readings in mode ``k``."""
    return f"CAST(count(CASE WHEN {S.MODE} = {k} THEN 1 END) AS BIGINT)"


#: The aggregates of the run summary (A2-A7) and their columns, in output order.
AGGREGATES = [
    (f"min({S.TIMESTAMP})", S.START),
    (f"max({S.TIMESTAMP})", S.END),
    ("CAST(count(1) AS BIGINT)", S.RECORDS),
    (f"max({S.FLOW_RATE})", "MAX_FLOW_RATE"),
    (f"avg({S.FLOW_RATE})", "AVG_FLOW_RATE"),
    (f"sum({S.FLOW_RATE})", "SUM_FLOW_RATE"),
    (f"CAST(min({S.TEMPERATURE}) AS INT)", "MIN_TEMPERATURE"),
    (f"CAST(max({S.TEMPERATURE}) AS INT)", "MAX_TEMPERATURE"),
    (f"avg({S.TEMPERATURE})", "AVG_TEMPERATURE"),
    (f"min({S.PRESSURE})", "MIN_PRESSURE"),
    (f"max({S.PRESSURE})", "MAX_PRESSURE"),
    (f"avg({S.PRESSURE})", "AVG_PRESSURE"),
    (_sd(S.PRESSURE), "SD_PRESSURE"),
    (_sd(S.FLOW_RATE), "SD_FLOW_RATE"),
    (_mode(2), "SYSTEM_MODE_2"),
    (_mode(3), "SYSTEM_MODE_3"),
    (_mode(5), "SYSTEM_MODE_5"),
]


def run_aggregates() -> list[Column]:
    """``AGGREGATES`` as columns; written as SQL expressions, one call into the JVM each."""
    return [F.expr(f"{e} AS {name}") for e, name in AGGREGATES]


def duration() -> Column:
    """Whole seconds of END minus whole seconds of START."""
    return (epoch_seconds(S.END) - epoch_seconds(S.START)).alias(S.DURATION)


def summarize_ids(ids: DataFrame, batch_cols: Sequence[str] = ()) -> DataFrame:
    """Aggregate readings that carry ``RUN_ID`` into the run table (RUNS_SCHEMA order).

    Spark aggregates partially before the shuffle on ``(DEVICE_ID, RUN_ID)``, so a run
    spread over many chunks moves as one partial row per chunk.
    """
    agg = ids.groupBy(S.DEVICE_ID, *batch_cols, S.RUN_ID).agg(*run_aggregates())
    return agg.select(*[c for c in S.RUN_COLUMNS if c != S.DURATION], duration())


def summarize_runs(readings: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
                   tiebreak: Sequence[str] = (), batch_cols: Sequence[str] = ()) -> DataFrame:
    """Readings -> one row per run (the transform of every job)."""
    return summarize_ids(island_ids(readings, chunk_seconds, tiebreak, batch_cols), batch_cols)


SUMMARY_SQL = (f"SELECT {S.DEVICE_ID}, " + ", ".join(f"{e} AS {name}" for e, name in AGGREGATES)
               + f" FROM {{view}} GROUP BY {S.DEVICE_ID}, {S.RUN_ID}")


def summarize_view(spark, ids: DataFrame, view: str = "run_readings") -> DataFrame:
    """The same summary through a registered temporary view and ``spark.sql``."""
    ids.createOrReplaceTempView(view)
    agg = spark.sql(SUMMARY_SQL.format(view=view))
    return agg.select(*[c for c in S.RUN_COLUMNS if c != S.DURATION], duration())
