"""S6-S8 sinks: append by column name, checkpoint append, and replacement of start dates.

The run table is stored by the date of ``START_TIMESTAMP``, in versions (``sources.versions``): a repair
writes the new rows of the dates it changes beside the old ones, and publishes them as the next version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from flowruns import schema as S
from flowruns.sources import versions
from flowruns.sources.versions import exists

PART = S.START_DATE


def append_by_name(df: DataFrame, path: str, fmt: str = "parquet", columns: list[str] | None = None,
                   options: dict[str, str] | None = None) -> None:
    """Append rows, matching columns by name to the target's column order.

    Raises when a column of the target is missing in ``df`` or the other way round."""
    spark = df.sparkSession
    cols = columns
    if cols is None and exists(spark, path):
        try:
            cols = spark.read.format(fmt).options(**(options or {})).load(path).columns
        except AnalysisException:
            cols = None
    if cols and set(cols) != set(df.columns):
        raise ValueError(f"columns differ: missing {sorted(set(cols) - set(df.columns))}, surplus {sorted(set(df.columns) - set(cols))}")
    out = df.select(*(cols or df.columns))
    out.write.mode("append").format(fmt).options(**(options or {})).save(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the stored run table, with its partition column ``START_DATE`` last, so that filters on it
    choose the folders that are read; empty when not written yet."""
    return versions.read_version(spark, versions.latest(spark, path))


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], S.CHECKPOINT_SCHEMA)
    return spark.read.schema(S.CHECKPOINT_SCHEMA).parquet(path)


def append_checkpoint(checkpoint_row: DataFrame, path: str) -> None:
    """Append the batch's checkpoint row (a one-row DataFrame) to the checkpoint table."""
    checkpoint_row.select(F.col(S.TIMESTAMP).cast("timestamp_ntz").alias(S.TIMESTAMP)).write.mode("append").parquet(path)


def dated(runs: DataFrame) -> DataFrame:
    """The run columns and ``START_DATE``: the stored partition column where there is one."""
    out = runs if PART in runs.columns else runs.withColumn(PART, F.to_date(S.START))
    return out.select(*S.RUN_COLUMNS, PART)


def write_runs(runs: DataFrame, path: str) -> versions.Version:
    """Write a whole run table, in place of all stored rows."""
    base = versions.latest(runs.sparkSession, path)
    rows = dated(runs).where(F.col(PART).isNotNull())
    days = sorted(set(base.dates) | {r[0] for r in rows.select(PART).distinct().collect()})
    return versions.publish(base, rows, days)


def replace_dates(new_table: DataFrame, path: str, dates: DataFrame, base: versions.Version | None = None) -> versions.Version:
    """Replace the start dates ``dates`` (one column ``START_DATE``) of the table by the rows of
    ``new_table`` in those dates; only these are computed. ``base`` is the version that ``new_table`` was computed
    from: if there is a newer one, ``versions.Conflict`` is raised and nothing is changed."""
    spark = new_table.sparkSession
    base = base or versions.latest(spark, path)
    return versions.commit(spark, path, lambda rows, now: (_same(base, now, new_table), dates), attempts=1)


def _same(base: versions.Version, now: versions.Version, table: DataFrame) -> DataFrame:
    if now.number != base.number:
        raise versions.Conflict(f"version {base.number} of {base.path} was replaced by {now.number}")
    return dated(table)
