"""Session helpers: a local session for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from flowruns import schema as S

# Largest per-device table, in bytes, that is broadcast. Larger ones go through a shuffle
# join (AQE splits skewed partitions).
BROADCAST_MAX_BYTES = 64 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "flowruns") -> SparkSession:
    """Build (or reuse) a local session configured like the cluster jobs expect.

    On a cluster the caller owns the session; this is for tests and ``bench.py``.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # remove reliable-checkpoint files once nothing refers to them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session has none (a test) is a private folder made and set; on a cluster
    a folder of one machine would lose data, so there the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="flowruns-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint to the shared checkpoint folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(df: DataFrame, **aggregates: Column) -> tuple[DataFrame, Row]:
    """``materialize(df)`` and the given aggregates of it, observed while it is written: one job, no second pass."""
    seen = Observation()
    out = materialize(df.observe(seen, *[c.alias(name) for name, c in aggregates.items()]))
    return out, Row(**seen.get)


def _bytes(df: DataFrame) -> dict[str, Column]:
    """Rows and bytes of device ids, from which ``small_side`` knows a table's size."""
    return {"n": F.count(F.lit(1)), "ids": F.coalesce(F.sum(F.octet_length(S.DEVICE_ID)), F.lit(0))}


def small_table(df: DataFrame, max_bytes: int | None = None, **aggregates: Column) -> tuple[DataFrame, Row]:
    """``measured``, with ``n`` (rows) and ``fits`` in the row, and the table marked for broadcast where it fits (``small_side``)."""
    out, row = measured(df, **_bytes(df), **aggregates)
    fits = row["n"] * 8 * (len(df.columns) + 1) + row["ids"] <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes)
    return F.broadcast(out) if fits else out, Row(**row.asDict(), fits=fits)


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """``small_side``, and whether the table is broadcast."""
    n, ids = df.agg(*_bytes(df).values()).first()
    fits = n * 8 * (len(df.columns) + 1) + ids <= max_bytes
    return F.broadcast(df) if fits else df, fits


def small_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast a materialized per-device table only when its size, measured here, is within
    ``max_bytes`` (8 bytes a column and the device ids); otherwise leave the join strategy to Spark/AQE."""
    return broadcast_if_small(df, max_bytes)[0]
