"""A keyed state of open runs, so that readings in time order cost neither the run table nor the source.

The state holds a row per device: the time of its last reading and, if that reading flows, the run it belongs to as a
mergeable part (``operators.merge``). Readings of a device that are all after its last one then need nothing else: runs are
found in the micro-batch alone, and the batch's run without an idle reading before it (RUN_ID 0) continues the open
run, whose summary is merged from the two parts. A closed last run cannot change any more and is not kept.

A micro-batch writes the rows of its devices only, to a folder of its own under the run table; the version it publishes
names that folder after those before it (``Version.state``), so that runs and state change together or not at all.
Of a device's rows the newest folder's counts. After ``COMPACT_AFTER`` folders the state is written whole. A job that keeps
no state (a repair, a back-fill) publishes a version without one; the next micro-batch builds it from the source again,
by one partially aggregated pass over device, time and flow.

Cases: readings without device or time are left out; of readings with equal times idle ones are last, so a device whose last
time has an idle reading is closed; repeated rows are readings of their own; an empty micro-batch changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowruns import schema as S
from flowruns.operators.merge import COUNTS, PART_COLUMNS, merge_rows, numbered_parts, summarize_parts
from flowruns.operators.runs import DEFAULT_CHUNK_SECONDS, clean, idle_flag, resolve_chunks
from flowruns.session import materialize, small_table
from flowruns.sources.scans import scan_extents
from flowruns.sources.versions import STATES, Version

PART_SCHEMA = T.StructType([*S.RUNS_SCHEMA.fields, *[T.StructField(n, T.LongType()) for n in COUNTS.values()]])
STATE_SCHEMA = T.StructType([T.StructField(S.DEVICE_ID, T.StringType()), T.StructField("LAST", T.TimestampNTZType()),
                             T.StructField("PART", PART_SCHEMA)])
COMPACT_AFTER = 8


def last_readings(readings: DataFrame) -> DataFrame:
    """(DEVICE_ID, _FIRST, _LAST, _IDLE, _OPEN): times of the first, last and last idle reading, and whether the last one flows."""
    ts = F.col(S.TIMESTAMP)
    x = clean(readings).groupBy(S.DEVICE_ID).agg(
        F.min(ts).alias("_FIRST"), F.max(ts).alias("_LAST"), F.max(F.when(idle_flag() == 1, ts)).alias("_IDLE"))
    return x.withColumn("_OPEN", F.coalesce(F.col("_IDLE") < F.col("_LAST"), F.lit(True)))


def read_state(spark: SparkSession, version: Version, devices: DataFrame | None = None) -> DataFrame:
    """The state rows (STATE_SCHEMA) of a version, of the given devices only where there are any given."""
    folders = [f"{version.path.rstrip('/')}/{STATES}/{name}" for name in version.state or ()]
    rows = [spark.read.schema(STATE_SCHEMA).parquet(f).withColumn("_AGE", F.lit(k)) for k, f in enumerate(folders)]
    if not rows:
        return spark.createDataFrame([], STATE_SCHEMA)
    every = reduce(DataFrame.unionByName, rows)
    if devices is not None:
        every = every.join(devices.select(S.DEVICE_ID), S.DEVICE_ID, "left_semi")
    newest = every.groupBy(S.DEVICE_ID).agg(F.max_by(F.struct("LAST", "PART"), "_AGE").alias("_ROW"))
    return newest.select(S.DEVICE_ID, "_ROW.LAST", "_ROW.PART")


def write_state(rows: DataFrame, version: Version) -> tuple[str, ...]:
    """Write the rows of the devices that changed on top of the state of ``version``; returns the new version's folders."""
    before, name = version.state or (), uuid.uuid4().hex
    if len(before) >= COMPACT_AFTER:
        kept = read_state(rows.sparkSession, version).join(rows.select(S.DEVICE_ID), S.DEVICE_ID, "left_anti")
        before, rows = (), kept.unionByName(rows)
    rows = rows.select(*STATE_SCHEMA.names).hint("rebalance").sortWithinPartitions(S.DEVICE_ID)
    rows.write.parquet(f"{version.path.rstrip('/')}/{STATES}/{name}")
    return *before, name


def state_rows(last: DataFrame, parts: DataFrame) -> DataFrame:
    """STATE_SCHEMA rows from (DEVICE_ID, _LAST, _OPEN) and the parts, among them each open device's last one."""
    ending = parts.select(S.DEVICE_ID, F.col(S.END).alias("_LAST"), F.struct(*PART_COLUMNS).alias("PART"))
    return last.select(S.DEVICE_ID, "_LAST", "_OPEN").join(ending, [S.DEVICE_ID, "_LAST"], "left").select(
        S.DEVICE_ID, F.col("_LAST").alias("LAST"), F.when(F.col("_OPEN"), F.col("PART")).alias("PART"))


def build_state(readings: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The state after all the ``readings``: one pass for the last ones, and a second over the open runs alone."""
    last = materialize(last_readings(readings))
    ext = last.where("_OPEN").select(S.DEVICE_ID, F.coalesce("_IDLE", "_FIRST").alias(S.START), F.col("_LAST").alias(S.END))
    ext, seen = small_table(ext, lo=F.min(S.START), hi=F.max(S.END))
    if not seen.n:
        return last.select(S.DEVICE_ID, F.col("_LAST").alias("LAST"), F.lit(None).cast(PART_SCHEMA).alias("PART"))
    reread = scan_extents(readings, ext, seen.lo, seen.hi, seen.fits)
    return state_rows(last, summarize_parts(reread, resolve_chunks(reread, chunk_seconds), tiebreak))


def continue_runs(batch: DataFrame, state: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
                  tiebreak: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(parts, continued)``: the runs of a batch whose readings are all after the LAST of their devices, open runs
    of the state continued; and (DEVICE_ID, START) of these, which the continued ones replace."""
    parts = materialize(numbered_parts(batch, resolve_chunks(batch, chunk_seconds), tiebreak))
    heads = parts.where(F.col(S.RUN_ID) == 0)
    opened = state.where(F.col("PART").isNotNull()).select("PART.*").join(heads.select(S.DEVICE_ID), S.DEVICE_ID, "left_semi")
    opened, _ = small_table(opened.select(*PART_COLUMNS))
    grown = heads.join(opened, S.DEVICE_ID, "left_semi").select(*PART_COLUMNS).unionByName(opened)
    others = parts.where(F.col(S.RUN_ID) != 0).unionByName(heads.join(opened, S.DEVICE_ID, "left_anti"))
    out = merge_rows(grown, [S.DEVICE_ID]).select(*PART_COLUMNS).unionByName(others.select(*PART_COLUMNS))
    return materialize(out), opened.select(S.DEVICE_ID, S.START)
