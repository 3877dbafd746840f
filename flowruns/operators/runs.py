"""Run ("island") detection over per-device time series of readings.

A reading is *idle* iff ``FLOW_RATE = 0.0`` (NULL and NaN flows are not idle). A run is a
maximal sequence of consecutive non-idle readings of one device in time order. So the
run of a non-idle reading is identified by the number of idle readings before it:
``RUN_ID = count of idle readings at or before it``.

Scale design. A plain ``Window.partitionBy(DEVICE_ID)`` puts each device into one task,
and one hot device may hold a third of all readings. Instead every window here is
partitioned by ``(DEVICE_ID, chunk)``, where ``chunk`` is a time bucket (``Chunks``, or of
the fixed width ``chunk_seconds``), and what crosses a chunk boundary is carried by a small per-chunk
table (one row per device and chunk):

1. ``local`` = running count of idle readings inside the chunk (window over the chunk);
2. ``offset`` = idle readings in all earlier chunks of the device (a partial aggregate
   per chunk, then a running sum over the chunk table);
3. ``RUN_ID = offset + local``, joined on ``(DEVICE_ID, chunk)``; the readings side is
   already hash-partitioned on exactly those keys by the window, so it is not shuffled
   again.

Lag / lead use the same trick: the first and last reading of each chunk are kept in the
chunk table and shifted across chunk boundaries there.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowruns import schema as S
from flowruns.functions.timecols import US_SQL
from flowruns.session import small_table

# ``chunk_seconds`` is a width in seconds, "auto", or the ``Chunks`` that "auto" resolved to.
DEFAULT_CHUNK_SECONDS = "auto"
AUTO_TARGET_ROWS = 2_000_000
# Nested bucket widths in microseconds, widest first: 366 days, day, hour, minute, second,
# millisecond, microsecond. Each divides the one before it.
LEVELS_US = (31_622_400_000_000, 86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)


class Chunks(NamedTuple):
    """``hot[i]``: the (DEVICE_ID, _B) buckets of level ``i`` with more readings than the target.

    A reading's chunk is its bucket on the first level where that bucket is not hot. ``single``: no bucket is hot, and
    the readings that this was resolved for all lie in one bucket of the first level, so nothing crosses a chunk's bounds.
    That does not hold for other readings (``elsewhere``)."""

    hot: tuple[DataFrame, ...]
    single: bool = False

    def elsewhere(self) -> Chunks:
        """These chunks for readings other than those they were resolved for."""
        return self._replace(single=False)


def idle_flag() -> Column:
    """1 if the flow is 0.0 (or -0.0), else 0; NULL and NaN flows give 0."""
    return F.when(F.col(S.FLOW_RATE).isin(0.0), F.lit(1)).otherwise(F.lit(0))


def zero_flag(readings: DataFrame) -> DataFrame:
    """P2 as a column ``IS_SKIPPED``."""
    return readings.withColumn(S.IDLE, idle_flag())


def nonzero_readings(readings: DataFrame) -> DataFrame:
    """Keep every reading that is not idle (NULL and NaN flows stay)."""
    f = F.col(S.FLOW_RATE)
    return readings.where(f.isNull() | (f != F.lit(0.0)))


def prune_readings(readings: DataFrame) -> DataFrame:
    """Drop the column no summary uses."""
    return readings.drop(S.VALVE_STATE)


def clean(readings: DataFrame) -> DataFrame:
    """Readings without a device or a time cannot be placed in a run; they are left out.

    A session-zone ``timestamp`` column (as JDBC sources deliver) becomes wall-clock
    ``timestamp_ntz`` in the session zone, the type all time arithmetic here expects.
    """
    if isinstance(readings.schema[S.TIMESTAMP].dataType, T.TimestampType):
        readings = readings.withColumn(S.TIMESTAMP, F.col(S.TIMESTAMP).cast("timestamp_ntz"))
    return readings.where(F.col(S.DEVICE_ID).isNotNull() & F.col(S.TIMESTAMP).isNotNull())


def _bucket(width_us: int) -> Column:
    """Start, in microseconds, of the time bucket of ``width_us`` microseconds a reading lies in."""
    us = US_SQL.format(c=S.TIMESTAMP)
    return F.expr(f"{us} - pmod({us}, {int(width_us)})")


def resolve_chunks(readings: DataFrame, chunk_seconds: float | str | Chunks = DEFAULT_CHUNK_SECONDS,
                   target_rows: int = AUTO_TARGET_ROWS) -> float | Chunks:
    """Return ``chunk_seconds``, or for ``"auto"`` the ``Chunks`` of these readings, such that no
    (device, chunk) holds more than ``target_rows`` readings (unless they share one microsecond).

    Only buckets over the target are split, level by level, so a burst in one device leaves the
    chunks of every other device, and of its own quiet times, wide. A level has at most
    ``rows / target_rows`` hot buckets. Each level is one partially aggregated pass over (device,
    time) of the readings in the hot buckets of the level before; the first finds none in sparse data.
    """
    if chunk_seconds != "auto":
        return chunk_seconds
    left = clean(readings).select(S.DEVICE_ID, S.TIMESTAMP)
    hot, met = [], Observation()
    for width_us in LEVELS_US[:-1]:
        counts = left.withColumn("_B", _bucket(width_us)).groupBy(S.DEVICE_ID, "_B").count()
        if not hot:  # the first level's buckets, all devices'
            counts = counts.observe(met, F.min("_B").alias("first"), F.max("_B").alias("last"))
        over, seen = small_table(counts.where(F.col("count") > target_rows).select(S.DEVICE_ID, "_B"))
        if not seen.n:
            break
        hot.append(over)
        left = left.withColumn("_B", _bucket(width_us)).join(hot[-1], [S.DEVICE_ID, "_B"], "left_semi").drop("_B")
    return Chunks(tuple(hot), not hot and met.get["first"] == met.get["last"])


def with_chunk(readings: DataFrame, chunk_seconds: float | str | Chunks = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Add the time bucket used to split one device over many tasks."""
    chunks = resolve_chunks(readings, chunk_seconds)
    if not isinstance(chunks, Chunks):
        return readings.withColumn(S.CHUNK, _bucket(max(1, round(chunks * 1_000_000))))
    out = readings.withColumn(S.CHUNK, _bucket(LEVELS_US[0]))
    for hot, width_us in zip(chunks.hot, LEVELS_US[1:]):
        over = hot.select(F.col(S.DEVICE_ID).alias("_HD"), F.col("_B").alias("_HB"))
        out = (out.join(over, (F.col(S.DEVICE_ID) == F.col("_HD")) & (F.col(S.CHUNK) == F.col("_HB")), "left")
               .withColumn(S.CHUNK, F.when(F.col("_HB").isNotNull(), _bucket(width_us)).otherwise(F.col(S.CHUNK)))
               .drop("_HD", "_HB"))
    return out


def _order(tiebreak: Sequence[str], last: Sequence[Column]) -> list[Column]:
    """Time, ``tiebreak``, then ``last``, which settles equal timestamps in every computation alike."""
    return [F.col(S.TIMESTAMP), *[F.col(c) for c in tiebreak], *last]


def _chunk_window(order: Sequence[Column], keys: Sequence[str] = (S.DEVICE_ID,)):
    return Window.partitionBy(*keys, S.CHUNK).orderBy(*order)


def _local_ids(readings: DataFrame, chunk_seconds, tiebreak: Sequence[str], keys: Sequence[str]):
    """The readings with ``_IDLE``, the same with ``_LOCAL`` (idle readings of the chunk so far), and
    their chunk window.

    At equal timestamps idle readings come last, unless ``tiebreak`` says otherwise. ``_IDLE`` is a
    column, so that all windows share one sort."""
    r = with_chunk(clean(readings), chunk_seconds).withColumn("_IDLE", idle_flag())
    r = r.where(F.col(S.CHUNK).isNotNull())  # always so; without it a join adds it to one of its sides only
    w = _chunk_window(_order(tiebreak, [F.col("_IDLE")]), keys)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return r, r.withColumn("_LOCAL", F.sum("_IDLE").over(so_far)), w


def _before(keys: Sequence[str]):
    """All earlier chunks of the device, in the per-chunk table."""
    return Window.partitionBy(*keys).orderBy(S.CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def _offset(keys: Sequence[str]) -> Column:
    return F.coalesce(F.sum("_N_IDLE").over(_before(keys)), F.lit(0).cast("bigint"))


def _many(chunk_seconds) -> bool:
    """Whether a device may have many chunks: not where "auto" found no hot bucket, so all are 366 days wide."""
    return not isinstance(chunk_seconds, Chunks) or bool(chunk_seconds.hot)


def _in_blocks(per_chunk: DataFrame) -> DataFrame:
    """The chunk table with ``_BLOCK``, the day of each chunk's start."""
    return per_chunk.withColumn("_BLOCK", F.expr(f"{S.CHUNK} - pmod({S.CHUNK}, {LEVELS_US[1]})"))


def chunk_offsets(per_chunk: DataFrame, keys: Sequence[str], many: bool = True) -> DataFrame:
    """(keys, chunk, _OFFSET): the idle readings of all earlier chunks of the device.

    With ``many`` chunks the sum has two levels, the chunks of a day and the days of a device, so that no window
    holds all chunks of a device."""
    if not many:
        return per_chunk.select(*keys, S.CHUNK, _offset(keys).alias("_OFFSET"))
    block = [*keys, "_BLOCK"]
    inside = _in_blocks(per_chunk).select(*block, S.CHUNK, "_N_IDLE", _offset(block).alias("_INSIDE"))
    days = inside.groupBy(*block).agg(F.sum("_N_IDLE").alias("_N_IDLE"))
    earlier = F.coalesce(F.sum("_N_IDLE").over(Window.partitionBy(*keys).orderBy("_BLOCK").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    days = days.select(*block, earlier.alias("_DAYS"))
    return inside.join(days, block).select(*keys, S.CHUNK, (F.col("_INSIDE") + F.col("_DAYS")).alias("_OFFSET"))


def chunk_neighbours(per_chunk: DataFrame, many: bool = True) -> DataFrame:
    """(device, chunk, _PREV_TAIL, _NEXT_HEAD): the ``_TAIL`` of the chunk before and the ``_HEAD`` of the one after,
    in two levels like ``chunk_offsets``."""
    def beside(w):
        return F.lag("_TAIL").over(w).alias("_PREV_TAIL"), F.lead("_HEAD").over(w).alias("_NEXT_HEAD")

    if not many:
        return per_chunk.select(S.DEVICE_ID, S.CHUNK, *beside(Window.partitionBy(S.DEVICE_ID).orderBy(S.CHUNK)))
    block = [S.DEVICE_ID, "_BLOCK"]
    chunks = _in_blocks(per_chunk)
    inside = chunks.select(*block, S.CHUNK, *beside(Window.partitionBy(*block).orderBy(S.CHUNK)))
    days = chunks.groupBy(*block).agg(F.min_by("_HEAD", S.CHUNK).alias("_HEAD"), F.max_by("_TAIL", S.CHUNK).alias("_TAIL"))
    days = days.select(*block, *beside(Window.partitionBy(S.DEVICE_ID).orderBy("_BLOCK"))).withColumnsRenamed(
        {"_PREV_TAIL": "_DAY_TAIL", "_NEXT_HEAD": "_DAY_HEAD"})
    return inside.join(days, block).select(S.DEVICE_ID, S.CHUNK, F.coalesce("_PREV_TAIL", "_DAY_TAIL").alias("_PREV_TAIL"),
                                           F.coalesce("_NEXT_HEAD", "_DAY_HEAD").alias("_NEXT_HEAD"))


def island_ids(readings: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
               tiebreak: Sequence[str] = (), batch_cols: Sequence[str] = ()) -> DataFrame:
    """The non-idle readings with ``RUN_ID`` (idle readings of the device so far).

    ``tiebreak`` names extra ordering columns for readings of one device with equal
    timestamps (idle readings come last among those still equal).
    ``batch_cols`` split each device further, so runs are found in each batch alone
    (how a destination that was loaded batch by batch looks before repair).
    """
    keys = [S.DEVICE_ID, *batch_cols]
    chunk_seconds = resolve_chunks(readings, chunk_seconds)
    if isinstance(chunk_seconds, Chunks) and chunk_seconds.single:
        # no idle readings in earlier chunks: one read, no join. Without the chunk among the window's keys, a run lies in one
        # partition, and what is grouped by it is not shuffled again
        r = clean(readings).withColumn("_IDLE", idle_flag())
        so_far = Window.partitionBy(*keys).orderBy(*_order(tiebreak, [F.col("_IDLE")])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return r.withColumn(S.RUN_ID, F.sum("_IDLE").over(so_far)).where(F.col("_IDLE") == 0).drop("_IDLE")

    r, local, _ = _local_ids(readings, chunk_seconds, tiebreak, keys)
    # One row per (device, chunk): partial aggregation happens before the shuffle.
    per_chunk = r.groupBy(*keys, S.CHUNK).agg(F.sum("_IDLE").alias("_N_IDLE"))
    offsets = chunk_offsets(per_chunk, keys, _many(chunk_seconds))

    kept = local.where(F.col("_IDLE") == 0)
    return (kept.join(offsets, [*keys, S.CHUNK], "inner")
            .withColumn(S.RUN_ID, F.col("_OFFSET") + F.col("_LOCAL"))
            .drop("_OFFSET", "_LOCAL", "_IDLE", S.CHUNK))


def neighbours(readings: DataFrame, columns: Sequence[str], chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
               tiebreak: Sequence[str] = (), prefix_prev: str = "PREV_", prefix_next: str = "NEXT_") -> DataFrame:
    """``lag(c, 1)`` and ``lead(c, 1)`` per device in time order, for each column.

    Computed inside each (device, chunk) window; the first / last reading of a chunk takes
    its neighbour from the previous / next non-empty chunk through the per-chunk table.
    """
    chunk_seconds = resolve_chunks(readings, chunk_seconds)
    r = with_chunk(clean(readings), chunk_seconds)
    cols = list(columns)
    order = _order(tiebreak, [F.col(c) for c in cols])
    w = _chunk_window(order)
    order_key = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)])

    inner = r.select(
        "*",
        F.lag(S.TIMESTAMP).over(w).isNull().alias("_FIRST"),
        F.lead(S.TIMESTAMP).over(w).isNull().alias("_LAST"),
        *[F.lag(c).over(w).alias(f"_L_{c}") for c in cols],
        *[F.lead(c).over(w).alias(f"_N_{c}") for c in cols],
    )
    edge = F.struct(*[F.col(c) for c in cols])
    per_chunk = r.groupBy(S.DEVICE_ID, S.CHUNK).agg(
        F.min_by(edge, order_key).alias("_HEAD"), F.max_by(edge, order_key).alias("_TAIL"))
    across = chunk_neighbours(per_chunk, _many(chunk_seconds))

    j = inner.join(across, [S.DEVICE_ID, S.CHUNK], "inner")
    out = j.select(
        *[F.col(c) for c in r.columns if c != S.CHUNK],
        *[F.when(F.col("_FIRST"), F.col("_PREV_TAIL")[c]).otherwise(F.col(f"_L_{c}")).alias(prefix_prev + c)
          for c in cols],
        *[F.when(F.col("_LAST"), F.col("_NEXT_HEAD")[c]).otherwise(F.col(f"_N_{c}")).alias(prefix_next + c)
          for c in cols],
    )
    return out


def island_bounds(readings: DataFrame, chunk_seconds: float | str = DEFAULT_CHUNK_SECONDS,
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Each non-idle reading with the START / END of its run.

    Inside a chunk the first / last reading of a run spreads its time over the run by ordered
    windows. Only the run open at a chunk's start and the one open at its end reach into other
    chunks; their bounds come from the per-chunk table: ``_IN`` is the earliest start among the
    earlier chunks whose last run is the one open here, ``_OUT`` the latest end likewise. So the
    readings need no second shuffle and no join on the run.
    """
    keys = [S.DEVICE_ID]
    _, local, w = _local_ids(readings, chunk_seconds, tiebreak, keys)
    ts, idle = F.col(S.TIMESTAMP), F.col("_IDLE")
    flowing = idle == 0
    to_here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    prev_idle = F.coalesce(F.lag(idle).over(w), F.lit(1)) == 1
    next_idle = F.coalesce(F.lead(idle).over(w), F.lit(1)) == 1
    marked = (local.withColumn("_S", F.when(flowing & prev_idle, ts)).withColumn("_E", F.when(flowing & next_idle, ts))
              .withColumn("_S", F.last("_S", ignorenulls=True).over(to_here))
              .withColumn("_E", F.first("_E", ignorenulls=True).over(from_here)))

    # Per chunk: idle readings, the end of the run it starts in, the start of the run it ends in.
    per_chunk = marked.groupBy(*keys, S.CHUNK).agg(
        F.max("_LOCAL").alias("_N_IDLE"),
        F.max(F.when(flowing & (F.col("_LOCAL") == 0), ts)).alias("_HEAD"),
        F.max(F.when(flowing, F.struct("_LOCAL", "_S"))).alias("_LAST"))
    tail = F.when(F.col("_LAST._LOCAL") == F.col("_N_IDLE"), F.col("_LAST._S"))
    edges = per_chunk.select(*keys, S.CHUNK, "_N_IDLE", "_HEAD", tail.alias("_TAIL"), _offset(keys).alias("_FIRST_RUN"))
    edges = (edges.withColumn("_LAST_RUN", F.col("_FIRST_RUN") + F.col("_N_IDLE"))
             .withColumn("_OPEN_FROM", F.min("_TAIL").over(Window.partitionBy(*keys, "_LAST_RUN")))
             .withColumn("_OPEN_TO", F.max("_HEAD").over(Window.partitionBy(*keys, "_FIRST_RUN"))))
    w_dev = Window.partitionBy(*keys).orderBy(S.CHUNK)
    edges = edges.select(*keys, S.CHUNK, "_N_IDLE", F.lag("_OPEN_FROM").over(w_dev).alias("_IN"),
                         F.lead("_OPEN_TO").over(w_dev).alias("_OUT"))

    return (marked.where(flowing).join(edges, [*keys, S.CHUNK], "inner")
            .withColumn(S.START, F.when(F.col("_LOCAL") == 0, F.least("_S", "_IN")).otherwise(F.col("_S")))
            .withColumn(S.END, F.when(F.col("_LOCAL") == F.col("_N_IDLE"), F.greatest("_E", "_OUT"))
                        .otherwise(F.col("_E")))
            .drop("_LOCAL", "_IDLE", "_S", "_E", "_N_IDLE", "_IN", "_OUT", S.CHUNK))
