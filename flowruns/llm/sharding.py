"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every row has a point on a ring of 2^64 hashes. The ring is cut into ``2 ** CELL_BITS``
equal cells; every shard owns ``vnodes`` points. A cell goes to the shard of the first
virtual node clockwise of it that still has room for the cell's bytes, where a shard's room
is ``(1 + slack)`` times the mean load. A cell that no shard has room for goes to the shard with the least load, which
is below the mean. So no load exceeds the greater of that room and the mean plus one cell, and a change of the shard
count moves little beyond what the new shard takes.

Only the per-cell byte counts (a table of fixed size: ``2 ** CELL_BITS`` rows, whatever the
input) reach the driver, which walks the ring and sends back one byte per cell. Rows never do.
All row work is DataFrame functions.

Defined cases: a null text has no bytes (size 1, crc32 of the empty string); a null doc_id is a
key like any other; repeated rows are all kept, each at a point of its own (the key is the
row's doc_id, text checksum, size and its number among equal rows), so copies of one row cannot
form a hot cell, and blocks of ``COPIES`` of them are numbered by different tasks; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

import bisect
import hashlib
import math

from pyspark.sql import DataFrame, Window, functions as F

from flowruns.llm.common import staged

CELL_BITS = 16
MAX_SHARDS = 256  # one byte per cell in the map that goes back to Spark
#: Copies of one row that one task numbers at most.
COPIES = 1 << 12


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """Sorted (position, shard) of all virtual nodes; a shard's points do not depend on the others."""
    point = lambda s, v: int.from_bytes(hashlib.blake2b(f"shard {s} node {v}".encode(), digest_size=8).digest(), "big")
    return sorted((point(s, v), s) for s in range(shards) for v in range(vnodes))


def walk_ring(cells: list[tuple[int, int]], shards: int, vnodes: int, slack: float) -> bytes:
    """The shard of every cell. ``cells``: (cell, bytes) of the cells that hold rows.

    Cells arrive in classes of falling size (powers of two) and in ring order within a class, so
    that large ones find room and small ones fill what is left. A cell that fits nowhere goes to
    the shard with the least load.
    """
    points = ring_points(shards, vnodes)
    where = [p for p, _ in points]
    load, out = [0] * shards, bytearray(1 << CELL_BITS)
    room = math.ceil(sum(b for _, b in cells) / shards * (1 + slack))
    for cell, size in sorted(cells, key=lambda x: (-x[1].bit_length(), x[0])):
        start, tried, found = bisect.bisect_left(where, cell << (64 - CELL_BITS)), set(), -1
        for k in range(len(points)):
            s = points[(start + k) % len(points)][1]
            if s in tried:
                continue
            if load[s] + size <= room:
                found = s
                break
            tried.add(s)
            if len(tried) == shards:
                break
        out[cell] = s = found if found >= 0 else load.index(min(load))
        load[s] += size
    return bytes(out)


def copies(same: DataFrame) -> DataFrame:
    """Every row of ``same`` ``n`` times, numbered from 1 in ``copy``. Rows of more than ``COPIES`` copies
    are dealt to the tasks in blocks of so many, so no task makes all copies of a row."""
    few = same.where(F.col("n") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    many = same.where(F.col("n") > COPIES).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    # a stated number of partitions, which adaptive execution leaves as it is
    tasks = int(same.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(tasks, *same.columns, "block")
    many = many.withColumn("copy", F.explode(F.sequence(F.col("block") * COPIES + 1, F.least("n", (F.col("block") + 1) * COPIES))))
    return few.drop("n").unionByName(many.drop("n", "block"))


def ring_shards(docs: DataFrame, shards: int = 16, vnodes: int = 64, slack: float = 0.001,
                text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot (0, 1, ... in each shard)."""
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"1 to {MAX_SHARDS} shards")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    same = docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))
    # written out, as both halves of ``copies`` read it
    rows = copies(staged(same.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")), "distinct"))
    rows = rows.withColumn("point", F.xxhash64("doc_id", "text_crc32", "size", "copy"))
    rows = staged(rows.withColumn("cell", F.shiftrightunsigned("point", 64 - CELL_BITS).cast("int")), "ring")
    cells = staged(rows.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "cells")
    owner = walk_ring([(r.cell, r.bytes) for r in cells.select("cell", "bytes").collect()], shards, vnodes, slack)
    owned = cells.withColumn("shard", F.conv(F.hex(F.substring(F.lit(owner), F.col("cell") + 1, F.lit(1))), 16, 10).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    owned = owned.select("cell", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("cell").orderBy("point", "doc_id", "text_crc32", "size", "copy")
    # at most 2 ** CELL_BITS rows of 16 bytes
    return rows.withColumn("at", F.row_number().over(within)).join(F.broadcast(owned), "cell").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("at") - 1).alias("slot"))


def op9_ring_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15; law ``bytes``."""
    from flowruns.llm.common import table

    out = ring_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
