"""Exact top-k inner-product search with a vector-approximation file.

Every vector is turned into whole numbers, floor(``scale`` * x), and every component into one of
``CELLS`` cells of its dimension: the approximation, one byte per component. The cell bounds are quantiles of a
bounded sample (``SAMPLE`` vectors); the outermost cells reach to the exact least and greatest value. A
search takes the queries in blocks against all vectors:

1. *Scan the cells.* For each query and vector, twice the middle of a cell box gives the middle of the possible scores, and half
   its widths, weighted by the query's absolute values, their reach: two matrix products give a lower and an
   upper bound on the score. Each task keeps the k best lower bounds of a query and the vectors whose upper
   bound is not below the k-th; the k-th best lower bound of all tasks then prunes again.
2. *Read exact vectors in the order of their bounds.* First the ``FIRST`` * k best by upper bound; a vector whose upper
   bound is below the k-th exact score found cannot enter the result, so then only the others are read, and the result is certain.

Equal vectors are one entry of the files, with their ``k + 1`` least ids, which is all a result can show of them, and equal
query vectors are searched once; so a vector that a third of all rows hold costs no more than another. (One id more than k, since a
query's own row is taken from its result at the end.) Both files are Parquet in the shared folder; the driver sees
the sample, one block of query vectors (``BLOCK_BYTES``) at a time, and counts.

Defined cases: a vector that is null, or holds null or non-finite components, takes no part; vectors are
compared with those of their own length only, each length on its own; an empty vector has score 0; repeated rows (same id, same vector) count once, while rows that share an id but not
the vector are rows of their own, and also queries of their own; a null id is no query, and comes last among ties; fewer than k
candidates give fewer ranks; an empty table gives an empty result; extra columns do not matter. A vector whose whole
numbers have a sum of squares of 2^62 or more raises an error, since scores would leave the range of a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowruns.llm.common import shared_folder, staged, table

CELLS = 256
#: Vectors from which the cell bounds are taken (those with the least hashes).
SAMPLE = 4_096
#: Bytes of the query vectors of a block.
BLOCK_BYTES = 8 << 20
#: Scores that are bounded at a time in a task (about 40 bytes each).
SCORES = 1 << 21
#: Candidates of a task, over all queries of a block, before they are sent on.
HELD = 1 << 20
FIRST = 3
NEAR = 1.0 / (1 << 48)  # relative error that the bounds allow for


def whole_vector(vector: Column, scale: int) -> Column:
    """The vector as whole numbers; null where it takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    square = F.aggregate(whole, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    large = F.raise_error(F.lit("a vector is too long for whole-number scores")).cast("array<int>")
    return F.when(vector.isNotNull() & fine, F.when(square < 2.0 ** 62, F.transform(whole, lambda x: x.cast("int"))).otherwise(large))


def _matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def ranges(vectors: DataFrame, width: int) -> np.ndarray:
    """Exact (least, greatest) of every dimension."""
    def run(batches):
        low = high = None
        for b in batches:
            m = _matrix(b.column(0), width)
            if len(m):
                low = m.min(axis=0) if low is None else np.minimum(low, m.min(axis=0))
                high = m.max(axis=0) if high is None else np.maximum(high, m.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(low), pa.array(high)], ["i", "low", "high"])

    parts = vectors.select("vector").mapInArrow(run, "i int, low long, high long").groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return np.array([(r.low, r.high) for r in sorted(parts.collect())], dtype=np.int64).reshape(width, 2)  # a row per dimension


def cell_bounds(vectors: DataFrame, width: int) -> np.ndarray:
    """(width, CELLS + 1) whole numbers: cell c of a dimension holds what is >= bound c and < bound c + 1."""
    few = vectors.orderBy("gid").limit(SAMPLE).select("vector").collect()
    sample = np.array([r.vector for r in few], dtype=np.int64).reshape(len(few), width)
    edge = ranges(vectors, width)
    inner = np.quantile(sample, np.linspace(0, 1, CELLS + 1)[1:-1], axis=0, method="lower").T.astype(np.int64)
    inner = np.clip(inner, edge[:, :1], edge[:, 1:])
    return np.concatenate([edge[:, :1], inner, edge[:, 1:] + 1], axis=1)


def approximated(vectors: DataFrame, bounds: np.ndarray) -> DataFrame:
    """(gid, cells): one byte per component."""
    def run(batches):
        for b in batches:
            m = _matrix(b.column(1), len(bounds))
            cells = np.empty(m.shape, dtype=np.uint8)
            for i in range(len(bounds)):
                cells[:, i] = np.searchsorted(bounds[i, 1:-1], m[:, i], side="right")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in cells], pa.binary())], ["gid", "cells"])

    return vectors.select("gid", "vector").mapInArrow(run, "gid long, cells binary")


def bound_candidates(cells: DataFrame, bounds: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(query, gid, lower, upper): the vectors that the cells cannot rule out, for each row of ``queries``."""
    low, high = bounds[:, :-1].astype(float), (bounds[:, 1:] - 1).astype(float)
    high = np.maximum(low, high)  # an empty cell
    held = cells.sparkSession.sparkContext.broadcast((queries.astype(float), (low + high) / 2, (high - low) / 2))

    def run(batches):
        q, middle, half = held.value
        width, reach = len(middle), np.abs(q)
        error = NEAR * max(1, width) * (reach @ (np.abs(middle) + half).max(axis=1)) if width else np.zeros(len(q))
        best = np.full((len(q), k), -np.inf)  # the k best lower bounds of every query so far
        kept, size = [], 0

        def prune():
            out = [np.concatenate(x) for x in zip(*kept)]
            live = out[3] >= best[out[0], 0]
            return [x[live] for x in out]

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query", "gid", "lower", "upper"])

        for b in batches:
            gids = b.column(0).to_numpy()
            codes = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint8).reshape(len(gids), width)
            mid, rad = np.empty(codes.shape), np.empty(codes.shape)
            for i in range(width):
                mid[:, i], rad[:, i] = middle[i][codes[:, i]], half[i][codes[:, i]]
            step = max(1, SCORES // max(1, len(gids)))
            for lo in range(0, len(q), step):
                some = slice(lo, lo + step)
                score, gap = q[some] @ mid.T, reach[some] @ rad.T + error[some, None]
                lower, upper = score - gap, score + gap
                if lower.shape[1] > k:
                    top = np.partition(lower, lower.shape[1] - k, axis=1)[:, -k:]
                else:
                    top = lower
                best[some] = np.sort(np.concatenate([best[some], top], axis=1), axis=1)[:, -k:]
                qi, vi = np.nonzero(upper >= best[some, :1])
                kept.append(((qi + lo).astype(np.int64), gids[vi], lower[qi, vi], upper[qi, vi]))
                size += len(qi)
            if size > HELD:
                kept = [prune()]
                size = len(kept[0][0])
                if size > HELD:  # bounds that rule out little: send on, and go on
                    yield batch_of(kept[0])
                    kept, size = [], 0
        if kept:
            yield batch_of(prune())

    found = cells.mapInArrow(run, "query long, gid long, lower double, upper double")
    return _from_kth(found, "lower", "upper", k)


def _kth(found: DataFrame, score: str, k: int) -> DataFrame:
    """(query, least): the k-th best score of every query that has k."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(score)))
    return found.select("query", score, place.alias("place")).where(f"place <= {k}").groupBy("query").agg(
        F.when(F.count("*") == k, F.min(score)).alias("least"))


def _from_kth(found: DataFrame, score: str, bound: str, k: int) -> DataFrame:
    found = staged(found, "candidates")
    # a row per query of the block
    kth = F.broadcast(_kth(found, score, k))
    return found.join(kth, "query").where(F.col("least").isNull() | (F.col(bound) >= F.col("least"))).drop("least")


def searched(vectors: DataFrame, cells: DataFrame, bounds: np.ndarray, block: pa.Table, k: int) -> DataFrame:
    """(query, ids, score, own) of every vector that may be among the k best of a query of ``block``, those among
    them exact; ``own`` tells the query's vector itself."""
    spark = vectors.sparkSession
    queries = _matrix(block["q"].combine_chunks(), len(bounds))
    found = bound_candidates(cells, bounds, queries, k).groupBy("query", "gid").agg(F.max("upper").alias("upper"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("upper"), "gid"))
    found = staged(found.withColumn("place", place), "bounds")
    asked = spark.createDataFrame(block).select("query", "q")
    dot = F.aggregate(F.zip_with("q", "vector", lambda x, y: x.cast("long") * y), F.lit(0).cast("long"), lambda s, x: s + x)

    def read(rows: DataFrame) -> DataFrame:
        exact = rows.join(vectors, "gid").join(F.broadcast(asked), "query")  # a block has BLOCK_BYTES
        return staged(exact.select("query", "ids", dot.alias("score"), (F.col("q") == F.col("vector")).alias("own")), "exact")

    first = read(found.where(F.col("place") <= FIRST * k))
    rest = found.where(F.col("place") > FIRST * k).join(F.broadcast(_kth(first, "score", k)), "query")
    return first.unionByName(read(rest.where(F.col("least").isNull() | (F.col("upper") >= F.col("least")))))


def _block(rows: list, width: int) -> pa.Table:
    """(query, gid, q) of collected (gid, vector) rows, numbered from 0."""
    values = pa.array(np.array([r.vector for r in rows], dtype=np.int32).reshape(-1))
    q = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width, pa.int32()), values)
    return pa.table({"query": pa.array(range(len(rows)), pa.int64()), "gid": pa.array([r.gid for r in rows], pa.int64()), "q": q})


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of every row for which ``is_query`` holds with
    all other rows, ties to the smaller id."""
    spark = rows.sparkSession
    whole = rows.select(F.col(key).alias("id"), is_query.alias("asks"), whole_vector(F.col(vector), scale).alias("vector")).where("vector IS NOT NULL")
    whole = whole.groupBy("id", "vector").agg(F.bool_or("asks").alias("asks"))
    whole = staged(whole.withColumn("gid", F.xxhash64("vector")), "vectors")  # equal hashes of unequal vectors do no harm
    order = Window.partitionBy("gid", "vector").orderBy(F.asc_nulls_last("id"))
    least = whole.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    entries = staged(least.groupBy("gid", "vector").agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("ids")), "entries")
    asked = staged(whole.where("asks AND id IS NOT NULL"), "queries")
    others = F.filter("best", lambda x: ~(x["own"] & x["vec_id"].eqNullSafe(F.col("id"))))
    others = F.transform(F.slice(others, 1, k), lambda x, i: F.struct((i + 1).cast("int").alias("rank"), x["vec_id"].alias("vec_id"), x["score"].alias("score")))
    kind = whole.schema["id"].dataType.simpleString()
    results, schema = shared_folder(spark, "found"), f"query_id {kind}, rank int, vec_id {kind}, score long"
    lengths = sorted(r[0] for r in asked.select(F.size("vector")).distinct().collect())  # the lengths of the queries' vectors
    for width in lengths:
        mine, these = (x.where(F.size("vector") == width) for x in (entries, asked))
        bounds = cell_bounds(mine, width)
        cells = staged(approximated(mine, bounds), "cells")
        texts = staged(these.select("gid", "vector").distinct(), "query-vectors")
        blocks = -(-texts.count() * max(8, 4 * width) // BLOCK_BYTES)
        for i in range(blocks):
            in_block = F.pmod(F.xxhash64("gid"), F.lit(blocks)) == i
            found = texts.where(in_block).collect()
            if not found:
                continue
            block = _block(found, width)
            scores = searched(mine, cells, bounds, block, k + 1).select("query", "score", "own", F.explode("ids.id").alias("vec_id"))
            place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
            best = scores.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("query").agg(
                F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("best"))
            best = best.join(F.broadcast(spark.createDataFrame(block)), "query").select("gid", F.col("q").alias("vector"), "best")
            # a row per query of the block, so broadcast: any number of rows may ask with one vector
            rows = these.where(in_block).join(F.broadcast(staged(best, "best")), ["gid", "vector"])
            rows.select(F.col("id").alias("query_id"), F.explode(others).alias("x")).select("query_id", "x.*").write.mode("append").parquet(results)
    return spark.read.schema(schema).parquet(results) if lengths else spark.createDataFrame([], schema)


def op13_cell_topk(spark, sf_dir: str) -> DataFrame:
    """The five nearest rows of every row of ``embeddings`` whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


#: DuckDB: all scores of the queries.
OP13_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
