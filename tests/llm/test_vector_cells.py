"""op13 against DuckDB and brute force, loose bounds and several blocks included, and the defined cases."""

import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowruns.llm import vector_cells as V

SF = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, label int, gid string, query long, `vector` int, own string, score int"


def plain(rows, every, k=5):
    """(query_id, rank, vec_id, score) of (vec_id, vector) rows."""
    fine = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, v in fine:
        if i is not None and i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j is None, j or 0, j) for j, w in fine if (j, w) != (i, v) and len(w) == len(v))
            out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(scores[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    assert rows_of(V.op13_cell_topk(spark, SF)) == sorted(con.execute(V.OP13_SQL).fetchall(), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(3)
    rows = [(i, np.float32(rng.normal(0, 0.3, 8)).tolist()) for i in range(300)]
    hot = rows[4][1]
    rows += [(i, hot) for i in range(1000, 1150)] + [(1002, hot)] * 3 + [(1000, rows[7][1]), (None, rows[9][1]), (None, hot)]
    rows += [(2000, None), (2010, [None] * 8), (2020, [float("nan")] * 8), (2030, [float("inf")] + [0.0] * 7), (2040, []), (2041, []), (2050, [1.0, 2.0]), (2051, [0.5, -2.0]),
             (2060, [0.0] * 8), (2070, [9000.0] * 8), (2071, [-9000.0] * 8)]
    return rows


def test_odd_rows_equal_brute_force(spark, odd):
    df = spark.createDataFrame([(i, v, 1, "g", 2, 3, "o", 4) for i, v in odd], ROWS)
    assert rows_of(V.top_k(df, F.col("vec_id") % 10 == 0)) == plain(odd, 10)


@pytest.mark.parametrize("limits", [{"CELLS": 2}, {"SAMPLE": 2, "HELD": 50}, {"BLOCK_BYTES": 300, "SCORES": 700}, {"FIRST": 1}])
def test_loose_bounds_and_small_blocks_change_nothing(spark, odd, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(V, name, value)
    df = spark.createDataFrame(odd[:160] + odd[300:360], "vec_id long, embedding array<float>")
    assert rows_of(V.top_k(df, F.col("vec_id") % 20 == 0)) == plain(odd[:160] + odd[300:360], 20)


def test_bounds_hold_and_rule_out_most(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    entries = rows.select(F.col("vec_id").alias("gid"), V.whole_vector(F.col("embedding"), 256).alias("vector")).cache()
    vectors = {r.gid: np.array(r.vector) for r in entries.collect()}
    width = len(vectors[0])
    bounds = V.cell_bounds(entries, width)
    assert all((bounds[:, :-1] <= bounds[:, 1:]).all(axis=1))
    queries = np.array([vectors[i] for i in (0, 50, 100)])
    found = V.bound_candidates(V.approximated(entries, bounds), bounds, queries, 6).collect()
    per = defaultdict(dict)
    for r in found:
        score = int(queries[r["query"]] @ vectors[r.gid])
        assert r.lower <= score <= r.upper
        per[r["query"]][r.gid] = score
    for q in range(3):
        best = sorted(((int(queries[q] @ v), -g) for g, v in vectors.items()), reverse=True)[:6]
        assert {-g for _, g in best} <= set(per[q]) and len(per[q]) < len(vectors) / 5


def test_empty_table_and_fewer_candidates(spark):
    assert V.top_k(spark.createDataFrame([], ROWS), F.col("vec_id") % 50 == 0).collect() == []
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert rows_of(V.top_k(two, F.col("vec_id") % 50 == 0)) == [(0, 1, 1, 256 * 512)]
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert V.top_k(one, F.col("vec_id") % 50 == 0).collect() == []


def test_vectors_too_long_for_a_long_score_raise(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too long"):
        V.top_k(df, F.col("vec_id") % 50 == 0).collect()
