"""op12 against DuckDB and a plain-Python statement, in blocks of several sizes, and the defined cases."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from flowruns.llm import divergence_audit as D

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, term string, n long, counts long, total string, number int"


def plain(rows, most=200):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows."""
    docs = [(la or "", so or "", TERM.findall((t or "").translate(LOWER))) for t, la, so in rows]
    seen, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for la, so, words in docs:
        groups[la].add(so)
        count[la, so].update(words)
        seen[la].update(set(words))
    out = []
    for la, sources in groups.items():
        kept = [t for t, k in seen[la].items() if k >= 3]
        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        p = {so: shares(count[la, so]) for so in sources}
        q = shares(sum((count[la, so] for so in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for so in sources:
            pairs = sorted((-sum(f(p[so][t], p[x][t]) for t in kept), x.encode(), x) for x in sources if x != so)
            over = sorted((-f(p[so][t], q[t]), t.encode(), t) for t in kept if count[la, so][t] and p[so][t] > q[t])[:most]
            out += [(la, so, part, x, -v, k + 1) for part, found in (("pair", pairs), ("term", over)) for k, (v, _, x) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(f"SELECT lang, source, part, item, value, rank FROM ({D.OP12_SQL})").fetchall()
    assert rows_of(D.op12_level_products(spark, SF)) == sorted(want)


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(5)
    words = ["alpha", "Beta", "GAMMA", "été", "ÉTÉ", "中文", "don't", "x1y", "ß"]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 30))), str(rng.choice(["en", "de"])), f"s{rng.integers(0, 7)}") for _ in range(120)]
    rows += [(None, None, None), ("", "en", None), ("12 34", "xx", "a"), (None, "xx", "b"), (None, "xx", "c"), ("alpha " * 50_000, "en", "s1"),
             ("solo word", "yy", "only")] + [("alpha beta", None, "s1")] * 4 + [("alpha beta", "zz", "same")] * 4 + [("same text", "zz", None)] * 3
    return rows


def test_odd_rows_equal_plain_python(spark, odd):
    df = spark.createDataFrame([(i, t, la, so, "t", 1, 2, "x", 3) for i, (t, la, so) in enumerate(odd)], DOCS)
    assert rows_of(D.audit(df)) == plain(odd)
    assert rows_of(D.audit(df, most=2)) == plain(odd, most=2)


def test_small_blocks_and_flushes_change_nothing(spark, odd, monkeypatch):
    """Pairs in several passes, counters sent on often, texts in pieces."""
    monkeypatch.setattr(D, "GROUPS", 3)
    monkeypatch.setattr(D, "FLUSH", 5)
    monkeypatch.setattr(D, "PIECE", 10)
    df = spark.createDataFrame([(t, la, so) for t, la, so in odd], "text string, lang string, source string")
    assert len(list(D.passes({"en": 8, "de": 7}))) > 4
    assert rows_of(D.audit(df)) == plain(odd)


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_products_equal_term_by_term_prices():
    rng = np.random.default_rng(1)
    counts = (rng.zipf(1.3, (700, 9)) % 10**6 * (rng.random((700, 9)) < 0.4)).astype(np.int64)
    totals = counts.sum(axis=0).tolist()
    p = np.array([[1 + D.UNIT * (int(c) + 1) // (n + 700) for c, n in zip(row, totals)] for row in counts])
    want = np.array([[sum(int((x - y) ** 2 // y) for x, y in zip(p[:, a], p[:, b])) for b in range(4, 9)] for a in range(4)])
    assert (D.pair_values(counts, totals, 700, slice(0, 4), slice(4, 9)) == want).all()
    for most in (9, 40, 10_000):
        assert sum(len(hot) for hot, _, _ in D.blocks_of(counts, most)) == 700
        assert all((hot.sum(axis=1) == 9).all() for hot, _, _ in D.blocks_of(counts, most))


def test_shares_beyond_a_long_are_exact(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(5 * 10**17, 10**18, 10**9)], "n long, total long, terms long").select(D.share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first().p
    assert got == 1 + 10**9 * (5 * 10**17 + 1) // (10**18 + 10**9)
