"""op11 against a plain-Python statement of the same weights, scores and ranks, and the defined cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

from flowruns.llm import importance
from flowruns.llm.importance import feature_sums, op11_byte_importance, resampled

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, weight string, score long, uid long, `at` int, rank string, n_words int"


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(docs, target, min_words=20, percent=5):
    """(doc_id, n_features, weight, score, rank) of every (doc_id, text)."""
    rows = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for r in rows for b in r[2]), Counter(b for x in target for b in features(x)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in range(10_000)]
    out = []
    for i, n, found in rows:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    ranked = [(i, f, w, sc, k + 1 if k < drawn else None) for k, (i, _, f, w, sc) in enumerate(able)]
    return sorted(ranked + [(i, f, w, sc, None) for i, n, f, w, sc in out if n < min_words], key=repr)


def test_scores_and_ranks_equal_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(map(tuple, op11_byte_importance(spark, SF).collect()), key=repr) == plain(docs, target)


def test_odd_rows_ties_and_repeats(spark):
    good = " ".join(f"Word{i % 31}-ÉCOLE{i % 7}" for i in range(60))
    texts = [(1, good), (2, good), (2, good), (2, good), (None, good), (None, good), (None, None), (3, None), (4, ""), (5, " \t\n!?\x00"),
             (6, "Ünïcode 中文字符 Straße"), (7, "x " * 200_000), (8, "tiny")] + [(20 + i, f"{good} extra{i}") for i in range(40)]
    df = spark.createDataFrame([(i, t, None, "w", 1, 2, 3, "r", 4) for i, t in texts], DOCS)
    target = spark.createDataFrame([("word1 école1 word2",), (None,), ("",)], "text string")
    got = [tuple(r) for r in resampled(df, target, percent=30).collect()]
    assert sorted(got, key=repr) == plain(texts, ["word1 école1 word2", None, ""], percent=30)
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, len(ranks) + 1))


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert resampled(none, none).collect() == []
    some = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert [r["rank"] for r in resampled(some, none, percent=100).collect()] == [1]


def test_pieces_change_nothing(monkeypatch):
    text = " ".join("longer%d ab" % i * (i % 5) for i in range(300)).encode() + b" " + b"q" * 500 + b" end"
    whole = sorted(x for _, sums in feature_sums(text, 3) for x in sums.tolist())
    words = sum(n for n, _ in feature_sums(text, 3))
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(importance, "PIECE", size)
        assert sorted(x for _, sums in feature_sums(text, 3) for x in sums.tolist()) == whole
        assert sum(n for n, _ in feature_sums(text, 3)) == words


def test_repeated_rows_are_spread_over_ranges(spark):
    """A third of all rows equal: the sort by which ranks are made splits them too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        text = " ".join(f"w{i}" for i in range(25))
        rows = spark.range(6000).selectExpr("if(id < 2000, 7, id) AS doc_id", f"if(id < 2000, '{text}', concat('{text} ', id)) AS text").repartition(16)
        got = resampled(rows, rows.limit(1), percent=100)
        assert [r["rank"] for r in got.orderBy("rank").select("rank").collect()] == list(range(1, 6001))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
