"""Each operator against brute force, an exact round trip or held-out accuracy, and the defined cases."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, size long"


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, columns with clashing names."""
    good = " ".join(f"word{i % 97} and the{i % 13}." for i in range(300))
    rows = [(1, good, "en", "a", 5, "x", 9), (2, good, "en", "a", 5, "x", 9), (2, good, "en", "a", 5, "x", 9),
            (3, None, None, None, None, None, None), (None, "", "en", None, 0, "", 0), (None, " \t\n ", None, "b", 3, "", 0),
            (4, "tiny", "de", "b", 4, "y", 1), (5, "Lang " * 60_000, "en", "a", 1, "z", 2), (2, good + " more.", "en", "c", 5, "x", 9),
            (6, "ÄÖ #é|" * 80, "de", "ß", 5, "q", 9)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def oracle(sql, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    return sorted(map(repr, (sorted(zip(names, x)) for x in r.fetchall())))


def rows_of(df):
    return sorted(repr(sorted(r.asDict().items())) for r in df.collect())


# 1 token files
def test_tokens_round_trip_whole_texts(spark, texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    from flowruns.llm.token_files import Tokens, op1_token_files, open_folder, read_tokens, write_tokens

    path = public_tokenizers.path("word_bpe_49k.json")
    t, start = Tokenizer.from_file(path), 0
    got = {r.doc_id: r for r in op1_token_files(spark, SF).collect()}
    every = []
    for d in sorted(texts):
        ids = t.encode(texts[d], add_special_tokens=False).ids + [1]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        every += ids
    docs = spark.read.parquet(f"{SF}/documents.parquet").coalesce(1)
    folder, parts = write_tokens(docs, path, folder=str(tmp_path), length=64, rows=8)
    back = []
    for part, n in parts:
        f, seqs = Tokens(folder, part), []
        for i in range(-(-n // 64)):
            ids, mask = f.sequence(i)
            assert len(ids) == 64
            seqs.append(ids[mask])
        back += np.concatenate(seqs).tolist()
        assert f.ids(5, n - 7).tolist() == back[len(back) - n:][5:n - 2]
    assert back == every
    assert not [f for f in open_folder(folder)[0].get_file_info(__import__("pyarrow").fs.FileSelector(str(tmp_path))) if not f.path.endswith(".arrow")]


def test_tokens_of_hard_words_equal_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    from flowruns.llm.token_files import encoder

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    hard = ["", "a.b,c.", "<|endoftext|>. X<|startoftext|>,", "<|ENDOFTEXT|>", "It's, I'M. don't.,!", "...,. 3.14, 1,000.", "É, İstanbul. ΑΣ. ß,",
            "\x1ca.\x85b,", "日本語。テスト. ‍,", "<a.>, <b>. <", "á\ńb .́c", "A.́ b,̈", "q.'s t,'ll", "ﬁ Å 1² x́y"]
    for split in (True, False):
        for x, y in zip(hard, encoder(path, "uint16", split)([h.encode() for h in hard])):
            assert np.frombuffer(y, "<u2").tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_tokens_words_beside_marks_and_capitals_share_their_letters():
    """Marks after letters, and capitals of Latin letters, cost no encoding of their own: the letters are learnt once."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from flowruns.llm import token_files

    path, kind = public_tokenizers.path("word_bpe_49k.json"), "uint32"
    t, encode = Tokenizer.from_file(path), token_files.encoder(path, kind, True)
    known = token_files._seen[path, kind, True]["known"]
    known.clear()
    whole, models, one = [], [], known.one
    known.whole = lambda x, **k: whole.append(x) or t.encode(x, **k)
    known.one = lambda x: models.append(x) or one(x)
    x = "Élan élan, ÉLAN$$$ élan.!! élan'' Élan&&& élan%%%"
    assert np.frombuffer(encode([x.encode()])[0], "<u4").tolist() == t.encode(x, add_special_tokens=False).ids
    assert len(models) == 1 and whole == [",", "$$$", ".!!", "''", "&&&", "%%%"]  # the marks alone
    random.seed(7)
    signs = "aZéÉßẞΣσςİıǅǆȺﬁ日１²5'.,$%&<|>_\u0301 \u0085\x1c-Ⅷªº‍ʰͅﬀÅ"
    for _ in range(3000):
        x = " ".join("".join(random.choices(signs, k=random.randint(1, 7))) for _ in range(2))
        assert np.frombuffer(encode([x.encode()])[0], "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_tokens_remembered_words_are_bounded(monkeypatch):
    import public_tokenizers

    from flowruns.llm import token_files

    path = public_tokenizers.path("word_bpe_49k.json")
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}.," for i in range(600)]
    want = token_files.encoder(path, "uint32", False)([" ".join(words).encode()])
    known = token_files.encoder(path, "uint32", True) and token_files._seen[path, "uint32", True]["known"]
    known.clear()
    monkeypatch.setattr(token_files, "REMEMBERED", 50)
    assert token_files.encoder(path, "uint32", True)([" ".join(words).encode()]) == want and len(known) <= 50


def test_tokens_odd_rows(spark, odd_docs, no_docs):
    import public_tokenizers

    from flowruns.llm.token_files import read_tokens, write_tokens

    path = public_tokenizers.path("word_bpe_49k.json")
    out = read_tokens(spark, *write_tokens(odd_docs, path)).orderBy("start").collect()
    assert len(out) == 10 and [r.doc_id for r in out][:2] == [None, None] and sorted(r.n_tokens for r in out)[:3] == [1, 1, 1]
    assert [r.start for r in out] == np.cumsum([0] + [r.n_tokens for r in out])[:-1].tolist()
    assert read_tokens(spark, *write_tokens(no_docs, path)).count() == 0


# 2 mixing
def test_mix_equals_sql(spark):
    from flowruns.llm.mixing import OP2_SQL, op2_pareto_mix

    assert rows_of(op2_pareto_mix(spark, SF)) == oracle(OP2_SQL, "documents")


def test_mix_targets_caps_and_odd_rows(spark, odd_docs, no_docs):
    from flowruns.llm.mixing import mix, mixed

    out = mix(odd_docs).collect()
    assert len(out) == 10 and all(0 <= r.copies <= 2 for r in out)
    size = sum(r.words for r in out)
    targets = {r.row.source: r.target for r in out}
    assert sum(targets.values()) == pytest.approx(1.5 * size)
    assert all(r.target <= 2 * r.source_words for r in out)
    whole = mixed(odd_docs)
    assert whole.columns == odd_docs.columns and whole.count() == sum(r.copies for r in out)
    assert mix(no_docs).count() == 0


def test_pareto_sampling_is_near_targets_with_many_documents(spark):
    from flowruns.llm.mixing import mix

    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.pmod(F.col("id") * 7, F.lit(90)).cast("int")).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    for r in mix(docs, slim=True).groupBy("source_words", "target").agg(F.sum(F.col("copies") * F.col("words")).alias("t")).collect():
        assert abs(r.t - r.target) <= 90


# 3 pseudonyms
def test_pseudonyms_invert_link_and_stay_valid(spark):
    from flowruns.llm.pseudonyms import pseudonymized

    text = "2024-02-29 078-05-1120 4799 1346 8104 4206, 4799134681044206 10.0.0.255 +1 (319) 555-5132 +44 20 7946 0958 A.b-9z@x.org"
    bad = "4799134681044207 300.1.1.1 666-11-1111 2024-02-30 1899-12-31 12345"
    docs = spark.createDataFrame([(1, text, 1), (2, text, 2), (3, bad, 3), (4, None, 4), (5, "", 5)], "doc_id int, text string, n_found int")
    out = {r.row.doc_id: r for r in pseudonymized(docs, "k").collect()}
    assert out[1].text == out[2].text != text and out[1].n_changed == 8
    assert re.sub("[0-9]", "9", out[1].text.split(" 9z")[0])[10:30] == re.sub("[0-9]", "9", text)[10:30]
    parts = out[1].text.split(" ")
    cards = ["".join(parts[2:6]).rstrip(","), parts[6]]
    assert all(len(c) == 16 for c in cards) and all(sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, c))) % 10 == 0 for c in cards)
    assert len(set(cards)) == 1  # the two spellings of one number
    assert out[3].text == bad and out[4].text is None and out[5].text == ""
    new = spark.createDataFrame([(out[1].text,)], "text string")
    assert pseudonymized(new, "k", reveal=True).first().text == text
    assert pseudonymized(docs, "other").where("row.doc_id = 1").first().text != out[1].text


def test_feistel_is_a_permutation(spark):
    from flowruns.llm.pseudonyms import feistel

    df = spark.range(1000).select(F.array((F.col("id") / 100).cast("int"), (F.col("id") / 10 % 10).cast("int"), (F.col("id") % 10).cast("int")).alias("v"))
    ten = F.array(*[F.lit(10)] * 3)
    out = df.select("v", feistel(F.col("v"), ten, "k", "t", False).alias("w"))
    assert out.select("w").distinct().count() == 1000 and out.where("v = w").count() < 50
    assert out.where(feistel(F.col("w"), ten, "k", "t", True) != F.col("v")).count() == 0


# 4 simhash
def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hs = [xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(fps, budget):
    u = sorted(set(fps))
    up = {f: f for f in u}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(u):
        for b in u[i + 1:]:
            if (a ^ b).bit_count() <= budget:
                up[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in u}


def test_simhash_groups_equal_brute_force(spark, texts):
    from flowruns.llm.simhash import op4_simhash_trie

    out = op4_simhash_trie(spark, SF).collect()
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in out} == fps
    group, least = plain_groups(fps.values(), 4), {}
    for d, f in fps.items():
        least[group[f]] = min(least.get(group[f], d), d)
    assert {r.doc_id: r.component_id for r in out} == {d: least[group[f]] for d, f in fps.items()}


@pytest.mark.parametrize("most", [1 << 20, 8])
def test_trie_links_dense_clusters_also_when_keys_are_split(spark, most):
    from flowruns.llm.common import connected
    from flowruns.llm.simhash import links

    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(25):
            x = int(c)
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    got = {r.node: r.root for r in connected(links(df, 4, most)).collect()}
    unsigned = lambda x: x % (1 << 64)
    want = plain_groups(fps, 4)
    classes = lambda m: {frozenset(k) for k in _classes(m).values()}
    mine = {f: f for f in fps} | {unsigned(k): unsigned(v) for k, v in got.items()}
    assert classes(mine) == classes(want)


def _classes(m):
    out = defaultdict(set)
    for k, v in m.items():
        out[v].add(k)
    return out


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    from flowruns.llm.simhash import drop_near_copies, near_groups

    g = near_groups(odd_docs).collect()
    assert len(g) == 10 and len({r.root for r in g if r.fp == 0}) == 1
    kept = drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({r.root for r in g})
    assert near_groups(no_docs).count() == 0 == drop_near_copies(no_docs).count()


def test_repeats_of_a_kept_row_do_not_meet_in_one_task(spark):
    from flowruns.llm.simhash import drop_near_copies

    docs = spark.range(0, 30_000, 1, 12).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one text of six words here").alias("text"))
    out = drop_near_copies(docs.union(docs.limit(1).withColumn("doc_id", F.lit(8).cast("long"))))
    assert [r.doc_id for r in out.collect()] == [7]
    plan = out._jdf.queryExecution().executedPlan().toString()
    last = plan[:plan.index("Exchange", plan.index("WindowGroupLimit"))]  # each task hands on one row of a group
    assert "Final" in last and "Partial" in plan[len(last):]


# 5 decontamination
def test_alignment_equals_plain_smith_waterman():
    from flowruns.llm.decontaminate import align

    rng = np.random.default_rng(1)
    items = [rng.integers(1, 6, rng.integers(1, 12)).astype(np.int32) for _ in range(40)]
    docs = [rng.integers(0, 6, rng.integers(1, 20)).astype(np.int32) for _ in range(40)]
    for a, b, got in zip(items, docs, align(items, docs)):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert got == h.max()


def test_contaminated_finds_exact_and_edited_copies_only(spark, texts):
    from flowruns.llm.decontaminate import contaminated, drop_contaminated, op5_seed_align

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    found = {(r.doc_id, r.item_id) for r in op5_seed_align(spark, SF).collect()}
    assert found >= {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    words = max(items.values(), key=len).split()
    edited = " ".join(w if k % 7 else "changed" for k, w in enumerate(words))
    exact = " ".join(words)
    clean = next(t for d, t in texts.items() if d not in {x[0] for x in found} and len(t) > 500)
    rows = [(1, f"{clean} {edited} {clean}"), (2, clean), (3, None), (4, ""), (None, edited), (1, f"{clean} {edited} {clean}")]
    rows += [(100 + k, exact) for k in range(30)]  # beside many exact copies, an edited one must still be found
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted((r.doc_id or 0) for r in contaminated(docs, bench).collect())
    assert got == [0, 1, *range(100, 130)]
    kept = drop_contaminated(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4] and kept.columns == docs.columns
    assert contaminated(docs, bench.limit(0)).count() == 0 == contaminated(docs.limit(0), bench).count()


def test_many_edited_copies_beside_one_exact_copy_are_found(spark):
    from flowruns.llm.decontaminate import contaminated

    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.desc(F.length("text"))).limit(4)
    rows = []
    for r in bench.collect():
        rows += [(len(rows), r.text)]
        rows += [(len(rows) + k, " ".join(w if (j + 1) % 6 else f"changed{k}" for j, w in enumerate(r.text.split()))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert {r.doc_id for r in contaminated(docs, bench).collect()} == {r[0] for r in rows}


def test_found_pairs_equal_the_alignment_of_every_document_with_every_item(spark, texts):
    from flowruns.llm.decontaminate import MATCH, WORDS, align, op5_seed_align

    number = defaultdict(lambda: len(number) + 1)
    ids = lambda t: np.array([number[w] for w in WORDS.findall((t or "").lower())], dtype=np.int32)
    items = {r.item_id: ids(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    items = {i: w for i, w in items.items() if len(w) >= 4}
    want = {}
    for d, t in texts.items():
        if len(w := ids(t)):
            best = align(list(items.values()), [w] * len(items))
            want |= {(d, i): s / (MATCH * len(x)) for (i, x), s in zip(items.items(), best.tolist()) if s >= MATCH * len(x) / 2}
    assert {(r.doc_id, r.item_id): r.score for r in op5_seed_align(spark, SF).collect()} == want and want


def test_phrase_of_thousands_of_items_costs_no_pairs_and_loses_none():
    import tracemalloc

    from flowruns.llm.decontaminate import Items, run_hashes

    phrase = "according to the following"
    rows = [(i, f"{phrase} " + " ".join(f"w{i}x{k}" for k in range(12))) for i in range(2000)]
    block = Items(rows, 4, 0.5)

    def seeded(text):
        ids = np.array([block.vocab.get(w, 0) for w in text.split()], dtype=np.int32)
        h = run_hashes(ids, 4)
        at = np.flatnonzero(np.isin(h, block.runs))
        return [(block.ids[i], len(w)) for i, w in block.windows(ids, np.searchsorted(block.runs, h[at]).astype(np.int32), at.astype(np.int32), 0.5)]

    stock = f"{phrase} filler " * 4000
    tracemalloc.start()
    assert seeded(stock) == []
    # the item's phrase is its only whole run here, and every third of its own words is another
    edited = " ".join(w if k % 3 else "changed" for k, w in enumerate(rows[7][1].split()[4:], 1))
    assert [i for i, _ in seeded(f"{stock} {phrase} {edited} {stock}")] == [7]
    assert [i for i, _ in seeded(f"{stock} {rows[9][1]}")] == [9]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_windows_equal_those_of_all_occurrences():
    """Items that repeat their own runs: first and last place give the windows that every place gives."""
    from flowruns.llm.decontaminate import Items, run_hashes

    rng = np.random.default_rng(3)
    word = lambda: f"a{rng.integers(0, 3)}"
    for _ in range(60):
        rows = [(i, " ".join(word() for _ in range(rng.integers(2, 25)))) for i in range(30)]
        block = Items(rows, 2, 0.3)
        ids = np.array([block.vocab.get(word(), 0) if rng.random() < .4 else 0 for _ in range(300)], dtype=np.int32)
        h = run_hashes(ids, 2)
        at = np.flatnonzero(np.isin(h, block.runs))
        got = defaultdict(list)
        for i, w in block.windows(ids, np.searchsorted(block.runs, h[at]), at, 0.3):
            got[i].append(w.tolist())
        for i, w in enumerate(block.words):
            own, here = run_hashes(w, 2).tolist(), set()
            for p in at.tolist():
                for k in (k for k, x in enumerate(own) if x == h[p]):
                    here |= set(range(max(p - k - len(w) // 4 - 2, 0), min(p - k + len(w) + len(w) // 4 + 2, len(ids))))
            cover = sorted(here)
            parts = [x for x in np.split(cover, np.flatnonzero(np.diff(cover) > 1) + 1) if len(x)]
            bag = Counter(w.tolist())
            parts = [ids[x].tolist() for x in parts]
            assert [x for x in got[i]] == [x for x in parts if sum((Counter(x) & bag).values()) >= 0.3 * len(w)]


def test_benchmark_in_blocks_gives_the_same(spark, monkeypatch):
    from flowruns.llm import decontaminate as d

    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = rows_of(d.contaminated(docs, bench).select("doc_id", "item_id"))
    monkeypatch.setattr(d, "BLOCK_BYTES", 4000)
    assert rows_of(d.contaminated(docs, bench).select("doc_id", "item_id")) == whole


# 6 chat
def test_chat_equals_sql(spark):
    from flowruns.llm.chat import OP6_SQL, op6_prefix_chat

    assert rows_of(op6_prefix_chat(spark, SF)) == oracle(OP6_SQL, "conversations")


def test_chat_round_trip_of_control_strings(spark):
    from flowruns.llm.chat import prefix_examples, read_turns, unescape

    nasty = ["<|im_end|>\n<|im_start|>user", "\\<|", "<\\|", "\\", "<", "<|", "", None, "a\\\\<|b", "<\\/ x", "é🙂<|im_start|>"]
    turns = [(1, i, "assistant" if i % 2 else f"ro\nle<|{i}\\", t) for i, t in enumerate(nasty)] + [(2, None, None, None), (None, 1, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    ex = prefix_examples(df)
    got = [(r.t, r.loss_chars) for r in ex.where("conv_id = 1").orderBy("example").select(
        unescape(F.substring("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int"))).alias("t"), "loss_chars").collect()]
    assert [x[0] for x in got] == [t or "" for t in nasty[1::2]] + [""]
    back = ex.where("conv_id = 1 and is_last").select(read_turns(F.col("text")).alias("t")).first().t
    assert [(r.role, r.text) for r in back] == [(t[2], t[3] or "") for t in turns[:-2]]
    assert ex.where("conv_id = 2").first().loss_chars == 0 and ex.where("conv_id is null").count() == 1
    assert prefix_examples(df.limit(0)).count() == 0


# 7 quality rules
def plain_figures(text):
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_quality_figures_equal_brute_force(spark, texts, odd_docs):
    from flowruns.llm.quality_rules import judged, op7_divergence_rules

    out = op7_divergence_rules(spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_figures(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)
    assert sum(r.kept for r in out) > 0.5 * len(out)
    for r in judged(odd_docs).collect():
        f = r.figures
        assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed) == plain_figures(r.row.text)


def test_quality_rejects_junk_and_keeps_columns(spark, odd_docs, no_docs):
    from flowruns.llm.quality_rules import distance, keep_good

    assert keep_good(odd_docs).columns == odd_docs.columns and keep_good(no_docs).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    n = keep_good(docs).join(labels, "doc_id").groupBy("quality").count().collect()
    n = {r.quality: r["count"] for r in n}
    assert n[1] > 60 and n.get(0, 0) <= 2
    d = spark.range(1).select(distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(3.0))).alias("a"),
                              distance(F.array(F.lit(1.0), F.lit(1.0)), F.array(F.lit(3.0), F.lit(3.0))).alias("b")).first()
    assert (d.a, d.b) == (1.0, 0.0)


def test_quality_rejects_wrong_languages_and_texts_without_common_words(spark):
    from flowruns.llm.quality_rules import judged

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").select("doc_id")
    plain = [r for r in docs.join(good, "doc_id").where("length(text) > 1500").orderBy("doc_id").collect()]
    wrong = [next(r.text for r in plain if r.lang == a) for a in ("en", "fr", "de", "es")]
    rng = np.random.default_rng(3)
    letters = lambda first, n: "".join(chr(first + x) for x in rng.integers(0, n, 7))
    odd = [(-1 - i, t, lang) for i, (t, lang) in enumerate(zip(wrong, ("de", "es", "en", "fr")))]
    odd += [(-10, " ".join(letters(97, 26) for _ in range(200)), "en"), (-11, " ".join(letters(0x3B1, 16) for _ in range(200)), "en"),
            (-12, " ".join(letters(0x4E00, 900) for _ in range(200)), "de"), (-13, " ".join(letters(0x1F600, 40) for _ in range(200)), "en")]
    out = judged(docs.union(spark.createDataFrame(odd, docs.schema)))
    out = {r.doc_id: r for r in out.select("row.doc_id", "figures.*").collect()}
    assert not any(out[x[0]].base_failed or out[x[0]].kept for x in odd)
    assert all(out[x].word_distance > 0.36 for x in (-1, -2, -3, -4, -10))
    assert all(out[x].char_distance > 0.2 for x in (-11, -12, -13))
    judge = [out[r.doc_id] for r in plain if not out[r.doc_id].base_failed]
    assert sum(r.kept for r in judge) >= 0.99 * len(judge)


# 8 classifier
def test_classifier_on_held_out_rows(spark):
    from flowruns.llm.classifier import op8_rule_quality

    sf = "/root/testdata/sf0.01"
    out = op8_rule_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert out.count() == 1000 and out.where("score < 0 or score > 1 or score is null").count() == 0
    assert out.where(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)).count() == 0
    rows = out.where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95


def test_classifier_odd_rows_and_rules(spark, odd_docs, no_docs):
    from flowruns.llm.classifier import scored, tree_rules

    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (4, None), (99, 0)], "doc_id long, quality int")
    for labels in (none, one):
        out = scored(odd_docs, labels).collect()
        assert len(out) == 10 and all(0 <= r.score <= 1 for r in out)
    assert scored(no_docs, one).count() == 0
    debug = "x\n  Tree\n  If (feature 0 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 0.5)\n   Predict: 1.0\n"
    assert tree_rules(debug, ["a", "b"]) == {(("a", "<=", 0.5),), (("a", ">", 0.5),), (("a", "<=", 0.5), ("b", "<=", 2.0)), (("a", "<=", 0.5), ("b", ">", 2.0))}


def test_compiled_rules_equal_plain_scores_and_hold_where_the_tree_says(spark):
    from math import exp

    from flowruns.llm.classifier import fit_rules

    rng = np.random.default_rng(2)
    rows = [(float(a), float(b), float(c), int(a + (b > 0.6) > 0.9)) for a, b, c in rng.random((400, 3)).round(3)]
    df = spark.createDataFrame(rows, "s_a double, s_b double, s_c double, label int")
    names = ["s_a", "s_b", "s_c"]
    model = fit_rules(df, names, trees=4)
    assert model.rules and all(w for _, w in model.rules)

    def plain(values):
        total = model.bias + sum(w * values[n] for n, w in model.linear)
        for rule, w in model.rules:
            if all(values[n] <= x if op == "<=" else values[n] > x for n, op, x in rule):
                total += w
        return 1 / (1 + exp(-total))

    got = df.select(*names, "label", model.score().alias("s")).collect()
    assert len(got) == 400 and all(abs(r.s - plain(r.asDict())) < 1e-12 for r in got)
    assert np.mean([(r.s > 0.5) == r.label for r in got]) > 0.95
    # sparse: the penalty leaves fewer rules the higher it is
    assert len(fit_rules(df, names, trees=4, penalty=0.05).rules) < len(model.rules)


def test_tree_paths_cover_every_row_once_per_leaf(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    from flowruns.llm.classifier import rule_sql, tree_rules

    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(a), float(b), float((a > .3) != (b > .6))) for a, b in rng.random((300, 2))], "a double, b double, y double")
    fit = DecisionTreeClassifier(featuresCol="v", labelCol="y", maxDepth=3).fit(VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df))
    rules = tree_rules(fit.toDebugString, ["a", "b"])
    assert len(rules) == fit.numNodes - 1
    leaves = [r for r in rules if not any(set(r) < set(x) for x in rules)]
    hits = df.select(sum(F.expr(f"CASE WHEN {rule_sql(r)} THEN 1 ELSE 0 END") for r in leaves).alias("n")).groupBy("n").count().collect()
    assert [(r.n, r["count"]) for r in hits] == [(1, 300)]


# 9 sharding
def test_ring_is_balanced_gapless_and_moves_little(spark, texts):
    from flowruns.llm.sharding import op9_ring_shards, ring_shards, walk_ring

    out = op9_ring_shards(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        body = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    cells = [(c, 100 + c % 7) for c in range(0, 65536, 5)]
    a, b = walk_ring(cells, 16, 64, 0.001), walk_ring(cells, 17, 64, 0.001)
    load = Counter()
    for c, size in cells:
        load[a[c]] += size
    assert max(load.values()) <= 1.002 * min(load.values()) + 2000
    assert sum(a[c] != b[c] for c, _ in cells) < 0.5 * len(cells)
    docs = spark.createDataFrame([(None, None)] * 50 + [(7, "x")] * 50, "doc_id long, text string")
    same = ring_shards(docs, 4)
    assert same.count() == 100 and {r["count"] for r in same.groupBy("shard").count().collect()} <= set(range(20, 31))
    assert ring_shards(docs.limit(0)).count() == 0


def test_ring_walk_equals_a_plain_walk_and_keeps_its_bound():
    from flowruns.llm.sharding import CELL_BITS, ring_points, walk_ring

    rng = np.random.default_rng(5)
    for shards, cells in ((3, 40), (7, 300), (1, 5), (16, 2000)):
        sizes = {int(c): int(s) for c, s in zip(rng.choice(1 << CELL_BITS, cells, replace=False), rng.pareto(1.2, cells) * 100 + 1)}
        got = walk_ring(sorted(sizes.items()), shards, 8, 0.01)
        mean, load = sum(sizes.values()) / shards, [0] * shards
        ring = ring_points(shards, 8)
        for c in sorted(sizes, key=lambda c: (-sizes[c].bit_length(), c)):
            at = c << (64 - CELL_BITS)
            clockwise = [s for p, s in ring if p >= at] + [s for p, s in ring if p < at]
            fits = [s for s in clockwise if load[s] + sizes[c] <= -(-mean * 1.01 // 1)]
            assert got[c] == (fits[0] if fits else load.index(min(load)))
            load[got[c]] += sizes[c]
        assert max(load) <= max(mean * 1.01 + 1, mean + max(sizes.values()))


def test_growing_the_ring_moves_little(spark):
    from flowruns.llm.sharding import ring_shards

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a, b = (ring_shards(docs, n).select("doc_id", "size", F.col("shard").alias(f"s{n}")) for n in (16, 17))
    both = a.join(b.drop("size"), "doc_id")
    moved = both.agg(F.sum(F.when(F.col("s16") != F.col("s17"), F.col("size"))) / F.sum("size"), F.count("*")).first()
    # the law is bytes: a 17th of them must go to the new shard, thrice that is the most (measured 2.0 times here, 1.3 at
    # sf0.1; by rows 0.23 and 0.16 move, as the small cells come last)
    assert moved[0] < 3 / 17 and moved[1] == docs.count()


def test_copies_of_one_row_are_numbered_by_many_tasks(spark):
    from flowruns.llm.sharding import COPIES, copies, ring_shards

    n = 40 * COPIES + 5
    same = spark.createDataFrame([(1, n), (2, 1), (3, COPIES), (4, COPIES + 1)], "doc_id long, n long")
    out = copies(same)
    assert {r.doc_id: (r.c, r.d, r.a, r.z) for r in out.groupBy("doc_id").agg(F.count("*").alias("c"), F.countDistinct("copy").alias("d"),
            F.min("copy").alias("a"), F.max("copy").alias("z")).collect()} == {k: (x, x, 1, x) for k, x in ((1, n), (2, 1), (3, COPIES), (4, COPIES + 1))}
    per = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per) < n / 2 and len(per) > 4
    docs = spark.range(3 * COPIES).select(F.lit(1).alias("doc_id"), F.lit("a b").alias("text"))
    got = ring_shards(docs, 4).groupBy("shard").agg(F.countDistinct("slot").alias("n"), F.max("slot").alias("top")).collect()
    assert sum(r.n for r in got) == 3 * COPIES and all(r.top == r.n - 1 for r in got)


# 10 substring
def test_repeated_passages_lose_all_but_the_first(spark):
    from flowruns.llm.substring import sentences_of, without_repeats

    def prose(seed, n):
        rng = np.random.default_rng(seed)
        return " ".join(" ".join(f"w{x}" for x in rng.integers(0, 10**6, 9)) + "." for _ in range(n))
    passage = prose(0, 7)
    docs = [(i, f"{prose(i + 1, 5)}\n{passage}\n{prose(i + 100, 5)}") for i in range(20)]
    docs += [(50, prose(500, 8)), (51, None), (52, ""), (53, " \n"), (54, "Short. Text."), (None, passage), (3, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    out = {r.row.doc_id: r for r in without_repeats(df).collect()}
    assert out[0].text == docs[0][1] and out[50].text == prose(500, 8) and out[51].text is None
    assert (out[52].text, out[53].text, out[54].text) == ("", " \n", "Short. Text.")
    for i in range(1, 20):
        assert out[i].text == docs[i][1].replace(passage + "\n", "") and out[i].n_removed == 7
    assert out[None].text == ""
    assert without_repeats(df).count() == len(docs) and without_repeats(df.limit(0)).count() == 0
    for t in (passage, "a,, b!\n\n c", ("x" * 9 + " ") * 100, "a b ... !\n!", "\n\nlead", "1.5 é; ü"):
        bounds, words = sentences_of(t.encode())
        assert bounds[-1] == len(t.encode()) and bounds == sorted(bounds) and len(bounds) == len(words) + 1
        marks = lambda x: [c for c in x.decode() if c.isalnum()]
        assert marks(b"".join(words)) == marks(t.lower().encode())


def plain_without_repeats(rows, sentences=3, words=20):
    """(doc_id, text) of every row: spans compared as lists of words, one by one."""
    from flowruns.llm.substring import sentences_of

    cut, seen = {}, defaultdict(list)
    for d, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        if t is None:
            continue
        bounds, said = sentences_of(t.encode())
        cut[d, t] = bounds, set()
        for a in range(len(said)):
            z = next((z for z in range(a + sentences, len(said) + 1) if sum(len(x.split()) for x in said[a:z]) >= words), None)
            if z:
                seen[tuple(said[a:z])].append((d, t, a, z))
    for places in seen.values():
        for d, t, a, z in places[1:]:
            cut[d, t][1].update(range(a, z))
    out = []
    for d, t in rows:
        bounds, gone = cut.get((d, t), ([0], set()))
        keep = [t.encode()[bounds[i]:bounds[i + 1]] for i in range(len(bounds) - 1) if i not in gone] if t else []
        out.append((d, b"".join(keep).decode() if t else t))
    return Counter(out)


def test_spans_equal_brute_force(spark, texts):
    from flowruns.llm.substring import op10_sentence_spans, without_repeats

    assert Counter((r.doc_id, r.text) for r in op10_sentence_spans(spark, SF).collect()) == plain_without_repeats(list(texts.items()))
    rng = np.random.default_rng(11)
    said = [" ".join(f"s{i}x{k}" for k in range(rng.integers(2, 12))) + ".?,\n"[i % 4] for i in range(40)]
    for _ in range(3):  # few sentences in many orders: spans overlap, repeat inside a text and at its ends
        rows = [(i, " ".join(said[x] for x in rng.integers(0, 40, rng.integers(0, 30)).tolist() for x in range(x, min(x + 4, 40)))) for i in range(60)]
        rows += [rows[3], (None, rows[5][1]), (70, rows[5][1]), (71, None)]
        df = spark.createDataFrame(rows, "doc_id int, text string")
        assert Counter((r.row.doc_id, r.text) for r in without_repeats(df).collect()) == plain_without_repeats(rows)


def test_clashing_columns_and_very_long_texts(spark):
    """Columns named as the operators' own, and a text of 2 MB, change no result."""
    from flowruns.llm.decontaminate import contaminated, drop_contaminated
    from flowruns.llm.sharding import ring_shards
    from flowruns.llm.substring import without_repeats

    rng = np.random.default_rng(8)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n)) + "."
    item = words(30)
    long = " ".join(words(9) for _ in range(30_000)) + " " + item
    rows = [(1, long), (2, long), (3, f"{words(40)} {item} {words(40)}"), (4, words(50))]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    own = ["row", "h", "t", "spans", "rows", "copy", "block", "n", "cell", "size", "shard", "_doc", "_hash", "text_hash", "item_id", "score", "ids", "start", "covered"]
    clash = plain.select("*", *[F.lit("x").alias(c) for c in own])
    bench = spark.createDataFrame([(7, item, "x", "y")], "item_id int, text string, i string, t string")
    assert rows_of(contaminated(clash, bench)) == rows_of(contaminated(plain, bench))
    assert sorted(r.doc_id for r in contaminated(clash, bench).collect()) == [1, 2, 3]
    kept = drop_contaminated(clash, bench)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [4]
    assert rows_of(ring_shards(clash, 4)) == rows_of(ring_shards(plain, 4))
    got = {r.row.doc_id: (r.text, r.n_removed) for r in without_repeats(clash).collect()}
    assert got == {r.row.doc_id: (r.text, r.n_removed) for r in without_repeats(plain).collect()}
    assert got[1] == (long, 0) and got[2][0] == "" and got[4][1] == 0


def test_repeats_in_texts_without_marks_or_blanks(spark):
    from flowruns.llm.substring import GAP, cuts_of, without_repeats

    rng = np.random.default_rng(5)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    han = lambda n: "".join("".join(chr(0x4E00 + x) for x in rng.integers(0, 9000, 9)) + "，。！"[i % 3] for i in range(n))
    docs, passages = [], [words(51) for _ in range(100)]
    for p in passages:
        docs += [(len(docs) + k, f"{words(40)} {p} {words(40)}") for k in range(2)]
    same, inside, unmarked = han(8), han(7), "".join(chr(0x4E00 + x) for x in rng.integers(0, 9000, 120))
    docs += [(1000, same), (1001, same), (1002, f"{han(4)}{inside}{han(4)}"), (1003, f"{han(4)}{inside}{han(4)}"), (1004, unmarked), (1005, unmarked)]
    out = {r.row.doc_id: r.text for r in without_repeats(spark.createDataFrame(docs, "doc_id int, text string")).collect()}
    texts = dict(docs)
    for i, p in enumerate(passages):
        assert out[2 * i] == texts[2 * i]
        kept = out[2 * i + 1].split()
        assert len(kept) <= 80 + 51 - 20 and set(kept) >= set(texts[2 * i + 1].split()) - set(p.split())
    assert [out[k] for k in (1000, 1002, 1004)] == [same, texts[1002], unmarked]
    assert out[1001] == "" and len(out[1005]) <= GAP and out[1003] == texts[1003].replace(inside, "")
    for n in (25, 100):
        cuts = cuts_of(words(n).encode().split())
        assert max(np.diff([0, *cuts, n])) <= GAP


# pipeline
def test_pipeline_against_plain_python(spark, texts, odd_docs, no_docs):
    import corpus_pipeline as p

    from flowruns.llm.common import staged
    from flowruns.llm.decontaminate import op5_seed_align
    from flowruns.llm.quality_rules import op7_divergence_rules

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = staged(p.quality(spark, docs, SF), "t")
    good = {r.doc_id for r in op7_divergence_rules(spark, SF).where("kept").collect()}
    assert {r.doc_id for r in now.collect()} == good and now.columns == docs.columns
    now = staged(p.near_copies(spark, now, SF), "t")
    group, least = plain_groups([plain_fingerprint(texts[d]) for d in good], 4), {}
    for d in good:
        g = group[plain_fingerprint(texts[d])]
        least[g] = min(least.get(g, d), d)
    assert sorted(r.doc_id for r in now.collect()) == sorted(least.values())
    now = staged(p.benchmark_copies(spark, now, SF), "t")
    bad = {r.doc_id for r in op5_seed_align(spark, SF).collect()}
    assert {r.doc_id for r in now.collect()} == set(least.values()) - bad
    mix = staged(p.mixture(spark, now, SF), "t")
    assert mix.columns == docs.columns and max(Counter(r.doc_id for r in mix.collect()).values()) <= 2
    last = p.run(spark, SF).collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in mix.collect())
    for table in (odd_docs, no_docs):
        for _, stage in p.STAGES:
            table = stage(spark, table, SF)
        table.count()
