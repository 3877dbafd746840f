"""Benchmark decontamination: rare n-gram seeds join passages to test items, then Smith-Waterman alignment.

One pass over the documents finds, in each, the places of all n-word runs that the test items
have, and keeps the passages around them (word numbers, not text). A run that at most ``RARE`` items of the
block hold is a rare seed: it joins its passage to all of them. A stock phrase that more items hold
joins a passage only to those of its items that also have one of their own rarest words there: an item of L words
cannot have ``share`` of them in a passage without one of its L - share * L + 1 rarest, so the limit loses no
pair, and phrases common to thousands of items cost no pairs. Rarity counts the items, not the documents: many edited
copies beside few exact ones stay joined. Around each joined run lies a window of the passage as long as the
item and its margins; overlapping windows of an item are one. Each window is aligned locally with the item, word by
word (match +2, mismatch -1, gap -1), unless passage or window holds too few of the item's words to reach the
limit at all. Equal passages of a task are aligned once. A pair counts if its score reaches ``share``
of the item's greatest score, so edited and paraphrased copies are found. A passage takes memory for its own
words and for the block, not for items times places.

The test items travel to the tasks as one broadcast block of at most ``BLOCK_BYTES`` of text; a
larger benchmark is taken in as many blocks, each against all documents. Words are lower-case runs
of letters, digits and underscores.

Defined cases: null and empty texts match nothing, nor do items of fewer than ``n`` words; equal
items each match; repeated rows match alike (one row per doc_id, text and item); null doc_ids are
kept; empty tables give an empty result; extra columns do not matter; whole texts are searched.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from flowruns.llm.common import staged, table, text_key

BLOCK_BYTES = 8 << 20
#: A task remembers the result of about so many different passages (a hash and mostly an empty list each).
KNOWN = 200_000
#: A run of more items than this joins through their rarest words.
RARE = 16
#: So many windows at most wait for their alignment.
WAITING = 4096
MATCH, MISMATCH, GAP = 2, -1, -1
WORDS = re.compile(r"\w+")


def run_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n word numbers; runs with an unknown word (0) hash to 0."""
    if len(ids) < n:
        return np.zeros(0, dtype=np.uint64)
    h, known = np.zeros(len(ids) - n + 1, dtype=np.uint64), np.ones(len(ids) - n + 1, dtype=bool)
    for k in range(n):
        part = ids[k:len(ids) - n + 1 + k]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (part.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        h ^= h >> np.uint64(29)
        known &= part > 0
    return np.where(known, h | np.uint64(1), np.uint64(0))


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of all ranges, one after another."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


class Items:
    """A block of test items: word numbers; for every run the items that hold it, with their first and last place
    of it; for every word the items among whose rarest it is."""

    def __init__(self, rows: list[tuple], n: int, share: float):
        self.n, self.vocab = n, {}
        self.ids, self.words = [], []
        for item, text in rows:
            w = WORDS.findall((text or "").lower())
            if len(w) >= n:
                self.ids.append(item)
                self.words.append(np.array([self.vocab.setdefault(x, len(self.vocab) + 1) for x in w], dtype=np.int32))
        size = np.array([len(w) for w in self.words], dtype=np.int64)
        chain = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        h = chain([run_hashes(w, n) for w in self.words], np.uint64)
        item = np.repeat(np.arange(len(size)), size - n + 1)
        place = chain([np.arange(k - n + 1) for k in size.tolist()], np.int64)
        order = np.lexsort((place, item, h))
        h, item, place = h[order], item[order], place[order]
        start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (item[1:] != item[:-1])])[:len(h)])
        self.item, self.low, self.high = item[start], place[start], place[np.append(start[1:], len(h))[:len(start)] - 1]
        self.runs, self.first, self.count = np.unique(h[start], return_index=True, return_counts=True)
        self.run = np.repeat(np.arange(len(self.runs)), self.count)
        size = size[self.item]
        margin = size // 4 + n
        of = lambda x: np.maximum.reduceat(x, self.first) if len(x) else x
        self.before, self.after = of(self.high + margin), of(size - self.low + margin)
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        often = np.bincount(chain([b[0] for b in self.bags], np.int64), minlength=len(self.vocab) + 1)
        heads = []
        for w in self.words:
            least = max(1, math.ceil(share * len(w) - 1e-9))
            heads.append(np.unique(w[np.argsort(often[w], kind="stable")][:len(w) - least + 1]))
        word, of_item = chain(heads, np.int64), np.repeat(np.arange(len(heads)), [len(x) for x in heads])
        self.head = of_item[np.argsort(word, kind="stable")]
        self.head_count = np.bincount(word, minlength=len(self.vocab) + 1)
        self.head_first = np.cumsum(self.head_count) - self.head_count

    def joined(self, runs: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Numbers of the (run, item) pairs that a passage with these runs and words is joined to, in item order."""
        few = self.count[runs] <= RARE
        pairs = [spread(self.first[runs[few]], self.count[runs[few]])]
        if not few.all():
            near = np.zeros(len(self.words), dtype=bool)
            near[self.head[spread(self.head_first[held], self.head_count[held])]] = True
            for r in runs[~few]:
                own = np.arange(self.first[r], self.first[r] + self.count[r])
                pairs.append(own[near[self.item[own]]])
        pairs = np.concatenate(pairs)
        return pairs[np.argsort(self.item[pairs], kind="stable")]

    def windows(self, ids: np.ndarray, runs: np.ndarray, places: np.ndarray, share: float):
        """(item, words) of the windows of a passage that can reach ``share`` of an item it is joined to."""
        def reaches(i: int, held: np.ndarray, often: np.ndarray) -> bool:
            # at best every word that both hold matches
            words, most = self.bags[i]
            k = np.minimum(np.searchsorted(held, words), len(held) - 1)
            return np.minimum(np.where(held[k] == words, often[k], 0), most).sum() >= share * len(self.words[i])

        order = np.argsort(runs, kind="stable")
        places, (own, first, count) = places[order], np.unique(runs[order], return_index=True, return_counts=True)
        bag = np.unique(ids, return_counts=True)
        pairs = self.joined(own, bag[0])
        for e in np.split(pairs, np.flatnonzero(np.diff(self.item[pairs])) + 1) if len(pairs) else ():
            i = int(self.item[e[0]])
            if not reaches(i, *bag):
                continue
            size, r = len(self.words[i]), np.searchsorted(own, self.run[e])
            at = places[spread(first[r], count[r])]
            # a run's places in the item are closer than a window is long, so first and last give the same windows as all
            lo = np.maximum(at - np.repeat(self.high[e], count[r]) - size // 4 - self.n, 0)
            hi = np.minimum(at - np.repeat(self.low[e], count[r]) + size + size // 4 + self.n, len(ids))
            order = np.argsort(lo, kind="stable")
            lo, hi = lo[order], np.maximum.accumulate(hi[order])
            new = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
            for x, y in zip(new, np.append(new[1:], len(lo))):
                part = ids[lo[x]:hi[y - 1]]
                if len(part) == len(ids) or reaches(i, *np.unique(part, return_counts=True)):
                    yield i, part


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each item with its passage; all pairs advance together, an item's
    word at a time (gaps cost the same each, so a row's gaps are a running maximum)."""
    wide, deep = max(map(len, passages)), max(map(len, items))
    d, t = np.zeros((len(items), wide), dtype=np.int32), np.full((len(items), deep), -1, dtype=np.int32)
    for r, (a, b) in enumerate(zip(items, passages)):
        t[r, :len(a)], d[r, :len(b)] = a, b
    slope = np.arange(wide, dtype=np.int32) * -GAP
    score, best = np.zeros((len(items), wide + 1), dtype=np.int32), np.zeros(len(items), dtype=np.int32)
    for i in range(deep):
        step = np.where(d == t[:, i:i + 1], MATCH, MISMATCH).astype(np.int32)
        now = np.maximum(np.maximum(score[:, :-1] + step, score[:, 1:] + GAP), 0)
        score[:, 1:] = np.maximum.accumulate(now + slope, axis=1) - slope
        best = np.maximum(best, score.max(axis=1))
    return best


def passages(docs: DataFrame, items, key: str, text: str) -> DataFrame:
    """(doc_id, text_hash, ids, runs, places): the passages of each document that may hold an item,
    with the runs they hold (their numbers in the block) and the runs' places in the passage."""
    def run(batches):
        block = items.value
        n, get = block.n, block.vocab.get
        for b in batches:
            rows = []
            for r, t in enumerate(b.column(2)):
                if not t.is_valid or not len(block.runs):
                    continue
                ids = np.array([get(w, 0) for w in WORDS.findall(t.as_py().lower())], dtype=np.int32)
                h = run_hashes(ids, n)
                at = np.flatnonzero(h)
                k = np.minimum(np.searchsorted(block.runs, h[at]), len(block.runs) - 1)
                hit = block.runs[k] == h[at]
                at, k = at[hit], k[hit]
                if not len(at):
                    continue
                lo, hi = np.maximum(at - block.before[k], 0), np.minimum(at + block.after[k], len(ids))
                lo = np.minimum.accumulate(lo[::-1])[::-1]
                new = np.flatnonzero(np.concatenate([[True], lo[1:] > np.maximum.accumulate(hi)[:-1]]))
                for x, y in zip(new, np.append(new[1:], len(at))):
                    a, z = int(lo[x]), int(hi[x:y].max())
                    rows.append((r, ids[a:z], k[x:y], at[x:y] - a))
            if rows:
                pick = pa.array([x[0] for x in rows])
                lists = [pa.array([x[c] for x in rows], pa.list_(pa.int32())) for c in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), *lists], ["doc_id", "text_hash", "ids", "runs", "places"])

    slim = docs.select(F.col(key).alias("doc_id"), text_key(text).alias("text_hash"), F.col(text).alias("t"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, text_hash long, ids array<int>, runs array<int>, places array<int>")


def aligned(found: DataFrame, items, share: float, item_type: DataType) -> DataFrame:
    """(doc_id, text_hash, item_id, score) of the passages that align with an item they are joined to."""
    id_type = to_arrow_type(item_type)

    def score(block, pairs) -> list:
        """Adds (item, score) to the list of each pair that reaches ``share``; no pair is left."""
        pairs = sorted(pairs, key=lambda x: len(x[2]))
        while pairs:
            # as many pairs at once as fit about 4M cells a row, so long passages go a few at a time
            take = max(1, min(len(pairs), 256, (4 << 20) // max(1, len(pairs[min(len(pairs), 256) - 1][2]))))
            now, pairs = pairs[:take], pairs[take:]
            best = align([block.words[i] for _, i, _ in now], [w for _, _, w in now])
            for (hits, i, _), s in zip(now, best.tolist()):
                if (reached := s / (MATCH * len(block.words[i]))) >= share:
                    hits.append((i, reached))
        return []

    def run(batches):
        block, known = items.value, {}
        for b in batches:
            pairs, equal, new = [], defaultdict(list), {}
            lists = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in (b.column(c) for c in (2, 3, 4))]
            for r in range(b.num_rows):
                ids, runs, places = (v[at[r]:at[r + 1]] for v, at in lists)
                key = blake2b(ids.tobytes(), digest_size=16).digest()
                equal[key].append(r)
                if key not in known and key not in new:
                    new[key] = []
                    for i, part in block.windows(ids, runs, places, share):
                        pairs.append((new[key], i, part))
                        if len(pairs) == WAITING:
                            pairs = score(block, pairs)
            score(block, pairs)
            out = [(r, *x) for key, rows in equal.items() for x in new.get(key, known.get(key, ())) for r in rows]
            known.update(new if len(known) < KNOWN else ())
            if out:
                pick = pa.array([x[0] for x in out])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), pa.array([block.ids[x[1]] for x in out], id_type),
                                                  pa.array([x[2] for x in out])], ["doc_id", "text_hash", "item_id", "score"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, text_hash long, item_id {item_type.simpleString()}, score double")


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 4, share: float = 0.5, text: str = "text",
                 key: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, score) of every document that holds a copy of a test item."""
    spark = docs.sparkSession
    tests = benchmark.select(F.col(item).alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    item_type = tests.schema["i"].dataType
    size = tests.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks, parts = max(1, -(-size // BLOCK_BYTES)), []
    for block in range(blocks):
        rows = tests.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).collect()
        items = spark.sparkContext.broadcast(Items(sorted(((r.i, r.t) for r in rows), key=lambda r: (r[0] is None, r)), n, share))
        found = staged(passages(docs, items, key, text), "passages")
        # passages may sit in few files: spread the alignment evenly
        parts.append(staged(aligned(found.repartition("doc_id", "text_hash"), items, share, item_type), "aligned"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy("doc_id", "text_hash", "item_id").agg(F.max("score").alias("score"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` without a copy of a test item."""
    bad = staged(contaminated(docs, benchmark, text=text, key=key, **how).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct(), "bad")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("doc_id"), text_key(text).alias("h"))
    return rows.join(bad, rows["doc_id"].eqNullSafe(bad["_doc"]) & (rows["h"] == bad["_hash"]), "left_anti").select("row.*")


def op5_seed_align(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a copy of a benchmark item, with the item and its score."""
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "score")
