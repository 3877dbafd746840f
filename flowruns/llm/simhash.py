"""SimHash near-duplicates by a binary trie self-join.

A document's fingerprint: of the 64-bit hashes of its word shingles, each bit is the majority.
Two fingerprints are linked if they differ in at most ``budget`` bits; documents are grouped by
reachability.

The join runs over distinct fingerprints (copies meet in a grouped minimum first). The 64 bits are
cut into ``BLOCKS`` blocks; a pair within the budget agrees wholly in at least ``BLOCKS - budget`` of
them, so each fingerprint is dealt once for every choice of that many blocks, keyed by the choice
and those blocks' bits. All fingerprints of a key share the top of one binary trie, whose remaining
levels a task walks: node pairs are traversed together, level by level and vectorised; a pair adds one
differing bit when its two nodes part, and is pruned when the budget is exceeded, or when
all leaves below both nodes are already known to be connected. A task emits a spanning forest of
its links, never all pairs.

A key with more than ``most`` fingerprints is split: its trie is cut ``SPLIT`` levels further down, and
each pair of subtries within the budget is a key of its own. Nothing is dropped or capped.

Defined cases: null, empty and blank texts have fingerprint 0 and are linked like any other; texts
shorter than a shingle are one shingle; null doc_ids are grouped but never name a group that has
another id; repeated rows are in one group; an empty table gives an empty result; extra
columns do not matter. ``drop_near_copies`` keeps the rows' columns.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowruns.llm.common import connected, staged, table, text_key

BLOCKS = 6
WIDTHS = (11, 11, 11, 11, 10, 10)  # of the blocks, high bits first; 64 in all
SPLIT = 8
SMALL = 64  # node pairs of at most so many leaf pairs are compared leaf by leaf
FRONTIER = 1 << 19


def fingerprint(text: bytes, n: int) -> int:
    """Majority of the bits of the hashes of all n-word shingles of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: A-Z only, ASCII blanks only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*[words[i:] for i in range(n)])) if len(words) >= n else iter([b" ".join(words)])
    hashes = np.fromiter((xxh64_intdigest(s, 42) for s in shingles), dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes(), shingle) if t.is_valid else 0 for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    slim = docs.select(F.col(key).alias("doc_id"), text_key(text).alias("text_hash"), F.col(text).cast("binary").alias("t"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def choices(budget: int) -> list[tuple[int, ...]]:
    """The sets of blocks of which a pair within the budget agrees in at least one."""
    return list(combinations(range(BLOCKS), max(0, BLOCKS - budget)))


def permuted(fp: np.ndarray, chosen: tuple[int, ...]) -> np.ndarray:
    """Fingerprints with the chosen blocks' bits moved to the top."""
    starts = np.concatenate([[0], np.cumsum(WIDTHS)])
    out, used = np.zeros(len(fp), dtype=np.uint64), 0
    for b in [*chosen, *[b for b in range(BLOCKS) if b not in chosen]]:
        w = WIDTHS[b]
        part = (fp >> np.uint64(64 - starts[b] - w)) & np.uint64((1 << w) - 1)
        out |= part << np.uint64(64 - used - w)
        used += w
    return out


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (least index of a component) after linking i and j."""
    while len(i):
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        while not np.array_equal(new, new[new]):
            new = new[new]
        label, apart = new, new[i] != new[j]
        i, j = i[apart], j[apart]
    return label


def trie_links(a: np.ndarray, nodes: np.ndarray, budget: int) -> np.ndarray:
    """Component labels of the sorted, distinct fingerprints ``a`` (as bits from the root down).

    ``nodes``: rows (lo, hi, lo2, hi2, depth, spent) of node pairs to start from; a node is the range
    of leaves below it.
    """
    label = np.arange(len(a))
    close = np.unique(nodes[(nodes[:, 1] - nodes[:, 0]) > 1024][:, :2], axis=0)
    for lo, hi in close:  # dense clusters: link neighbours at one bit first, so that most pairs are pruned
        part = a[lo:hi]
        for bit in range(64):
            flipped = part ^ np.uint64(1 << bit)
            at = np.minimum(np.searchsorted(part, flipped), len(part) - 1)
            hit = np.flatnonzero(part[at] == flipped)
            label = merge(label, lo + hit, lo + at[hit])
    stack = [nodes]
    while stack:
        now = stack.pop()
        if len(now) > FRONTIER:
            stack += [now[FRONTIER:]]
            now = now[:FRONTIER]
        turns = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        lo, hi, lo2, hi2, depth, spent = now.T
        known = (turns[lo] == turns[hi - 1]) & (turns[lo2] == turns[hi2 - 1]) & (label[lo] == label[lo2])
        now = now[~known]
        few = (now[:, 1] - now[:, 0]) * (now[:, 3] - now[:, 2]) <= SMALL
        lo, hi, lo2, hi2, depth, spent = now[few].T
        pairs = (hi - lo) * (hi2 - lo2)
        which = np.repeat(np.arange(len(pairs)), pairs)
        k = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        i, j = lo[which] + k // (hi2 - lo2)[which], lo2[which] + k % (hi2 - lo2)[which]
        linked = (i < j) & (np.bitwise_count(a[i] ^ a[j]) <= budget)
        label = merge(label, i[linked], j[linked])
        now = now[~few]
        if not len(now):
            continue
        lo, hi, lo2, hi2, depth, spent = now.T
        bit = np.uint64(1) << (63 - depth).astype(np.uint64)

        def parting(lo, hi):
            first = (a[lo] | (bit - np.uint64(1)) | bit) ^ (bit - np.uint64(1))  # the least leaf with this bit set
            return np.clip(np.searchsorted(a, first), lo, hi)

        mid, mid2 = parting(lo, hi), parting(lo2, hi2)
        same = lo == lo2
        kids = [(lo, mid, lo2, mid2, 0, None), (mid, hi, mid2, hi2, 0, None), (lo, mid, mid2, hi2, 1, None), (mid, hi, lo2, mid2, 1, ~same)]
        out = []
        for l1, h1, l2, h2, cost, only in kids:
            live = (h1 > l1) & (h2 > l2) & (spent + cost <= budget)
            live = live if only is None else live & only
            out.append(np.stack([l1, h1, l2, h2, depth + 1, spent + cost], axis=1)[live])
        stack.append(np.concatenate(out))
    return label


def links(distinct: DataFrame, budget: int = 4, most: int = 1 << 20) -> DataFrame:
    """(u, v) links that connect all pairs of ``distinct`` (one column fp) within ``budget`` bits.

    The links span the same components as all such pairs do."""
    starts = [sum(WIDTHS[:b]) for b in range(BLOCKS)]
    sets = choices(budget)
    free = 64 - max(sum(WIDTHS[b] for b in s) for s in sets)

    def key(s):
        out = F.lit(0).cast("long")
        for b in s:
            part = F.shiftrightunsigned("fp", 64 - starts[b] - WIDTHS[b]).bitwiseAND(F.lit((1 << WIDTHS[b]) - 1).cast("long"))
            out = F.shiftleft(out, WIDTHS[b]).bitwiseOR(part)
        return out

    def below(s):
        """The next SPLIT bits of the trie after the chosen blocks."""
        out, got = F.lit(0).cast("long"), 0
        for b in [b for b in range(BLOCKS) if b not in s]:
            take = min(WIDTHS[b], SPLIT - got)
            if take > 0:
                part = F.shiftrightunsigned("fp", 64 - starts[b] - take).bitwiseAND(F.lit((1 << take) - 1).cast("long"))
                out, got = F.shiftleft(out, take).bitwiseOR(part), got + take
        return out.cast("int")

    dealt = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(c).cast("short").alias("c"), key(s).alias("k"), below(s).alias("b")) for c, s in enumerate(sets)])).alias("d")).select("fp", "d.*")
    heavy = dealt.groupBy("c", "k").agg(F.count("*").alias("n")).where(F.col("n") > most).select("c", "k", F.lit(True).alias("heavy"))
    # of a heavy key: one copy for each pair of subtries within the budget that the fingerprint's is in
    near = F.filter(F.sequence(F.lit(0), F.lit((1 << SPLIT) - 1)), lambda x: F.bit_count(x.bitwiseXOR(F.col("b"))) <= budget)
    task = F.when(F.col("heavy"), F.transform(near, lambda x: F.least(x, F.col("b")) * (1 << SPLIT) + F.greatest(x, F.col("b"))))
    dealt = dealt.join(heavy, ["c", "k"], "left").select(
        "c", "k", F.explode(F.coalesce(task, F.array(F.lit(-1)))).alias("task"), "fp")
    dealt = dealt.repartition("c", "k", "task").sortWithinPartitions("c", "k", "task")

    def run(batches):
        import pandas as pd

        kept = None
        for b in batches:
            df = pd.DataFrame({n: b.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(("c", "k", "task", "fp"))})
            kept = df if kept is None else pd.concat([kept, df], ignore_index=True)
            c, k, t = (kept[x].to_numpy() for x in ("c", "k", "task"))
            changes = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1]) | (t[1:] != t[:-1])) + 1
            if len(kept) >= 1 << 18 and len(changes):
                yield from walk(kept.iloc[:changes[-1]])
                kept = kept.iloc[changes[-1]:]
        if kept is not None and len(kept):
            yield from walk(kept)

    def walk(rows):
        for c, part in rows.groupby("c", sort=False):
            chosen = sets[c]
            skip = sum(WIDTHS[b] for b in chosen)
            fp = part["fp"].to_numpy().view(np.uint64)
            task, a = part["task"].to_numpy(), permuted(fp, chosen)
            for t in np.unique(task):  # heavy keys' tasks one by one, all other keys together
                at = np.flatnonzero(task == t)
                at = at[np.argsort(a[at], kind="stable")]
                bits, own = a[at], fp[at]
                new = np.concatenate([[True], bits[1:] != bits[:-1]])
                bits, own = bits[new], own[new]  # a subtrie joined with itself gets each once already
                depth = skip + (SPLIT if t >= 0 else 0)
                top = bits >> np.uint64(64 - depth)
                lo = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
                hi = np.append(lo[1:], len(bits))
                z = np.zeros_like(lo)
                nodes = np.stack([lo, hi, lo, hi, z + depth, z], axis=1)
                if t >= 0 and t >> SPLIT != t & ((1 << SPLIT) - 1):  # pairs of two subtries, of each key in turn
                    root = top >> np.uint64(SPLIT)
                    pair = [(x, y) for x, y in zip(range(len(lo) - 1), range(1, len(lo))) if root[lo[x]] == root[lo[y]]]
                    cost = int(t >> SPLIT ^ t & ((1 << SPLIT) - 1)).bit_count()
                    nodes = np.array([[lo[x], hi[x], lo[y], hi[y], depth, cost] for x, y in pair], dtype=np.int64).reshape(-1, 6)
                else:
                    nodes = nodes[hi - lo > 1]
                label = trie_links(bits, nodes, budget) if len(nodes) else np.arange(len(bits))
                linked = np.flatnonzero(label != np.arange(len(bits)))
                if len(linked):
                    yield pa.RecordBatch.from_arrays([pa.array(own[linked].view(np.int64)), pa.array(own[label[linked]].view(np.int64))], ["u", "v"])

    assert free >= SPLIT
    return dealt.mapInArrow(run, "u long, v long")


def near_groups(docs: DataFrame, shingle: int = 4, budget: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row: ``root`` names the group, and
    ``component_id`` is its smallest doc_id."""
    each = staged(fingerprints(docs, shingle, text, key), "fingerprints")
    distinct = staged(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected(links(distinct.select("fp"), budget))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    # written out, so that the join on a large group's root is a plain one, which can be split
    ids = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = staged(named.join(ids, "root").select("fp", "root", "component_id"), "named")
    return each.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 4, budget: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of ``docs`` of each group: the one with the smallest doc_id (null last), then text hash."""
    groups = near_groups(docs, shingle, budget, text, key)
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("b"))
    keep = staged(best.select(F.col("b.doc_id").alias("_doc"), F.col("b.text_hash").alias("_hash")), "keep")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("doc_id"), text_key(text).alias("h"))
    kept = rows.join(keep, rows["doc_id"].eqNullSafe(keep["_doc"]) & (rows["h"] == keep["_hash"]), "left_semi")
    # rows equal in id and text: one stays. Spark keeps one of each task before the shuffle (WindowGroupLimit)
    one = Window.partitionBy("doc_id", "h").orderBy("doc_id")
    return kept.withColumn("k", F.row_number().over(one)).where("k = 1").select("row.*")


def op4_simhash_trie(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: shingles of 4 words, at most 4 differing bits."""
    out = near_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
