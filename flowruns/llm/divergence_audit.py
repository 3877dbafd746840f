"""Audit of how the sources of a language differ in their use of its terms, from one-hot level products.

Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased; a language keeps the terms that
are in at least ``min_docs`` of its documents. A group is a (language, source), and its share of a term
depends on nothing but the term's count in the group (its level). So all that a pair of groups needs is its joint
table: how many terms have level i in one and level j in the other. With one indicator column per
(group, level) and one row per term, the matrix times its transpose holds the joint tables of all
pairs at once. The product is taken in blocks of terms, small enough that a block has few levels, and exactly
(counts of at most a block's rows in doubles); each entry is then priced once, by the group shares of its two levels.

1. Each task reduces its documents to one row per (language, source, term), in flushes of bounded size; one shuffle by
   (language, term) sums them and gathers a term's counts by source into one row.
2. Groups are numbered within their language. The sums of a block of terms for all pairs of at most
   ``GROUPS`` by ``GROUPS`` groups are one matrix; more groups are taken in several passes, so neither the matrix nor the
   group table that goes to the tasks grows with the data.
3. Terms are priced by plain columns against their language's shares, and ranked by window, which
   Spark cuts to the first ranks in the tasks, before its shuffle.

All arithmetic is in whole numbers. Shares come from decimals; a pair's sum is at most about (10^9 + V)^2 < 2^63.

Defined cases: null text, language and source are the empty string; a document without terms still makes its
group; a language without kept terms has value 0 for each pair and no term rows; repeated rows are documents of
their own; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowruns.llm.common import staged, table

UNIT = 1_000_000_000
#: Entries of the counters of a task before they are sent on.
FLUSH = 500_000
#: Bytes of a text that are split at a time.
PIECE = 1 << 20
#: Groups on either side of a matrix of pair values.
GROUPS = 1_024
#: Indicator columns of a block of terms (beyond four per group).
LEVELS = 512
#: Letters and all bytes of characters beyond ASCII stay, A-Z become a-z, all else a blank.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of ``text``, in lists of about ``PIECE`` bytes."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and TABLE[text[end]] != 32:  # to the end of the term that the piece would cut
            end += 1
        yield text[at:end].translate(TABLE).split()
        at = end


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, term, source, n, docs): partial sums of occurrences and of documents with the term."""
    def run(batches):
        n, seen, size = defaultdict(Counter), defaultdict(Counter), 0

        def flush():
            for (la, so), counts in n.items():
                terms, k = list(counts), len(counts)
                in_docs = seen[la, so]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([la] * k, pa.string()), pa.array(terms, pa.binary()), pa.array([so] * k, pa.string()),
                     pa.array(list(counts.values()), pa.int64()), pa.array([in_docs[t] for t in terms], pa.int64())], ["lang", "term", "source", "n", "docs"])
            n.clear()
            seen.clear()

        for batch in batches:
            for la, so, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts, own = n[la, so], set()
                size -= len(counts)
                for terms in term_pieces(t.as_py()):
                    counts.update(terms)
                    own.update(terms)
                seen[la, so].update(own)
                size += len(counts)
                if size > FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(_name(lang).alias("lang"), _name(source).alias("source"), body.alias("t"))
    out = rows.mapInArrow(run, "lang string, term binary, source string, n long, docs long")
    return out.withColumn("term", F.col("term").cast("string"))


def _name(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + terms)), exact."""
    whole = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", whole(count + 1) * F.lit(UNIT).cast("decimal(10,0)"), whole(total + terms)) + 1


def price(p, q):
    """floor((p - q)^2 / q), of columns or arrays of longs."""
    return (p - q) * (p - q) // q if isinstance(p, np.ndarray) else F.call_function("div", (p - q) * (p - q), q)


def blocks_of(counts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``counts`` (terms by groups) in blocks of rows with at most ``most`` levels, or of few rows.

    Yields per block the one-hot rows (terms by levels), and the group and the count of each level, in order of groups."""
    stack = [counts[np.argsort(counts.sum(axis=1), kind="stable")]]
    while stack:
        block = stack.pop()
        order = np.sort(block, axis=0)
        new = np.ones(block.shape, dtype=bool)
        new[1:] = order[1:] != order[:-1]
        if new.sum() > most and len(block) > 16:
            stack += [block[len(block) // 2:], block[:len(block) // 2]]
            continue
        group = np.repeat(np.arange(block.shape[1]), new.sum(axis=0))
        level = order.T[new.T]
        hot = np.zeros((len(block), len(group)))
        start = np.concatenate([[0], np.cumsum(new.sum(axis=0))])
        rows = np.arange(len(block))
        for g in range(block.shape[1]):
            hot[rows, start[g] + np.searchsorted(level[start[g]:start[g + 1]], block[:, g])] = 1
        yield hot, group, level


def pair_values(counts: np.ndarray, totals: list[int], terms: int, left: slice, right: slice) -> np.ndarray:
    """Summed prices, over the rows of ``counts``, of the groups ``left`` against the groups ``right``."""
    first, second = range(*left.indices(counts.shape[1])), range(*right.indices(counts.shape[1]))
    out = np.zeros((len(first), len(second)), dtype=np.int64)
    for hot, group, level in blocks_of(counts, max(LEVELS, 4 * counts.shape[1])):
        p = np.array([1 + UNIT * (int(c) + 1) // (totals[g] + terms) for g, c in zip(group, level)], dtype=np.int64)
        a, b = (np.flatnonzero((group >= r.start) & (group < r.stop)) for r in (first, second))
        joint = (hot[:, a].T @ hot[:, b]).astype(np.int64)
        values = joint * price(p[a][:, None], p[b][None, :])
        edges = lambda at: np.flatnonzero(np.diff(group[at], prepend=-1))  # every group has a level in every block
        out += np.add.reduceat(np.add.reduceat(values, edges(a), axis=0), edges(b), axis=1)
    return out


def passes(sizes: dict[str, int]) -> Iterator[list[tuple[str, int, int]]]:
    """(language, first group, first group) of blocks of pairs, in lists of at most ``GROUPS`` by ``GROUPS`` pairs."""
    now, room = [], GROUPS * GROUPS
    for lang, n in sizes.items():
        for i in range(0, n, GROUPS):
            for j in range(0, n, GROUPS):
                need = min(GROUPS, n - i) * min(GROUPS, n - j)
                if now and need > room:
                    yield now
                    now, room = [], GROUPS * GROUPS
                now.append((lang, i, j))
                room -= need
    if now:
        yield now


def pair_sums(terms: DataFrame, groups: DataFrame, units: list[tuple[str, int, int]]) -> DataFrame:
    """(lang, a, b, value) of the ordered pairs of groups, by their numbers, of the given blocks."""
    spark = terms.sparkSession
    wanted = spark.createDataFrame(sorted({(la, k // GROUPS) for la, i, j in units for k in (i, j)}), "lang string, block long")
    mine = groups.join(F.broadcast(wanted), ["lang", "block"]).select("lang", "number", "source", "total", "terms")
    held = defaultdict(dict)  # at most two rows per row or column of the matrices
    for r in mine.collect():
        held[r.lang][r.number] = r
    held, by_lang = spark.sparkContext.broadcast(dict(held)), defaultdict(list)
    for unit in units:
        by_lang[unit[0]].append(unit)

    def counted(rows: pa.RecordBatch, sources: list[str]) -> Iterator[np.ndarray]:
        """The rows' counts by source, in matrices of about a million entries."""
        step = max(16, (1 << 20) // len(sources))
        for lo in range(0, len(rows), step):
            entries = rows.column(1).slice(lo, step)
            flat = entries.flatten()
            at = pc.fill_null(pc.index_in(flat.field("source"), value_set=pa.array(sources, pa.string())), -1).to_numpy()
            row = np.repeat(np.arange(len(entries)), pc.list_value_length(entries).to_numpy())
            counts = np.zeros((len(entries), len(sources)), dtype=np.int64)
            counts[row[at >= 0], at[at >= 0]] = flat.field("n").to_numpy()[at >= 0]
            yield counts

    def run(batches):
        sums = {}
        for batch in batches:
            langs = batch.column(0)
            for lang in pc.unique(langs).to_pylist():
                rows = batch.filter(pc.equal(langs, lang))
                for unit in by_lang.get(lang, ()):
                    _, i, j = unit
                    here = [held.value[lang][k] for k in sorted(held.value[lang]) if k // GROUPS in (i // GROUPS, j // GROUPS)]
                    cut = sum(r.number < max(i, j) for r in here) if i != j else len(here)
                    low, high = slice(0, cut), slice(cut if i != j else 0, len(here))
                    left, right = (low, high) if i <= j else (high, low)
                    for counts in counted(rows, [r.source for r in here]):
                        value = pair_values(counts, [r.total for r in here], here[0].terms, left, right)
                        sums[unit] = sums[unit] + value if unit in sums else value
        for (lang, i, j), value in sums.items():
            for x, line in enumerate(value):
                k = len(line)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), pa.array(np.full(k, i + x)), pa.array(np.arange(j, j + k)), pa.array(line)],
                                                 ["lang", "a", "b", "value"])

    parts = terms.select("lang", "counts").mapInArrow(run, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def kept_terms(docs: DataFrame, min_docs: int, text: str, lang: str, source: str) -> DataFrame:
    """(lang, term, total, counts): the occurrences of every kept term, in all and by source."""
    # the tasks have summed up, so one shuffle by term does for both groupings
    sums = term_counts(docs, text, lang, source).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return staged(terms.where(F.col("docs") >= min_docs).drop("docs"), "terms")


def group_table(docs: DataFrame, terms: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, number, block, total, terms, lang_total) of every group; numbers from 0 in each language."""
    every = docs.select(_name(lang).alias("lang"), _name(source).alias("source")).distinct()
    found = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("total"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_total"))
    out = every.join(found, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    # a row per group: the result has a row per pair of them
    out = out.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
    return staged(out.withColumn("block", F.floor(F.col("number") / GROUPS)), "groups")


def audit(docs: DataFrame, min_docs: int = 3, most: int = 200, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): for each group its prices against the other sources of its
    language (part ``pair``, all ranks), and its ``most`` overused terms (part ``term``)."""
    terms = kept_terms(docs, min_docs, text, lang, source)
    groups = group_table(docs, terms, lang, source)

    sizes = groups.where("terms > 0").groupBy("lang").agg(F.count("*").alias("n")).where("n > 1").orderBy("lang").collect()  # a row per language with pairs
    names = groups.select("lang", "source", "number")
    pairs = groups.where("terms = 0").alias("x").join(groups.alias("y"), F.expr("x.lang = y.lang AND x.number <> y.number")).select(
        "x.lang", "x.source", F.col("y.source").alias("item"), F.lit(0).cast("long").alias("value"))
    for units in passes({r.lang: r.n for r in sizes}):
        sums = staged(pair_sums(terms, groups, units).where("a <> b"), "pairs")
        named = sums.join(names.withColumnRenamed("number", "a"), ["lang", "a"])
        named = named.join(names.select("lang", F.col("source").alias("item"), F.col("number").alias("b")), ["lang", "b"])
        pairs = pairs.unionByName(named.select("lang", "source", "item", "value"))

    few = groups.select("lang", F.col("source"), "total", "terms", "lang_total")
    few = F.broadcast(few) if groups.count() <= GROUPS * 100 else few
    each = terms.select("lang", "term", F.col("total").alias("in_lang"), F.explode("counts").alias("c")).select("lang", "term", "in_lang", "c.source", "c.n")
    priced = each.join(few, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("in_lang"), F.col("lang_total"), F.col("terms")).alias("q"))
    over = priced.where("p > q").select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(over, "term").where(F.col("rank") <= most))


def op12_level_products(spark, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit(table(spark, sf_dir, "documents"))


#: DuckDB: every pair is priced term by term, without levels.
OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY ALL),
gt AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
lt AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM c GROUP BY lang, term),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
      1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(gt.total, 0) + v.v) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) x
         ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
q AS (SELECT lt.lang, lt.term, 1 + (1000000000::HUGEINT * (lt.n + 1)) // (lt.total + v.v) AS q FROM lt JOIN v USING (lang)),
term AS (SELECT p.lang, p.source, p.term AS item, (p - q) * (p - q) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
u AS (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term' AS part, * FROM term)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u) WHERE part = 'pair' OR rank <= 200
"""
