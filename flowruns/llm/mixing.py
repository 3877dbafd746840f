"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words: its weight's share of ``share`` times all words, at
most ``cap`` times its own; what a capped source leaves is dealt to the others by weight. The
result is the water level ``t = least(cap * words, level * weight)``, found over the source
table with two windows (``level`` is the greatest of the levels met on the way up).

Within a source, a document's expected copies are ``least(cap, level * preference)``, with the
level that meets the source's target. Whole copies are certain. The fraction left is the
document's inclusion probability p, and documents are ranked by Pareto's statistic
``odds(u) / odds(p)`` with u uniform; the lowest ranks are taken until the source's words are
spent (the sample's size is fixed; it ends with the document whose middle is the last before
the end). u comes from a digest of seed, doc_id and text, so reruns agree.

A hot source is not one task: ranks are cut into ``BINS`` bins, words are summed by
(source, bin), and only the order within a bin needs a window.

Defined cases: a null text has no words (size 0) and is taken 0 words; null sources form a
source of their own, last in order; rows with null doc_id are documents; repeated rows are
separate documents with equal rank, so which of them is taken makes no difference; with no
words at all every target is 0; an empty table gives an empty result; extra columns are kept, whatever their names (rows travel as
one struct).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowruns.llm.common import WORD, staged, table

BINS = 4096
#: Beyond so many (source, preference) classes they are joined by shuffle, not broadcast (under 64 bytes each).
BROADCAST_CLASSES = 100_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, key: str, text: str) -> Column:
    """A number in (0, 1) by seed, key and text: 52 bits of an MD5 digest, at the middle of its step."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("|"),
                            F.md5(F.coalesce(F.col(text), F.lit("")))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def water_level(df: DataFrame, group: list[str], weight: str, cap: str, budget: str) -> Column:
    """The level at which least(cap, level * weight) sums to the budget in each group."""
    up = Window.partitionBy(*group).orderBy(F.col(cap) / F.col(weight), F.col(weight)) if group else \
        Window.orderBy(F.col(cap) / F.col(weight), "source")
    lower = up.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(*group)
    left = F.sum(weight).over(everywhere) - F.coalesce(F.sum(weight).over(lower), F.lit(0))
    return (F.col(budget) - F.coalesce(F.sum(cap).over(lower), F.lit(0))) / F.when(left > 0, left)


def mix(docs: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0, seed: str = "mix",
        preference=lambda size: F.when(size < 50, 0.5).otherwise(1.0), slim: bool = False, key: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """(row, words, source_words, target, copies) of every row of ``docs``; copies: 0 to ``cap``.

    ``weights`` repeat over the sources in code point order. ``preference``: maps the word count to
    a column with few distinct positive values, by which documents of one source are preferred
    (default: those under 50 words count half). ``slim``: doc_id in place of the struct ``row``.
    """
    size = word_count(text)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("doc_id"),
                       F.col(source).cast("string").alias("source"), size.alias("size"), uniform(seed, key, text).alias("u"))
    rows = rows.withColumn("pref", preference(F.col("size")).cast("double"))
    thin = staged(rows.drop("row"), "sizes")
    full = thin if slim else rows

    # sources: targets
    cells = staged(thin.groupBy("source", "pref").agg(F.sum("size").alias("words")), "cells")
    per = cells.groupBy("source").agg(F.sum("words").alias("words"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1)
    per = per.withColumn("weight", weight).withColumn("cap", F.col("words") * F.lit(cap))
    per = per.withColumn("budget", F.sum("words").over(Window.partitionBy()) * F.lit(share))
    per = per.withColumn("level", water_level(per, [], "weight", "cap", "budget"))
    top = F.max("level").over(Window.partitionBy())
    per = per.select("source", F.col("words").alias("source_words"), F.least(F.col("cap"), top * F.col("weight")).alias("target"))

    # classes of a source: expected copies, whole copies and inclusion odds
    cells = cells.join(per, cells["source"].eqNullSafe(per["source"])).drop(per["source"])
    cells = cells.withColumn("w", F.col("pref") * F.col("words")).withColumn("cap", F.col("words") * F.lit(cap))
    filled = cells.where("words > 0")
    filled = filled.withColumn("level", water_level(filled, ["source"], "w", "cap", "target"))
    levels = filled.groupBy("source").agg(F.max("level").alias("level"))
    cells = cells.join(levels, cells["source"].eqNullSafe(levels["source"]), "left").drop(levels["source"])
    cells = cells.withColumn("e", F.least(F.lit(float(cap)), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("pref")))
    cells = cells.withColumn("whole", F.floor("e")).withColumn("p", F.col("e") - F.floor("e"))
    in_source = Window.partitionBy("source")
    cells = cells.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(in_source))
    cells = cells.withColumn("odds", F.when(F.col("p") > 0, F.col("p") / (1 - F.col("p"))))
    # the source's classes that have ranks: share of the words, odds
    part = F.struct((F.col("words") / F.col("source_words")).alias("share"), "odds")
    cells = cells.withColumn("ranked", F.sort_array(F.collect_list(F.when(F.col("odds").isNotNull(), part)).over(in_source)))
    cells = staged(cells.select("source", "pref", "source_words", "target", "whole", "rest", "odds", "ranked"), "classes")
    few = cells.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES

    def ranked(df: DataFrame) -> DataFrame:
        c = cells.withColumnsRenamed({"source": "_cs", "pref": "_cp"})
        out = df.join(F.broadcast(c) if few else c, F.col("source").eqNullSafe(F.col("_cs")) & F.col("pref").eqNullSafe(F.col("_cp")))
        out = out.withColumn("q", (F.col("u") / (1 - F.col("u"))) / F.col("odds"))
        # the share of a source's ranks below q, which spreads them evenly over the bins
        below = lambda a, c: a + c["share"] * (F.col("q") * c["odds"] / (1 + F.col("q") * c["odds"]))
        full_share = F.aggregate("ranked", F.lit(0.0), lambda a, c: a + c["share"])
        bin_ = F.least(F.floor(F.aggregate("ranked", F.lit(0.0), below) / full_share * BINS), F.lit(BINS - 1)).cast("int")
        # rows without a fractional copy need no order: they are spread over bins of their own
        spread = BINS + F.floor(F.col("u") * BINS).cast("int")
        return out.withColumn("bin", F.when(F.col("q").isNull(), spread).otherwise(bin_)).drop("_cs", "_cp")

    bins = ranked(thin).where("q is not null").groupBy("source", "bin").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(F.col("source").alias("_bs"), F.col("bin").alias("_bb"),
                       F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    out = ranked(full).join(bins, F.col("source").eqNullSafe(F.col("_bs")) & F.col("bin").eqNullSafe(F.col("_bb")), "left")
    here = Window.partitionBy("source", "bin").orderBy("q", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("base") + F.coalesce(F.sum("size").over(here), F.lit(0))
    chosen = F.col("q").isNotNull() & (2 * ahead + F.col("size") <= 2 * F.col("rest"))
    out = out.withColumn("copies", (F.col("whole") + F.when(chosen, 1).otherwise(0)).cast("int"))
    return out.select("doc_id" if slim else "row", F.col("size").alias("words"), "source_words", "target", "copies")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    out = mix(docs, **how).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def op2_pareto_mix(spark, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 3, 1, 2 over the sources, 150 % of all words, at most 2 copies."""
    out = mix(table(spark, sf_dir, "documents"), slim=True)
    return out.select("doc_id", F.col("words").alias("size"), F.col("source_words").alias("source_size"), "target",
                      (F.col("copies") * F.col("words")).alias("taken"), "copies")


OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    (('0x' || substr(md5('mix|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))), 1, 13))::bigint::double
      + 0.5) / 4503599627370496.0::double AS u
  FROM documents),
c AS (SELECT *, CASE WHEN size < 50 THEN 0.5::double ELSE 1.0::double END AS pref FROM d),
src AS (
  SELECT source, sum(size)::bigint AS words, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM c GROUP BY source),
w AS (
  SELECT *, [3.0::double, 1.0::double, 2.0::double][((k - 1) % 3) + 1] AS weight, words * 2.0::double AS cap,
    (sum(words) OVER ())::double * 1.5::double AS budget FROM src),
l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER up, 0)) / nullif(sum(weight) OVER () - coalesce(sum(weight) OVER up, 0), 0) AS level
  FROM w WINDOW up AS (ORDER BY cap / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, words, least(cap, (max(level) OVER ()) * weight) AS target FROM l),
cell AS (
  SELECT c.source, c.pref, sum(c.size)::bigint AS words, any_value(t.target) AS target, any_value(t.words) AS source_size
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source GROUP BY c.source, c.pref),
cl AS (
  SELECT *, (target - coalesce(sum(words * 2.0::double) OVER up, 0))
      / (sum(pref * words) OVER (PARTITION BY source) - coalesce(sum(pref * words) OVER up, 0)) AS level
  FROM cell WHERE words > 0
  WINDOW up AS (PARTITION BY source ORDER BY (words * 2.0::double) / (pref * words), pref * words
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT source, max(level) AS level FROM cl GROUP BY source),
e AS (
  SELECT cell.*, least(2.0::double, coalesce(lv.level, 0) * cell.pref) AS e
  FROM cell LEFT JOIN lv ON cell.source IS NOT DISTINCT FROM lv.source),
p AS (
  SELECT *, floor(e) AS whole, e - floor(e) AS p, target - sum(floor(e) * words) OVER (PARTITION BY source) AS rest FROM e),
r AS (
  SELECT c.doc_id, c.size, p.source_size, p.target, p.whole, p.rest, c.source,
    CASE WHEN p.p > 0 THEN (c.u / (1 - c.u)) / (p.p / (1 - p.p)) END AS q
  FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source AND c.pref = p.pref),
s AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM r),
x AS (SELECT *, (whole + CASE WHEN q IS NOT NULL AND 2 * ahead + size <= 2 * rest THEN 1 ELSE 0 END)::integer AS copies FROM s)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM x
"""
