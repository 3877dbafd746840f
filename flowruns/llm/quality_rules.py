"""Quality rules: divergence of a document's histograms from its language's reference.

Two histograms of every document are compared with those of its language by Jensen-Shannon
distance (base 2, from 0 to 1): character classes (``CLASSES``) and common words (the ``top_words``
words most frequent in the language; the ``BANDS[-1]`` most frequent after these, in one bin per band
of ranks; and all others as one bin). The bands hold about a third of a language's words, so a text
without any common word is beyond the limit, while a short text's chance choice of words hardly
counts. The references are counted over all documents. A document is
rejected if either distance exceeds its limit; histograms of fewer than ``min_chars`` characters
or ``min_words`` words say too little and are not judged (the guards). A language with fewer than ``LEAST_DOCS`` documents
or ``LEAST_WORDS`` words says too little as well, and mostly what the judged document itself says: its documents
are compared with the language that shares most of its words' occurrences.

Before that stand the base rules: under 50 words, or over half of the words in repeated windows of
three words.

Everything is DataFrame functions. Per-document figures come from the document's own row (arrays
of words and sorted hashes), so no document is shuffled; the references are partial sums per
task and one row per language (its words in ``SLOTS`` slots by hash, so a word is looked up in one step), joined by broadcast after a check of their bytes.
A text is read twice: once for its words (whose counts also give the characters of the language), once for its verdict.

Defined cases: a null or blank text has no words, fails the base rules and is not kept; null
languages form a language of their own; if no language says enough, or its reference has no words, the base rules
judge alone; repeated rows get equal verdicts; an empty table gives an
empty result; extra columns are left alone by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowruns.llm.common import BLANKS, WORD, staged, table

#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
#: Character classes that are counted: A-Z and other capitals, digits, ASCII marks, a-z, blanks, other letters, all else.
CLASSES = 7
#: Ranks, after the top words, that end a band of common words. (Up to 1000 words in all, Spark cuts the ranking in the
#: tasks before its shuffle, spark.sql.optimizer.windowGroupLimitThreshold.)
BANDS = (64, 256, 896)
SLOTS = 1024
#: Beyond so many bytes the references are joined by shuffle, not broadcast.
BROADCAST_BYTES = 32 << 20
#: A language has a reference of its own from so many documents with words, and words, on.
LEAST_DOCS = 10
LEAST_WORDS = 4_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def bind(value: Column, f) -> Column:
    """``f`` of ``value``, which is computed once per row however often ``f`` uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def kept_chars(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, ""))


def char_figures(text: Column) -> Column:
    """Counts of ``CLASSES`` in a text (``classes``) and of its symbols. Plain lower-case letters and spaces go in one pass, and the
    others are counted in the little that is left."""
    t = F.coalesce(text, F.lit(""))
    def counts(rest: Column) -> Column:
        upper, digit, mark, blank, letter, symbols = (kept_chars(rest, others) for others in (
            r"\P{Lu}+", r"\P{Nd}+", r"\P{Punct}+", r"[^\x20\x09-\x0D]+", r"[\P{L}\p{Lu}]+", f"[^{SYMBOLS[1:-1]}]+"))
        space = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
        return F.struct(upper.alias("u"), digit.alias("d"), mark.alias("m"), (F.length(t) - F.length(rest) - space).alias("a"),
                        (blank + space).alias("b"), space.alias("s"), letter.alias("l"), F.length(rest).alias("n"), symbols.alias("symbols"))
    def every(c: Column) -> Column:
        classes = (c["u"], c["d"], c["m"], c["a"], c["b"], c["l"], c["n"] - c["u"] - c["d"] - c["m"] - (c["b"] - c["s"]) - c["l"])
        return F.struct(F.array(*[x.cast("double") for x in classes]).alias("classes"), c["symbols"].cast("long").alias("symbols"))
    return bind(bind(F.regexp_replace(t, "[a-z ]+", ""), counts), every)


def repeated_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """``df`` with ``name``: the number of words, in the array column ``words``, in windows of three
    that occur twice or more in the array, the first occurrence included.

    Windows are hashed. Where two hashes are equal, the high bits of a hash and the window's place share a long, so one sort of
    primitives brings equal windows together. Neighbours with equal hash bits are then compared as
    strings, which makes it exact. (The last two windows are short; they equal no other.)
    """
    w, high, h = F.col(words), F.col("_high"), F.col("_windows")
    none = F.lit(0).cast("long")

    def window(v: Column) -> Column:
        i = v.bitwiseAND(F.bitwise_not(high)).cast("int")
        return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("s"), i.alias("i"))

    def places(x: Column) -> Column:
        equal = F.filter(x, lambda y, i: (F.get(x, i - 1)["s"] == y["s"]) | (F.get(x, i + 1)["s"] == y["s"]))
        return F.sort_array(F.transform(equal, lambda y: y["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(gaps, none, lambda a, g: a + g)

    def near(s: Column) -> Column:
        same = lambda v, i: v.bitwiseXOR(F.get(s, i)).bitwiseAND(high) == 0
        return F.sort_array(F.transform(F.filter(s, lambda v, i: same(v, i - 1) | same(v, i + 1)), window))

    packed = F.sort_array(F.transform(h, lambda v, i: v.bitwiseAND(high).bitwiseOR(i.cast("long"))))
    df = df.withColumn("_high", F.call_function("shiftleft", F.lit(-1).cast("long"), F.length(F.bin(F.size(w).cast("long")))))
    df = df.withColumn("_windows", F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))
    # most texts repeat no window, which a set of their hashes shows
    again = F.size(F.array_distinct(h)) < F.size(h)
    count = bind(bind(bind(packed, near), places), covered)
    return df.withColumn(name, F.when(again, count).otherwise(none)).drop("_high", "_windows")


def dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; null if either is empty of counts."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    def with_totals(t):
        terms = F.zip_with(p, q, lambda x, y: bind(F.struct((x / t["p"]).alias("x"), (y / t["q"]).alias("y")), lambda z:
                           part(z["x"], (z["x"] + z["y"]) / 2) + part(z["y"], (z["x"] + z["y"]) / 2)))
        return F.when((t["p"] > 0) & (t["q"] > 0), F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2)))
    return bind(F.struct(total(p).alias("p"), total(q).alias("q")), with_totals)


def slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


def mark(i: int) -> str:
    """The character that stands for the words of bin ``i`` while they are counted."""
    return chr(0x100 + i)


def references(docs: DataFrame, text: str, lang: str, top_words: int) -> DataFrame:
    """One row per language: the common words to compare with by slot, the counts of their bins and the rest's, its
    character classes, and the bytes of the words."""
    words = docs.select(F.col(lang).cast("string").alias("lang"), F.explode(words_of(F.col(text))).alias("word"))
    counts = staged(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "words")

    # the characters of a language are those of its words, each word counted as often as it occurs, and blanks
    classes = char_figures(F.col("word"))["classes"]
    chars = counts.select("lang", "n", F.length("word").alias("size"), classes.alias("c")).groupBy("lang").agg(
        F.sum("n").alias("all"), F.sum(F.col("n") * F.col("size")).alias("in_words"), *[F.sum(F.col("c")[i] * F.col("n")).alias(f"c{i}") for i in range(CLASSES)])
    sizes = docs.select(F.col(lang).cast("string").alias("lang"), F.length(text).alias("size"), F.col(text).rlike(WORD).cast("int").alias("used")).groupBy("lang").agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.coalesce(F.sum("used"), F.lit(0)).alias("docs"))
    of_words = [F.coalesce(F.col(f"c{i}"), F.lit(0.0)) for i in range(CLASSES)]
    of_words[4] = (F.col("size") - F.coalesce("in_words", F.lit(0))).cast("double")
    langs = sizes.join(chars, sizes["lang"].eqNullSafe(chars["lang"]), "left").select(
        sizes["lang"], F.coalesce("all", F.lit(0)).alias("all"), F.array(*of_words).alias("ref_chars"),
        ((F.col("docs") >= LEAST_DOCS) & (F.coalesce("all", F.lit(0)) >= LEAST_WORDS)).alias("says"))
    langs = staged(langs, "languages")  # a row per language

    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    band = F.col("k") - 1
    for i, end in enumerate(BANDS):
        band = F.when(F.col("k") > top_words + (0, *BANDS)[i], top_words + i).otherwise(band)
    bins = top_words + len(BANDS)
    able = langs.where("says").select(F.col("lang").alias("_able"), "all")
    top = counts.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top_words + BANDS[-1]).withColumn("band", band.cast("int"))
    top = staged(top.join(able, top["lang"].eqNullSafe(able["_able"])).select("lang", "word", "n", "band", "all"), "common")
    shown = F.array(*[F.sum(F.when(F.col("band") == i, F.col("n")).otherwise(0)).cast("double") for i in range(bins)])
    common = top.groupBy("lang").agg(F.collect_list(F.struct(slot(F.col("word")).alias("slot"), "word", "band")).alias("top"), shown.alias("shown"),
                                     F.first("all").alias("all"), F.sum(F.octet_length("word") + 64).alias("bytes"))
    rest = F.col("all").cast("double") - F.aggregate("shown", F.lit(0.0), lambda s, x: s + x)
    marks = F.array(*[F.lit(mark(i)) for i in range(bins)])
    slots = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.map_from_entries(F.transform(
        F.filter("top", lambda x: x["slot"] == i), lambda x: F.struct(x["word"], F.get(marks, x["band"])))))
    common = common.select(F.col("lang").alias("_with"), slots.alias("slots"), F.concat("shown", F.array(rest)).alias("ref_words"), "bytes")

    # the language of the reference: a small one's is that which holds most of its words, else the largest one
    small = counts.join(langs.where("NOT says").select(F.col("lang").alias("_small")), F.col("lang").eqNullSafe(F.col("_small"))).select("_small", "word", "n")
    held = small.join(top.select("word", F.col("lang").alias("_in"), "all"), "word").groupBy("_small", "_in", "all").agg(F.sum("n").alias("n"))
    best = held.groupBy("_small").agg(F.max_by(F.struct("_in"), F.struct("n", "all", "_in")).alias("best"))
    largest = able.agg(F.max_by("_able", F.struct("all", "_able")), F.count("*")).first()
    of_largest = F.struct(F.lit(largest[0]).cast("string").alias("_in")) if largest[1] else F.lit(None)
    chosen = langs.join(best, langs["lang"].eqNullSafe(best["_small"]), "left")
    chosen = chosen.select("lang", F.when(F.col("says"), F.struct(F.col("lang").alias("_in"))).otherwise(F.coalesce("best", of_largest)).alias("ref"))
    chosen = chosen.where(F.col("ref").isNotNull()).select("lang", F.col("ref._in").alias("_ref"))
    its_chars = langs.select(F.col("lang").alias("_char_lang"), "ref_chars")
    out = chosen.join(common, chosen["_ref"].eqNullSafe(common["_with"])).join(its_chars, chosen["_ref"].eqNullSafe(its_chars["_char_lang"]))
    return out.select("lang", "slots", "ref_words", "ref_chars", "bytes")


def judged(docs: DataFrame, top_words: int = 16, min_words: int = 50, min_chars: int = 200, most_chars: float = 0.2,
           most_words: float = 0.36, text: str = "text", lang: str = "lang") -> DataFrame:
    """(row, figures) of every row of ``docs``: ``row`` is the row itself, ``figures`` a struct of
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance,
    word_distance, kept."""
    refs = staged(references(docs, text, lang, top_words), "references").withColumnRenamed("lang", "_lang")
    size = refs.agg(F.sum(F.col("bytes") + 16 * SLOTS)).first()[0] or 0
    refs = F.broadcast(refs.drop("bytes")) if size <= BROADCAST_BYTES else refs.drop("bytes")
    t = F.col("row")[text]
    out = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    out = out.join(refs, F.col("row")[lang].cast("string").eqNullSafe(F.col("_lang")), "left")

    def word_figures(w: Column) -> Column:
        # one character per common word, so that a bin is counted by what is gone without its character
        hits = F.array_join(F.transform(w, lambda x: F.get(F.col("slots"), slot(x))[x]), "")
        def counts(h):
            seen = [(F.length(h) - F.length(F.replace(h, F.lit(mark(i)), F.lit("")))).cast("double") for i in range(top_words + len(BANDS))]
            return F.array(*seen, (F.size(w) - F.length(h)).cast("double"))
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        bind(bind(hits, counts), lambda c: distance(c, F.col("ref_words"))).alias("word_distance"))

    out = repeated_words(out.withColumn("words", words_of(t)), "words", "n_repeat_words")
    out = out.select("row", "n_repeat_words", word_figures(F.col("words")).alias("w"), dup_lines(t).alias("n_dup_lines"), bind(
        char_figures(t), lambda c: F.struct(c["symbols"].alias("symbols"), distance(c["classes"], F.col("ref_chars")).alias("d"))).alias("c"))
    n = F.col("w.n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    far = ((F.col("w.word_chars") >= min_chars) & (F.col("c.d") > most_chars)) | ((n >= min_words) & (F.col("w.word_distance") > most_words))
    figures = F.struct(n.alias("n_words"), "w.word_chars", F.col("c.symbols").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), F.col("c.d").alias("char_distance"), "w.word_distance",
                       (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"))
    # a generator, so that a later filter on the verdict is not pushed below it, where it would
    # repeat every figure it depends on
    return out.select("row", F.explode(F.array(figures)).alias("figures"))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    return judged(docs, **limits).where("figures.kept").select("row.*")


def op7_divergence_rules(spark, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    out = judged(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "figures.*")
