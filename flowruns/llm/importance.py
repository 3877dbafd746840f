"""Resampling documents towards a target text by hashed n-gram importance weights.

Every text is taken as UTF-8 bytes. One 256-byte table lower-cases A-Z and turns every separator
into a blank, so ``bytes.split`` yields the words; the features are all runs of one to
``longest`` words, and the checksum of a run seeds the one of the run a word longer, so
``zlib.crc32`` reads each word ``longest`` times and no run is ever built. A feature's bucket is
its checksum modulo ``buckets``.

1. Each task reduces its texts to one Counter of buckets (at most ``buckets`` entries); their sums over
   all documents and over the target are two tables of fixed size, from which the driver takes one
   whole-number gain per bucket.
2. A second pass adds the gains over each text's features and a Gumbel number drawn from the
   document's id: the ``share`` of highest scores is a weighted sample without replacement.
3. The narrow score rows are sorted by range partitions, and a rank is the partition's offset plus
   the row's place in it: no task sees more than its range, and only row counts reach the driver.

A text is read in pieces of ``PIECE`` bytes, so memory is bounded whatever its length.

Defined cases: a null or blank text has no words, no features and weight 0; a null id is the empty
text in its hash and comes last among ties; repeated rows get equal scores and ranks of their own;
a document under ``min_words`` words gets a score but is never drawn; an empty target or an empty
table leaves all counts at zero (gains then come from the other side alone); extra columns do not
matter.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowruns.llm.common import staged, table

PIECE = 1 << 20
#: Digits, lower-case letters and all bytes of characters beyond ASCII stay, A-Z become a-z, all else a blank.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PLACES = 33  # bits of monotonically_increasing_id that count rows within a partition


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text``, in lists of about ``PIECE`` bytes."""
    at = 0
    while at < len(text):
        if len(text) - at <= PIECE:
            yield text[at:].translate(TABLE).split()
            return
        # end the piece at a separator; a word longer than a piece is taken whole
        piece = text[at:at + PIECE].translate(TABLE)
        end = piece.rfind(b" ") + 1
        while not end:
            more = text[at + len(piece):at + 2 * len(piece)].translate(TABLE)
            piece, cut = piece + more, more.find(b" ")
            end = len(piece) - len(more) + cut + 1 if cut >= 0 else 0 if more else len(piece)
        yield piece[:end].split()
        at += end


def feature_sums(text: bytes, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, checksums of all runs that end in them) for each piece of ``text``."""
    last: list[bytes] = []  # the words before this piece that a run may start with
    for words in word_pieces(text):
        both = last + words
        blank = [b" " + w for w in both]
        sums, out, new = list(map(zlib.crc32, both)), [], len(last)
        for n in range(longest):
            # sums[i] is the checksum of the run of n + 1 words that ends in word i + n
            out.append(np.array(sums[max(0, new - n):], dtype=np.uint32))
            sums = list(map(zlib.crc32, blank[n + 1:], sums))
        yield len(words), np.concatenate(out)
        last = both[len(both) - min(len(both), longest - 1):]


def utf8(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def bucket_counts(df: DataFrame, text: str, longest: int, buckets: int) -> dict[int, int]:
    """Features of all texts by bucket; at most ``buckets`` numbers reach the driver."""
    def count(batches):
        found = Counter()
        for batch in batches:
            for t in batch.column(0):
                for _, sums in feature_sums(t.as_py(), longest):
                    found.update((sums % buckets).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(found.keys()), pa.int64()), pa.array(list(found.values()), pa.int64())], ["bucket", "n"])

    parts = df.select(utf8(text).alias("t")).mapInArrow(count, "bucket long, n long")
    return {r.bucket: r.n for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of every bucket, each count smoothed by one."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * s_all / ((source.get(b, 0) + 1) * t_all)))
                     for b in range(buckets)], dtype=np.int64)


def gumbel(key: str) -> int:
    """A Gumbel number in thousandths, rounded down, from the digest of ``key``."""
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, seed: int, longest: int, text: str, key: str) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of ``docs``."""
    table_of = docs.sparkSession.sparkContext.broadcast(gains)  # one long per bucket
    id_type = docs.schema[key].dataType

    def score(batches):
        g = table_of.value
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(1).to_pylist(), batch.column(2)):
                n_words = n_features = weight = 0
                for n, sums in feature_sums(t.as_py(), longest):
                    n_words, n_features = n_words + n, n_features + len(sums)
                    weight += int(g[sums % len(g)].sum())
                rows.append((n_words, n_features, weight, weight + gumbel(f"{seed}:{k}")))
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), utf8(text).alias("t"))
    return rows.mapInArrow(score, f"doc_id {id_type.simpleString()}, n_words long, n_features long, weight long, score long")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, longest: int = 3,
              buckets: int = 10_000, text: str = "text", key: str = "doc_id", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``; ``rank`` (from 1) is null unless
    the row is among the floor(``percent`` * N / 100) highest scores of the N rows with ``min_words`` words."""
    spark = docs.sparkSession
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    rows = staged(scored(docs, gains, seed, longest, text, key).withColumn("uid", F.monotonically_increasing_id()), "scores")
    able = F.col("n_words") >= min_words
    drawn = rows.where(able).count() * percent // 100
    # uid tells repeated rows apart, so that a row with very many copies is spread over ranges as well
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("uid")]
    ranged = rows.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = staged(ranged.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", _PLACES)
    sizes = sorted((r.part, r.n) for r in ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    starts = list(zip([p for p, _ in sizes], accumulate((n for _, n in sizes), initial=0)))
    starts = spark.createDataFrame(starts, "part long, start long")  # a row per partition of the sort
    ranked = ranged.withColumn("part", part).join(F.broadcast(starts), "part")
    place = F.col("start") + F.col("at").bitwiseAND((1 << _PLACES) - 1) + 1
    ranked = ranked.withColumn("rank", F.when(place <= drawn, place))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("long")).select(columns))


def op11_byte_importance(spark, sf_dir: str) -> DataFrame:
    """Weights, scores and ranks of all documents, towards ``benchmark``."""
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
