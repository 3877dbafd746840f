"""Substring dedup by sliding spans of sentences.

A text is cut into sentences, and these into their clauses, so that a long sentence beside an edited one
can still be matched (ends are ``. ! ? , ; :``, their full-width and other scripts' kin, and line ends; a piece of over ``LONG``
words without one is cut after the least word hash of every ``GAP`` words on end, so its parts have at most ``GAP`` words and
equal words are cut alike, but for ``GAP`` at both ends; "sentence" below means such a piece). Characters of scripts without
blanks count as words. From each sentence starts a
span: the shortest run of consecutive sentences with at least ``sentences`` sentences and ``words``
words. Spans are hashed (128 bits of their lower-case words) and joined over all documents. Of equal spans
the first (by doc_id, text, place) stays; every sentence covered by any other is removed.

Spans are counted by half of their hash, partially summed before the shuffle; only spans whose half
occurs twice are kept and grouped by the whole hash. A passage that a third of all documents
share is a hot key of the joins, which adaptive execution splits; the groupings of it are
sums and minima.

Defined cases: null and blank texts have no sentences and stay as they are; texts with fewer sentences
or words than a span are never changed; null doc_ids come last; rows equal in doc_id and
text are one document (each keeps what the first keeps); an empty table gives an empty result;
extra columns are kept, whatever their names.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowruns.llm.common import staged, table, text_key

#: Ends: ASCII marks, and those of CJK, full-width, Arabic, Devanagari, Ethiopic, Burmese and Khmer texts, in UTF-8.
END = (rb"(?:[.!?,;:\n]|\xe3\x80[\x81\x82]|\xef\xbc[\x81\x8c\x8e\x9a\x9b\x9f]|\xef\xbd[\xa1\xa4]|\xe2\x80[\xa6\xbc]|\xe2\x81[\x87-\x89]"
       rb"|\xd8[\x8c\x9b\x9f]|\xdb\x94|\xe0\xa5[\xa4\xa5]|\xe1\x8d[\xa1-\xa8]|\xe1\x81[\x8a\x8b]|\xe1\x9f[\x94\x95])")
LEAD = rb"\xd8\xdb\xe0-\xe3\xef"
PIECE = re.compile(rb"(?:[^.!?,;:\n" + LEAD + rb"]++|(?!" + END + rb")[" + LEAD + rb"])++" + END + rb"*\s*|" + END + rb"+\s*")
PLAIN = re.compile(rb"[^.!?,;:\n]+[.!?,;:\n]*\s*|[.!?,;:\n]+\s*")  # the same for texts without the first bytes below
OTHER = re.compile(rb"[\xd8\xdb\xe0-\xe9\xef]")
#: A character of a script without blanks (Chinese, Japanese, Thai, Lao, Burmese, Khmer).
UNSPACED = rb"(?:[\xe3-\xe9][\x80-\xbf]{2}|\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf])"
WIDE = re.compile(UNSPACED)
UNIT = re.compile(rb"(?:" + UNSPACED + rb"|(?:(?!" + UNSPACED + rb")[^\x20\x09-\x0D])+)[\x20\x09-\x0D]*")
SPACED = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
LETTER = re.compile(rb"[0-9A-Za-z\x80-\xff]")
LONG = 24
GAP = 8


def cuts_of(words: list[bytes]) -> list[int]:
    """Places after the least hash (the last of equal ones) of every ``GAP`` words on end."""
    h, best, out = [crc32(x) for x in words], -1, []
    for i in range(GAP - 1, len(h)):
        if best <= i - GAP:
            best = min(range(i, i - GAP, -1), key=h.__getitem__)
        elif h[i] <= h[best]:
            best = i
        if not out or out[-1] != best + 1:
            out.append(best + 1)
    return out[:-1] if out[-1] == len(h) else out


def sentences_of(text: bytes) -> tuple[list[int], list[bytes]]:
    """Bounds of the sentences (one more than there are) and their words, lower-case and joined.

    Pieces without a letter or digit belong to the sentence before them; the sentences cover the text."""
    bounds, words = [0], []
    other = OTHER.search(text)
    for m in (PIECE if other else PLAIN).finditer(text):
        word = UNIT if other and WIDE.search(m[0]) else SPACED
        w = m[0].lower().split() if word is SPACED else [x[0].strip() for x in UNIT.finditer(m[0].lower())]
        if len(w) > LONG:
            at = [x.end() for x in word.finditer(m[0])]  # ends of the words, with the blanks after them
            cuts = cuts_of(w)
            for a, z in zip([0, *cuts], [*cuts, len(w)]):
                bounds.append(m.start() + at[z - 1])
                words.append(b" ".join(w[a:z]))
            bounds[-1] = m.end()
        elif words and not LETTER.search(m[0]):
            bounds[-1] = m.end()
        else:
            bounds.append(m.end())
            words.append(b" ".join(w))
    return bounds, words


def spans_of(words: list[bytes], least_sentences: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the span from each sentence that has one, and the spans' hashes (two longs)."""
    from xxhash import xxh3_128_digest

    count = np.concatenate([[0], np.cumsum([w.count(b" ") + 1 if w else 0 for w in words])])
    start = np.arange(len(words))
    end = np.maximum(np.searchsorted(count, count[:-1] + least_words), start + least_sentences)
    start, end = start[end <= len(words)], end[end <= len(words)]
    joined = b"\n".join(words)
    at = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).tolist()
    digests = b"".join(xxh3_128_digest(joined[at[a]:at[b] - 1]) for a, b in zip(start.tolist(), end.tolist()))
    return np.stack([start, end], axis=1), np.frombuffer(digests, dtype="<i8").reshape(-1, 2)


def spans(docs: DataFrame, sentences: int, words: int, text: str, key: str) -> DataFrame:
    """(h, g, doc_id, text_hash, start, end) of every span."""
    def run(batches):
        for b in batches:
            which, where, hashes, size = [], [], [], 0
            for r, t in enumerate(b.column(2)):
                if not t.is_valid:
                    continue
                at, h = spans_of(sentences_of(t.as_buffer().to_pybytes())[1], sentences, words)
                which.append(np.full(len(at), r))
                where.append(at)
                hashes.append(h)
                size += len(at)
                if size >= 1 << 17 or r == b.num_rows - 1:
                    yield batch(b, which, where, hashes)
                    which, where, hashes, size = [], [], [], 0
            if size:
                yield batch(b, which, where, hashes)

    def batch(b, which, where, hashes):
        pick = pa.array(np.concatenate(which).astype(np.int64))
        at, h = np.concatenate(where).astype(np.int32), np.concatenate(hashes)
        return pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), b.column(0).take(pick), b.column(1).take(pick),
                                           pa.array(at[:, 0].copy()), pa.array(at[:, 1].copy())], ["h", "g", "doc_id", "text_hash", "start", "end"])

    slim = docs.select(F.col(key).alias("doc_id"), text_key(text).alias("text_hash"), F.col(text).cast("binary").alias("t"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"h long, g long, doc_id {kind}, text_hash long, start int, end int")


def covered(docs: DataFrame, sentences: int, words: int, text: str, key: str) -> DataFrame:
    """(doc_id, text_hash, spans): of each document with a repeated span that is not the first, those spans."""
    every = spans(docs, sentences, words, text, key)
    twice = staged(every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated")
    again = staged(every.join(twice, "h", "left_semi"), "occurrences")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash", "start")
    # written out, so that the join below reads plain shuffles, which adaptive execution can split at a hot span
    first = staged(again.groupBy("h", "g").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "first")
    later = again.join(first, ["h", "g"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # at most one per sentence


def without_repeats(docs: DataFrame, sentences: int = 3, words: int = 20, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, text, n_sentences, n_removed) of every row of ``docs``: the text without its covered sentences."""
    cut = staged(covered(docs, sentences, words, text, key), "covered").withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("doc_id"), text_key(text).alias("h"))
    rows = rows.join(cut, rows["doc_id"].eqNullSafe(cut["_doc"]) & (rows["h"] == cut["_hash"]), "left")
    rows = rows.select("row", F.col("row")[text].cast("binary").alias("t"), "spans")

    def run(batches):
        for b in batches:
            texts, sizes, removed = [], [], []
            for t, s in zip(b.column(1), b.column(2)):
                body = t.as_buffer().to_pybytes() if t.is_valid else b""
                bounds, words_ = sentences_of(body)
                gone = np.zeros(len(words_), dtype=bool)
                for x in s.as_py() or ():
                    gone[x["start"]:x["end"]] = True
                kept = b"".join(body[bounds[i]:bounds[i + 1]] for i in np.flatnonzero(~gone)) if gone.any() else body
                texts.append(kept.decode() if t.is_valid else None)
                sizes.append(len(words_))
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(removed, pa.int32())],
                                             ["row", "text", "n_sentences", "n_removed"])

    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    out = StructType([rows.schema["row"], StructField("text", StringType()), StructField("n_sentences", IntegerType()), StructField("n_removed", IntegerType())])
    return rows.mapInArrow(run, out)


def op10_sentence_spans(spark, sf_dir: str) -> DataFrame:
    """Every document without the sentences of repeated spans."""
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "text", "n_sentences", "n_removed")
