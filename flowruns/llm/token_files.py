"""Token ids as Arrow stream files of fixed-size lists.

``write_tokens`` deals documents out by ranges of doc_id, encodes each range in one task, appends the
end id to every document, and writes two Arrow stream files per range:

* ``tokens-<part>.arrow``: rows of ``ids`` (fixed-size list of ``length`` unsigned integers) and ``mask``
  (fixed-size list of booleans, false in the padding of the last row). Every batch has ``rows``
  rows but the last. All batches before it take the same number of bytes, so batch k starts at a
  known offset and ``Tokens`` reads any sequence from a memory map without copying.
* ``index-<part>.arrow``: doc_id, first (place of its first id in the part), n_tokens.

A part is written under a temporary name and then moved, so a repeated or speculative task
leaves whole files. ``read_tokens`` reads the files back: one task per part slices the ids out
of the lists and digests them.

The tokenizer is a file of the ``tokenizers`` library. Words (runs between ASCII blanks) are
encoded once and remembered up to a bound. That gives the same ids as whole texts if the tokenizer drops
white space, lower-cases, works on bytes, and makes each run of letters a piece of its own, as that of
``op1`` does (tested); for others, ``split_words=False`` encodes whole texts.

Defined cases: a null text is empty (the end id alone); documents are in ascending doc_id order,
nulls first, equal ids by text; repeated rows are documents of their own; an empty table gives
no files and an empty result; extra columns do not matter; long texts are only bounded by memory
for one document's ids.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowruns.llm.common import shared_folder, table

#: Words, and their letters and marks, remembered by a Python worker (about 200 bytes each); beyond, it starts anew.
REMEMBERED = 1_000_000
_seen: dict = {}
#: Byte-level tokenizers write bytes that are no visible Latin-1 characters as signs from 256 on.
_visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _visible)}
MARKS = "!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"


class Known(dict):
    """Ids of words (both as bytes), found where they are missing: one look-up is all that a known word costs."""

    def __init__(self, t, code: str):
        super().__init__()
        self.one, self.whole, self.code = t.model.tokenize, t.encode, code

    def __missing__(self, word: bytes) -> bytes:
        """``Word.,`` is ``word`` and ``.,``: the tokenizer lower-cases and cuts marks off letters. Lower-case letters alone
        are one piece, which goes straight to the tokenizer's model."""
        x = word.decode()
        core, tail = ("", "") if "<" in x else cut_marks(x)
        if core and core != x:
            found = self[core.encode()] + (self[tail.encode()] if tail else b"")
        elif core:
            found = array(self.code, [p.id for p in self.one(x if x.isascii() else word.decode("latin-1").translate(BYTE_SIGNS))]).tobytes()
        else:
            found = array(self.code, self.whole(x, add_special_tokens=False).ids).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


def cut_marks(x: str) -> tuple[str, str]:
    """The letters of a word, in lower case, and the ASCII marks after them; two empty texts for words of another form.

    Only where Python's lower case is the tokenizer's, letter by letter, and composing (NFC) changes nothing: always below U+0250."""
    core = x.rstrip(MARKS)
    if not core.isalpha():
        return "", ""
    low = core.lower()
    if max(core) < "\u0250":
        return (low, x[len(core):]) if low.isalpha() else ("", "")
    return (low, x[len(core):]) if low == core and is_normalized("NFC", core) else ("", "")


def encoder(path: str, kind: str, split_words: bool):
    """Function from UTF-8 texts to the bytes of their ids, as unsigned integers of ``kind``."""
    code = {"uint16": "H", "uint32": "I"}[kind]
    state = _seen.setdefault((path, kind, split_words), {})
    if "t" not in state:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        state["t"] = Tokenizer.from_file(path)
        state["known"] = Known(state["t"], code)
    t, known = state["t"], state["known"]

    def whole(texts: list[bytes]) -> list[bytes]:
        return [array(code, e.ids).tobytes() for e in t.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)]

    def words(texts: list[bytes]) -> list[bytes]:
        return [b"".join(map(known.__getitem__, x.split())) for x in texts]

    return words if split_words else whole


def layout(kind: str, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("item", pa.from_numpy_dtype(np.dtype(kind)), False), length)),
                      ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))])


def open_folder(folder: str):
    """The file system of a folder (any that pyarrow knows) and the path in it."""
    return pafs.FileSystem.from_uri(folder if re.match(r"[a-z0-9]+:", folder) else f"file://{folder}")


class PartWriter:
    """Writes one part: ids as they come, in batches of ``rows`` lists."""

    def __init__(self, folder: str, part: int, kind: str, length: int, rows: int):
        self.fs, base = open_folder(folder)
        self.names = [f"{base}/{stem}-{part:08d}.arrow" for stem in ("tokens", "index")]
        self.tmp = [f"{n}.{uuid.uuid4().hex}" for n in self.names]
        self.kind, self.length, self.full = np.dtype(kind), length, rows * length
        self.schema = layout(kind, length)
        self.out = self.fs.open_output_stream(self.tmp[0])
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.waiting, self.n, self.index = bytearray(), 0, []

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // self.kind.itemsize
        self.index.append((doc_id, self.n, n))
        self.n += n
        self.waiting += ids
        size = self.full * self.kind.itemsize
        while len(self.waiting) >= size:
            self._batch(bytes(self.waiting[:size]), self.full)
            del self.waiting[:size]

    def _batch(self, data: bytes, real: int) -> None:
        ids = np.frombuffer(data, dtype=self.kind)
        mask = np.arange(len(ids)) < real
        self.stream.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), self.schema)], schema=self.schema))

    def close(self, id_type: pa.DataType) -> None:
        if real := len(self.waiting) // self.kind.itemsize:
            self._batch(bytes(self.waiting) + bytes(-real % self.length * self.kind.itemsize), real)
        self.stream.close()
        self.out.close()
        ids, firsts, counts = zip(*self.index)
        batch = pa.record_batch([pa.array(ids, id_type), pa.array(firsts, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "first", "n_tokens"])
        with self.fs.open_output_stream(self.tmp[1]) as f, pa.ipc.new_stream(f, batch.schema) as s:
            s.write_batch(batch)
        for a, b in zip(self.tmp, self.names):
            self.fs.move(a, b)


class Tokens:
    """Random access to the equal-length sequences of a tokens file, without copying where the file
    system can map files: sequence i is in batch i // rows, which starts at a known offset."""

    def __init__(self, folder: str, part: int):
        fs, base = open_folder(folder)
        name = f"{base}/tokens-{part:08d}.arrow"
        self.file = pa.memory_map(name) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(name)
        self.schema = pa.ipc.read_schema(self.file)
        self.start = self.file.tell()
        self.length = self.schema.field("ids").type.list_size
        first = self._read(self.start)
        self.rows = first.num_rows if first else 0
        self.step = self.file.tell() - self.start

    def _read(self, at: int):
        self.file.seek(at)
        try:
            message = pa.ipc.read_message(self.file)
        except EOFError:
            return None
        return pa.ipc.read_record_batch(message, self.schema)

    def batch(self, k: int) -> pa.RecordBatch:
        return self._read(self.start + k * self.step)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i of the part."""
        b, r = self.batch(i // self.rows), i % self.rows
        span = slice(r * self.length, (r + 1) * self.length)
        return b.column("ids").values.to_numpy()[span], b.column("mask").values.to_numpy(zero_copy_only=False)[span]

    def ids(self, first: int, n: int) -> np.ndarray:
        """n ids from place ``first`` on; a view unless they lie in several batches."""
        size, out = self.rows * self.length, []
        while n > 0:
            k, at = divmod(first, size)
            part = self.batch(k).column("ids").values.to_numpy()[at:at + n]
            out.append(part)
            first, n = first + len(part), n - len(part)
        return out[0] if len(out) == 1 else np.concatenate(out or [np.zeros(0, np.uint16)])


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 1, kind: str = "uint16", length: int = 2048,
                 rows: int = 64, split_words: bool = True, text: str = "text", key: str = "doc_id") -> tuple[str, list[tuple[int, int]]]:
    """Write the files; returns the folder and (part, ids) of every part, in order.

    ``folder`` must be shared and is new by default. Parts follow adaptive execution's partition sizes."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    fs, base = open_folder(folder)
    fs.create_dir(base, recursive=True)
    dealt = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    dealt = dealt.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "t")

    def run(batches):
        from pyspark import TaskContext

        part, out, encode, end = TaskContext.get().partitionId(), None, None, np.array([end_id], dtype=kind).tobytes()
        for b in batches:
            if b.num_rows and out is None:
                out, encode, id_type = PartWriter(folder, part, kind, length, rows), encoder(tokenizer, kind, split_words), b.column(0).type
            for at in range(0, b.num_rows, 500):
                some = b.slice(at, 500)
                for d, ids in zip(some.column(0).to_pylist(), encode([t.as_buffer().to_pybytes() for t in some.column(1)])):
                    out.add(d, ids + end)
        if out:
            out.close(id_type)
            yield pa.record_batch([pa.array([part]), pa.array([out.n])], ["part", "n"])

    parts = dealt.mapInArrow(run, "part long, n long").collect()  # one row per part
    return folder, sorted((r.part, r.n) for r in parts)


def read_tokens(spark: SparkSession, folder: str, parts: list[tuple[int, int]], id_type: str = "bigint") -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, part."""
    starts, total = [], 0
    for part, n in parts:
        starts.append((part, total))
        total += n

    def run(batches):
        for b in batches:
            for i in b.column(0).to_pylist():
                part, start = starts[i]
                tokens, (fs, base) = Tokens(folder, part), open_folder(folder)
                with fs.open_input_stream(f"{base}/index-{part:08d}.arrow") as f:
                    index = pa.ipc.open_stream(f).read_all().combine_chunks()
                first, n = index["first"].to_numpy(), index["n_tokens"].to_numpy()
                crc = [zlib.crc32(tokens.ids(a, k).astype("<u4")) for a, k in zip(first.tolist(), n.tolist())]
                full = pa.table([index["doc_id"], pa.array(first + start), index["n_tokens"], pa.array(crc, pa.int64()),
                                 pa.array(np.full(len(n), part))], ["doc_id", "start", "n_tokens", "ids_crc32", "part"])
                yield from full.to_batches(max_chunksize=10_000)

    kind = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, part long"
    if not parts:
        return spark.createDataFrame([], kind)
    return spark.range(0, len(parts), 1, len(parts)).mapInArrow(run, kind)


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    """All documents by ``word_bpe_49k.json`` with end id 1, written and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    folder, parts = write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder, parts, docs.schema["doc_id"].dataType.simpleString())
