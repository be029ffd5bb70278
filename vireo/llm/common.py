"""Helpers shared by the operators: table access, written intermediates, byte-level tokenizing.

Text is handled as UTF-8 bytes in numpy: a word is a run of bytes whose class
is set in a 256-entry table, so a whole Arrow batch is split without a Python
object per word. Batches are cut into slices of a few MB, which bounds memory
whatever the length of single texts.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vireo.session import checkpoint_dir, scratch_path

SLICE_BYTES = 4 << 20

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words [^\x20\x09-\x0D]+.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (digits, a-z, all of non-ASCII).
LETTER_DIGIT = np.ones(256, dtype=bool)
LETTER_DIGIT[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False


def release() -> None:
    """Hand memory that finished work has freed back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def frugal(run: Callable) -> Callable:
    """A function over batches that releases memory when it is done with them."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()
    return over


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    The plan that follows starts from files every executor can reach, so a
    lost executor costs a re-read and not a recomputation.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_stored(docs: DataFrame) -> bool:
    """Whether ``docs`` is a table of files as it lies, with nothing done to it."""
    return docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation"


def row_keyed(docs: DataFrame) -> DataFrame:
    """(doc, file, row): every row of ``docs`` as a struct, with a key of its own that no retry changes.

    The key is the row's place in the Parquet files; rows that are not read
    from files as they lie are written first.
    """
    docs = docs if is_stored(docs) else written(docs, "rows")
    place = docs.metadataColumn("_metadata")
    return docs.select(F.struct("*").alias("doc"), place["file_path"].alias("file"), place["row_index"].alias("row"))


#: Bits of a row's place inside its file.
ROW_BITS = 40


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, number): as row_keyed(), with one number for file and row (the files are ranked by path; as many rows as files)."""
    rows = row_keyed(docs)
    files = rows.select("file").distinct().withColumn("rank", F.row_number().over(Window.orderBy("file")).cast("long"))
    files = written(files, "files")
    return rows.join(F.broadcast(files), "file").select("doc", (F.col("rank") * (1 << ROW_BITS) + F.col("row")).alias("number"))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_fold(key: str, modulus: int):
    """crc32 of the decimal text of a key, modulo ``modulus`` (null key: null)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(modulus)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    if len(texts) == 0:
        return
    ends = np.cumsum(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array (null: empty) and the offsets of its rows."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def word_spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row) of the words; no word crosses a row."""
    if len(buf) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(buf), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(buf), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_array(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an Arrow binary array, built without Python objects."""
    lengths = ends - starts
    offs = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    delta = np.zeros(len(buf) + 1, np.int8)
    delta[starts] += 1
    delta[ends] -= 1
    data = buf[np.cumsum(delta[:-1], dtype=np.int8).astype(bool)]
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(data))])


#: ASCII white space in the widest sense (C0 separators included).
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
#: Lead bytes of white space beyond ASCII.
_WIDE_LEAD = np.zeros(256, bool)
_WIDE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _spaces(buf: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    space = _SPACE[buf]
    if _WIDE_LEAD[buf].any():
        two = (buf[:-1] == 0xC2) & ((buf[1:] == 0x85) | (buf[1:] == 0xA0))
        space[:-1] |= two
        space[1:] |= two
        if len(buf) > 2:
            lead, mid, end = buf[:-2], buf[1:-1], buf[2:]
            three = (((lead == 0xE1) & (mid == 0x9A) & (end == 0x80)) | ((lead == 0xE3) & (mid == 0x80) & (end == 0x80))
                     | ((lead == 0xE2) & (mid == 0x81) & (end == 0x9F))
                     | ((lead == 0xE2) & (mid == 0x80) & ((end <= 0x8A) | (end == 0xA8) | (end == 0xA9) | (end == 0xAF))))
            for k in range(3):
                space[k:len(buf) - 2 + k] |= three
    return space


def chunk_table(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(distinct chunks as strings, code of every chunk, first chunk of each text and the end).

    Texts are cut before every blank that stands alone between two other
    characters. Byte-level BPE pre-tokenizers never let a piece run over such
    a place (a piece holds a blank only as its first character), so chunks can
    be encoded on their own; they repeat far more often than texts do.
    """
    buf, offs = text_bytes(texts)
    if len(buf) == 0:
        return pa.array([], pa.string()), pa.array([], pa.int32()), np.zeros(len(offs), np.int64)
    space = _spaces(buf)
    cut = np.zeros(len(buf) + 1, bool)
    cut[1:-2] = (buf[1:-1] == 0x20) & ~space[:-2] & ~space[2:]
    cut[offs] = True
    edges = np.flatnonzero(cut)
    pieces = pa.Array.from_buffers(pa.string(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(buf))])
    coded = pieces.dictionary_encode()
    return coded.dictionary, coded.indices, np.searchsorted(edges, offs)


def binary_array(data: np.ndarray | bytes, offs: np.ndarray) -> pa.Array:
    """Binary values back to back in ``data``, cut at ``offs`` (with the end)."""
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1, [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(data)])


def gathered(values: pa.Array, codes: pa.Array, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all codes back to back, and where each row's part begins (and the end)."""
    buf, offs = text_bytes(values.take(codes))
    return buf, offs[firsts]


class Memory:
    """Values that a worker keeps by chunk: two generations of at most ``rows`` each, the older dropped when the newer is full."""

    def __init__(self, rows: int):
        self.rows, self.new, self.old = rows, {}, {}

    def missing(self, keys: list[str]) -> list[str]:
        """Those without a value; the others are in the newer generation afterwards."""
        if len(self.new) > self.rows:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        unknown = [k for k in keys if k not in new]
        kept = {k: old[k] for k in unknown if k in old}
        new.update(kept)
        return [k for k in unknown if k not in kept] if kept else unknown


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the least hash of ``key``; about as many reach the final sort."""
    total = df.count()
    spread = F.xxhash64(F.col(key).cast("string"))
    if total > rows:
        share = min(1.0, 1.5 * rows / total)
        df = df.where(spread <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1))))
    return df.orderBy(spread, key).limit(rows)


#: Multiplier of the polynomial word hash, its inverse modulo 2^64, and the two of the bit mixer (SplitMix64).
HASH_BASE = np.uint64(0x9E3779B97F4A7C15)
HASH_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
HASH_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a number spread over 64."""
    x = (x ^ (x >> np.uint64(30))) * HASH_MIX[0]
    x = (x ^ (x >> np.uint64(27))) * HASH_MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from running sums of byte times HASH_BASE to the place."""
    powers = np.full(len(buf) + 1, HASH_BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(powers[:-1] * (buf.astype(np.uint64) + np.uint64(1)), out=sums[1:])
    powers[1:] = HASH_INVERSE
    np.multiply.accumulate(powers, out=powers)
    return mixed((sums[ends] - sums[starts]) * powers[starts])


def row_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive entries of ``firsts``."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[firsts[1:]] - total[firsts[:-1]]
