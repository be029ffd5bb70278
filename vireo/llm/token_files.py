"""Token-id files: every document a zstandard frame of its own, with one shared dictionary.

The file set is three Parquet tables below one folder, so any store that Spark
reaches will do: ``dictionary`` (one row: its SHA-256 and bytes), ``packs`` and
``shards``. A pack is a run of documents in ascending doc_id order: the frames
back to back, the offset index (end of each frame and number of ids per
document), the doc_ids, the dictionary hash, and the least and greatest doc_id
as plain columns, by which Parquet statistics lead a lookup to its pack.
A pack knows the ids before it in its shard and ``shards`` those before each
shard, so positions in the whole corpus are known without reading frames.

Ids are serialized little-endian, in two bytes if the vocabulary allows, else
four. The dictionary is trained on the id arrays of at most ``SAMPLE_DOCS``
documents (those with the least key hash) and ``SAMPLE_BYTES``; it changes how
small the frames are, never what they hold.

Defined results: null and empty texts hold only the end id. Rows of one doc_id
are kept each, ordered by a hash of their text; null doc_ids come first. An
empty table gives an empty dictionary and no packs. Frames of another
dictionary are refused. Only key and text are read.
"""

from __future__ import annotations

import hashlib
import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vireo.llm.common import Memory, bounded_sample, chunk_table, frugal, gathered, slices

SAMPLE_DOCS = 1000
SAMPLE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
PACK_BYTES = 8 << 20
#: Chunks a worker remembers in each of two generations.
MEMORY_ROWS = 350_000

PACK_SCHEMA = ("shard int, pack int, dictionary string, width int, n_ids long, ids_before long, "
               "least long, greatest long, "
               "doc_ids binary, counts binary, ends binary, frames binary")
DOC_SCHEMA = "shard int, before long, doc_id long, n_tokens long, ids_crc32 long"


def byte_characters() -> dict[int, str]:
    """For every character up to U+00FF, what byte-level BPE models write for its UTF-8 bytes.

    A printable byte stands for itself; the others are numbered from U+0100 on.
    """
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    shown = {b: chr(b) for b in printable}
    shown |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: "".join(shown[b] for b in chr(c).encode()) for c in range(256)}


SHOWN = byte_characters()
CLOSING = frozenset(".,;:!?")


class Encoder:
    """The tokenizers library, with the ids of the chunks a worker has met lately."""

    def __init__(self, definition: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.width = 2 if max(self.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.end = self._serialized([end_id])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.memory = Memory(MEMORY_ROWS)

    def _serialized(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [self._serialized(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str, plain: bool) -> bytes:
        """A blank and letters, or a mark: one piece to the pre-tokenizer, so it goes to the library's model at once."""
        found = self.memory.new.get(word)
        if found is None:
            shown = word.replace(" ", SHOWN[32]) if plain else word.translate(SHOWN)
            found = self.memory.new[word] = self._serialized([t.id for t in self.model.tokenize(shown)])
        return found

    def learn(self, unseen: list[str]) -> None:
        """Ids of new chunks. Words with or without a closing mark are one or two pieces; the library splits the rest."""
        rest, known = [], self.memory.new
        for c in unseen:
            letters, mark = (c[1:-1], c[-1]) if c[-1] in CLOSING else (c[1:], "")
            if c[0] == " " and letters.isalpha() and ((plain := letters.isascii()) or max(letters) <= "\u00ff"):
                if mark:
                    known[c] = self._word(c[:-1], plain) + self._word(mark, True)
                else:
                    self._word(c, plain)
            else:
                rest.append(c)
        known.update(zip(rest, self._ids(rest), strict=True))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Serialized ids of every text (null: empty), end id included.

        Texts are encoded chunk by chunk, unless they hold an added token's
        string, which the library looks for in the whole text.
        """
        table, codes, firsts = chunk_table(texts)
        distinct = table.to_pylist()
        self.learn(self.memory.missing(distinct))
        known = self.memory.new
        ids, offs = gathered(pa.array([known[c] for c in distinct], pa.binary()), codes, firsts)
        ids = ids.tobytes()
        out = [ids[offs[i]:offs[i + 1]] + self.end for i in range(len(texts))]
        for s in self.special:
            for i in np.flatnonzero(pc.fill_null(pc.match_substring(texts, s), False).to_numpy(zero_copy_only=False)):
                out[i] = self._ids([texts[i].as_py()])[0] + self.end
        return out


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(definition: str, end_id: int) -> Encoder:
    """The worker's encoder of that definition, built at first use."""
    if (definition, end_id) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[definition, end_id] = Encoder(definition, end_id)
    return _ENCODERS[definition, end_id]


def train_dictionary(docs: DataFrame, definition: str, end_id: int) -> bytes:
    """A zstandard dictionary from a bounded sample (empty if there is too little to learn from)."""
    own = Encoder(definition, end_id)
    samples, size = [], 0
    for row in bounded_sample(docs.select("doc_id", "text"), "doc_id", SAMPLE_DOCS).toLocalIterator():
        if size > SAMPLE_BYTES:
            break
        samples += own.encode(pa.array([row.text], pa.string()))
        size += len(samples[-1])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _pack(part: pa.RecordBatch, own: Encoder, squeeze: zstandard.ZstdCompressor) -> dict[str, object]:
    ids = part.column(0)
    serialized = own.encode(part.column(1))
    frames = [squeeze.compress(s) for s in serialized]
    keys = ids.drop_null().to_numpy(zero_copy_only=False)
    counts = np.array([len(s) // own.width for s in serialized], "<i8")
    return {"width": own.width, "n_ids": int(counts.sum()), "least": int(keys.min()) if len(keys) else None,
            "greatest": int(keys.max()) if len(keys) else None,
            "doc_ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes() + ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
            "counts": counts.tobytes(), "ends": np.cumsum([len(f) for f in frames]).astype("<i8").tobytes(), "frames": b"".join(frames)}


def write(docs: DataFrame, path: str, definition: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> None:
    """Encode all documents and write the file set below ``path``."""
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    dictionary = train_dictionary(rows, definition, end_id)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, bytearray(dictionary))], "dictionary string, bytes binary").write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard, pack, ids_before = encoder(definition, end_id), TaskContext.get().partitionId(), 0, 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        schema = pa.schema([("shard", pa.int32()), ("pack", pa.int32()), ("dictionary", pa.string()), ("width", pa.int32()), ("n_ids", pa.int64()),
                            ("ids_before", pa.int64()), ("least", pa.int64()), ("greatest", pa.int64()), *[(c, pa.binary()) for c in ("doc_ids", "counts", "ends", "frames")]])
        for batch in batches:
            for a, b in slices(batch.column(1), PACK_BYTES):
                row = {"shard": shard, "pack": pack, "dictionary": name, "ids_before": ids_before} | _pack(batch.slice(a, b - a), own, squeeze)
                yield pa.RecordBatch.from_pylist([row], schema)
                pack, ids_before = pack + 1, ids_before + row["n_ids"]

    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(frugal(run), PACK_SCHEMA).write.parquet(f"{path}/packs")
    shards = spark.read.schema(PACK_SCHEMA).parquet(f"{path}/packs").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    # one small row per shard: their running sum is all that one task does
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards.select("shard", before.cast("long").alias("ids_before")).write.parquet(f"{path}/shards")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.schema("dictionary string, bytes binary").parquet(f"{path}/dictionary").first()
    name = hashlib.sha256(bytes(row.bytes)).hexdigest()
    if name != row.dictionary:
        raise ValueError("the dictionary does not have the hash it is stored under")
    return name, bytes(row.bytes)


def unpack(row: dict, name: str, dictionary: bytes, wanted: int | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the documents of a pack; ``wanted``: only those of that doc_id, by the offset index."""
    if row["dictionary"] != name:
        raise ValueError("the pack was written with another dictionary")
    n = len(row["ends"]) // 8
    keys, null = np.frombuffer(row["doc_ids"][:8 * n], "<i8"), np.frombuffer(row["doc_ids"][8 * n:], bool)
    ends, counts = np.frombuffer(row["ends"], "<i8"), np.frombuffer(row["counts"], "<i8")
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    expand = zstandard.ZstdDecompressor(dict_data=shared)
    for i in range(n) if wanted is None else np.flatnonzero((keys == wanted) & ~null):
        ids = np.frombuffer(expand.decompress(row["frames"][(ends[i - 1] if i else 0):ends[i]]), f"<u{row['width']}")
        if len(ids) != counts[i]:
            raise ValueError("a frame does not hold as many ids as the index says")
        yield None if null[i] else int(keys[i]), ids


def document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (one array per row of that doc_id), read from its packs alone."""
    name, dictionary = _dictionary(spark, path)
    packs = spark.read.schema(PACK_SCHEMA).parquet(f"{path}/packs").where((F.col("least") <= doc_id) & (F.col("greatest") >= doc_id))
    return [ids for row in packs.orderBy("shard", "pack").toLocalIterator() for _, ids in unpack(row.asDict(), name, dictionary, doc_id)]


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    name, dictionary = _dictionary(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = list(unpack(row, name, dictionary))
                counts = np.array([len(ids) for _, ids in found], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(found), pa.int32()), pa.array(np.cumsum(counts) - counts + row["ids_before"]),
                     pa.array([d for d, _ in found], pa.int64()), pa.array(counts),
                     pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in found], pa.int64())],
                    names=["shard", "before", "doc_id", "n_tokens", "ids_crc32"])

    docs = spark.read.schema(PACK_SCHEMA).parquet(f"{path}/packs").mapInArrow(frugal(run), DOC_SCHEMA)
    shards = spark.read.schema("shard int, ids_before long").parquet(f"{path}/shards")
    return docs.join(shards, "shard").select("doc_id", (F.col("before") + F.col("ids_before")).alias("start"), "n_tokens", "ids_crc32")
