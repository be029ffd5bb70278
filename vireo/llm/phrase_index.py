"""Benchmark decontamination over a distributed positional inverted index.

The index is a table with one row per shard, a run of a few MB of documents:
the shard's sorted terms, and for each term its positions, counted through the
shard with a gap between documents so that no phrase crosses one. It holds the
postings of every word of every document and does not depend on the benchmark.

A query item is cut into windows of ``WINDOW`` consecutive words (a shorter
item is one window). Per shard a window starts from the postings of its rarest
term, moved back by the term's place in the window, and is intersected with
the moved postings of the next rarest terms until it is empty or proven: exact
phrase matches. ``slack`` > 0 asks for proximity matches instead: the words in
order within ``slack`` extra words. Items come in blocks of bounded size, so
neither the benchmark nor the index has to fit anywhere whole.

Defined results: a null or empty text has no words and is never contaminated.
Repeated rows (also of one doc_id) are rows of their own. Items with a null id
or without words match nothing; rows of one item_id are one item. An empty
benchmark leaves every document clean. Only the named columns are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import LETTER_DIGIT, LOWER, frugal, slices, text_bytes, word_array, word_spans, written

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20

INDEX_SCHEMA = "shard string, doc_ids binary, firsts binary, terms binary, term_ends binary, ends binary, positions binary"
MATCH_SCHEMA = "shard string, ordinal int, starts array<int>, ends array<int>, items array<string>"
DOCUMENT_SCHEMA = "shard string, ordinal int, doc_id long, n_words long"


def _shard(part: pa.RecordBatch) -> dict[str, object]:
    """Postings of one run of documents, all arrays as little-endian bytes."""
    buf, offs = text_bytes(part.column(1))
    buf = LOWER[buf]
    starts, ends, firsts = word_spans(buf, offs, LETTER_DIGIT)
    coded = word_array(buf, starts, ends).dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    rows = len(firsts) - 1
    positions = np.arange(len(codes), dtype=np.int32) + np.repeat(np.arange(rows, dtype=np.int32), np.diff(firsts))
    term_bytes, term_offs = text_bytes(coded.dictionary)
    ids = part.column(0)
    return {"shard": uuid.uuid4().hex,
            "doc_ids": pa.py_buffer(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                                    + ids.is_null().to_numpy(zero_copy_only=False).tobytes()).to_pybytes(),
            "firsts": firsts.astype("<i4").tobytes(), "terms": term_bytes.tobytes(),
            "term_ends": term_offs[1:].astype("<i4").tobytes(),
            "ends": np.cumsum(np.bincount(codes, minlength=len(coded.dictionary))).astype("<i4").tobytes(),
            "positions": positions[order].astype("<i4").tobytes()}


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index of all documents, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.string()), *[(c, pa.binary()) for c in ("doc_ids", "firsts", "terms", "term_ends", "ends", "positions")]])
        for batch in batches:
            for a, b in slices(batch.column(1), SHARD_BYTES):
                yield pa.RecordBatch.from_pylist([_shard(batch.slice(a, b - a))], schema=schema)

    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return written(rows.mapInArrow(frugal(run), INDEX_SCHEMA), "phrase-index")


class Queries:
    """The windows of a block of items, as rows of codes into the block's vocabulary."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        vocabulary: dict[bytes, int] = {}
        self.items, windows, owner = [], [], []
        for item_id, text in items:
            buf = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            starts, ends, _ = word_spans(buf, np.array([0, len(buf)]), LETTER_DIGIT)
            raw = buf.tobytes()
            codes = [vocabulary.setdefault(raw[s:e], len(vocabulary)) for s, e in zip(starts, ends, strict=True)]
            if codes:
                self.items.append(item_id)
                for at in range(max(1, len(codes) - window + 1)):
                    windows.append(codes[at:at + window])
                    owner.append(len(self.items) - 1)
        self.vocabulary = pa.array(list(vocabulary), pa.binary())
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.codes = np.full((len(windows), window), -1, np.int64)
        for i, w in enumerate(windows):
            self.codes[i, :len(w)] = w
        self.owner = np.array(owner, np.int64)


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.searchsorted(among, values)
    return (at < len(among)) & (among[np.minimum(at, len(among) - 1)] == values)


def exact_starts(lists: list[np.ndarray]) -> np.ndarray:
    """Positions at which the terms follow each other: rarest list first, each moved to the start."""
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    found = lists[order[0]] - order[0]
    for k in order[1:]:
        found = found[_member(found + k, lists[k])]
        if not len(found):
            break
    return found


def near_spans(lists: list[np.ndarray], slack: int, row_of) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the terms in order within ``slack`` extra words of one document."""
    reach = len(lists) - 1 + slack
    rare = min(range(len(lists)), key=lambda k: len(lists[k]))
    first = lists[0]
    at = np.searchsorted(lists[rare], first)
    near = (at < len(lists[rare])) & (lists[rare][np.minimum(at, len(lists[rare]) - 1)] - first <= reach)
    first = last = first[near]
    for more in lists[1:]:
        at = np.searchsorted(more, last, side="right")
        keep = at < len(more)
        first, last = first[keep], more[at[keep]]
        keep = last - first <= reach
        first, last = first[keep], last[keep]
    keep = row_of(first) == row_of(last)
    return first[keep], last[keep] + 1


def search_shard(row: dict[str, bytes], queries: Queries, slack: int = 0) -> dict[str, list]:
    """For every document of a shard that has a match: covered word ranges and matching items."""
    firsts = np.frombuffer(row["firsts"], "<i4").astype(np.int64)
    rows = len(firsts) - 1
    begins = firsts[:-1] + np.arange(rows)  # position of each document's first word
    row_of = lambda p: np.searchsorted(begins, p, side="right") - 1
    ends = np.frombuffer(row["ends"], "<i4")
    positions = np.frombuffer(row["positions"], "<i4").astype(np.int64)
    term_ends = np.frombuffer(row["term_ends"], "<i4")
    offs = np.concatenate([np.zeros(1, np.int32), term_ends])
    terms = pa.Array.from_buffers(pa.binary(), len(term_ends), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(row["terms"])])
    local = pc.fill_null(pc.index_in(queries.vocabulary, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.where(local >= 0, np.diff(ends, prepend=0)[local] if len(ends) else 0, 0)
    alive = np.flatnonzero(((counts[queries.codes] > 0) | (queries.codes < 0)).all(axis=1)) if len(queries.codes) and len(ends) else []
    covered = np.zeros(int(firsts[-1]) + rows + 1, np.int64)
    matched: list[np.ndarray] = []
    for w in alive:
        codes = local[queries.codes[w, :queries.lengths[w]]]
        lists = [positions[(ends[c - 1] if c else 0):ends[c]] for c in codes]
        if slack:
            s, e = near_spans(lists, slack, row_of)
        else:
            s = exact_starts(lists)
            e = s + len(codes)
        if len(s):
            np.add.at(covered, s, 1)
            np.subtract.at(covered, e, 1)
            matched.append(np.unique(row_of(s)) * len(queries.items) + queries.owner[w])
    inside = np.cumsum(covered) > 0
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    run_starts, run_ends = edges[::2], edges[1::2]
    run_rows = row_of(run_starts)
    cut = np.searchsorted(run_rows, np.arange(rows + 1))
    pairs = np.unique(np.concatenate(matched)) if matched else np.empty(0, np.int64)
    pair_cut = np.searchsorted(pairs // max(1, len(queries.items)), np.arange(rows + 1))
    hit = np.flatnonzero(np.diff(pair_cut))
    return {"ordinal": hit.tolist(),
            "starts": [(run_starts[cut[i]:cut[i + 1]] - begins[i]).tolist() for i in hit],
            "ends": [(run_ends[cut[i]:cut[i + 1]] - begins[i]).tolist() for i in hit],
            "items": [[queries.items[k] for k in pairs[pair_cut[i]:pair_cut[i + 1]] % max(1, len(queries.items))] for i in hit]}


def documents_of(index: DataFrame) -> DataFrame:
    """(shard, ordinal, doc_id, n_words) of every document in the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.string()), ("ordinal", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                n_words = np.diff(np.frombuffer(row["firsts"], "<i4")).astype(np.int64)
                rows, ids = len(n_words), row["doc_ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * rows, pa.string()), pa.array(np.arange(rows, dtype=np.int32)),
                     pa.array(np.frombuffer(ids[:8 * rows], "<i8"), pa.int64(), mask=np.frombuffer(ids[8 * rows:], bool)), pa.array(n_words)], schema=schema)

    return index.select("shard", "doc_ids", "firsts").mapInArrow(frugal(run), DOCUMENT_SCHEMA)


def _search(index: DataFrame, items: list[tuple[str, str]], window: int, slack: int) -> DataFrame:
    queries = Queries(items, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.string()), ("ordinal", pa.int32()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                cols = search_shard(row, queries, slack)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(cols["ordinal"]), pa.string()), *[pa.array(cols[f.name], f.type) for f in list(schema)[1:]]], schema=schema)

    return index.mapInArrow(frugal(run), MATCH_SCHEMA)


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """The query set in blocks of about ``BLOCK_BYTES`` of text; one block at a time is on the driver."""
    rows = items.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t")).where("k IS NOT NULL AND t IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for b in range(blocks):
        yield [(r.k, r.t) for r in rows.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == b).toLocalIterator()]


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, slack: int = 0, percent: int = 5) -> DataFrame:
    """One row per document: words, covered words and ranges, matching items, verdict.

    A document is contaminated if at least ``percent`` % of its words (and at
    least one) lie in a match.
    """
    index = build_index(docs, key, text)
    found = None
    for block in item_blocks(items, item_key, item_text):
        part = _search(index, block, window, slack)
        found = part if found is None else found.unionByName(part)
    spans = F.arrays_zip(F.flatten(F.collect_list("starts")).alias("s"), F.flatten(F.collect_list("ends")).alias("e"))
    merged = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["upto"]))).alias("n"),
                                F.greatest(acc["upto"], x["e"]).alias("upto")))
    hits = (found.groupBy("shard", "ordinal")
            .agg(spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .withColumn("n_hit", merged["n"].cast("long")))
    none = {c: F.array().cast(hits.schema[c].dataType) for c in ("spans", "items")}
    return (documents_of(index).join(hits, ["shard", "ordinal"], "left")
            .withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), **{c: F.coalesce(c, e) for c, e in none.items()}})
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
                    ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))).alias("contaminated")))
