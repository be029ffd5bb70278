"""Quality rule by compression bands: zstandard ratios of whole documents and fixed chunks.

The ratio is bytes of text over bytes of its zstandard frame. Text that packs
far better than prose of its length repeats itself; text that barely packs is
noise. How well prose packs depends on its length, so the limits are a table
by size (powers of four). The whole text and every chunk of ``CHUNK_BYTES``
are judged, the shorter last one by the limits of its own size, so that a
repetitive stretch inside an ordinary document is seen: a document fails if
its own ratio is out of band or more than ``MAX_BAD_CHUNKS`` of its chunks are.

Defined results: null and empty texts have no words, ratio null, and fail the
base rule (too few words). A text shorter than the smallest band has no ratio
limit. Nothing depends on other rows, so ties and repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from vireo.llm.common import NOT_SPACE, frugal, slices, text_bytes, word_array, word_spans

LEVEL = 3
CHUNK_BYTES = 4096
MAX_BAD_CHUNKS = 0.5
#: (least bytes, least ratio, greatest ratio): prose lies well inside, by size.
BANDS = ((64, 0.75, 4.0), (256, 1.05, 4.5), (1024, 1.2, 5.0), (4096, 1.3, 6.0), (16384, 1.35, 8.0))
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long")


def in_band(n_bytes: int, ratio: float) -> bool:
    """Whether a ratio is ordinary for a text of that many bytes."""
    limits = [(low, high) for least, low, high in BANDS if n_bytes >= least]
    return not limits or limits[-1][0] <= ratio <= limits[-1][1]


def bands_of(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float | None, int, int]:
    """Ratio of the whole text, number of chunks, and how many are out of the band of their size."""
    if not data:
        return None, 0, 0
    bad = chunks = 0
    for at in range(0, len(data), CHUNK_BYTES):
        chunk = data[at:at + CHUNK_BYTES]
        chunks += 1
        bad += not in_band(len(chunk), len(chunk) / len(compressor.compress(chunk)))
    return len(data) / len(compressor.compress(data)), chunks, bad


def repeated_window_words(codes: np.ndarray, firsts: np.ndarray, size: int = 3) -> np.ndarray:
    """Per row, how many words lie in a window of ``size`` words found twice or more in that row."""
    n, rows = len(codes), len(firsts) - 1
    row_of = np.repeat(np.arange(rows), np.diff(firsts))
    covered = np.zeros(n, bool)
    if n >= size:
        key = codes.astype(np.int64)
        for k in range(1, size):
            key = pd.factorize(key[:len(key) - 1] * (int(codes.max()) + 1) + codes[k:])[0].astype(np.int64)
        same = row_of[:n - size + 1] == row_of[size - 1:]
        at = np.flatnonzero(same)
        window = pd.factorize(key[at] * rows + row_of[at])[0]
        repeated = at[np.bincount(window)[window] > 1] if len(at) else at
        for k in range(size):
            covered[repeated + k] = True
    return np.bincount(row_of[covered], minlength=rows)


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The word, symbol, line and repetition counts of every text (null: no words)."""
    buf, offs = text_bytes(texts)
    starts, ends, firsts = word_spans(buf, offs, NOT_SPACE)
    inside = np.zeros(len(buf) + 1, np.int64)
    # a code point is counted at its first byte; words hold whole code points
    np.cumsum(NOT_SPACE[buf] & ((buf & 0xC0) != 0x80), out=inside[1:])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    symbols = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(symbol[buf], out=symbols[1:])
    codes = word_array(buf, starts, ends).dictionary_encode().indices.to_numpy() if len(starts) else np.empty(0, np.int32)
    raw, dup = buf.tobytes(), np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        lines = [x for x in raw[offs[i]:offs[i + 1]].split(b"\n") if x.split()]
        dup[i] = len(lines) - len(set(lines))
    return {"n_words": np.diff(firsts), "word_chars": inside[offs[1:]] - inside[offs[:-1]],
            "n_symbols": symbols[offs[1:]] - symbols[offs[:-1]], "n_dup_lines": dup,
            "n_repeat_words": repeated_window_words(codes, firsts)}


def judge_texts(texts: pa.Array) -> dict[str, object]:
    """All result columns but the key for one slice of texts."""
    cols = base_counts(texts)
    buf, offs = text_bytes(texts)
    raw, compressor = buf.tobytes(), zstandard.ZstdCompressor(level=LEVEL)
    bands = [bands_of(raw[offs[i]:offs[i + 1]], compressor) for i in range(len(texts))]
    failed = (cols["n_words"] < MIN_WORDS) | (100 * cols["n_repeat_words"] > MAX_REPEAT_PERCENT * cols["n_words"])
    ok = np.array([r is None or (in_band(int(n), r) and bad <= MAX_BAD_CHUNKS * k)
                   for (r, k, bad), n in zip(bands, np.diff(offs), strict=True)], dtype=bool)
    return cols | {"base_failed": failed, "kept": ~failed & ok, "ratio": [b[0] for b in bands],
                   "n_chunks": [b[1] for b in bands], "n_bad_chunks": [b[2] for b in bands]}


def compression_bands(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base counts, verdict, ratio and chunk counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                cols = judge_texts(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(v) if not isinstance(v, list) else pa.array(v, pa.float64() if k == "ratio" else pa.int64())
                                       for k, v in cols.items()]],
                    names=["doc_id", *cols])

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(frugal(run), SCHEMA)


