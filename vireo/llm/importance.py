"""Target-distribution importance resampling: hashed n-gram weights, Gumbel scores, a cutoff by counting.

Features of a text are its runs of one to ``longest`` words, filed into
``BUCKETS`` buckets by crc32. The counts of all documents and of all target
texts give every bucket a gain (scaled log ratio of the smoothed shares), and
the gains lie in one array of fixed length that goes to the tasks; a batch of
texts becomes bucket numbers, and the weights of its rows are sums of the
array at these numbers. A row's score is its weight plus Gumbel noise from a
hash of its id, so the highest scores are a draw without replacement by
weight.

Which scores are drawn is found by numbers alone: scores are written once, and
jobs that count rows at ``POINTS`` thresholds each narrow the range of the
cutoff until one score is left; the ids tied at that score are narrowed in the
same way. Only the rows beyond the cutoff are dealt out by ranges of (score,
id) and numbered. No rows are sorted that are not drawn, and none reach the
driver.

Defined results: a null or empty text has no words, weight 0, and is not drawn
unless ``least_words`` is 0. A null id is hashed as an empty text and comes
last in a tie; rows that tie in everything are drawn in the order in which
they lie in their files. An empty document table gives no rows; an empty
target has no features (T = 0). Only the named columns of the inputs are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import LETTER_DIGIT, LOWER, frugal, row_keyed, slices, text_bytes, word_array, word_spans, written
from vireo.operators.keys import dense_key

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
SCALE = 1000
#: Thresholds that one job counts at.
POINTS = 15


def feature_buckets(texts: pa.Array, longest: int = LONGEST, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of the features of every length, for some texts; runs of one word come first."""
    buf, offs = text_bytes(texts)
    low = LOWER[buf]
    starts, ends, firsts = word_spans(low, offs, LETTER_DIGIT)
    row = np.repeat(np.arange(len(texts)), np.diff(firsts))
    if longest > 1:  # the words with one blank behind each
        words, lengths = text_bytes(word_array(low, starts, ends))[0], ends - starts
        starts = np.cumsum(lengths + 1) - lengths - 1
        ends = starts + lengths
        low = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
        inside = np.ones(len(low), bool)
        inside[ends] = False
        low[inside] = words
    for size in range(1, longest + 1):
        rows, found = [], []
        for shift in range(size):  # runs that do not overlap
            at = np.arange(shift, len(starts) - size + 1, size)
            at = at[row[at] == row[at + size - 1]]
            coded = word_array(low, starts[at], ends[at + size - 1]).dictionary_encode()
            number = np.fromiter((zlib.crc32(w) % buckets for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
            rows.append(row[at])
            found.append(number[coded.indices.to_numpy()])
        yield np.concatenate(rows), np.concatenate(found)


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts lie in every bucket (one row a bucket reaches the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                for _, found in feature_buckets(batch.column(0).slice(a, b - a), longest, buckets):
                    counts += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at])], names=["bucket", "n"])

    partial = texts.select(texts[text].cast("string").alias("text")).mapInArrow(frugal(run), "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for r in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The scaled log ratio of every bucket's smoothed share in the target to that in the source, floored."""
    all_s, all_t, size = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(scale * math.log((t + 1.0) * (all_s + size) / ((s + 1.0) * (all_t + size))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(key: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """Scaled Gumbel noise of a key, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = LONGEST,
           seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """(file, row, doc_id, n_words, n_features, weight, score) of every document, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(3)):
                part = batch.slice(a, b - a)
                words = features = weight = np.zeros(part.num_rows, np.int64)
                for k, (row, found) in enumerate(feature_buckets(part.column(3), longest, len(gains))):
                    count = np.bincount(row, minlength=part.num_rows)
                    words = words if k else count
                    total = np.concatenate([[0], np.cumsum(gains[found[np.argsort(row, kind="stable")]])])
                    upto = np.concatenate([[0], np.cumsum(count)])
                    features, weight = features + count, weight + total[upto[1:]] - total[upto[:-1]]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(words), pa.array(features), pa.array(weight)],
                                                 names=["file", "row", "doc_id", "n_words", "n_features", "weight"])

    rows = row_keyed(docs).select("file", "row", F.col(f"doc.`{key}`").cast("long").alias("doc_id"), F.col(f"doc.`{text}`").cast("string").alias("text"))
    weighed = rows.mapInArrow(frugal(run), "file string, row long, doc_id long, n_words long, n_features long, weight long")
    return written(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed, scale)), "scores")


def least_reaching(rows: DataFrame, value: Column, wanted: int, low: int, high: int) -> int:
    """The least number in low..high that at least ``wanted`` values do not exceed; counted at a few thresholds a job."""
    while low < high:
        width = high - low
        marks = sorted({low + width * i // (POINTS + 1) for i in range(1, POINTS + 1)} | {low})
        counts = rows.agg(*[F.count_if(value <= F.lit(m)).alias(f"n{i}") for i, m in enumerate(marks)]).first()
        enough = [m for i, m in enumerate(marks) if counts[i] >= wanted]
        short = [m for i, m in enumerate(marks) if counts[i] < wanted]
        low, high = (short[-1] + 1 if short else low), (enough[0] if enough else high)
    return low


def cutoff(eligible: DataFrame, wanted: int) -> Column:
    """The condition on (score, doc_id) that the ``wanted`` first rows meet, and besides them only rows that tie with the last in both."""
    ends = eligible.agg(F.min("score"), F.max("score")).first()
    score = -least_reaching(eligible, -F.col("score"), wanted, -ends[1], -ends[0])
    tied = eligible.where(F.col("score") == score)
    above, ids, low, high = (eligible.where(F.col("score") > score).count(), *tied.agg(F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first())
    named = wanted - above
    within = F.lit(True) if named > ids else F.col("doc_id") <= least_reaching(tied, F.col("doc_id"), named, low, high)
    return (F.col("score") > score) | ((F.col("score") == score) & F.coalesce(within, F.lit(False)))


def ranked(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with the rank of the rows that are drawn: ``percent`` of those with enough words, the highest scores."""
    eligible = scores.where(F.col("n_words") >= least_words)
    wanted = percent * eligible.count() // 100
    if not wanted:
        return scores.withColumn("rank", F.lit(None).cast("long"))
    chosen = cutoff(eligible, wanted) & (F.col("n_words") >= least_words)
    ordered = scores.where(chosen).withColumns({"below": -F.col("score"), "unnamed": F.col("doc_id").isNull()})
    ranks = dense_key(ordered, ["below", "unnamed", "doc_id", "file", "row"], "rank").drop("below", "unnamed")
    ranks = ranks.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return ranks.unionByName(scores.where(~chosen).withColumn("rank", F.lit(None).cast("long")))


def importance(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST,
               buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """scored() rows of every document with their rank, resampled towards the words of ``target``.
    """
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    return ranked(scored(docs, gains, key, text, longest, seed, SCALE), percent, least_words)


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """(doc, rank): the drawn documents with all their columns."""
    docs = written(docs, "rows")
    ranks = importance(docs, target, **options).where("rank is not null").select("file", "row", "rank")
    return row_keyed(docs).join(ranks, ["file", "row"]).select("doc", "rank")
