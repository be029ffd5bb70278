"""Toxicity by class-conditional Kneser-Ney models of spelling.

Words are spelled as bytes, padded at their start and closed by an end mark,
and each class has interpolated Kneser-Ney n-gram counts over them. The order
``ORDER`` is a class's own; what it leaves to rarer expressions backs off to
lower orders whose Kneser-Ney continuation counts both classes share, so an
expression that neither class knows well says nothing. A toxic document is ordinary language with a share
``MIX`` of toxic expressions, so its likelihood takes each word from the
mixture of both models. A document's evidence is the difference of its toxic
and ordinary log-likelihoods over its number of words, mapped to 0..1 by a
logistic curve fitted on documents the counts have not seen.

The models are fitted on a bounded sample of labelled documents: at most
``MAX_DOCS`` per class, those with the least hash of their id, and at most
``MAX_CHARS`` characters per class. Word counts of the sample come from a
Spark aggregate; the fit itself is small. Scoring covers all documents whole.

Defined results: null and empty texts have no words and get the score of no
evidence. A document labelled more than once counts as toxic if one label says
so; null labels are ignored. Without labels of both classes every score is 0.
Equal texts get equal scores. Only key, text and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import LETTER_DIGIT, LOWER, bounded_sample, frugal, row_sums, slices, text_bytes, word_array, word_spans

MAX_DOCS = 4000
MAX_CHARS = 8_000_000
#: No text above this part of MAX_CHARS is in the sample.
DOCS_AT_LEAST = 8
ORDER = 6
DISCOUNT = 0.75
MIX = 0.005
THRESHOLD = 0.3


def spelled(words: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of every word as big-endian numbers, and the first n-gram of each word (and the end)."""
    buf, offs = text_bytes(words)
    sizes = np.diff(offs)
    firsts = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes + 1)])  # one n-gram a byte, one for the end
    padded = np.zeros(int((sizes + order).sum()), np.uint64)
    starts = np.cumsum(sizes + order) - sizes - 1  # n - 1 zeros before each word, one after
    padded[np.arange(len(buf)) + np.repeat(starts - offs[:-1], sizes)] = buf
    at = np.arange(firsts[-1]) + np.repeat(starts - firsts[:-1], sizes + 1)
    grams = np.zeros(len(at), np.uint64)
    for k in range(order - 1, -1, -1):
        grams = (grams << np.uint64(8)) | padded[at - k]
    return grams, firsts


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    uniq, inverse = np.unique(keys, return_inverse=True)
    return uniq, np.bincount(inverse, weights=values, minlength=len(uniq))


def _at(keys: np.ndarray, among: np.ndarray, values: np.ndarray, missing: float = 0.0) -> np.ndarray:
    """values[k] where among[k] is the key, else ``missing``; ``among`` is sorted."""
    if not len(among):
        return np.full(len(keys), missing)
    place = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return np.where(among[place] == keys, values[place], missing)


def shared_backoff(grams: np.ndarray, order: int, discount: float = DISCOUNT) -> np.ndarray:
    """Kneser-Ney probability of the last byte of each of the distinct n-grams given shorter contexts.

    At every lower order an n-gram counts once for each byte seen before it.
    """
    if order == 1:
        return np.full(len(grams), 1 / 256)
    short = grams & np.uint64((1 << 8 * (order - 1)) - 1)
    seen, count = _sums(short, np.ones(len(short)))
    lower = shared_backoff(seen, order - 1, discount)
    contexts, total = _sums(seen >> np.uint64(8), count)
    _, kinds = _sums(seen >> np.uint64(8), np.ones(len(seen)))
    of = np.searchsorted(contexts, seen >> np.uint64(8))
    prob = np.maximum(count - discount, 0) / total[of] + discount * kinds[of] / total[of] * lower
    return prob[np.searchsorted(seen, short)]


@dataclass
class Model:
    """Log-likelihood ratios of n-grams known to a class and of contexts in front of other bytes, and the curve."""

    order: int = ORDER
    mix: float = MIX
    grams: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    gram_ratio: np.ndarray = field(default_factory=lambda: np.empty(0))
    contexts: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    context_ratio: np.ndarray = field(default_factory=lambda: np.empty(0))
    offset: float = -np.inf
    slope: float = 0.0

    def word_ratios(self, words: pa.Array) -> np.ndarray:
        """log of the word's probability in a toxic document over that in an ordinary one."""
        grams, firsts = spelled(words, self.order)
        known = _at(grams, self.grams, self.gram_ratio, np.nan)
        other = _at(grams >> np.uint64(8), self.contexts, self.context_ratio)
        ratio = row_sums(np.where(np.isnan(known), other, known), firsts)
        return np.logaddexp(np.log1p(-self.mix), np.log(self.mix) + ratio)

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Difference of the log-likelihoods of every text, by its number of words (none: 0)."""
        buf, offs = text_bytes(texts)
        buf = LOWER[buf]
        starts, ends, firsts = word_spans(buf, offs, LETTER_DIGIT)
        if not len(starts):
            return np.zeros(len(texts))
        coded = word_array(buf, starts, ends).dictionary_encode()
        ratios = self.word_ratios(coded.dictionary)[coded.indices.to_numpy()]
        return row_sums(ratios, firsts) / np.maximum(1, np.diff(firsts))

    def score(self, texts: pa.Array) -> np.ndarray:
        if not np.isfinite(self.offset):
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * self.evidence(texts), -500, 500)))


def fit_counts(words: pa.Array, counts: np.ndarray, order: int = ORDER, discount: float = DISCOUNT) -> Model:
    """The models of both classes from distinct words; counts[c, i] is how often class c has word i."""
    grams, firsts = spelled(words, order)
    times = np.repeat(counts, np.diff(firsts), axis=1)
    uniq, inverse = np.unique(grams, return_inverse=True)
    own = np.stack([np.bincount(inverse, weights=t, minlength=len(uniq)) for t in times])
    lower = shared_backoff(uniq, order, discount)
    contexts, of = np.unique(uniq >> np.uint64(8), return_inverse=True)
    prob, left = [], []
    for c in own:
        total = np.bincount(of, weights=c, minlength=len(contexts))
        kinds = np.bincount(of, weights=(c > 0).astype(float), minlength=len(contexts))
        rest = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        prob.append(np.where(total[of] > 0, np.maximum(c - discount, 0) / np.maximum(total[of], 1), 0) + rest[of] * lower)
        left.append(rest)
    return Model(order, MIX, uniq, np.log(prob[1]) - np.log(prob[0]), contexts, np.log(left[1]) - np.log(left[0]))


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Offset and slope of a weighted logistic regression of y on x (Newton steps)."""
    scale = float(np.std(x)) or 1.0
    design, w = np.stack([np.ones(len(x)), x / scale], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1] / scale)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, holdout: tuple[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """(key, text, toxic) of the sample, and the number of labelled training documents of each class."""
    marked = (labels.select(labels[key].cast("long").alias("key"), labels[label].cast("int").alias("toxic"))
              .where("key IS NOT NULL AND toxic IS NOT NULL")
              .where(F.crc32(F.col("key").cast("string").cast("binary")) % holdout[0] != holdout[1])
              .groupBy("key").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")))
    sizes = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for c in (0, 1):
        part = bounded_sample(marked.where(F.col("toxic") == c), "key", MAX_DOCS)
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * MAX_DOCS ids
    rows = (docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text")).where("text IS NOT NULL")
            .join(F.broadcast(chosen), "key"))
    return rows, sizes


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
        holdout: tuple[int, int] = (4, 2), order: int = ORDER) -> Model:
    """Counts from four fifths of the sample, the curve from the rest; ``holdout`` (modulus, remainder) is never read."""
    rows, sizes = training_rows(docs, labels, label, key, text, holdout)
    kept = {0: [], 1: []}
    room = Window.partitionBy("toxic").orderBy(F.xxhash64(F.col("key").cast("string")), "key", "text")
    rows = rows.where(F.length("text") <= MAX_CHARS // DOCS_AT_LEAST)  # no single text shuts out those behind it
    bounded = rows.withColumn("upto", F.sum(F.length("text")).over(room)).withColumn("rank", F.row_number().over(room))
    for r in bounded.where((F.col("rank") <= MAX_DOCS) & ((F.col("upto") <= MAX_CHARS) | (F.col("rank") == 1))).select("key", "toxic", "text").toLocalIterator():
        kept[r.toxic].append((xxhash.xxh64_intdigest(str(r.key), 1) % 5 == 0, r.text))
    if not (kept[0] and kept[1]):
        return Model(order)
    parts: dict[bool, tuple[list[str], list[int]]] = {}
    for held in (False, True):
        chosen = [(t, c) for c in (0, 1) for h, t in kept[c] if h == held]
        parts[held] = [t for t, _ in chosen], [c for _, c in chosen]
    return fit_sample(parts[False], parts[True], sizes, order)


def fit_sample(counted: tuple[list[str], list[int]], curve: tuple[list[str], list[int]], sizes: dict[int, int], order: int = ORDER) -> Model:
    """A model whose counts come from ``counted`` and whose curve comes from ``curve`` (both where one is empty)."""
    texts, classes = counted if set(counted[1]) == {0, 1} else (counted[0] + curve[0], counted[1] + curve[1])
    buf, offs = text_bytes(pa.array(texts, pa.large_string()))
    buf = LOWER[buf]
    starts, ends, firsts = word_spans(buf, offs, LETTER_DIGIT)
    coded = word_array(buf, starts, ends).dictionary_encode()
    of_class = np.repeat(np.array(classes), np.diff(firsts))
    counts = np.stack([np.bincount(coded.indices.to_numpy()[of_class == c], minlength=len(coded.dictionary)) for c in (0, 1)]).astype(float)
    model = fit_counts(coded.dictionary, counts, order)
    texts, classes = curve if set(curve[1]) == {0, 1} else (texts, classes)
    y = np.array(classes, float)
    share = np.array([sizes[c] / max(1, classes.count(c)) for c in (0, 1)])
    weight = share[y.astype(int)] / share[y.astype(int)].mean()  # classes as frequent as among all labels
    model.offset, model.slope = fit_curve(model.evidence(pa.array(texts, pa.large_string())), y, weight)
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row; the model is small by its bounded sample and goes with the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(part.column(1)), pa.float64())], names=["doc_id", "score"])

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(frugal(run), "doc_id long, score double")


def keep_ordinary(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that score below ``threshold``."""
    fields = [f"{f.name}" for f in docs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = fields.index(text)
        for batch in batches:
            for a, b in slices(batch.column(at).cast(pa.string())):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array(model.score(part.column(at).cast(pa.string())) < threshold))

    return docs.mapInArrow(frugal(run), docs.schema)
