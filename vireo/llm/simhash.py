"""SimHash near-duplicates found with vantage-point trees.

A fingerprint bit is set where it is set in over half of the XXH64 hashes of a
text's word shingles. Texts within ``max_bits`` differing bits are linked, and
linked texts form a group.

Pairs are found exactly without comparing all: of two fingerprints within
``max_bits`` = 3 bits, one 32-bit half differs in at most one bit. Each half
has a vantage-point tree: an inner node holds a vantage point and a radius, a
fingerprint belongs to one leaf (its home), and by the triangle inequality the
points within ``max_bits // 2`` of it can only lie in leaves whose side of
every boundary that ball touches; it is sent there as a visitor. A leaf is a
Spark group: its members are sorted by half and probed with every half within
the search radius, pairs are proven on all 64 bits, and only a spanning forest
leaves the task, so a dense group costs rows in proportion to its size. The
tree itself is fitted to a bounded sample (``SAMPLE`` fingerprints); every
fingerprint is indexed.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; fewer words than a shingle make one shingle. Equal
fingerprints are one point. Rows of one doc_id are one node each but share its
id. A null doc_id never names a component that has another id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.llm.common import LOWER, bounded_sample, frugal, numbered, slices, text_bytes, written
from vireo.llm.components import components, union

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SAMPLE = 65536
LEAF_ROWS = 32768
PAIR_CHUNK = 1 << 20


#: A byte's bits as eight counters of eight bits in one number.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def majority_bits(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Per row, the 64-bit word of the bits set in over half of its hashes (no hashes: zero)."""
    counts = np.diff(firsts)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        # the counters hold 255 hashes: rows are summed in runs of at most that many, then the runs
        runs = -(-counts[full] // 255)
        first_run = np.cumsum(runs) - runs
        starts = np.repeat(firsts[:-1][full], runs) + 255 * (np.arange(runs.sum()) - np.repeat(first_run, runs))
        packed = np.add.reduceat(SPREAD[hashes.view(np.uint8).reshape(-1, 8)], starts, axis=0)
        ones = np.add.reduceat(packed.view(np.uint8).reshape(len(starts), 64), first_run, axis=0, dtype=np.int32)
        major = np.packbits(ones * 2 > counts[full, None], axis=1, bitorder="little")
        out[full] = np.ascontiguousarray(major).view(np.uint64).ravel()
    return out


#: Hashes of a row up to which rows are counted side by side.
SIDE_BY_SIDE = 255


def majorities(hashes_at: Callable[[np.ndarray], np.ndarray], firsts: np.ndarray, words: int) -> np.ndarray:
    """majority_bits() for ``words`` sets of hashes at once, as columns; ``hashes_at`` gives them, a row a set, for some places.

    The counters of all 64 bits of all rows are kept as planes of bits: a hash
    is added to its row by carries from plane to plane.
    """
    counts = np.diff(firsts)
    out = np.zeros((words, len(counts)), np.uint64)
    order = np.argsort(-counts, kind="stable")
    order = order[np.searchsorted(-counts[order], -SIDE_BY_SIDE):]
    begin, size = firsts[:-1][order], counts[order]
    planes = np.zeros((int(size.max(initial=0)).bit_length(), words, len(order)), np.uint64)
    for k in range(int(size.max(initial=0))):
        n = int(np.searchsorted(-size, -k))
        carry = hashes_at(begin[:n] + k)
        for plane in planes[:(k + 1).bit_length(), :, :n]:
            kept = plane & carry
            plane ^= carry
            carry = kept
    more, same = np.zeros((words, len(order)), np.uint64), np.full((words, len(order)), ~np.uint64(0))
    for k in range(len(planes) - 1, -1, -1):
        half = np.where(size // 2 >> k & 1, ~np.uint64(0), np.uint64(0))
        more |= same & planes[k] & ~half
        same &= ~(planes[k] ^ half)
    out[:, order] = more
    long = np.flatnonzero(counts > SIDE_BY_SIDE)
    for row in long.tolist():
        for word, hashes in enumerate(hashes_at(np.arange(firsts[row], firsts[row + 1]))):
            out[word, row] = majority_bits(np.ascontiguousarray(hashes), np.array([0, len(hashes)]))[0]
    return np.ascontiguousarray(out.T)


def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of every text (null: empty) over its lower-cased word shingles, repeats included."""
    buf, offs = text_bytes(texts)
    raw = LOWER[buf].tobytes()
    digest, hashes, firsts = xxhash.xxh64_intdigest, [], [0]
    for i in range(len(texts)):
        words = raw[offs[i]:offs[i + 1]].split()
        joined = b" ".join(words)
        if len(words) > shingle:
            ends = np.cumsum([len(w) + 1 for w in words])
            begins = [0, *ends[:-shingle].tolist()]
            hashes += [digest(joined[s:e], SEED) for s, e in zip(begins, (ends[shingle - 1:] - 1).tolist(), strict=True)]
        elif words:
            hashes.append(digest(joined, SEED))
        firsts.append(len(hashes))
    return majority_bits(np.array(hashes, np.uint64), np.array(firsts))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit number."""
    return prints(docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")), shingle)


def prints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of rows (doc_id, text); the key may be of any type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints_of(part.column(1), shingle).view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(frugal(run), T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())]))


class VantageTree:
    """A vantage-point tree over 32-bit halves: inner nodes 1.. in heap order, leaves below."""

    def __init__(self, sample: np.ndarray, depth: int, radius: int, seed: int = 7):
        self.depth, self.radius = depth, radius
        self.points = np.zeros(1 << depth, np.uint32)
        self.cuts = np.zeros(1 << depth, np.int64)
        rng = np.random.default_rng(seed)
        held = {1: sample}
        for node in range(1, 1 << depth):
            part = held.pop(node)
            best = None
            for vp in rng.choice(part, 8) if len(part) else [np.uint32(0)]:
                d = np.bitwise_count(part ^ vp).astype(np.int64)
                cut = int(np.median(d)) if len(d) else 16
                lost = np.mean(np.abs(d - cut - 0.5) <= radius) if len(d) else 0.0  # share that visits both sides
                best = min(best or (2.0, 0, 0), (lost, int(vp), cut))
            _, self.points[node], self.cuts[node] = best
            near = np.bitwise_count(part ^ self.points[node]) <= self.cuts[node]
            held[2 * node], held[2 * node + 1] = part[near], part[~near]

    def visits(self, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, home) for every leaf that a ball around a half touches."""
        row, node, home = np.arange(len(halves)), np.ones(len(halves), np.int64), np.ones(len(halves), bool)
        for _ in range(self.depth):
            d = np.bitwise_count(halves[row] ^ self.points[node]).astype(np.int64)
            inner, outer = d - self.radius <= self.cuts[node], d + self.radius > self.cuts[node]
            own = d <= self.cuts[node]
            row, node, home = (np.concatenate([row[inner], row[outer]]),
                               np.concatenate([2 * node[inner], 2 * node[outer] + 1]),
                               np.concatenate([(home & own)[inner], (home & ~own)[outer]]))
        return row, node - (1 << self.depth), home


def leaf_forest(fps: np.ndarray, halves: np.ndarray, home: np.ndarray, max_bits: int, radius: int) -> np.ndarray:
    """Class labels of the points of a leaf, linked within ``max_bits``; members are probed by half."""
    members = np.flatnonzero(home)
    members = members[np.argsort(halves[members], kind="stable")]
    sorted_halves = halves[members]
    labels = np.arange(len(fps))
    for k in range(radius + 1):
        for flips in combinations(range(32), k):
            target = halves ^ np.uint32(sum(1 << f for f in flips))
            low, high = np.searchsorted(sorted_halves, target, "left"), np.searchsorted(sorted_halves, target, "right")
            rows = np.flatnonzero(high > low)
            upto = np.cumsum((high - low)[rows])
            at = 0
            while at < len(rows):
                stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIR_CHUNK, "right")))
                part = rows[at:stop]
                sizes = (high - low)[part]
                left = np.repeat(part, sizes)
                right = members[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low[part], sizes)]
                close = np.bitwise_count(fps[left] ^ fps[right]) <= max_bits
                labels = union(labels, left[close], right[close])
                at = stop
    return labels


def links(points: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """A spanning set of links (a, b) between distinct fingerprints within ``max_bits`` bits.

    ``points`` holds distinct values in column fp.
    """
    radius = max_bits // 2
    sample = np.array([r.fp for r in bounded_sample(points.select("fp"), "fp", SAMPLE).collect()], np.int64).view(np.uint64)
    depth = max(0, int(np.ceil(np.log2(max(1, points.count()) / leaf_rows))))
    trees = [VantageTree((sample >> np.uint64(32 * h)).astype(np.uint32), depth, radius, seed=7 + h) for h in (0, 1)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for h, tree in enumerate(trees):
                row, leaf, home = tree.visits((fps >> np.uint64(32 * h)).astype(np.uint32))
                yield pa.RecordBatch.from_arrays([pa.array(leaf * 2 + h), pa.array(fps[row].view(np.int64)), pa.array(home)], names=["leaf", "fp", "home"])

    def forest(group: pa.Table) -> pa.Table:
        half = int(group.column("leaf")[0].as_py()) % 2
        fps = group.column("fp").to_numpy().view(np.uint64)
        home = group.column("home").to_numpy()
        halves = (fps >> np.uint64(32 * half)).astype(np.uint32)
        labels = leaf_forest(fps, halves, home, max_bits, radius)
        child = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"a": fps[child].view(np.int64), "b": fps[labels[child]].view(np.int64)})

    return (points.select("fp").mapInArrow(frugal(spread), "leaf long, fp long, home boolean")
            .groupBy("leaf").applyInArrow(forest, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the least doc_id reachable over links."""
    return with_components(written(fingerprints(docs, shingle, key, text), "fingerprints"), max_bits)


def with_components(found: DataFrame, max_bits: int) -> DataFrame:
    """Written prints() with the least doc_id of every row's component."""
    classes = written(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes, max_bits)).withColumnRenamed("node", "fp")
    named = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return found.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of every group of near-duplicates the first row (all columns): least key, null last, then place in the files.

    Every row is known by its place, so rows that share a key, or have none,
    go and stay on their own.
    """
    rows = numbered(docs)
    own = F.col(f"doc.`{key}`").cast("long")
    place = F.struct(own.isNull().alias("unnamed"), own.alias("id"), "number")
    found = with_components(written(prints(rows.select(place.alias("doc_id"), F.col(f"doc.`{text}`").cast("string").alias("text")), shingle), "fingerprints"), max_bits)
    gone = found.where("doc_id.number <> component_id.number").select("doc_id.number")
    return rows.join(gone, "number", "left_anti").select("doc.*")
