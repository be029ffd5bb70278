"""Connected components of a link table, by alternating large-star and small-star rounds.

Links are first contracted to forests within runs of bounded size, which
shortens chains; then rounds go on until nothing changes. A round is two
aggregates and two joins on the node; no neighbour list is ever gathered, so a
hub with a third of all links is only a skewed join, which adaptive execution
splits. Rounds are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import frugal, written

RUN_ROWS = 500_000


def union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the classes of a[i] and b[i]; labels hold the least index of each class."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        low, high = np.minimum(la[apart], lb[apart]), np.maximum(la[apart], lb[apart])
        np.minimum.at(labels, high, low)
        while not np.array_equal(jumped := labels[labels], labels):
            labels = jumped


def _forest(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Stars around the least node of every component of the links of one batch."""
    ends = pa.concat_arrays([batch.column(0), batch.column(1)]).dictionary_encode()
    order = pc.sort_indices(ends.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    codes = rank[ends.indices.to_numpy()]
    labels = union(np.arange(len(order)), codes[:len(batch)], codes[len(batch):])
    child = np.flatnonzero(labels != np.arange(len(labels)))
    nodes = ends.dictionary.take(order)
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(child)), nodes.take(pa.array(labels[child]))], names=["a", "b"])


def contracted(links: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """The links as forests of about ``run_rows`` links each, with the same components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * run_rows:
                held = [_forest(pa.Table.from_batches(held).combine_chunks().to_batches()[0])]
                rows = held[0].num_rows
                if rows >= run_rows:  # little to contract: hand it on
                    yield held[0]
                    held, rows = [], 0
        if rows:
            yield _forest(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    runs = max(1, -(-links.count() // run_rows))
    return links.repartition(runs, "a").mapInArrow(frugal(run), links.schema)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """(node, root) for every node with a link; the root is the least node of its component.

    ``links`` has columns a and b of one orderable type; self links and nulls
    are ignored, order and repetition do not matter. No links: no rows.
    """
    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    found = written(links.select("a", "b").where("a <> b"), "links")
    edges = written(contracted(found, run_rows).distinct(), "components")
    before = state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "components")
        now = state(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
