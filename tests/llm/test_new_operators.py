"""External shuffle, fill-in-the-middle and importance resampling against plain implementations, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from vireo.llm import external_shuffle, fill_in_middle, importance, queries
from vireo.session import scratch_path

ODD = [(1, "x", "é漢🤦🏼‍♂️ text", 0), (2, None, None, 0), (3, "x", "", 0), (4, "y", "one two " * 40_000, 0), (5, "x", "has <S> in it", 0), (5, "x", "has <S> in it", 0),
       (None, "z", "nobody's text", 0), (None, "z", "nobody's text", 0), (-7, "z", "a\nb\tc  d", 0), *[(100 + i, "hot", "the same words again", 0) for i in range(40)]]
SCHEMA = "doc_id long, source string, text string, {} int"


def table(name, *columns):
    return [tuple(r[c] for c in columns) for r in pq.read_table(f"{SF_SMALL}/{name}.parquet").to_pylist()]


def shards(spark, docs, **options):
    path = scratch_path(spark, "test-shards")
    external_shuffle.write(docs, path, **options)
    return external_shuffle.read(spark, path, docs.schema), path


# --- external shuffle -----------------------------------------------------------------------------

def laws(rows, n, count):
    """rows: (shard, slot)."""
    by_shard = Counter(s for s, _ in rows)
    assert sum(by_shard.values()) == n and set(by_shard) <= set(range(count))
    sizes = [by_shard.get(s, 0) for s in range(count)]
    assert max(sizes) - min(sizes) <= 1
    assert sorted(rows) == [(s, i) for s in range(count) for i in range(sizes[s])]


def test_op11_rows_law_sizes_and_round_trip(spark):
    docs = table("documents", "doc_id", "text")
    got = queries.QUERIES["op11_external_shuffle"](spark, SF_SMALL)
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    got = got.collect()
    laws([(r.shard, r.slot) for r in got], len(docs), 16)
    expected = sorted((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in docs)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == expected
    assert all(r.law == "rows" and r.grown_shard is None for r in got)


def test_shuffle_is_uniform_and_follows_the_seed(spark):
    """Every part of the input reaches every shard, neighbours part, and a seed gives one order."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    path = scratch_path(spark, "plain")
    docs.coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    orders = []
    for seed in (1, 1, 2):
        rows = shards(spark, stored, shards=8, seed=seed, bucket_bytes=4096)[0].select("doc.doc_id", "shard", "slot").collect()
        laws([(r.shard, r.slot) for r in rows], 4000, 8)
        orders.append([r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))])
    assert orders[0] == orders[1] != orders[2]
    cells = Counter((i // 500, k // 500) for i, k in enumerate(orders[0]))
    chi2 = sum((cells[a, b] - 62.5) ** 2 / 62.5 for a in range(8) for b in range(8))
    assert chi2 < 95  # 49 degrees of freedom: one in ten thousand lies above
    assert sum(abs(a - b) == 1 for a, b in zip(orders[0], orders[0][1:], strict=False)) < 30


def test_shuffle_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA.format("shard"))  # a column named like one of the results
    got, _ = shards(spark, docs, shards=4)
    rows = got.collect()
    laws([(r.shard, r.slot) for r in rows], len(ODD), 4)
    assert Counter((r.doc.doc_id, r.doc.source, r.doc.text, r.doc.shard) for r in rows) == Counter(ODD)
    few = shards(spark, docs.limit(3), shards=16)[0].collect()
    laws([(r.shard, r.slot) for r in few], 3, 16)
    assert shards(spark, docs.limit(0))[0].count() == 0


def test_equal_rows_do_not_share_a_bucket(spark):
    """A table of one repeated row is cut into buckets like any other."""
    docs = spark.createDataFrame([(None, None)], "doc_id long, text string").crossJoin(spark.range(2000)).drop("id")
    got, path = shards(spark, docs, shards=3, bucket_bytes=64)
    laws([(r.shard, r.slot) for r in got.collect()], 2000, 3)
    index = spark.read.parquet(f"{path}/index").collect()
    assert sum(r.n for r in index) == 2000 and len(index) >= 8 and max(r.n for r in index) < 2000 / 4
    at = 0
    for r in sorted(index, key=lambda r: r.bucket):
        assert r["first"] == at
        at += r.n


def test_index_sums_over_blocks(spark):
    rows = spark.range(9000).select((F.col("id") * F.col("id") % 2500).alias("bucket"))
    got = {r.bucket: (r.n, r["first"]) for r in external_shuffle.bucket_index(rows).collect()}
    counts, at = Counter(i * i % 2500 for i in range(9000)), 0
    for bucket in sorted(counts):
        assert got[bucket] == (counts[bucket], at)
        at += counts[bucket]


def test_shuffle_plan_is_native_and_moves_texts_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path, seen = scratch_path(spark, "plan"), []
    writer = type(docs.write)
    old = writer.parquet

    def parquet(self, *args, **kwargs):
        seen.append(self._df._jdf.queryExecution().executedPlan().toString())
        return old(self, *args, **kwargs)
    writer.parquet = parquet
    try:
        external_shuffle.write(docs, path)
    finally:
        writer.parquet = old
    plan = seen[-1]
    assert "Python" not in plan and "Arrow" not in plan
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning(bucket" in x]
    assert len([x for x in exchanges if "REPARTITION_BY_NUM" in x]) == 1 and len(exchanges) <= 2


# --- fill in the middle ---------------------------------------------------------------------------

def fim_row(key, text, seed=1, plain_from=90, spm_below=20):
    text = text or ""
    x = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted(v % (n + 1) for v in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plain_from:
        return key, n, "plain", None, None, text
    if h[3] % 100 < spm_below:
        return key, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return key, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_op12_matches_plain_slicing_and_sql(spark):
    from tests.oracle_compare import duck, rows_of_pandas
    docs = table("documents", "doc_id", "text")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [(*r[:5], sha(r[5]), sha(t or "")) for r, t in ((fim_row(k, t), t) for k, t in docs)]
    got = queries.QUERIES["op12_fill_in_middle"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert rows_of_pandas(got.toPandas()) == rows_of_pandas(duck(SF_SMALL).execute(queries.ORACLE_SQL["op12_fill_in_middle"]).df())
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("size", [7, 1000, fill_in_middle.SLICE_BYTES])
def test_fill_in_middle_of_odd_rows(spark, size):
    """Also where a text is longer than a slice: its segments give the same pieces."""
    extra = [(1000 + i, "s", "äöü漢字🤦🏼‍♂️ <P " * (i + 1), 0) for i in range(60)]
    rows = ODD + extra if size > 7 else [r for r in ODD + extra if len(r[2] or "") < 5000]
    docs = spark.createDataFrame(rows, SCHEMA.format("output"))
    got = fill_in_middle.fill_in_middle(docs, size=size).withColumn("back", fill_in_middle.restored(F.col("form"), F.col("output")))
    expected = Counter((*fim_row(k, t), t or "") for k, _, t, _ in rows)
    assert Counter(map(tuple, got.collect())) == expected
    assert fill_in_middle.fill_in_middle(docs.limit(0)).collect() == []


def test_pieces_that_look_like_marks(spark):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("<PSM> ") for _ in range(rng.randrange(1, 12)))) for i in range(600)]
    got = fill_in_middle.fill_in_middle(spark.createDataFrame(texts, "doc_id long, text string"))
    rows = got.withColumn("back", fill_in_middle.restored(F.col("form"), F.col("output"))).collect()
    assert {r.doc_id: r.back for r in rows} == dict(texts)
    assert sorted((r.doc_id, r.output) for r in rows) == sorted((k, fim_row(k, t)[5]) for k, t in texts)


# --- importance resampling ------------------------------------------------------------------------

def importance_rows(docs, target, longest=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    def features(text):
        words = brute.ALNUM.findall(brute.lowered(text))
        return len(words), [zlib.crc32(b" ".join(words[i:i + n])) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    made = [features(t) for _, t in docs]
    s, t = Counter(b for _, f in made for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for (key, _), (n, f) in zip(docs, made, strict=True):
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(order[:percent * len(order) // 100]):
        r[5] = i + 1
    return [(r[0], *r[2:]) for r in out]


def test_op13_matches_brute_force_and_sql(spark):
    from tests.oracle_compare import duck, rows_of_pandas
    got = queries.QUERIES["op13_importance_resampling"](spark, SF_SMALL)
    expected = importance_rows(table("documents", "doc_id", "text"), [t for t, in table("benchmark", "text")])
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(expected) and any(r[4] for r in expected)
    assert rows_of_pandas(got.toPandas()) == rows_of_pandas(duck(SF_SMALL).execute(queries.ORACLE_SQL["op13_importance_resampling"]).df())


@pytest.mark.parametrize("longest, percent, least", [(1, 50, 0), (3, 30, 2), (2, 100, 1), (1, 0, 0)])
def test_importance_of_odd_rows(spark, longest, percent, least):
    docs = spark.createDataFrame(ODD, SCHEMA.format("score"))
    target = ["words again", None, "", "Text IN it 漢"]
    got = importance.importance(docs, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=500, percent=percent, least_words=least)
    expected = importance_rows([(k, t) for k, _, t, _ in ODD], target, longest, 500, percent, least)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()) == Counter(expected)
    empty = importance.importance(docs.limit(0), docs.limit(0), percent=percent, least_words=least)
    assert empty.collect() == []


def test_resample_gives_whole_documents(spark):
    docs = spark.createDataFrame(ODD, SCHEMA.format("rank"))
    target = spark.createDataFrame([("the same words",)], "text string")
    got = importance.resample(docs, target, percent=40, least_words=1).collect()
    expected = [r for r in importance_rows([(k, t) for k, _, t, _ in ODD], ["the same words"], percent=40, least_words=1) if r[4]]
    assert sorted((r["rank"], r.doc.doc_id) for r in got) == sorted((r[4], r[0]) for r in expected)
    assert not Counter(tuple(r.doc) for r in got) - Counter(ODD)


def test_cutoff_by_counting_with_ties(spark):
    """Any number of rows of a table full of ties, against sorting it."""
    rng = random.Random(8)
    rows = [(rng.choice([-9_000_000_000, -3, 0, 0, 0, 4, 7_000_000_000]), rng.choice([None, -(1 << 63), 5, 5, (1 << 63) - 1, 9])) for _ in range(60)]
    scores = spark.createDataFrame([("f", i, k, 1, 1, 0, s) for i, (s, k) in enumerate(rows)],
                                   "file string, row long, doc_id long, n_words long, n_features long, weight long, score long").cache()
    order = sorted(range(60), key=lambda i: (-rows[i][0], rows[i][1] is None, rows[i][1] or 0, i))
    for percent in (2, 50, 85, 100):
        wanted = percent * 60 // 100
        got = {r.row: r["rank"] for r in importance.ranked(scores, percent, 1).collect()}
        assert len(got) == 60 and {k: v for k, v in got.items() if v} == {i: p + 1 for p, i in enumerate(order[:wanted])}
    scores.unpersist()
