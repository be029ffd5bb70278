"""The corpus pipeline against the plain implementations, stage after stage."""

from __future__ import annotations

import base64
import hashlib

import public_tokenizers
import pyarrow.parquet as pq
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from vireo.llm import toxicity
from vireo.llm.common import table


def test_whole_pipeline(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    model = toxicity.fit(docs, table(spark, SF_SMALL, "labels"))
    calm = {r.doc_id for r in toxicity.score(docs, model).where("score < 0.3").collect()}
    kept = [(r["doc_id"], r["text"]) for r in rows if r["doc_id"] in calm]
    assert 0 < len(kept) < len(rows)
    calm_docs = docs.where(F.col("doc_id").isin(calm))  # the line stage has a test of its own; from here on its texts count
    cleaned = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, calm_docs, SF_SMALL).collect()}
    assert sum(len(brute.lowered(t)) for _, t in kept) > sum(len(brute.lowered(t)) for t in cleaned.values()) > 0
    kept = [(k, cleaned[k]) for k, _ in kept]
    kept = [(k, t) for (k, t), (_, _, group) in zip(kept, brute.simhash_rows(kept), strict=True) if k == group]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    dirty = {r[0] for r in brute.contamination_rows(kept, items) if r[5]}
    kept = [(k, t) for k, t in kept if k not in dirty]
    assert dirty
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = set()
    for key, text in kept:
        ids = library.encode_ordinary(text or "")
        expected.add((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect()} == expected


def test_stages_keep_columns_and_stand_odd_rows(spark):
    rows = [(1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "one two three four five six", None, "s", 27), (3, "one two three four five six", None, "s", 27),
            (4, "ONE two three four five six!", "en", None, 28), (None, "seven eight nine ten eleven twelve", "en", "s", 34), (5, "word " * 30_000, "en", "s", 150_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(0) for c in ("gone", "fp", "row_key")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, SF_SMALL)
            assert out.columns == docs.columns, name
            assert out.count() <= frame.count()
    lines = {(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.line_stage(spark, docs, SF_SMALL).collect()}
    assert (4, "", 0) in lines and (3, "one two three four five six", 27) in lines
    assert corpus_pipeline.near_duplicate_stage(spark, docs, SF_SMALL).where("doc_id = 1").count() == 1
    assert corpus_pipeline.near_duplicate_stage(spark, docs, SF_SMALL).where("doc_id = 2").count() == 0
    assert corpus_pipeline.token_stage(spark, docs, SF_SMALL).count() == len(rows)


def test_stages_know_rows_by_their_place(spark):
    """Ids that are null or repeat: a contaminated row goes alone, and one copy of every text stays."""
    passage = pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()[0]["text"]
    clean = "nothing that any benchmark holds " * 5
    rows = [(None, passage), (None, clean), (4, clean + "at all"), (4, passage), (4, passage)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.text for r in corpus_pipeline.benchmark_stage(spark, docs, SF_SMALL).collect()) == [clean, clean + "at all"]
    left = corpus_pipeline.near_duplicate_stage(spark, docs, SF_SMALL)
    assert {r.text for r in left.collect()} >= {passage} and left.where(F.col("text") == passage).count() == 1


def test_names_and_sql():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None
