"""Corpus pipeline: the documents table through five of the training-data operators, stage by stage.

Each stage works on all rows its predecessor kept: toxic documents go, lines
that other documents have already shown are taken out, one document of each
group of near-duplicates stays, documents that benchmark passages make up go,
and what is left becomes token ids. All stages but the last return the columns
of ``documents``; a stage that changes texts also sets n_chars.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm import duckdb_bpe, fuzzy_lines, phrase_index, simhash, toxicity
from vireo.llm.common import numbered, table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic (score below the operator's threshold)."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_ordinary(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one has shown."""
    cleaned = fuzzy_lines.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id."""
    return simhash.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    rows = numbered(docs)  # ids may repeat or be null, rows are known by their place
    found = phrase_index.contamination(rows.select("number", "doc.text"), table(spark, sf_dir, "benchmark"), key="number")
    return rows.join(found.where("contaminated").select(F.col("doc_id").alias("number")), "number", "left_anti").select("doc.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: n_tokens, ids_sha256 and decoded_sha256 of its byte-level BPE ids."""
    return duckdb_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_stage), ("near_dedup", near_duplicate_stage),
          ("decontamination", benchmark_stage), ("bpe", token_stage)]

#: Models, fingerprint groups and recursive merges per stage: no stage but the fourth can be said in SQL, so run() is tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and reread before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
