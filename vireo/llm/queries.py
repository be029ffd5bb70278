"""The registered queries of the subpackage, over whole driver tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm import (compression, duckdb_bpe, external_shuffle, fill_in_middle, fuzzy_lines, importance, phrase_index, ppm, simhash, site_style,
                       token_files, toxicity, url_rules)
from vireo.llm.common import crc_fold, table
from vireo.session import checkpoint_dir, scratch_path

#: (host, path, verdict) of the listed URLs.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op1_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.main_texts(table(spark, sf_dir, "pages"))


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.ppm_scores(table(spark, sf_dir, "documents"))


def op3_blocked_bloom_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules, keep=("page_id",))


def op4_zstd_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    path = scratch_path(spark, "token-files")
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
        token_files.write(table(spark, sf_dir, "documents"), path, f.read())
    return token_files.read(spark, path)


def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_bands(table(spark, sf_dir, "documents"))


def op6_duckdb_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return duckdb_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents"), counts=True).select("doc_id", "n_lines", "n_removed", "text")


def op9_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_vantage_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    path, docs = scratch_path(spark, "shards"), table(spark, sf_dir, "documents")
    external_shuffle.write(docs, path)
    text = F.col("doc.text")
    return external_shuffle.read(spark, path, docs.schema).select(
        "doc.doc_id", external_shuffle.text_size(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(external_shuffle.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("form"), F.col("output"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_site_style_tree": op1_site_style_tree,
    "op2_ppm_scores": op2_ppm_scores,
    "op3_blocked_bloom_urls": op3_blocked_bloom_urls,
    "op4_zstd_token_files": op4_zstd_token_files,
    "op5_compression_bands": op5_compression_bands,
    "op6_duckdb_bpe": op6_duckdb_bpe,
    "op7_kneser_ney_toxicity": op7_kneser_ney_toxicity,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_phrase_index": op9_phrase_index,
    "op10_vantage_simhash": op10_vantage_simhash,
    "op11_external_shuffle": op11_external_shuffle,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE_SQL: dict[str, str] = {
    "op3_blocked_bloom_urls": r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT p.page_id, p.host, p.path,
       (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
        WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)) AS rule,
       coalesce((SELECT max_by(rule_verdict, length(rule_host || rule_path)) FROM rules
        WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)), 'allow') AS verdict
FROM parts p""",
    "op9_phrase_index": r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, w[s:s + least(13, len(w)) - 1] AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT row_no, s, size, w[s:s + size - 1] AS words
  FROM (SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
m AS (SELECT dw.row_no, dw.s, dw.size, iw.item_id FROM dw JOIN iw ON iw.size = dw.size AND iw.words = dw.words),
hit AS (SELECT row_no, count(DISTINCT place) AS n_hit FROM (SELECT row_no, unnest(range(s, s + size)) AS place FROM m) GROUP BY row_no),
named AS (SELECT row_no, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT row_no, item_id FROM m) GROUP BY row_no)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit h USING (row_no) LEFT JOIN named n USING (row_no)""",
    "op12_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, t, n, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (n + 1) AS u, CAST('0x' || substr(x, 9, 8) AS BIGINT) % (n + 1) AS v,
         CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
c AS (
  SELECT doc_id, t, n, least(u, v) AS a, greatest(u, v) AS b,
         CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT doc_id, t, n, a, b, form, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""",
    "op13_importance_resampling": r"""
WITH crc AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i::BIGINT, range(0, 8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
dw AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
d AS (SELECT row_no, unnest(w) AS word FROM dw),
b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
words AS (SELECT DISTINCT word, hex(encode(word)) AS x FROM (SELECT word FROM d UNION ALL SELECT word FROM b)),
filed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
         lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1]))) % 10000 AS bucket
  FROM words, crc),
s AS (SELECT bucket, count(*) AS n FROM d JOIN filed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN filed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0) + 10000)::DOUBLE
         / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)),
weights AS (SELECT row_no, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM d JOIN filed USING (word) JOIN gains USING (bucket) GROUP BY row_no),
scores AS (
  SELECT row_no, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
         / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM dw LEFT JOIN weights USING (row_no)),
places AS (SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS all_rows FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * all_rows // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (row_no)""",
}
