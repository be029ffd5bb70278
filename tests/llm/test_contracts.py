"""Every registered operator query on the smallest tables against a plain implementation of its contract."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm import brute
from vireo.llm import queries


def table(name, *columns):
    return [tuple(r[c] for c in columns) for r in pq.read_table(f"{SF_SMALL}/{name}.parquet").to_pylist()]


@pytest.fixture(scope="module")
def docs():
    return table("documents", "doc_id", "text")


def rows(spark, name):
    return [tuple(r) for r in queries.QUERIES[name](spark, SF_SMALL).collect()]


def test_names_cover_all():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_op1_article_text(spark):
    import html
    import re
    expected = {}
    for page, url, source in table("pages", "page_id", "url", "html"):
        article = re.search(r"<article>(.*?)</article>", source, re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|table|tr|td|li|ul)>", article)]
        text = "\n".join(b for b in blocks if b)
        expected[page] = (page, url, text, len(text))
    assert {r[0]: r for r in rows(spark, "op1_site_style_tree")} == expected


def test_op2_base_and_model(spark, docs):
    from vireo.llm import ppm
    base, got = brute.base_rows(docs), rows(spark, "op2_ppm_scores")
    assert len(got) == len(docs)
    for key, held, n_tokens, n_known, train, base_score, score in got:
        assert (held, n_tokens, n_known, train) == base[key][:4]
        assert base_score == pytest.approx(base[key][4], rel=1e-9)
        assert score < 0
    short = [(k, (t or "")[:300]) for k, t in docs[:60]]
    small = spark.createDataFrame(short, "doc_id long, text string")
    for order in (2, 5):
        expected = brute.ppm_scores(short, order)
        for r in ppm.ppm_scores(small, order=order).collect():
            assert r.score == pytest.approx(expected[r.doc_id], rel=1e-6)


def test_op2_whole_texts(spark, docs):
    """The query's own scores, of whole texts learned from whole texts, against a plain trie."""
    expected = brute.ppm_scores(docs, ppm_order())
    for r in rows(spark, "op2_ppm_scores"):
        assert r[6] == pytest.approx(expected[r[0]], rel=1e-6)


def ppm_order():
    import inspect

    from vireo.llm import ppm
    return inspect.signature(ppm.ppm_scores).parameters["order"].default


def test_op3_matches_sql(spark):
    from tests.oracle_compare import duck, rows_of_pandas
    got = queries.QUERIES["op3_blocked_bloom_urls"](spark, SF_SMALL).toPandas()
    assert rows_of_pandas(got) == rows_of_pandas(duck(SF_SMALL).execute(queries.ORACLE_SQL["op3_blocked_bloom_urls"]).df())


def test_op4_files_hold_the_librarys_ids(spark, docs):
    library, expected, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}, 0
    for key, text in sorted(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        expected[key] = (key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r[0]: r for r in rows(spark, "op4_zstd_token_files")} == expected


def test_op5_base_counts_and_bands(spark, docs):
    expected = brute.quality_rows(docs)
    got = {r[0]: r[1:] for r in rows(spark, "op5_compression_bands")}
    assert {k: v[:6] for k, v in got.items()} == expected
    assert all(not v[6] for v in got.values() if v[5])
    import zstandard

    from vireo.llm import compression as c
    packed = lambda data: len(data) / len(zstandard.ZstdCompressor(level=c.LEVEL).compress(data))
    for key, text in docs:
        data = (text or "").encode()
        cut = [data[i:i + c.CHUNK_BYTES] for i in range(0, len(data), c.CHUNK_BYTES)]
        bad = sum(not c.in_band(len(x), packed(x)) for x in cut)
        fits = not data or (c.in_band(len(data), packed(data)) and bad <= c.MAX_BAD_CHUNKS * len(cut))
        assert got[key][6:] == (not got[key][5] and fits, packed(data) if data else None, len(cut), bad)
    quality = dict(table("labels", "doc_id", "quality"))
    good = [got[k][6] for k, q in quality.items() if q == 1 and k in got and not got[k][5]]
    assert good and all(good)


def test_op6_is_tiktoken(spark, docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = set()
    for key, text in docs:
        ids = library.encode_ordinary(text or "")
        expected.add((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert set(rows(spark, "op6_duckdb_bpe")) == expected


def test_op7_held_out_accuracy(spark):
    from tests.conftest import SF_SMALL as small
    larger = small.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in queries.QUERIES["op7_kneser_ney_toxicity"](spark, larger).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{larger}/labels.parquet").to_pylist()}
    held = [(truth[k], got[k].predicted) for k in truth if brute.fold(k, 4) == 2]
    assert all(r.held_out == (brute.fold(k, 4) == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for k, r in got.items())
    right = sum(t == p for t, p in held) / len(held)
    caught = [p for t, p in held if t == 1]
    assert right >= 0.93 and sum(caught) >= 0.6 * len(caught)


def test_op7_is_plain_kneser_ney(spark, docs):
    """Evidence and score of whole texts against models of dictionaries, fitted on the rows that the operator fits on."""
    import math

    import pyarrow as pa
    import xxhash

    from vireo.llm import toxicity
    toxic: dict = {}
    for key, label in table("labels", "doc_id", "toxic"):
        if brute.fold(key, 4) != 2 and label is not None:
            toxic[key] = max(toxic.get(key, 0), int(label > 0))
    texts = {k: t for k, t in docs if t is not None}
    seen = [(texts[k], c) for k, c in toxic.items() if k in texts and xxhash.xxh64_intdigest(str(k), 1) % 5]
    assert {c for _, c in seen} == {0, 1}
    expected = brute.spelling_evidence(seen, [t or "" for _, t in docs])
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(table("labels", "doc_id", "toxic"), "doc_id long, toxic int"))
    assert model.evidence(pa.array([t or "" for _, t in docs])).tolist() == pytest.approx(expected, rel=1e-6, abs=1e-9)
    got = {r[0]: r[2] for r in rows(spark, "op7_kneser_ney_toxicity")}
    for (key, _), x in zip(docs, expected, strict=True):
        assert got[key] == pytest.approx(1 / (1 + math.exp(-(model.offset + model.slope * x))), rel=1e-5)


def test_op8_texts(spark, docs):
    """Nothing goes that edit similarity alone would keep, and almost all that it removes goes."""
    got = {r[0]: r for r in rows(spark, "op8_fuzzy_lines")}
    expected = brute.deduped_texts(docs)
    assert len(got) == len(docs)
    removed = wanted = 0
    for key, n_lines, n_removed, text in expected:
        assert got[key][1] == n_lines and got[key][2] <= n_removed
        removed, wanted = removed + got[key][2], wanted + n_removed
        if got[key][2] == n_removed:
            assert got[key][3] == text
        else:
            left = iter((got[key][3] or "").split("\n"))
            assert not text or all(x in left for x in text.split("\n"))
    assert removed >= 0.97 * wanted > 0


def test_op9_contamination(spark, docs):
    from tests.oracle_compare import duck
    got = rows(spark, "op9_phrase_index")
    assert sorted(got) == sorted(brute.contamination_rows(docs, table("benchmark", "item_id", "text")))
    assert sorted(got) == sorted(duck(SF_SMALL).execute(queries.ORACLE_SQL["op9_phrase_index"]).fetchall())
    assert any(r[5] for r in got)


def test_op10_groups(spark, docs):
    assert sorted(rows(spark, "op10_vantage_simhash")) == sorted(brute.simhash_rows(docs))
