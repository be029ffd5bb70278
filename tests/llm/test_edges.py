"""Defined results for nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vireo.llm import compression, duckdb_bpe, fuzzy_lines, phrase_index, ppm, simhash, site_style, token_files, toxicity, url_rules
from vireo.llm.components import components

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = " ".join(f"word{i * 7919 % 5003}x{i}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog near the old stone bridge at dawn"
TEXTS = [(1, None), (2, ""), (3, PROSE), (3, PROSE), (4, PROSE), (5, LONG), (6, " \n\t "), (7, "é" * 900), (8, "a  b\n\n c d "), (None, PROSE + " again")]


@pytest.fixture(scope="module")
def odd(spark):
    """Columns that operators use inside clash with those of the input on purpose."""
    return spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("row_key", "fp", "k", "block", "gone", "n_lines", "component_id", "score", "shard", "page", "host", "node")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def collected(df):
    return [tuple(r) for r in df.collect()]


def in_order(values):
    return sorted(values, key=repr)


def test_compression(odd, empty):
    got = collected(compression.compression_bands(odd))
    assert in_order(r[:7] for r in got) == in_order((k, *brute.quality_rows([(k, t)])[k]) for k, t in TEXTS)
    assert collected(compression.compression_bands(empty)) == []
    assert all(r[8] is None for r in got if r[0] in (1, 2))


def test_compression_bands_reject_both_ends(spark):
    import random
    rng = random.Random(5)
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(6)) for _ in range(400))
    same = "\n".join(f"{i} line of the very same words that come again and again {i}" for i in range(300))
    prose = " ".join(rng.choice("lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor".split()) + str(rng.randrange(90)) for _ in range(900))
    hidden = prose + " " + " ".join("qwertyuiop" + "ab"[i % 2] * (1 + i % 3) for i in range(9000))
    df = spark.createDataFrame([(1, noise), (2, same), (3, prose), (4, hidden)], "doc_id long, text string")
    got = {r.doc_id: r for r in compression.compression_bands(df).collect()}
    assert got[1].ratio < got[3].ratio < got[2].ratio
    assert got[3].kept and not got[2].kept and not got[4].kept
    assert not compression.in_band(2000, 1.0) and compression.in_band(2000, 2.0) and not compression.in_band(2000, 9.0) and compression.in_band(10, 0.5)


def test_simhash(odd, empty):
    got = collected(simhash.near_duplicates(odd))
    by_key = {(k, fp): c for k, fp, c in got}
    expected = brute.simhash_rows([(k if k is not None else 99, t) for k, t in TEXTS])
    named = {(99 if k is None else k, f"{fp % (1 << 64):016x}", 99 if c is None else c) for (k, fp), c in by_key.items()}
    assert len(got) == len(TEXTS) and named == set(expected)
    assert collected(simhash.near_duplicates(empty)) == []
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert in_order(r[0] for r in kept.select("doc_id").collect()) == in_order([1, 3, 5, 7, 8, None])


def test_one_of_each_keeps_a_copy_of_every_text(spark):
    """Ids that repeat, or are missing, do not decide which rows are alike."""
    texts = {c: " ".join(f"{c}{i * i % 97}" for i in range(60)) for c in "xyz"}
    rows = [(1, "x"), (5, "x"), (5, "y"), (7, "y"), (None, "z"), (None, "z"), (7, "y")]
    docs = spark.createDataFrame([(k, texts[t], i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, number int").coalesce(1)
    kept = sorted((r.number, r.doc_id, r.text) for r in simhash.one_of_each(docs).collect())
    assert kept == [(0, 1, texts["x"]), (2, 5, texts["y"]), (4, None, texts["z"])]


def test_vantage_tree_finds_every_pair(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2)
    points = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 6)), replace=False)) for c in centres for _ in range(40)}
    points = sorted(points)
    signed = [(p - (1 << 64) if p >= 1 << 63 else p,) for p in points]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), leaf_rows=100)
    roots = {r.node: r.root for r in components(links).collect()}
    group = brute.groups(len(points), lambda i, j: (points[i] ^ points[j]).bit_count() <= 3)
    ours = [roots.get(s[0], s[0]) for s in signed]
    pairs = set(zip(group, ours, strict=True))
    assert len(pairs) == len(set(group)) == len(set(ours))


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    for run_rows in (500_000, 20):
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), run_rows).collect()}
        assert {k: v for k, v in got.items() if k < 100} == {i: 0 for i in range(1, 61)}
        assert {v for k, v in got.items() if k > 100} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lines(spark, odd, empty):
    docs = [(1, "one two three four five six seven\nshort line\n" + PROSE), (2, PROSE.upper() + "!\nshort line"), (3, PROSE.replace("lazy", "lazi")),
            (4, None), (5, ""), (6, PROSE), (7, "\n" + PROSE + "\n\n"), (8, LONG)]
    got = [tuple(r) for r in fuzzy_lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), counts=True).select("doc_id", "n_lines", "n_removed", "text").collect()]
    assert sorted(got) == sorted(brute.deduped_texts(docs))
    got = {r[0]: r[1:] for r in got}
    assert got[6] == (1, 1, "") and got[7][2] == "\n\n" and got[4] == (0, 0, None)
    cleaned = fuzzy_lines.dedup_lines(odd)
    assert cleaned.columns == odd.columns and cleaned.count() == len(TEXTS)
    texts = {r.doc_id: r.text for r in cleaned.select("doc_id", "text").collect()}
    assert texts[3] == PROSE and texts[4] == ""
    assert fuzzy_lines.dedup_lines(empty).count() == 0


def test_lines_of_rows_without_ids_of_their_own(spark):
    """Rows of one id, of none, and rows equal in everything are told apart; the first of a group keeps its line."""
    docs = [(5, PROSE + "\nalso this line of five"), (5, PROSE), (None, PROSE + "\nonly here once, in this row"), (None, "only HERE once: in this row"),
            (None, "only here once, in this row"), (3, "also this line of five!"), (3, "also this line of five!")]
    frame = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(docs)], "doc_id long, text string, number int").coalesce(1)
    got = sorted((r.number, r.doc_id, r.text) for r in fuzzy_lines.dedup_lines(frame).collect())
    assert got == [(i, k, t) for i, (k, _, _, t) in enumerate(brute.deduped_texts(docs))]
    assert [t for *_, t in got] == [PROSE, "", "only here once, in this row", "", "", "also this line of five!", ""]


def line_rows(lines):
    import pyarrow as pa
    import xxhash
    prints = fuzzy_lines.simhash(pa.array(lines), 2).view("int64").tolist()
    return [(bytearray(xxhash.xxh3_128_digest(x.encode())), x, *p) for x, p in zip(lines, prints, strict=True)]


def test_dense_groups_are_cut_in_chunks(spark):
    base = [f"token{c}{d}" for c in "abcdefgh" for d in "abcdefghij"]
    lines = sorted({" ".join(base[:k] + ["other" + "abcdef"[k % 6]] + base[k + 1:]) for k in range(0, 80)} | {" ".join(base), " ".join(base[::-1])})
    rows = line_rows(lines)
    texts = spark.createDataFrame(rows, "digest binary, line string, p0 long, p1 long")
    groups = texts.select(F.lit(9).cast("long").alias("bucket"), "p0", "p1").distinct()
    for chunk_rows in (7, 4096):
        roots = {bytes(r.node): bytes(r.root) for r in components(fuzzy_lines.line_links(texts, groups, chunk_rows=chunk_rows)).collect()}
        group = brute.groups(len(rows), lambda i, j: fuzzy_lines.similar(rows[i][1], rows[j][1]))
        pairs = set(zip(group, [roots.get(bytes(r[0]), bytes(r[0])) for r in rows], strict=True))
        assert len(pairs) == len(set(group)) == 2


def test_blocks_hold_to_the_pigeonhole_principle():
    """Two lines that differ in fewer bits than there are blocks share a key, whatever the bits."""
    import numpy as np
    rng = np.random.default_rng(4)
    size, blocks = fuzzy_lines.block_plan(3, 30_000)
    words = rng.integers(0, 1 << 63, (200, -(-size * blocks // 64)), dtype=np.uint64)
    other = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
    for row in other:
        row[rng.choice(size * blocks, blocks - 1, replace=False)] ^= 1
    other = np.packbits(other, axis=1, bitorder="little").view(np.uint64)
    a, b = (fuzzy_lines.block_keys(w, np.full(200, 3), {3: (size, blocks)}) for w in (words, other))
    met = {(int(k), int(o)) for k, o in zip(*a, strict=True)} & {(int(k), int(o)) for k, o in zip(*b, strict=True)}
    assert {o for _, o in met} == set(range(200))
    line, band = fuzzy_lines.bands_of(np.array([1, 11, 12, 24, 29, 30, 31, 47, 96, 50_000]))
    bands = [set(band[line == i].tolist()) for i in range(10)]
    assert bands == [{0}, {0}, {0}, {0, 1}, {0, 1}, {0, 1}, {1}, {1}, {2, 3}, {11, 12}]


def test_edit_distance():
    import random
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(2))
        d = brute.edit_distance(a, b)
        for most in (0, 2, 12):
            assert fuzzy_lines.edit_distance(a, b, most) == min(d, most + 1)


def test_phrases(spark, odd, empty):
    items = [("a", PROSE), ("a", PROSE), ("b", "lazy dog"), (None, "the old"), ("c", None), ("d", "..."), ("e", "word0x0 word2916x1")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated)
           for r in phrase_index.contamination(odd, benchmark).collect()]
    assert in_order(got) == in_order(brute.contamination_rows(TEXTS, [i for i in items if i[0] and i[1]]))
    assert phrase_index.contamination(empty, benchmark).count() == 0
    assert not any(r.contaminated for r in phrase_index.contamination(odd, benchmark.limit(0)).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha x x x x beta gamma"), (4, "alpha beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "alpha beta gamma")], "item_id string, text string")
    assert {r.doc_id: r.n_hit for r in phrase_index.contamination(docs, items, slack=2).collect()} == {1: 5, 2: 0, 3: 0, 4: 3}


def test_bpe(odd, empty):
    got = collected(duckdb_bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN))
    assert in_order((r[0], r[3]) for r in got) == in_order((k, hashlib.sha256((t or "").encode()).hexdigest()) for k, t in TEXTS)
    assert {r[1] for r in got if r[0] in (1, 2)} == {0}
    assert collected(duckdb_bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN)) == []
    ids = duckdb_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    texts = {r.doc_id: bytes(r.decoded).decode() for r in duckdb_bpe.decode(ids, RANKS, public_tokenizers.PATTERN).collect()}
    assert texts == {k: t or "" for k, t in TEXTS}


def test_bpe_is_tiktoken_on_odd_text():
    import random

    import tiktoken
    ranks = duckdb_bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own, rng = duckdb_bpe.Codec(ranks, public_tokenizers.PATTERN), random.Random(2)
    texts = ["", " ", "  a", "a  ", "a \n b", "don't we'll", "aaaaaaaaaaaaaaaaaaaaaaa", "<|endoftext|>", "x" * 3000, "ab" * 900, "日本語 テキスト", "🙂🙃 🙂",
             "\r\n\r\n x y", *["".join(rng.choice(" \n\t'abcdtsre.é1🙂 ") for _ in range(60)) for _ in range(200)]]
    texts += [f"{a}{s}{b}" for s in ("\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\x1c", "\u200b") for a in ("x ", "é", "") for b in (" y", "é ", "")]
    assert [s.decode() for _, s in own.encode(pa.array(texts))] == [",".join(map(str, library.encode_ordinary(t))) for t in texts]
    with pytest.raises(ValueError):
        own.decode([(10 ** 6).to_bytes(4, "little")])


def test_token_files(spark, tmp_path, odd, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path) as f:
        definition = f.read()
    library = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(9, "end <|endoftext|> of"), (10, "ﬁ ligature 日本  two\n\n x")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(extra)
    token_files.write(docs, str(tmp_path / "t"), definition)
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in token_files.read(spark, str(tmp_path / "t")).collect())
    assert [s for s, _, _ in got] == [sum(n for _, n, _ in got[:i]) for i in range(len(got))]
    assert [k for _, _, k in got] == [None, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 10]
    for key, text in (*TEXTS, (9, "end <|endoftext|> of"), (10, "ﬁ ligature 日本  two\n\n x")):
        if key is not None:
            found = token_files.document(spark, str(tmp_path / "t"), key)
            assert all(ids.tolist() == library.encode(text or "", add_special_tokens=False).ids + [0] for ids in found) and found
    token_files.write(empty, str(tmp_path / "e"), definition)
    assert token_files.read(spark, str(tmp_path / "e")).count() == 0


def test_token_encoder_is_the_library_on_odd_text():
    import random

    import numpy as np
    from tokenizers import Tokenizer
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(8)
    with open(path) as f:
        own = token_files.Encoder(f.read(), 0)
    library = Tokenizer.from_file(path)
    texts = ["", " ", " a", "a ", "a  b", "a \n b", "don't, we'll!", "é à ñ.", "ªº µ", "x<|endoftext|>y", "日本 語", "🙂 🙃", "ﬁ  ﬂ", "a\xa0b \u2003c", "1 2,3 4.",
             *["".join(rng.choice(" \n\t'abcdtsre.,;é1🙂\xa0") for _ in range(60)) for _ in range(300)]]
    got = [np.frombuffer(s, "<u2").tolist() for s in own.encode(pa.array(texts))]
    assert got == [library.encode(t, add_special_tokens=False).ids + [0] for t in texts]


def test_frames_need_their_dictionary():
    with pytest.raises(ValueError):
        list(token_files.unpack({"dictionary": "other"}, "name", b""))


def test_ppm(odd, empty):
    got = collected(ppm.ppm_scores(odd))
    assert len(got) == len(TEXTS)
    same = {r for r in got if r[0] in (3, 4)}
    assert len({r[6] for r in same}) == 1
    blank = {r[2] for r in got if r[0] in (1, 2, 6)}
    assert blank == {1}
    assert collected(ppm.ppm_scores(empty)) == []


def test_ppm_sums_to_one(spark):
    """All one-symbol continuations of a context share probability one."""
    grams = [(5, 3), (6, 1), (5 + (5 << 9), 2), (6 + (5 << 9), 1)]
    every = [(c + (5 << 9), 0) for c in range(1, 258) if c not in (5, 6)]
    counts = spark.createDataFrame([(0, g, n) for g, n in [x for x in grams if x[0] > 511] + every], "p int, gram long, c long")
    total = sum(10 ** r.value for r in ppm.gram_scores(counts, 1).collect())
    assert total == pytest.approx(1.0)


def test_toxicity(spark, odd, empty):
    mild = "the river runs past the mill and the road to town"
    docs = [(i, (mild if i % 2 else "you stupid idiot worthless scum") + f" {i}") for i in range(200)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)] + [(0, 0), (1, None)], "doc_id long, toxic long")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(frame, labels)
    got = {r.doc_id: r.score for r in toxicity.score(frame, model).collect()}
    assert all((got[i] >= 0.3) == (i % 2 == 0) for i in range(200))
    assert len(collected(toxicity.score(odd, model))) == len(TEXTS)
    assert collected(toxicity.score(empty, model)) == []
    assert {r.score for r in toxicity.score(odd, toxicity.fit(odd, labels.limit(0))).collect()} == {0.0}
    giant = spark.createDataFrame([(k, "calm " * 250_000) for k in range(100, 108)], "doc_id long, text string")  # above the bound of one text
    more = labels.unionByName(spark.createDataFrame([(k, 0) for k in range(100, 108)], labels.select("doc_id", "toxic").schema), allowMissingColumns=True)
    with_giant = toxicity.fit(frame.select("doc_id", "text").union(giant), more)
    assert len(with_giant.grams) == len(model.grams)  # all other documents count as before
    kept = toxicity.keep_ordinary(odd.unionByName(odd.limit(1).withColumn("text", F.lit("idiot scum stupid"))), model)
    assert kept.columns == odd.columns and kept.count() == len(TEXTS)


def test_urls(spark):
    urls = [(1, None), (2, "no scheme"), (3, "http://A.Example.NET/en/x?y"), (4, "https://example.net/enx"), (5, "http://xexample.com/de/"),
            (6, "http://example.com/de"), (7, "http://b.example.org/fr/1#z"), (8, "http://net"), (9, "http://net/"), (3, "http://A.Example.NET/en/x?y")]
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de/", "block"), ("org", "/fr/", "allow"), (None, "/", "block")],
                                  "host string, path string, verdict string")
    frame = spark.createDataFrame(urls, "page_id long, url string").withColumns({c: F.lit(1) for c in ("rule", "key", "best", "w0", "block")})
    got = collected(url_rules.judge(frame, rules, keep=("page_id",)))
    assert in_order((r[0], r[3], r[4]) for r in got) == in_order([
        (1, None, "allow"), (2, None, "allow"), (3, "example.net/en/", "allow"), (3, "example.net/en/", "allow"), (4, "net/", "block"), (5, None, "allow"),
        (6, None, "allow"), (7, "org/fr/", "allow"), (8, None, "allow"), (9, "net/", "block")])
    assert {r[1:] for r in got if r[0] in (1, 2)} == {("", "", None, "allow")}
    assert {r[4] for r in collected(url_rules.judge(frame, rules.limit(0), unlisted="block", keep=("page_id",)))} == {"block"}
    assert url_rules.judge(frame.limit(0), rules).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom, blocks = url_rules.bloom_blocks(keys)
    assert url_rules.maybe_listed(keys, bloom, blocks).count() == 5000
    others = spark.range(5000).select(F.concat(F.lit("o"), "id").alias("key"))
    assert url_rules.maybe_listed(others, bloom, blocks).count() < 100


PAGE = "<html><body>{}<div>{}</div><div>{}</div></body></html>"


def test_site_style_tree(spark):
    """Without declared roles, what the pages of a host repeat goes, also where copies exist."""
    pages = [(i, f"http://h.example/{i}", PAGE.format("<table><tr><td>Home<td>About</table>", f"<p>Text {i} of page {i * i}</p>" * (1 + i % 4), "Imprint and terms")) for i in range(30)]
    pages += [(100 + i, f"http://h.example/c{i}", pages[3][2]) for i in range(40)] + [(200, "http://one.example/", pages[0][2]), (201, "http://h.example/n", None), (202, None, "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("page", "host", "node", "judged")})
    got = {r.page_id: r.text for r in site_style.main_texts(frame).collect()}
    assert got[5] == "Text 5 of page 25\nText 5 of page 25" and got[103] == got[3]
    assert got[200].startswith("Home\nAbout\nText 0") and got[201] == got[202] == ""
    assert site_style.main_texts(frame.limit(0)).count() == 0


def site_texts(spark, sources, **params):
    frame = spark.createDataFrame([(i, "http://h.example/p", t) for i, t in enumerate(sources)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in site_style.main_texts(frame, **params).collect()}


def test_style_tree_takes_furniture_out_of_plain_markup(spark):
    """No tag, class or id tells a role: menus, notes with a changing part and imprints go, prose and single links stay."""
    menu = "<div><a href=/a>Start</a> <a href=/b>Archive</a> <a href=/c>Contact</a></div>"
    own = [f"<div><p>Report {i} tells of place {i * i}. Nobody had seen it before {i + 7}.</p><p>It goes on for {i} days.</p></div>" for i in range(12)]
    sources = [f"<body>{menu}{x}<div><span>All rights reserved. Printed by hand. Sold for free.</span></div></body>" for x in own]
    got = site_texts(spark, sources)
    assert got == {i: f"Report {i} tells of place {i * i}. Nobody had seen it before {i + 7}.\nIt goes on for {i} days." for i in range(12)}
    assert all("Archive" in x for x in site_texts(spark, sources[:4]).values())  # too few pages to judge


def test_style_tree_inside_declared_articles(spark):
    """A line that every article of a host repeats goes; passages of a few pages, repeated words in a sentence and near copies stay."""
    note = "<p>Read our story of the year. Tell your friends.</p>"
    page = "<article><h1>Title {0}</h1><p>Body <b>of the</b> text {0}, with more to tell than the note that stands below it.</p>{1}{2}</article>"
    shared = "<p>A passage that three pages quote.</p>"
    sources = [page.format(i, shared if i < 3 else "", note) for i in range(20)]
    got = site_texts(spark, sources)
    assert got == {i: f"Title {i}\nBody of the text {i}, with more to tell than the note that stands below it." + ("\nA passage that three pages quote." if i < 3 else "") for i in range(20)}
    copies = [f"<article><h1>One title</h1><p>One long body of text that all of them copy.</p><p>Line {i}</p></article>" for i in range(9)]
    assert site_texts(spark, copies)[4] == "One title\nOne long body of text that all of them copy.\nLine 4"


def test_style_tree_importances(spark):
    """Entropies of a small tree against a plain count."""
    import math
    sources = [f"<body><p>same here</p><p>only {i}</p>" + ("<p>half of them</p>" if i % 2 else "") + "</body>" for i in range(8)]
    frame = spark.createDataFrame([(i, "http://h.example/p", "h.example", i, t) for i, t in enumerate(sources)], "page_id long, url string, host string, page long, html string")
    nodes = site_style.page_trees(frame).select("page", F.explode("nodes").alias("at")).select("page", "at.*")
    got = {(r.node, r.feature): r.importance for r in site_style.importances(nodes, frame.select("page", F.lit(1).alias("copies")).limit(0)).collect()}
    clause = lambda x: site_style._hash("text", x)
    by_clause = {f: v for (_, f), v in got.items() if f is not None}
    assert by_clause == pytest.approx({clause("same here"): 0, clause("half of them"): 1 - math.log(4) / math.log(8)})
    assert sorted(v for (_, f), v in got.items() if f is None) == pytest.approx([0, 1 / 3, 1 / 3])  # root; body and paragraphs of two kinds


def test_style_tree_long_page(spark):
    body = " ".join(f"word{i}" for i in range(200_000))
    assert site_texts(spark, [f"<article><p>{body}</p></article>"])[0] == body


@pytest.mark.parametrize(("source", "text"), [
    ("<nav>m</nav><article><h1>T &amp; x</h1><p>a  b<br>c<p><b>d<br><p>e</b> f<ul><li>one<li>two</ul>tail</article><footer>z</footer>", "T & x\na b c\nd\ne f\none\ntwo\ntail"),
    ("<header><h1>Site</h1></header><main><header><h2>Own</h2></header><p>x<div class='comment-list'><p>no</div><form><p>no</form></main>", "Own\nx"),
    ("<article>a<script>if (a < b) document.write('</p>')</script><style>p{}</style><!-- no <p> -->b &lt;i&gt; 1 < 2</article>", "ab <i> 1 < 2"),
    ("<div id=sidebar>s</div><article><table><tr><td>1<td>2<tr><th>3</table><aside>x</aside>&nbsp;&#8364;</article><article class=comment>c</article>", "1\n2\n3\n€"),
    ("<div id='content'><h1>a</h1><div class='share'>no</div>b</div><div>other</div>", "a\nb"),
    ("plain text & more", "plain text & more"), ("<p>unclosed <a href='x>y'>link", "unclosed link"), ("<", "<"),
])
def test_extraction(source, text):
    assert site_style.page_text(source) == text
