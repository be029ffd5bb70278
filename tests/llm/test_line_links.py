"""Links between lines follow edit similarity alone, at any number of words and in any script."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tests.llm import brute
from vireo.llm import fuzzy_lines


def apart(a, b):
    """Share of SimHash bits that differ."""
    x, y = fuzzy_lines.simhash(pa.array([a, b]), 10)
    return int(np.bitwise_count(x ^ y).sum()) / 640


def left(spark, docs):
    return {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}


def test_lines_with_changed_words_are_linked(spark):
    """Almost all pairs, also far beyond three bits of a SimHash of their words, and none below the similarity."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(4000)]
    lines = []
    for n in [10, 14, 20, 30, 50] * 8:
        line = rng.sample(words, n)
        lines.append(" ".join(line))
        for _ in range(1 + n // 20):
            line[rng.randrange(n)] = rng.choice(words)
        lines.append(" ".join(line))
    got_lines = fuzzy_lines.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    gone = {r.doc_id for r in got_lines.where("text = ''").collect()}
    far = near = found = 0
    for i in range(0, len(lines), 2):
        close = brute.edit_distance(lines[i], lines[i + 1]) <= 0.2 * max(len(lines[i]), len(lines[i + 1])) + 1e-9
        assert close or i + 1 not in gone
        assert i not in gone
        near, found = near + close, found + (i + 1 in gone)
        far += close and apart(lines[i], lines[i + 1]) > 3 / 64
    assert far >= 20 and found >= 0.9 * near


def test_a_link_depends_on_its_two_lines_alone(spark):
    """The blocks are the same at any number of lines, so a pair meets among few lines if it meets among many."""
    assert all(fuzzy_lines.block_plan(band, 10) == fuzzy_lines.block_plan(band, 10 ** 9) for band in range(fuzzy_lines.BANDS))
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(4000)]
    pairs = []
    for _ in range(60):
        line = rng.sample(words, 10)
        other = line[:]
        other[rng.randrange(10)] = rng.choice(words)
        pairs += [" ".join(line), " ".join(other)]
    others = [" ".join(rng.sample(words, 10)) for _ in range(6000)]
    few, many = (left(spark, list(enumerate(lines))) for lines in (pairs, pairs + others))
    assert {k: v for k, v in many.items() if k < len(pairs)} == few


def test_lines_of_few_words_count_by_characters(spark):
    """Scripts without blanks, long words and numbers; lines below MIN_CHARS stay."""
    chinese = "机器学习是人工智能的一个分支它使计算机能够从数据中学习并且不断改进其性能"
    short, numbers = "Contact us", "2024 1200 3400 5600 7800"
    docs = [(1, "\n".join([chinese, short, numbers, "Internationalization documentation"])), (2, chinese), (3, chinese.replace("分支", "领域")),
            (4, short), (5, numbers), (6, numbers.replace("7800", "7801")), (7, "internationalization DOCUMENTATION!"), (8, "unrelated documentation 数据")]
    got = left(spark, docs)
    assert got[1] == docs[0][1]
    assert got[2] == got[3] == got[5] == got[7] == ""
    assert got[4] == short and got[6] == docs[5][1] and got[8] == docs[7][1]


def test_lines_that_differ_in_a_sixth_of_their_bits_mostly_meet():
    """Blocks of 12 bits, each the start of one of 13, bring together what blocks of 13 bits left out, and all that those did not."""
    rng = np.random.default_rng(6)
    size, blocks = fuzzy_lines.block_plan(3)
    bits = rng.integers(0, 2, (4000, 192), dtype=np.uint8)
    other = bits ^ (rng.random(bits.shape) < 0.16)
    words, changed = (np.packbits(x, axis=1, bitorder="little").view(np.uint64) for x in (bits, other))
    a, b = (fuzzy_lines.block_keys(w, np.full(4000, 3), {3: (size, blocks)})[0].reshape(4000, blocks) for w in (words, changed))
    met = (a == b).any(axis=1)
    longer = (bits == other)[:, :169].reshape(4000, 13, 13).all(axis=2).any(axis=1)
    assert not (longer & ~met).any() and met.mean() > 0.79 > longer.mean()


def test_large_blocks_are_compared_and_not_handed_on_whole():
    """A block of any number of lines falls into the sets of its close prints; lengths beyond the similarity do not connect."""
    rng = np.random.default_rng(7)
    p0, p1 = rng.integers(0, 1 << 63, (2, 6000), dtype=np.uint64)
    p0[1], p1[1] = p0[0] ^ np.uint64(7), p1[0]
    p0[5999], p1[5999] = p0[0], p1[0]
    chars = np.sort(rng.integers(100, 200, 6000))
    labels = fuzzy_lines.close_sets(np.zeros(6000, np.int64), p0, p1, chars)
    assert labels[1] == 0 and labels[5999] != 0 and len(np.unique(labels)) > 5900
