"""Many pairs of lines are verified at a time, with the result of edit distance pair by pair; blocks travel as bins."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from vireo.llm import fuzzy_lines


def changed(rng, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        k = rng.randrange(len(out) + 1)
        out[k:k + rng.randrange(2)] = rng.choice(letters) * rng.randrange(2)
    return "".join(out)


@pytest.mark.parametrize("letters", ["ab ", "abcdefghij ", "éñ日本a "])
def test_pairs_verified_together(letters):
    rng, lines = random.Random(5), []
    for _ in range(120):
        size = rng.choice([1, 12, 40, 63, 64, 65, 130, 161, 320])
        line = "".join(rng.choice(letters) for _ in range(size))
        lines += [line, changed(rng, line, rng.randrange(1 + size // 3), letters)]
    x, y = np.arange(0, len(lines), 2), np.arange(1, len(lines), 2)
    longer = np.array([max(len(lines[i]), len(lines[j])) for i, j in zip(x, y, strict=True)])
    for share in (0.0, 0.2, 0.35):
        most = (share * longer + 1e-9).astype(np.int64)
        expected = [brute.edit_distance(lines[i], lines[j]) <= m for i, j, m in zip(x, y, most, strict=True)]
        assert fuzzy_lines.within_edits(pa.array(lines), x, y, most).tolist() == expected
        shown = fuzzy_lines.Words(pa.array(lines)).within(x, y, most)
        assert not (shown & ~np.array(expected)).any()


def test_a_task_hands_on_bins_not_one_row_a_line_and_block(spark):
    """What is shuffled for the blocks are bins with many lines each."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(500)]
    docs = spark.createDataFrame([(i, i, " ".join(rng.choices(words, k=20))) for i in range(4000)], "doc_id long, number long, text string").coalesce(1)
    lines = fuzzy_lines.line_table(docs.selectExpr("struct(doc_id, text) AS doc", "number"), "doc_id", "text")
    plan = fuzzy_lines.candidate_groups(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "bin#" in plan and "lines#" in plan
