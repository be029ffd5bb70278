"""Fill-in-the-middle transformation by Arrow list arrays.

A text is a list of units (code points). Two cuts drawn from a hash of the
document's id part it into prefix, middle and suffix, and the parts are
joined in the order of the form: prefix-suffix-middle (psm), suffix-prefix-
middle (spm), or the text as it is (plain). A batch goes through one pipeline
of Arrow kernels: units as list arrays, flattened with the index of their
text, ordinals inside the text, the role that the cuts give an ordinal, units
filtered by role, lists rebuilt and joined to pieces, pieces joined with their
marks.

Work is done on ``SLICE_BYTES`` of text at a time; a longer text is cut into
segments whose ordinals go on from each other, and the pieces of its segments
are joined, so memory per unit does not depend on the length of a text.

``restored`` rebuilds a text from its output and form. A text with one of the
marks in it stays plain, so the marks of an output are the only ones in it.

Defined results: a null text counts as empty, and an empty text is plain with
n = 0. A null key is hashed as an empty text. Nothing depends on other rows;
repeated rows each get a row. An empty table gives no rows. Only the named
columns of the input are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import frugal, slices, text_bytes

SEED = 1
#: Of 100 texts, those from PLAIN_FROM on stay plain; of the others, spm below SPM_BELOW.
PLAIN_FROM, SPM_BELOW = 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = "<[PSM]>"
SLICE_BYTES = 1 << 20

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def hash_numbers(key: Column, seed: int = SEED) -> list[Column]:
    """The first four groups of eight hex digits of sha256 of ``seed:key``, as numbers h1 to h4."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def unit_lists(texts: pa.Array) -> pa.ListArray:
    """The code points of every text."""
    buf, offs = text_bytes(texts)
    starts = np.flatnonzero((buf & 0xC0) != 0x80)
    units = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(np.append(starts, len(buf)).astype(np.int32)),
                                                             pa.py_buffer(np.ascontiguousarray(buf))])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, offs), pa.int32()), units)


def pieces_by_role(texts: pa.Array, first_cut: np.ndarray, second_cut: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of every text: units before the first cut, before the second, and behind."""
    lists = unit_lists(texts)
    units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ordinal = pc.subtract(pa.array(np.arange(len(units))), pc.take(pc.cast(lists.offsets, pa.int64()), parent))
    role = pc.add(*[pc.cast(pc.greater_equal(ordinal, pc.take(pa.array(cut), parent)), pa.int8()) for cut in (first_cut, second_cut)])
    pieces = []
    for wanted in range(3):
        mask = pc.equal(role, wanted)
        sizes = np.bincount(pc.filter(parent, mask).to_numpy(), minlength=len(texts))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        pieces.append(pc.binary_join(pa.ListArray.from_arrays(offsets, pc.filter(units, mask)), ""))
    return pieces


def segments(text: pa.Array, size: int) -> Iterator[pa.Array]:
    """One text as consecutive texts of about ``size`` bytes, cut between code points."""
    buf, _ = text_bytes(text)
    at = 0
    while at < len(buf):
        end = min(at + size, len(buf))
        while end < len(buf) and buf[end] & 0xC0 == 0x80:
            end += 1
        yield pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, end - at], np.int32)), pa.py_buffer(buf[at:end])])
        at = end


def pieces_of_long(text: pa.Array, first_cut: int, second_cut: int, size: int) -> list[pa.Array]:
    """pieces_by_role() of one text, segment by segment."""
    parts: list[list[pa.Array]] = [[], [], []]
    for segment in segments(text, size):
        for held, piece in zip(parts, pieces_by_role(segment, np.array([first_cut]), np.array([second_cut])), strict=True):
            held.append(piece)
        length = pc.utf8_length(segment)[0].as_py()
        first_cut, second_cut = first_cut - length, second_cut - length
    return [pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), pa.concat_arrays(held)), "") for held in parts]


def transformed(texts: pa.Array, h: list[np.ndarray], plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
                size: int = SLICE_BYTES) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of some texts (no nulls); h are hash_numbers()."""
    n = pc.utf8_length(texts).to_numpy().astype(np.int64)
    ends = np.sort(np.stack([h[0] % (n + 1), h[1] % (n + 1)]), axis=0)
    plain = (n == 0) | (h[2] % 100 >= plain_from) | pc.match_substring_regex(texts, MARKS).to_numpy(zero_copy_only=False)
    spm = ~plain & (h[3] % 100 < spm_below)
    if len(texts) == 1 and len(texts[0].as_buffer() or b"") > size:
        prefix, middle, suffix = pieces_of_long(texts, int(ends[0, 0]), int(ends[1, 0]), size)
    else:
        prefix, middle, suffix = pieces_by_role(texts, ends[0], ends[1])
    joined = [pc.binary_join_element_wise(*parts, MIDDLE, middle, "") for parts in
              ((PREFIX, prefix, SUFFIX, suffix), (SUFFIX, suffix, PREFIX, prefix))]
    code = pa.array(np.where(plain, 0, np.where(spm, 2, 1)))
    return [pa.array(n), pc.take(pa.array(["plain", "psm", "spm"]), code), pa.array(ends[0], mask=plain), pa.array(ends[1] - ends[0], mask=plain),
            pc.if_else(pa.array(plain), texts, pc.if_else(pa.array(spm), joined[1], joined[0]))]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, plain_from: int = PLAIN_FROM,
                   spm_below: int = SPM_BELOW, size: int = SLICE_BYTES) -> DataFrame:
    """One row per document: key, units, form, units of prefix and middle (null if plain) and the transformed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), size):
                part = batch.slice(a, b - a)
                texts = pa.array([], pa.string()) if part.num_rows == 0 else pc.cast(part.column(1), pa.string()).fill_null("")
                h = [part.column(i).to_numpy().astype(np.int64) for i in range(2, 6)]
                yield pa.RecordBatch.from_arrays([part.column(0), *transformed(texts, h, plain_from, spm_below, size)],
                                                 names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"),
                       *hash_numbers(docs[key], seed)).mapInArrow(frugal(run), SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from."""
    part = F.split(output, MARKS, -1)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
