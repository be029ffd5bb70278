"""Line dedup across documents: SimHash of normalised lines, pigeonhole blocks, edit similarity, one line kept per group.

A line is normalised (A-Z lowered, every other ASCII byte that is not a-z a
blank, blanks joined), so case, digits and punctuation do not tell lines
apart. Equal normalised lines are one text. A line whose normal form has fewer
than ``MIN_CHARS`` characters (numbers, symbols) is compared as it is written
(A-Z lowered, blanks joined) and only for equality; if that is shorter than
``MIN_CHARS`` too, the line is left alone. Length is counted in characters, so
scripts without blanks are treated like others.

Two lines are linked if their edit similarity (1 - edit distance / longer
length) is at least ``MIN_SIMILARITY``; nothing else decides a link. Pairs to
verify come from a SimHash over the distinct words of a line (a word of more
than ``LONG_WORD`` characters counts as its pairs of characters). Its first
``PRINT_BITS`` bits are the print of the line; the bits behind are cut into
blocks, and lines that agree in a block meet. By the pigeonhole principle two
lines that differ in fewer bits than there are blocks always meet; beyond
that, most do. A block is the first ``VALUE_BITS`` of ``BLOCK_STEP`` bits, and the
number of blocks is such that lines that differ in ``DESIGN_SHARE`` of their bits,
or in short lines by one word, would meet with probability ``DESIGN_REACH`` if all
``BLOCK_STEP`` bits had to agree. Both depend on the band of
length alone, so whether two lines meet depends on the two and on no other line
of the table. Lines meet only within bands of length, which
overlap so far that lines of similar length share one; from ``LAST_BAND`` on there is
one band. Of the lines that meet, those whose lengths allow the similarity and
whose prints differ in at most ``MAX_BITS`` bits are verified. The
README has the recall against edit similarity alone.

The bits of all blocks are kept with the line table. Blocks travel with prints and
lengths, not with text; the lines of one task in a bin of blocks are one row. A block of any
size is compared in tiles. Lines connected by
close prints are one candidate group; groups of the same lines are one. Only lines in such a
group come with their text. Groups above ``CHUNK_ROWS`` are cut into chunks,
and each pair of chunks is verified on its own, so no task holds more than two
chunks of a group; pairs whose lines are connected already inside a group need
no proof. Many pairs are verified at a time: their words laid side by side prove most of the
similar ones, the others get their exact edit distance within the bound.

Links make connected components; of each component the first line (least
doc_id, null last, then place in the files, then line number) stays and the
others are removed from their documents. Lines are the pieces between \n.

Defined results: a null text has no lines and stays null; an empty text stays
empty. A document whose lines all go is kept with an empty text. Every row is
known by its place in the files, so rows that repeat a doc_id, or hold none,
are told apart, and of equal rows the first keeps its lines. An empty table
gives an empty result; extra columns pass through, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import LOWER, binary_array, frugal, mixed, numbered, slices, text_bytes, word_hashes, word_spans, written
from vireo.llm.components import components, union
from vireo.llm.simhash import majorities
from vireo.llm.url_rules import BLOCK_BYTES, BROADCAST_BYTES, bloom_blocks, maybe_listed

MIN_CHARS = 12
MIN_SIMILARITY = 0.8
CHUNK_ROWS = 4096
#: Lines that a task remembers as filed.
SEEN_ROWS = 1 << 18
#: Bytes of text whose features are in memory at a time.
KEY_BYTES = 1 << 22
#: Words of more characters than this count as their pairs of characters.
LONG_WORD = 16
#: Bits of the print, and how many may differ.
PRINT_BITS, MAX_BITS = 128, 38
#: Lines that differ in this share of their bits meet in a block with this probability.
DESIGN_SHARE, DESIGN_REACH = 0.12, 0.93
#: Characters of a usual word with its blank, and the greatest share that blocks of short lines are laid out for.
CHARS_A_WORD, SHORT_SHARE = 6, 0.19
#: Bits of a block, how far blocks are apart, and bands of length; the last band that is filed has no end.
VALUE_BITS, BLOCK_STEP, BANDS, LAST_BAND = 12, 13, 29, 3

LETTERS = LOWER.copy()
LETTERS[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20
IS_LETTER = LETTERS != 0x20

LINE_SCHEMA = "id long, number long, line_no int, digest binary, line string, chars int, p0 long, p1 long, words binary"
#: Bits of a block's number in its key, of a key inside a bin, and of a line's length behind it.
BLOCK_BITS, LOW_BITS, CHARS_BITS = 9, 4, 31
#: A line in a block, and how many of them a task lays into bins at a time.
FILED = np.dtype([("low", "u1"), ("chars", "<u4"), ("p0", "<u8"), ("p1", "<u8")])
FILED_ROWS = 1 << 20
#: Bits of a group and of a length in a sort by one number.
SORT_BITS = 18
#: Rows of a block that are compared at a time with all that follow, and close pairs that are held before they are merged.
TILE_ROWS, HELD_PAIRS = 64, 1 << 20
#: Words that may be passed over at a time where two lines are laid side by side.
PASSED_WORDS = 8
#: Pairs that are verified at a time, bytes of their lines laid side by side, and rows and bytes of the groups they come from.
PAIRS_AT_ONCE, BAND_BYTES, GROUP_ROWS, GROUP_BYTES = 1 << 14, 1 << 21, 1 << 15, 1 << 24
#: Fewer pairs of like length than these are verified one by one.
FEW_PAIRS = 12


def lines_of(texts: pa.Array, min_chars: int = MIN_CHARS) -> dict[str, object]:
    """Row, number, normalised text and digest of every line with enough characters (text empty: only equal lines match)."""
    buf, offs = text_bytes(texts)
    breaks = np.flatnonzero(buf == 0x0A)
    edge = np.unique(np.concatenate([offs, breaks + 1]))
    edge = edge[edge <= len(buf)]
    row = np.searchsorted(offs, edge[:-1], side="right") - 1
    number = np.arange(len(row)) - np.searchsorted(row, row)
    # letters, and one blank behind each word but the last of a line
    low = LETTERS[buf]
    keep = low != 0x20
    after = keep[:-1].copy()
    after[edge[1:-1] - 1] = False
    keep[1:] |= after
    upto = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(keep, out=upto[1:])
    upto, low = upto[edge], low[keep]
    last = upto[1:][np.diff(upto) > 0] - 1
    last = last[low[last] == 0x20]
    low, upto = np.delete(low, last), upto - np.searchsorted(last, upto).astype(np.int32)
    normal = pa.Array.from_buffers(pa.string(), len(row), [None, pa.py_buffer(upto), pa.py_buffer(low)])
    enough = pa.compute.utf8_length(normal).to_numpy() >= min_chars
    digests: dict[int, bytes] = {}
    for i in np.flatnonzero(~enough & (np.diff(edge) >= min_chars)).tolist():
        plain = b" ".join(LOWER[buf[edge[i]:edge[i + 1]]].tobytes().split())
        if len(plain.decode()) >= min_chars:
            digests[i] = xxhash.xxh3_128_digest(b"\n" + plain)  # no normalised line has a line break
    chosen = np.flatnonzero(enough | np.isin(np.arange(len(row)), list(digests)))
    normal = normal.take(pa.array(chosen))
    normal = pa.compute.if_else(pa.array(enough[chosen]), normal, "")
    return {"row": row[chosen], "line_no": number[chosen], "line": normal,
            "digest": [digests.get(i) or xxhash.xxh3_128_digest(x) for i, x in zip(chosen.tolist(), normal.cast(pa.binary()).to_pylist(), strict=True)]}


def line_table(rows: DataFrame, key: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with enough characters, from numbered() documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(2)):
                part = batch.slice(a, b - a)
                cols = lines_of(part.column(2), min_chars)
                at, coded = pa.array(cols["row"]), cols["line"].dictionary_encode()
                parts = [line_bits(coded.dictionary.slice(x, y - x)) for x, y in slices(coded.dictionary, KEY_BYTES)]
                prints = np.concatenate([np.empty((0, PRINT_BITS // 64), np.uint64), *[x for x, _ in parts]])[coded.indices.to_numpy()].view(np.int64)
                words = pa.concat_arrays([pa.array([], pa.binary()), *[x for _, x in parts]]).take(coded.indices)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(cols["line_no"], pa.int32()), pa.array(cols["digest"], pa.binary()),
                     cols["line"], pa.compute.utf8_length(cols["line"]), pa.array(prints[:, 0]), pa.array(prints[:, 1]), words],
                    names=["id", "number", "line_no", "digest", "line", "chars", "p0", "p1", "words"])

    return rows.select(F.col(f"doc.`{key}`").cast("long").alias("id"), "number", F.col(f"doc.`{text}`").cast("string").alias("text")).mapInArrow(frugal(run), LINE_SCHEMA)


def features(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first of every line): the distinct words of some lines, long ones as their pairs of characters."""
    buf, offs = text_bytes(lines)
    if not len(buf):
        return np.empty(0, np.uint64), np.zeros(len(offs), np.int64)
    cut = np.append(buf == 0x20, True)
    cut[offs] = True
    edges = np.flatnonzero(cut)
    coded = binary_array(np.ascontiguousarray(buf), edges).dictionary_encode()  # words, most with the blank before them
    number, owner = coded.indices.to_numpy(), np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(edges, offs)))
    buf, at = text_bytes(coded.dictionary)
    starts, ends = at[:-1] + ~IS_LETTER[buf[at[:-1]]], at[1:]
    known, of = np.unique(word_hashes(buf, starts, ends), return_inverse=True)
    long = np.flatnonzero(ends - starts > LONG_WORD)
    char = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))
    size = np.searchsorted(char, ends[long]) - np.searchsorted(char, starts[long])
    long, size = long[size > LONG_WORD], size[size > LONG_WORD]
    plain = np.ones(len(starts), bool)
    plain[starts == ends] = plain[long] = False
    used = plain[number]
    key = owner[used] * len(known) + of[number[used]]
    if len(long):
        pairs = size - 1
        begin = np.repeat(np.searchsorted(char, starts[long]) - np.cumsum(pairs) + pairs, pairs) + np.arange(pairs.sum())
        more, of = np.unique(word_hashes(buf, char[begin], char[begin + 2]), return_inverse=True)
        first = np.zeros(len(starts) + 1, np.int64)
        first[long + 1] = pairs
        np.cumsum(first, out=first)
        spelt = np.flatnonzero(np.isin(number, long))
        counts = first[number[spelt] + 1] - first[number[spelt]]
        picked = np.repeat(first[number[spelt]] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        both, into = np.unique(np.concatenate([known, more]), return_inverse=True)
        key = np.concatenate([key // len(known) * len(both) + into[key % len(known)], np.repeat(owner[spelt], counts) * len(both) + into[len(known) + of[picked]]])
        known = both
    key = np.sort(key)
    key = key[np.diff(key, prepend=-1) != 0]
    return known[key % len(known)], np.searchsorted(key, np.arange(len(offs)) * len(known))


def simhash(lines: pa.Array, words: int, skipped: int = 0) -> np.ndarray:
    """``words`` numbers of 64 bits of the SimHash of some lines, without the first ``skipped``."""
    return _majorities(*features(lines), words, skipped)


def _majorities(hashes: np.ndarray, firsts: np.ndarray, words: int, skipped: int = 0) -> np.ndarray:
    salts = mixed(np.arange(skipped + 1, skipped + words + 1, dtype=np.uint64))
    return majorities(lambda at: mixed(hashes[at] ^ salts[:, None]), firsts, words)


def line_bits(lines: pa.Array, least: float = MIN_SIMILARITY) -> tuple[np.ndarray, pa.Array]:
    """(prints, words) of some lines: ``words`` holds the numbers of simhash() behind the print that the blocks of a line need."""
    chars, own = pa.compute.utf8_length(lines).to_numpy(), PRINT_BITS // 64
    line, band = filed_bands(chars, least)
    need = np.zeros(len(chars), np.int64)
    np.maximum.at(need, line, np.array([plan_words(b) for b in range(LAST_BAND + 1)])[band])
    need[chars == 0] = 0
    hashes, firsts = features(lines)
    fewest = int(need[need > 0].min(initial=need.max(initial=0)))
    bits = np.zeros((len(chars), own + int(need.max(initial=0))), np.uint64)
    bits[:, :own + fewest] = _majorities(hashes, firsts, own + fewest)
    more = np.flatnonzero(need > fewest)
    if len(more):
        counts = np.diff(firsts)[more]
        ends = np.cumsum(counts)
        picked = np.repeat(firsts[more] - ends + counts, counts) + np.arange(counts.sum())
        bits[more, own + fewest:] = _majorities(hashes[picked], np.concatenate([[0], ends]), bits.shape[1] - own - fewest, own + fewest)
    held = np.arange(bits.shape[1] - own) < need[:, None]
    offs = np.concatenate([[0], np.cumsum(8 * need)]).astype(np.int32)
    return bits[:, :own], pa.Array.from_buffers(pa.binary(), len(chars), [None, pa.py_buffer(offs), pa.py_buffer(bits[:, own:][held])])


def bands_of(chars: np.ndarray, least: float = MIN_SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """(line, band) of the bands of length that lines lie in: band b begins at MIN_CHARS * 2^b and reaches 2 / least times as far."""
    home = np.maximum(0, np.log2(np.maximum(chars, 1) / MIN_CHARS).astype(np.int64))
    below = np.flatnonzero((home > 0) & (chars <= MIN_CHARS * 2.0 ** home / least))
    return np.concatenate([np.arange(len(chars)), below]), np.concatenate([home, home[below] - 1])


def block_plan(band: int, lines: int = 0) -> tuple[int, int]:
    """(bits, blocks) for a band, the same for any number of ``lines`` in it."""
    words = max(1.5, 1.5 * MIN_CHARS * 2.0 ** band / CHARS_A_WORD)  # in a line from the middle of the band
    share = max(DESIGN_SHARE, min(SHORT_SHARE, float(np.arccos(1 - 1 / words) / np.pi)))
    return VALUE_BITS, int(np.ceil(np.log(1 - DESIGN_REACH) / np.log(1 - (1 - share) ** BLOCK_STEP)))


def plan_words(band: int) -> int:
    """Numbers of 64 bits that the blocks of a band are cut from."""
    return -(-BLOCK_STEP * block_plan(band)[1] // 64)


def filed_bands(chars: np.ndarray, least: float = MIN_SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """As bands_of(), with the bands from ``LAST_BAND`` on as one: their blocks are the same, and lines of a block are sorted by length."""
    line, band = bands_of(chars, least)
    once = (np.arange(len(line)) < len(chars)) | (band < LAST_BAND)
    return line[once], np.minimum(band[once], LAST_BAND)


def block_keys(words: np.ndarray, band: np.ndarray, plan: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(key, row): the blocks of lines, each in one band; ``words`` are simhash() numbers behind the print."""
    value_bits = max(size for size, _ in plan.values())
    words = np.concatenate([words, np.zeros((len(words), 1), np.uint64)], axis=1)
    keys, owner = [], []
    for b in np.unique(band).tolist():
        size, blocks = plan[b]
        rows = np.flatnonzero(band == b)
        at = BLOCK_STEP * np.arange(blocks)
        shift = (at % 64).astype(np.uint64)
        values = words[rows[:, None], at // 64] >> shift | words[rows[:, None], at // 64 + 1] << np.uint64(1) << (np.uint64(63) - shift)
        values = (values & np.uint64((1 << size) - 1)).view(np.int64)
        keys.append(((b << BLOCK_BITS | np.arange(blocks)) << value_bits | values).ravel())
        owner.append(np.repeat(rows, blocks))
    return np.concatenate(keys), np.concatenate(owner)


def whole_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """(group number of each row, rows) of batches sorted by the key columns ``names``; no group is cut."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        group = _numbered(rows, names)
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield group[:cut], rows.slice(0, cut)
        held = rows.slice(cut)
    if held is not None:
        yield _numbered(held, names), held


def _numbered(rows: pa.Table, names: list[str]) -> np.ndarray:
    new = np.zeros(len(rows), bool)
    for n in names:
        values = rows.column(n).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def candidate_groups(lines: DataFrame, least: float = MIN_SIMILARITY) -> DataFrame:
    """(bucket, p0, p1): sets of prints to verify, each set once, from lines that may repeat."""
    plan = {b: block_plan(b) for b in range(LAST_BAND + 1)}
    needs = np.array([plan_words(b) for b in plan])

    def filed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        parts = [np.concatenate(x) for x in zip(*held, strict=True)]
        order = np.argsort(parts[0], kind="stable")
        key, packed = parts[0][order], np.empty(len(order), FILED)
        packed["low"] = key & (1 << LOW_BITS) - 1
        for name, x in zip(("chars", "p0", "p1"), parts[1:], strict=True):
            packed[name] = x[order]
        first = np.flatnonzero(np.diff(key >> LOW_BITS, prepend=-1))
        ends = FILED.itemsize * np.append(first, len(key))
        return pa.RecordBatch.from_arrays([pa.array(key[first] >> LOW_BITS), binary_array(packed.view(np.uint8), ends)], names=["bin", "lines"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, rows = np.empty(0, np.uint64), [], 0  # a line that is everywhere is filed once a task
        for batch in batches:
            p0, p1 = (batch.column(c).to_numpy().view(np.uint64) for c in (1, 2))
            ids, where = np.unique(mixed(p0) ^ p1 ^ mixed(batch.column(0).to_numpy().astype(np.uint64)), return_index=True)
            where = where[~np.isin(ids, seen)]
            seen = np.union1d(seen, ids) if len(seen) < SEEN_ROWS else ids
            chars = batch.column(0).to_numpy()[where].astype(np.int64)
            bits, firsts = text_bytes(batch.column(3).take(pa.array(where)))
            bits, firsts = np.ascontiguousarray(bits).view(np.uint64), firsts // 8
            line, band = filed_bands(chars, least)
            for n in np.unique(needs[band]).tolist():
                own, own_band = line[needs[band] == n], band[needs[band] == n]
                found, owner = block_keys(bits[firsts[own][:, None] + np.arange(n)], own_band, plan)
                at = own[owner]
                held.append((found, chars[at], p0[where[at]], p1[where[at]]))
                rows += len(at)
            if rows >= FILED_ROWS:
                yield filed(held)
                held, rows = [], 0
        if rows:
            yield filed(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in whole_groups(batches, ["bin"]):
            data, offs = text_bytes(rows.column("lines"))
            found = np.ascontiguousarray(data).view(FILED)
            group = np.repeat(number - number[0], np.diff(offs) // FILED.itemsize) << LOW_BITS | found["low"]
            chars, near = found["chars"].astype(np.int64), mixed(found["p0"]) ^ found["p1"]
            if max(int(group[-1]), int(chars.max())) >> SORT_BITS:
                order = np.lexsort((near, chars, group))
            else:  # by group and length, equal prints mostly side by side
                order = np.argsort((group << SORT_BITS | chars).astype(np.uint64) << np.uint64(64 - 2 * SORT_BITS) | near >> np.uint64(2 * SORT_BITS))
            group, chars, p0, p1 = group[order], chars[order], found["p0"][order], found["p1"][order]
            new = np.ones(len(p0), bool)
            new[1:] = (group[1:] != group[:-1]) | (chars[1:] != chars[:-1]) | (p0[1:] != p0[:-1]) | (p1[1:] != p1[:-1])
            group, chars, p0, p1 = group[new], chars[new], p0[new], p1[new]
            label = close_sets(group, p0, p1, chars, least)
            shared = np.flatnonzero(np.bincount(label, minlength=len(label))[label] > 1)
            shared = shared[np.lexsort((p1[shared], p0[shared], label[shared]))]
            label, p0, p1 = label[shared], p0[shared], p1[shared]
            new = np.ones(len(p0), bool)  # a print may come with several lengths
            new[1:] = (label[1:] != label[:-1]) | (p0[1:] != p0[:-1]) | (p1[1:] != p1[:-1])
            label, p0, p1 = label[new], p0[new], p1[new]
            if len(label):
                first = np.flatnonzero(np.diff(label, prepend=-1))
                size = np.diff(np.append(first, len(label)))
                name = np.add.reduceat(mixed(mixed(p0) ^ p1), first)  # the same for the same prints
                several = np.repeat(size > 1, size)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name, size)[several].view(np.int64)), pa.array(p0[several].view(np.int64)),
                                                  pa.array(p1[several].view(np.int64))], names=["bucket", "p0", "p1"])

    binned = lines.where("chars > 0").select("chars", "p0", "p1", "words").mapInArrow(frugal(keys), "bin long, lines binary")
    return binned.repartition("bin").sortWithinPartitions("bin").mapInArrow(frugal(run), "bucket long, p0 long, p1 long").distinct()


def close_sets(group: np.ndarray, p0: np.ndarray, p1: np.ndarray, chars: np.ndarray, least: float = MIN_SIMILARITY, most: int = MAX_BITS) -> np.ndarray:
    """Class of every row: rows of one group, sorted by length, connected by prints within ``most`` bits and lengths that allow ``least``."""
    labels, held, waiting = np.arange(len(group)), [], 0
    for i, j in near_rows(group, p0, p1, chars, least, most):
        held.append((i, j))
        waiting += len(i)
        if waiting > HELD_PAIRS:
            labels, held, waiting = union(labels, *(np.concatenate(x) for x in zip(*held, strict=True))), [], 0
    return union(labels, *(np.concatenate(x) for x in zip(*held, strict=True))) if held else labels


def near_rows(group: np.ndarray, p0: np.ndarray, p1: np.ndarray, chars: np.ndarray, least: float, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows that close_sets() connects."""
    first, stop = np.searchsorted(group, group), np.searchsorted(group, group, side="right")
    small = np.flatnonzero(stop - first <= TILE_ROWS)
    small = small[np.argsort((first - stop)[small], kind="stable")]  # greatest groups first, so rows at work lie in one piece
    size, q0, q1, own, length = (stop - first)[small], p0[small], p1[small], group[small], chars[small]
    for lag in range(1, int(size.max(initial=0))):
        n = int(np.searchsorted(-size, -lag))
        at = np.flatnonzero(np.bitwise_count(q0[:n - lag] ^ q0[lag:n]) + np.bitwise_count(q1[:n - lag] ^ q1[lag:n]) <= most)
        at = at[(own[at] == own[at + lag]) & (length[at] >= least * length[at + lag] - 1e-9)]
        if len(at):
            yield small[at], small[at + lag]
    for a in np.flatnonzero((first == np.arange(len(group))) & (stop - first > TILE_ROWS)).tolist():
        b = int(stop[a])
        reach = a + np.searchsorted(chars[a:b], chars[a:b] / least + 1e-9, side="right")
        for x in range(a, b - 1, TILE_ROWS):
            y = min(x + TILE_ROWS, b)
            z = int(reach[y - a - 1])
            bits = np.bitwise_count(p0[x:y, None] ^ p0[None, x:z])
            bits += np.bitwise_count(p1[x:y, None] ^ p1[None, x:z])
            i, j = np.divmod(np.flatnonzero(bits.ravel() <= most), z - x)
            wanted = (j > i) & (j + x < reach[x - a + i])
            if wanted.any():
                yield i[wanted] + x, j[wanted] + x


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or ``most`` + 1 if it is greater (bit-parallel over the shorter text)."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    short = min(len(a), len(b))
    start = next((k for k in range(short) if a[k] != b[k]), short)
    back = next((k for k in range(short - start) if a[-1 - k] != b[-1 - k]), short - start)
    a, b = a[start:len(a) - back], b[start:len(b) - back]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return min(len(b), most + 1)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    plus, minus = full, 0
    for k, c in enumerate(b):
        eq = where.get(c, 0)
        flat = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(flat | plus), plus & flat
        score += bool(up & top) - bool(down & top)
        if score - (len(b) - k - 1) > most:
            return most + 1
        up, down = (up << 1 | 1) & full, (down << 1) & full
        plus, minus = (down | ~(flat | up)) & full, up & flat
        if k & 31 == 31 and k < len(a):  # the diagonal: a path that passes it at a distance has to come back
            above = (2 << k) - 1
            if k + 1 + (plus & above).bit_count() - (minus & above).bit_count() - (len(b) - len(a)) > most:
                return most + 1
    return min(score, most + 1)


def distance_bound(x: list[str], y: list[str], most: int) -> int:
    """A number of edits that turn the words x into the words y, or more than ``most`` when they are no longer followed."""
    i = j = edits = 0
    nx, ny = len(x), len(y)
    while i < nx and j < ny:
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        for far in range(1, PASSED_WORDS + 1):  # the nearest place where two words are equal again
            for k in range(far + 1):
                if i + k < nx and j + far < ny and x[i + k] == y[j + far] and x[i + k + 1:i + k + 2] == y[j + far + 1:j + far + 2]:
                    p, q = k, far
                    break
                if i + far < nx and j + k < ny and x[i + far] == y[j + k] and x[i + far + 1:i + far + 2] == y[j + k + 1:j + k + 2]:
                    p, q = far, k
                    break
            else:
                continue
            break
        else:
            break
        edits += max(sum(map(len, x[i:i + p])) + p, sum(map(len, y[j:j + q])) + q)
        if edits > most:
            return edits
        i, j = i + p, j + q
    return edits + max(sum(map(len, x[i:])) + nx - i, sum(map(len, y[j:])) + ny - j)


def similar(a: str, b: str, least: float = MIN_SIMILARITY) -> bool:
    """Whether edit similarity reaches ``least``; words laid side by side bound it first."""
    most = int((1 - least) * max(len(a), len(b)) + 1e-9)
    return abs(len(a) - len(b)) <= most and (distance_bound(a.split(" "), b.split(" "), most) <= most or edit_distance(a, b, most) <= most)


def close_pairs(group: np.ndarray, chars: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group whose lengths allow a similarity of ``least``: each row with the next longer one, the one after, and so on."""
    order = np.lexsort((chars, group))
    group, chars = group[order], chars[order]
    at, lag = np.arange(len(group)), 1
    while len(at):
        at = at[at + lag < len(group)]
        at = at[(group[at] == group[at + lag]) & (chars[at] >= least * chars[at + lag] - 1e-9)]
        yield order[at], order[at + lag]
        lag += 1


class Words:
    """Words of some lines, each with the blank before it, as numbers: line r has ``count[r]`` from ``begin[r]`` on, then -1 as often as a search may look ahead."""

    def __init__(self, lines: pa.Array):
        buf, offs = text_bytes(lines)
        cut = np.append(buf == 0x20, True)
        cut[offs] = True
        edges = np.flatnonzero(cut)
        firsts = np.searchsorted(edges, offs)
        pieces = binary_array(np.ascontiguousarray(buf), edges)
        self.count = np.diff(firsts)
        self.begin = firsts[:-1] + np.arange(len(self.count)) * (PASSED_WORDS + 2)
        place = np.arange(len(pieces)) + np.repeat(np.arange(len(self.count)), self.count) * (PASSED_WORDS + 2)
        size = len(pieces) + len(self.count) * (PASSED_WORDS + 2)
        self.word = np.full(size, -1, np.int32)
        self.word[place] = pieces.dictionary_encode().indices.to_numpy()
        #: Bytes before each place, no fewer than characters.
        self.bytes = np.zeros(size + 1, np.int64)
        self.bytes[place + 1] = np.diff(edges)
        np.cumsum(self.bytes, out=self.bytes)

    def within(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether words laid side by side show that ``most`` edits turn line x into line y, for many pairs (as distance_bound())."""
        out = np.zeros(len(x), bool)
        at, i, j, left = np.arange(len(x)), self.begin[x], self.begin[y], most.astype(np.int64)
        stop_i, stop_j = i + self.count[x], j + self.count[y]
        while len(at):
            run = np.arange(len(at))
            while len(run):
                run = run[(i[run] < stop_i[run]) & (self.word[i[run]] == self.word[j[run]])]
                i[run] += 1
                j[run] += 1
            ended = (i == stop_i) | (j == stop_j)
            rest = np.maximum(self.bytes[stop_i] - self.bytes[i], self.bytes[stop_j] - self.bytes[j])
            out[at[ended & (rest <= left)]] = True
            open_ = np.flatnonzero(~ended)
            at, i, j, left, stop_i, stop_j = (v[open_] for v in (at, i, j, left, stop_i, stop_j))
            p, q = self._passed(i, j)
            far = np.flatnonzero(p < 0)  # nothing is equal again
            out[at[far[rest[open_][far] <= left[far]]]] = True
            p, q = np.minimum(i + p, stop_i), np.minimum(j + q, stop_j)
            left -= np.maximum(self.bytes[p] - self.bytes[i], self.bytes[q] - self.bytes[j])
            on = np.flatnonzero((left >= 0) & (p >= i))
            at, i, j, left, stop_i, stop_j = (v[on] for v in (at, p, q, left, stop_i, stop_j))
        return out

    def _passed(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words to pass over on either side to the nearest place where two words in a row are equal (-1: none near)."""
        p, q, word = np.full(len(i), -1), np.full(len(i), -1), self.word
        open_ = np.arange(len(i))
        for far in range(1, PASSED_WORDS + 1):
            for k in range(far + 1):
                for u, v in ((k, far), (far, k)):
                    a, b = i[open_] + u, j[open_] + v
                    same = (word[a] == word[b]) & (word[a + 1] == word[b + 1])
                    p[open_[same]], q[open_[same]] = u, v
                    open_ = open_[~same]
                    if not len(open_):
                        return p, q
        return p, q


def within_edits(lines: pa.Array, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether at most ``most`` edits turn line x into line y, for many pairs: edit_distance() over numpy rows, in a band around the diagonal."""
    used, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    buf, offs = text_bytes(lines.take(pa.array(used)).cast(pa.string()))
    if (buf < 0x80).all():
        codes = buf
    else:
        codes = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
        upto = np.zeros(len(buf) + 1, np.int64)
        np.cumsum((buf & 0xC0) != 0x80, out=upto[1:])
        offs = upto[offs]
        known = np.bincount(codes) > 0
        codes = np.cumsum(known).astype(np.uint8 if known.sum() < 256 else np.uint32)[codes]
    size = np.diff(offs)
    place_x, place_y = place[:len(x)], place[len(x):]
    out, columns = np.zeros(len(x), bool), size[place_y]
    words = most // 32 + 1
    words = np.where(words > 4, 1 << np.ceil(np.log2(words)).astype(np.int64), words)
    order = np.lexsort((-columns, words))
    start = 0
    while start < len(order):  # pairs of one width of the band, longest first
        n = int(words[order[start]])
        wide = int(max(size[place_x[order[start]]], columns[order[start]]) + most[order[start]]) + 128 * n
        stop = min(int(np.searchsorted(words[order], n, side="right")), start + max(1, BAND_BYTES // (wide * codes.itemsize)))
        at = order[start:stop]
        if len(at) >= FEW_PAIRS:
            out[at] = _banded(codes, offs, place_x[at], place_y[at], most[at], n)
        else:  # too few to be worth rows of numbers
            for k in at.tolist():
                out[k] = edit_distance(lines[int(x[k])].as_py(), lines[int(y[k])].as_py(), int(most[k])) <= most[k]
        start = stop
    return out


def _laid(codes: np.ndarray, offs: np.ndarray, rows: np.ndarray, before: int, behind: int) -> np.ndarray:
    """Rows side by side, with zeros before and behind."""
    size = offs[rows + 1] - offs[rows]
    out = np.zeros((len(rows), before + int(size.max()) + behind), codes.dtype)
    owner = np.repeat(np.arange(len(rows)), size)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    out[owner, before + k] = codes[np.repeat(offs[rows], size) + k]
    return out


def _banded(codes: np.ndarray, offs: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray, words: int) -> np.ndarray:
    """within_edits() for pairs whose band fits ``words`` numbers of 64 bits.

    Bit ``middle`` of a column stands for the diagonal, so the band moves down
    one row a column, and what lies outside costs more than ``most``. Distances
    never fall along a diagonal, so a pair ends where that of its last cell
    passes ``most``.
    """
    middle, at = 32 * words, np.arange(len(x))
    columns, lean = offs[y + 1] - offs[y], offs[x + 1] - offs[x] - offs[y + 1] + offs[y]
    a, b = _laid(codes, offs, x, middle, 64 * words + int(columns.max())), np.ascontiguousarray(_laid(codes, offs, y, 0, 0).T)
    out, last, ones, one = np.zeros(len(x), bool), np.maximum(lean, 0), ~np.uint64(0), np.uint64(1)
    near = np.abs(lean) <= most
    place = np.where(near, middle + lean, 0)
    held, bit = place // 64, (place % 64).astype(np.uint64)
    plus = np.zeros((words, len(x)), np.uint64)
    for w in range(words):
        if 64 * (w + 1) > middle:
            plus[w] = ones << np.uint64(max(0, middle - 64 * w))
    minus, stop = np.zeros_like(plus), columns.copy()
    for j in range(len(b) + 1):
        if j % 8 == 0 or j == len(b):
            on = near & (last <= most[at])
            out[at[on & (stop <= j)]] = True
            on &= stop > j
            if not on.all():
                at, last, held, bit, stop, near, plus, minus = at[on], last[on], held[on], bit[on], stop[on], near[on], plus[:, on], minus[:, on]
            if not len(at):
                break
        equal = np.packbits(a[at, j:j + 64 * words] == b[j, at][:, None], axis=1, bitorder="little").view(np.uint64).T
        zero = (equal & plus) + plus
        if words > 1:
            over, full, carry = zero < plus, zero == ones, np.zeros_like(plus)
            for w in range(1, words):
                carry[w] = over[w - 1] | full[w - 1] & (carry[w - 1] == one)
            zero += carry
        zero ^= plus  # where the distance is that of the cell up left
        zero |= equal
        zero |= minus
        up, down = minus | ~(zero | plus), zero & plus
        last = last + ((stop > j) & (zero[held, np.arange(len(at))] >> bit & one == 0))
        over = zero[1:] << np.uint64(63)
        zero >>= one
        zero[:-1] |= over
        plus, minus = down | ~(zero | up), zero & up
    return out


def verified_links(group: np.ndarray, rows: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, row) that connect what the verified pairs of each group connect."""
    side, crossed = rows.column("side").to_numpy(), rows.column("i").to_numpy() != rows.column("j").to_numpy()
    p0, p1 = (rows.column(c).to_numpy().view(np.uint64) for c in ("p0", "p1"))
    lines = rows.column("line").combine_chunks()
    chars, words, labels = pa.compute.utf8_length(lines).to_numpy(), Words(lines), np.arange(len(side))

    def apart(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = labels[a] != labels[b]  # most pairs of a dense group are connected by now
        return a[wanted], b[wanted]

    def similar_pairs(a: np.ndarray, b: np.ndarray, test) -> np.ndarray:
        nonlocal labels
        most = ((1 - least) * np.maximum(chars[a], chars[b]) + 1e-9).astype(np.int64)
        found = test(a, b, most)
        labels = union(labels, a[found], b[found])
        return found

    def settled(pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        for k in range(0, len(a), PAIRS_AT_ONCE):
            similar_pairs(*apart(a[k:k + PAIRS_AT_ONCE], b[k:k + PAIRS_AT_ONCE]), lambda *x: within_edits(lines, *x))

    waiting, doubtful = [], []
    for a, b in itertools.chain(close_pairs(group, chars, least), [(None, None)]):
        if a is not None:
            wanted = (labels[a] != labels[b]) & (~crossed[a] | (side[a] != side[b]))
            a, b = a[wanted], b[wanted]
            near = np.bitwise_count(p0[a] ^ p0[b]) + np.bitwise_count(p1[a] ^ p1[b]) <= MAX_BITS
            waiting.append((a[near], b[near]))
        if waiting and (a is None or sum(len(x) for x, _ in waiting) >= PAIRS_AT_ONCE):
            a_, b_ = apart(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            found = similar_pairs(a_, b_, words.within)
            doubtful, waiting = [*doubtful, (a_[~found], b_[~found])], []
        if doubtful and (a is None or sum(len(x) for x, _ in doubtful) >= HELD_PAIRS):
            settled(doubtful)
            doubtful = []
    child = np.flatnonzero(labels != np.arange(len(labels)))
    return child, labels[child]


def several_groups(groups: Iterator[tuple[np.ndarray, pa.Table]]) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """whole_groups() with as many groups at a time as ``GROUP_ROWS`` rows and ``GROUP_BYTES`` bytes need."""
    held, rows, size = [], 0, 0
    for group, part in groups:
        held.append((group - group[0] + (held[-1][0][-1] + 1 if held else 0), part))
        rows, size = rows + len(part), size + part.nbytes
        if rows >= GROUP_ROWS or size >= GROUP_BYTES:
            yield np.concatenate([g for g, _ in held]), pa.concat_tables([p for _, p in held])
            held, rows, size = [], 0, 0
    if held:
        yield np.concatenate([g for g, _ in held]), pa.concat_tables([p for _, p in held])


def line_links(texts: DataFrame, groups: DataFrame, least: float = MIN_SIMILARITY, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A spanning set of links (a, b) between digests of distinct lines (digest, line, p0, p1); ``groups`` (bucket, p0, p1) are to be verified."""
    large = (groups.join(texts.select("p0", "p1"), ["p0", "p1"]).groupBy("bucket").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
             .where("chunks > 1"))
    chunks = F.coalesce("chunks", F.lit(1))
    own = F.pmod(F.xxhash64("digest"), "chunks").cast("int")
    paired = (texts.join(groups.join(large, "bucket", "left").withColumn("chunks", chunks).hint("shuffle_hash"), ["p0", "p1"]).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "digest", "line", "p0", "p1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in several_groups(whole_groups(batches, ["bucket", "i", "j"])):
            a, b = verified_links(group, rows, least)
            digests = rows.column("digest").combine_chunks()
            yield pa.RecordBatch.from_arrays([digests.take(pa.array(a, pa.int64())), digests.take(pa.array(b, pa.int64()))], names=["a", "b"])

    return paired.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(frugal(run), "a binary, b binary")


def duplicate_lines(lines: DataFrame, least: float = MIN_SIMILARITY) -> DataFrame:
    """(number, line_no) of the lines to remove, from a written line table."""
    distinct = written(lines.groupBy("digest").agg(F.count("*").alias("n"), F.max("chars").alias("chars"), F.max("p0").alias("p0"), F.max("p1").alias("p1")),
                       "distinct-lines")
    # lines with one print are a group as well
    same = (distinct.where("chars > 0").groupBy("p0", "p1").agg(F.count("*").alias("lines")).where("lines > 1")
            .select(F.xxhash64("p0", "p1", F.lit(0)).alias("bucket"), "p0", "p1"))
    groups = written(candidate_groups(lines).unionByName(same), "line-groups")
    marked = written(groups.select("p0", "p1").distinct(), "marked-lines")
    key = F.concat_ws(" ", "p0", "p1").alias("key")
    maybe = lines.where("chars > 0").select("digest", "line", "p0", "p1", key)
    bloom, blocks = bloom_blocks(marked.select(key))
    if blocks * BLOCK_BYTES <= BROADCAST_BYTES:  # spares the unmarked lines the shuffle of the join; beyond, the join alone
        maybe = maybe_listed(maybe, bloom, blocks)
    texts = maybe.join(marked.hint("shuffle_hash"), ["p0", "p1"]).groupBy("digest", "p0", "p1").agg(F.min("line").alias("line"))
    roots = components(line_links(written(texts, "marked-texts"), groups, least))
    linked = roots.select(F.col("node").alias("digest"), "root").unionByName(roots.select(F.col("root").alias("digest"), "root").distinct())
    named = distinct.where("n > 1").select("digest").join(linked, "digest", "full").select("digest", F.coalesce("root", "digest").alias("root"))
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "number", "line_no").alias("place")
    members = written(lines.select("digest", place).join(named.hint("shuffle_hash"), "digest").select("root", "place"), "members")
    firsts = members.groupBy("root").agg(F.min("place").alias("first"))
    return members.join(firsts.hint("shuffle_hash"), "root").where(~F.col("place").eqNullSafe(F.col("first"))).select("place.number", "place.line_no")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                least: float = MIN_SIMILARITY, counts: bool = False) -> DataFrame:
    """``docs`` with duplicate lines taken out of ``text``; ``counts`` adds (or replaces) n_lines and n_removed."""
    rows = numbered(docs)
    lines = written(line_table(rows, key, text, min_chars), "lines")
    gone = duplicate_lines(lines, least).groupBy("number").agg(F.collect_set("line_no").alias("gone"))
    pieces = F.split(F.col(f"doc.`{text}`").cast("string"), "\n", -1)
    kept = F.filter(pieces, lambda x, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    added = {"n_lines": F.coalesce(F.size(pieces), F.lit(0)).cast("long"), "n_removed": F.coalesce(F.size("gone"), F.lit(0)).cast("long")} if counts else {}
    left = F.when(F.col("gone").isNull(), F.col(f"doc.`{text}`").cast("string")).otherwise(F.array_join(kept, "\n"))
    return (rows.join(gone.hint("shuffle_hash"), "number", "left")
            .select(*[left.alias(c) if c == text else F.col(f"doc.`{c}`") for c in docs.columns if c not in added],
                    *[v.alias(c) for c, v in added.items()]))
