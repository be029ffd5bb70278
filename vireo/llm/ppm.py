"""Language-model scores by prediction by partial matching (PPM) over a byte-context trie.

A text is scored as its words: A-Z lowered, one blank between words, an end
mark after the last. The trie holds, for every context of up to ``ORDER``
symbols, how often each symbol follows it in the training texts. A symbol is
predicted from the longest context; where that has not seen it, the model
escapes (method D: a context with n symbols, d of them distinct, gives a symbol
seen c times (2c - 1) / 2n and the escape d / 2n) to the next shorter context,
from which symbols seen in the longer one are excluded. After the empty
context the symbols never seen share what is left.

The probability of a position depends only on its last ``ORDER`` + 1 symbols
(its gram), and texts repeat grams. So documents are packed in blocks of some
MB, and a block gives its distinct grams with their training counts, as sorted
arrays per key range. Spark sums these into the trie, finds the probability of
each distinct gram by joins with the trie, and hands every block the
probabilities of its own grams. No task needs the trie: a range holds as many
keys as about ``RANGE_BYTES`` of text bring, a block's share is bounded by the
block. Words and their training counts, for the unigram base, go the same way
by a 64-bit hash (two of n different words share one with chance n^2 / 2^65).

Defined results: null and empty texts have the end token only. A null doc_id
is not held out. Repeated rows each get a row and each count. Without training
texts every symbol has probability 1/257 and the base score is 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import LOWER, NOT_SPACE, crc_fold, frugal, mixed, release, row_sums, slices, text_bytes, word_hashes, word_spans, written

ORDER = 5
SYMBOL_BITS = 9
#: Symbols: 0 before the text, byte + 1, and the end.
END = 257
SYMBOLS = 257
#: Contexts of fewer symbols than this are broadcast.
SHORT = 2
BLOCK_BYTES = 16 << 20
RANGE_BYTES = 16 << 20
#: A block number that no block has: what belongs to the corpus as a whole.
CORPUS = -1

BLOCK_SCHEMA = "block long, size long, doc_ids binary, held binary, ends binary, text binary"
KEY_SCHEMA = "kind int, p int, block long, keys binary, counts binary"
SHARE_SCHEMA = "block long, kind int, p int, keys binary, numbers binary"
SCORE_SCHEMA = "block long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, total long, different long"
GRAM, WORD = 0, 1


def pack_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, held, text) as a written table of blocks, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        schema = pa.schema([("block", pa.int64()), ("size", pa.int64()), *[(c, pa.binary()) for c in ("doc_ids", "held", "ends", "text")]])
        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            part = pa.Table.from_batches(held).combine_chunks()
            ids = part.column(0).combine_chunks()
            parts = [text_bytes(b.column(2)) for b in held]
            sizes = np.concatenate([np.diff(o) for _, o in parts])
            row = {"block": first + made, "size": int(sizes.sum()), "held": part.column(1).to_numpy().tobytes(), "ends": np.cumsum(sizes).astype("<i8").tobytes(),
                   "doc_ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes() + ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                   "text": b"".join(LOWER[b].tobytes() for b, _ in parts)}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for a, b in slices(batch.column(2)):
                held.append(batch.slice(a, b - a))
                size += int(pc.sum(pc.binary_length(held[-1].column(2))).as_py() or 0)
                if size >= BLOCK_BYTES:
                    yield block()
                    held, size, made = [], 0, made + 1
        if held:
            yield block()

    return written(docs.mapInArrow(frugal(run), BLOCK_SCHEMA), "ppm-blocks")


class Block:
    """A block row, read in slices of documents."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.ends = np.frombuffer(row["ends"], "<i8")
        n = len(self.ends)
        self.keys = np.frombuffer(row["doc_ids"][:8 * n], "<i8")
        self.null = np.frombuffer(row["doc_ids"][8 * n:], bool)
        self.held = np.frombuffer(row["held"], bool)
        self.text = np.frombuffer(row["text"], np.uint8)

    def parts(self, limit: int = 2 << 20) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """(documents, their bytes, their offsets) of about ``limit`` bytes."""
        start = 0
        while start < len(self.ends):
            base = self.ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(self.ends, base + limit, "right")))
            offs = np.concatenate([[base], self.ends[start:stop]])
            yield slice(start, stop), self.text[base:offs[-1]], offs - base
            start = stop


def grams_of(buf: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The gram of every symbol of every text, the first gram of each text (and the end), and the word spans."""
    starts, ends, firsts = word_spans(buf, offs, NOT_SPACE)
    counts = np.diff(firsts)
    # a word and the symbol after it; a text without words is one empty word
    place = firsts[:-1][counts == 0]
    sizes = np.insert(ends - starts, place, 0) + 1
    words = np.maximum(counts, 1)
    last = np.cumsum(words) - 1
    text_of = np.repeat(np.arange(len(words)), words)
    after = np.cumsum(sizes) - 1 + (text_of + 1) * order  # where each word's closing symbol goes; every text follows ``order`` zeros
    stream = np.zeros(int(sizes.sum()) + len(words) * order, np.uint64)
    symbol = np.ones(len(stream), bool)
    symbol[after] = False
    lengths = row_sums(sizes, np.concatenate([[0], last + 1]))
    begin = np.cumsum(lengths + order) - lengths - order
    symbol[(begin[:, None] + np.arange(order)).ravel()] = False
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    stream[symbol] = buf[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)].astype(np.uint64) + np.uint64(1)
    stream[after] = 0x20 + 1
    stream[after[last]] = END
    gram = np.zeros(len(stream), np.uint64)
    for k in range(order, -1, -1):
        gram[k:] |= stream[:len(stream) - k] << np.uint64(SYMBOL_BITS * k)
    real = symbol
    real[after] = True
    return gram[real].view(np.int64), np.concatenate([[0], np.cumsum(lengths)]), (starts, ends, firsts)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    codes, distinct = pd.factorize(np.concatenate(keys))
    total = np.bincount(codes, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    order = np.argsort(distinct)
    return distinct[order], total[order]


def block_counts(block: Block, order: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Distinct grams and word hashes of a block, in order, with their training counts."""
    found: dict[int, tuple[list, list]] = {GRAM: ([], []), WORD: ([], [])}
    for docs, buf, offs in block.parts():
        train = ~block.held[docs]
        grams, firsts, (starts, ends, word_firsts) = grams_of(buf, offs, order)
        words = word_hashes(buf, starts, ends).view(np.int64)
        for kind, keys, cut in ((GRAM, grams, firsts), (WORD, words, word_firsts)):
            codes, distinct = pd.factorize(keys)
            found[kind][0].append(distinct)
            found[kind][1].append(np.bincount(codes, weights=np.repeat(train, np.diff(cut)), minlength=len(distinct)))
    return {kind: summed(*lists) for kind, lists in found.items()}


def squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def expanded(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def keys_of(data: bytes) -> np.ndarray:
    """Sorted keys, stored as their differences."""
    return np.cumsum(expanded(data))


def block_keys(blocks: DataFrame, order: int, ranges: int) -> DataFrame:
    """One row per block, kind and key range: sorted keys and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("p", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0])
                rows = []
                for kind, (keys, counts) in block_counts(block, order).items():
                    of = (mixed(keys.view(np.uint64)) >> np.uint64(20)) % np.uint64(ranges)
                    place = np.argsort(of, kind="stable")
                    cuts = np.searchsorted(of[place], np.arange(ranges + 1))
                    for p in range(ranges):
                        part = place[cuts[p]:cuts[p + 1]]
                        if len(part):
                            rows.append({"kind": kind, "p": p, "block": block.number, "keys": squeezed(np.diff(keys[part], prepend=0)), "counts": squeezed(counts[part])})
                del block
                release()
                yield pa.RecordBatch.from_pylist(rows, schema)

    return blocks.mapInArrow(frugal(run), KEY_SCHEMA)


def gram_totals(group: pa.Table) -> pa.Table:
    """Training counts of the grams of a key range, over all blocks."""
    rows = group.to_pylist()
    grams, counts = summed([keys_of(r["keys"]) for r in rows], [expanded(r["counts"]) for r in rows])
    return pa.table({"p": pa.array(np.full(len(grams), rows[0]["p"], np.int32)), "gram": grams, "c": counts})


def _shares(rows: list[dict], numbers: list[bytes]) -> list[dict]:
    return [{"block": r["block"], "kind": r["kind"], "p": r["p"], "keys": r["keys"], "numbers": n} for r, n in zip(rows, numbers, strict=True)]


SHARES = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("p", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary())])


def gram_shares(keys: pa.Table, values: pa.Table) -> pa.Table:
    """The values of each block's grams of a key range."""
    rows, grams = keys.to_pylist(), values.column("gram").to_numpy()
    order = np.argsort(grams)
    grams, value = grams[order], values.column("value").to_numpy()[order]
    return pa.Table.from_pylist(_shares(rows, [squeezed(value[np.searchsorted(grams, keys_of(r["keys"]))].astype(np.float32)) for r in rows]), SHARES)


def word_shares(group: pa.Table) -> pa.Table:
    """The corpus counts of each block's words of a key range, and the range's tokens and different words."""
    rows = group.to_pylist()
    keys = [keys_of(r["keys"]) for r in rows]
    words, counts = summed(keys, [expanded(r["counts"]) for r in rows])
    out = _shares(rows, [squeezed(counts[np.searchsorted(words, k)]) for k in keys])
    out.append({"block": CORPUS, "kind": WORD, "p": rows[0]["p"], "keys": b"", "numbers": squeezed(np.array([counts.sum(), (counts > 0).sum()], np.int64))})
    return pa.Table.from_pylist(out, SHARES)


def gram_scores(counts: DataFrame, order: int) -> DataFrame:
    """(p, gram, value): log10 probability of the last symbol of every distinct gram, by escapes through the trie.

    ``counts`` has every gram, its key range p and its training count c (0: only in texts that are scored).
    """
    def mask(symbols: Column) -> Column:
        return F.pow(F.lit(2.0), symbols * SYMBOL_BITS).cast("long") - 1

    def low(k: Column, gram: str = "gram") -> Column:
        """The last k + 1 symbols of a gram."""
        return F.col(gram).bitwiseAND(mask(k + 1))

    levels = F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k")
    trie = written(counts.where("c > 0").select(levels, "gram", "c").select("k", low(F.col("k")).alias("gram"), "c")
                   .groupBy("k", "gram").agg(F.sum("c").alias("c")), "ppm-trie")
    context = F.shiftright("gram", SYMBOL_BITS).alias("context")
    contexts = trie.groupBy("k", context).agg(F.sum("c").alias("n"), F.count("*").alias("d"))
    # what a context one symbol longer excludes: its symbols' counts here, and how many they are
    longer = trie.where("k > 0").select((F.col("k") - 1).alias("k"), F.col("gram").alias("long_gram"), low(F.col("k") - 1).alias("gram"))
    excluded = (longer.join(trie, ["k", "gram"]).groupBy("k", F.shiftright("long_gram", SYMBOL_BITS).alias("long_context"))
                .agg(F.sum("c").alias("out_n"), F.count("*").alias("out_d")))
    tried = F.explode(F.when(F.col("c") > 0, F.array(F.lit(order))).otherwise(F.sequence(F.lit(0), F.lit(order)))).alias("k")
    asked = (counts.select("p", F.col("gram").alias("whole"), tried)
             .select("p", "whole", "k", low(F.col("k"), "whole").alias("gram"),
                     F.shiftright("whole", SYMBOL_BITS).bitwiseAND(mask(F.col("k"))).alias("context"),
                     F.when(F.col("k") < order, F.shiftright("whole", SYMBOL_BITS).bitwiseAND(mask(F.col("k") + 1)))
                     .otherwise(-1 - F.pmod(F.xxhash64("whole"), F.lit(1 << 30))).alias("long_context")))  # no context: spread, not one hot null

    def looked_up(at: Column, side: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return (asked.where(at).join(side(trie.where(at)), ["k", "gram"], "left").join(side(contexts.where(at)), ["k", "context"], "left")
                .join(side(excluded.where(at)), ["k", "long_context"], "left")
                .select("p", "whole", "k", "c", (F.col("n") - F.coalesce("out_n", F.lit(0))).alias("n"), (F.col("d") - F.coalesce("out_d", F.lit(0))).alias("d"),
                        F.col("d").alias("seen")))

    # every unseen gram asks the few keys of the short contexts: at most 258 * 258 rows by their length, so they go to the grams
    short = F.col("k") < SHORT
    steps = looked_up(short, F.broadcast).unionByName(looked_up(~short, lambda rows: rows))
    # the floor below the empty context
    floor = F.try_divide(F.lit(1.0), F.lit(SYMBOLS) - F.coalesce(F.max(F.when(F.col("k") == 0, F.col("seen"))), F.lit(0)))
    hit = F.max(F.when(F.col("c").isNotNull(), F.struct("k", F.log10(F.try_divide(2 * F.col("c") - 1, 2 * F.col("n"))).alias("p"))))
    escapes = F.array_agg(F.when(F.col("c").isNull() & (F.col("d") > 0), F.struct("k", F.log10(F.try_divide(F.col("d"), 2 * F.col("n"))).alias("p"))))
    return (steps.groupBy("p", "whole").agg(hit.alias("hit"), escapes.alias("escapes"), F.log10(floor).alias("floor"))
            .select("p", F.col("whole").alias("gram"),
                    (F.coalesce("hit.p", "floor") + F.aggregate(F.filter("escapes", lambda e: e["k"] > F.coalesce(F.col("hit.k"), F.lit(-1))),
                                                               F.lit(0.0), lambda s, e: s + e["p"])).alias("value")))


def score_block(block: Block, grams: np.ndarray, value: np.ndarray, words: np.ndarray, count: np.ndarray, order: int, ends: int) -> dict[str, np.ndarray]:
    """Sums over the documents of a block; ``ends`` is the end token's training count.

    ``base`` leaves out the denominator, which is the same for every token.
    """
    by_gram, by_word = pd.Index(grams), pd.Index(words)
    weight, out = np.log10(count + 0.5), {k: [] for k in ("n_tokens", "n_known", "base", "score")}
    for _, buf, offs in block.parts():
        found, firsts, (starts, stops, word_firsts) = grams_of(buf, offs, order)
        out["score"].append(row_sums(value[by_gram.get_indexer(found)], firsts))
        place = by_word.get_indexer(word_hashes(buf, starts, stops).view(np.int64))
        out["base"].append(row_sums(weight[place], word_firsts) + np.log10(ends + 0.5))
        out["n_known"].append(row_sums((count[place] > 0).astype(np.int64), word_firsts) + int(ends > 0))
        out["n_tokens"].append(np.diff(word_firsts) + 1)
    return {k: np.concatenate(v) for k, v in out.items()}


def ppm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", holdout: tuple[int, int] = (5, 1), order: int = ORDER) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Documents whose crc32(key as text) leaves ``holdout`` = (modulus, remainder) teach nothing.
    """
    held = F.coalesce(crc_fold(key, holdout[0]) == holdout[1], F.lit(False))
    ends = docs.where(~held).count()
    blocks = pack_blocks(docs.select(docs[key].cast("long").alias("doc_id"), held.cast("byte").alias("held"), docs[text].cast("string").alias("text")))
    size = blocks.agg(F.sum("size")).first()[0] or 0
    keys = written(block_keys(blocks, order, max(1, -(-size // RANGE_BYTES))), "ppm-keys")
    grams, words = keys.where(F.col("kind") == GRAM), keys.where(F.col("kind") == WORD)
    totals = written(grams.groupBy("p").applyInArrow(gram_totals, "p int, gram long, c long"), "ppm-grams")
    values = written(gram_scores(totals, order), "ppm-values")
    shares = (grams.groupBy("p").cogroup(values.groupBy("p")).applyInArrow(gram_shares, SHARE_SCHEMA)
              .unionByName(words.groupBy("p").applyInArrow(word_shares, SHARE_SCHEMA)))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = right.to_pylist()
        if not len(left):  # the corpus
            both = sum((expanded(r["numbers"]) for r in rows), np.zeros(2, np.int64))
            nothing = pa.nulls(1)
            cols = [pa.array([CORPUS]), *[nothing] * 6, pa.array([int(both[0])]), pa.array([int(both[1])])]
            return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cols, SCORES, strict=True)], schema=SCORES)
        release()
        block, part = Block(left.to_pylist()[0]), {}
        for kind, number in ((GRAM, np.float32), (WORD, np.int64)):
            own = [r for r in rows if r["kind"] == kind]
            part[kind] = (np.concatenate([keys_of(r["keys"]) for r in own] or [np.empty(0, np.int64)]),
                          np.concatenate([expanded(r["numbers"], number) for r in own] or [np.empty(0, number)]).astype(np.float64 if kind == GRAM else np.int64))
        cols = score_block(block, *part[GRAM], *part[WORD], order, ends)
        n = len(block.ends)
        return pa.Table.from_arrays([pa.array(np.full(n, block.number)), pa.array(block.keys, pa.int64(), mask=block.null), pa.array(block.held), pa.array(cols["n_tokens"]),
                                     pa.array(cols["n_known"]), pa.array(cols["base"]), pa.array(cols["score"]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=SCORES)

    scored = written(blocks.groupBy("block").cogroup(shares.groupBy("block")).applyInArrow(score, SCORE_SCHEMA), "ppm-scores")
    corpus = scored.where(F.col("block") == CORPUS).agg(F.sum("total").alias("tokens"), F.sum("different").alias("different")).first()
    total, different = (corpus.tokens or 0) + ends, (corpus.different or 0) + (ends > 0)
    share = F.log10(F.lit(total + 0.5 * (different + 1)))
    return scored.where(F.col("block") != CORPUS).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * share).alias("base_score"), "score")


SCORES = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("base", pa.float64()), ("score", pa.float64()), ("total", pa.int64()), ("different", pa.int64())])
