"""Byte-level BPE by recursive DuckDB queries inside each Spark partition.

The pieces that a text splits into become rows (word, position, token), one
per byte at first. A recursive query joins neighbouring rows with the merge
table, takes each word's pair of least rank (leftmost among equals), contracts
it and goes on until no word has a pair left. Decoding joins ids with the
vocabulary and puts the bytes together by an ordered aggregate.

A recursive query keeps the rows of every round, the square of a piece's
length. Pieces above ``LONG_PIECE`` bytes (no prose has them) are therefore
contracted by the same rule with a heap, in memory proportional to the piece.

Words repeat, so a slice of texts is first reduced to its distinct pieces, and
an id sequence to its distinct runs between blanks; the queries see each once,
and Arrow gathers put the texts together. A worker's connection keeps what it
has encoded and decoded in two tables and starts them anew at ``MEMORY_ROWS``
rows. A partition passes through in slices of ``SLICE`` bytes, whatever its size.

Defined results: null and empty texts have no ids and decode to nothing.
Special tokens are ordinary text. Each row is encoded on its own, so repeated
rows and ties get equal results. An id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from vireo.llm.common import binary_array, chunk_table, frugal, gathered, slices, text_bytes, word_array

SLICE = 8 << 20
MEMORY_ROWS = 500_000
LONG_PIECE = 512

#: Letters A-Z, a-z (ASCII) and closing marks.
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
CLOSING = np.zeros(256, bool)
CLOSING[list(b".,;:!?")] = True

ENCODE = """
WITH RECURSIVE step(word, pos, tok, round) AS (
  SELECT word, pos, tok, 0 FROM bytes
  UNION ALL
  SELECT s.word, s.pos - (s.pos > b.place)::INTEGER, CASE WHEN s.pos = b.place THEN b.merged ELSE s.tok END, s.round + 1
  FROM step s
  JOIN (SELECT word, (least_pair % 65536)::INTEGER AS place, (least_pair // 65536)::INTEGER AS merged
        FROM (SELECT x.word, min(m.merged * 65536 + x.pos) AS least_pair
              FROM step x JOIN step y ON y.word = x.word AND y.pos = x.pos + 1
              JOIN merges m ON m.pair = x.tok * 4294967296 + y.tok
              GROUP BY x.word)) b ON b.word = s.word
  WHERE s.pos <> b.place + 1)
SELECT s.word, s.tok
FROM step s JOIN (SELECT word, max(round) AS last FROM step GROUP BY word) e ON e.word = s.word AND e.last = s.round
ORDER BY s.word, s.pos"""

DECODE = """
SELECT i.run, string_agg(v.bytes, '' ORDER BY i.pos) AS decoded
FROM ids i JOIN vocabulary v ON v.tok = i.tok
GROUP BY i.run"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """A vocabulary in a DuckDB connection of its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.singles = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[r for t, r in ranks.items() if t[:1] == b" "]] = True
        self.decimals = pa.array([b"%d," % i for i in range(len(self.opens))], pa.binary())
        self.words_are_pieces = self.pattern.findall(" ab, c") == [" ab", ",", " c"]
        splits = [(ranks[t[:k]] << 32 | ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.merges = dict(splits)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "preserve_insertion_order": False})
        self._keep("merges", pair=np.array([s for s, _ in splits], np.int64), merged=np.array([r for _, r in splits], np.int64))
        # bytes as the characters of the same numbers, so that string_agg can join them
        self._keep("vocabulary", tok=np.array(list(ranks.values()), np.int64), bytes=[t.decode("latin-1") for t in ranks])
        self.kept = {}
        for table in ("encoded", "decoded"):
            self.con.execute(f"CREATE TABLE {table}(k BLOB, v BLOB)")
            self.kept[table] = 0

    def _keep(self, name: str, **columns) -> None:
        self.con.register("incoming", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def _rows(self, name: str, query: str, **columns) -> pa.Table:
        self.con.register(name, pa.table(columns))
        out = self.con.sql(query).to_arrow_table()
        self.con.unregister(name)
        return out

    def remembered(self, table: str, keys: pa.Array, work: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The value of every key: from the worker's table, or by ``work``, which the table then keeps."""
        hits = self._rows("wanted", f"SELECT w.n, t.v FROM wanted w JOIN {table} t ON t.k = w.k", n=np.arange(len(keys), dtype=np.int32), k=keys)
        found = hits.column("n").to_numpy()
        missing = np.ones(len(keys), bool)
        missing[found] = False
        fresh = np.flatnonzero(missing)
        unseen = keys.take(pa.array(fresh))
        values = work(unseen) if len(fresh) else pa.array([], pa.binary())
        self.con.register("incoming", pa.table({"k": unseen, "v": values}))
        if self.kept[table] + len(fresh) > MEMORY_ROWS:
            self.con.execute(f"CREATE OR REPLACE TABLE {table}(k BLOB, v BLOB)")
            self.kept[table] = 0
        self.con.execute(f"INSERT INTO {table} SELECT * FROM incoming")
        self.con.unregister("incoming")
        self.kept[table] += len(fresh)
        place = np.empty(len(keys), np.int64)
        place[np.concatenate([found, fresh])] = np.arange(len(keys))
        return pa.concat_arrays([hits.column("v").combine_chunks(), values]).take(pa.array(place))

    def tokens(self, pieces: pa.Array, rows: int = 2_000_000) -> pa.Array:
        """The ids of every piece as little-endian 32-bit numbers. Queries take pieces
        of like length, so that all rounds of one stay near ``rows`` rows."""
        sizes = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(sizes, kind="stable")
        short = int(np.searchsorted(sizes[order], LONG_PIECE, "right"))
        cost = np.cumsum(sizes[order[:short]] ** 2 // 2 + 1)
        parts, at = [], 0
        while at < short:
            stop = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + rows, "right")))
            parts.append(self._query(pieces.take(pa.array(order[at:stop]))))
            at = stop
        for i in order[short:]:
            ids = self._contract(pieces[int(i)].as_py())
            parts.append(binary_array(ids.astype("<i4").tobytes(), np.array([0, 4 * len(ids)])))
        if not parts:
            return pa.array([], pa.binary())
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return pa.concat_arrays(parts).take(pa.array(back))

    def _query(self, pieces: pa.Array) -> pa.Array:
        buf, offs = text_bytes(pieces)
        sizes = np.diff(offs)
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        place = np.arange(len(word)) - np.repeat(offs[:-1], sizes)
        found = self._rows("bytes", ENCODE, word=word, pos=place.astype(np.int32), tok=self.singles[buf])
        firsts = np.searchsorted(found.column("word").to_numpy(), np.arange(len(pieces) + 1))
        return binary_array(found.column("tok").to_numpy().astype("<i4").tobytes(), 4 * firsts)

    def _contract(self, piece: bytes) -> np.ndarray:
        toks, after = [int(self.singles[b]) for b in piece], list(range(1, len(piece) + 1))
        before, n = list(range(-1, len(piece) - 1)), len(piece)
        pair = lambda i: self.merges.get(toks[i] << 32 | toks[after[i]]) if after[i] < n else None
        heap = [(r, i) for i in range(n) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if toks[i] < 0 or pair(i) != rank:
                continue  # one of the two has been merged since
            gone, toks[i] = after[i], rank
            toks[gone], after[i] = -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := pair(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return np.array([t for t in toks if t >= 0], np.int64)

    def pieces(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(pieces of all chunks, order in which the chunks stand there, first piece of each and the end).

        A blank and letters, perhaps with a closing mark, are one or two
        pieces by their bytes; the pattern splits every other chunk.
        """
        buf, offs = text_bytes(chunks)
        begin, end = offs[:-1], offs[1:]
        behind_c3 = np.zeros(len(buf), bool)
        behind_c3[1:] = buf[:-1] == 0xC3  # U+00C0 to U+00FF, all letters but two
        letter = ASCII_LETTER[buf] | (buf == 0xC3) | (behind_c3 & (buf != 0x97) & (buf != 0xB7))
        other = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(~letter, out=other[1:])
        closed = CLOSING[buf[end - 1]] & (end - begin > 2)
        plain = (buf[begin] == 0x20) & (end - begin > 1) & (other[end - closed] - other[begin + 1] == 0) & self.words_are_pieces
        easy, hard = np.flatnonzero(plain), np.flatnonzero(~plain)
        cuts = np.zeros(len(buf) + 1, bool)
        cuts[begin[easy]] = True
        cuts[end[easy][closed[easy]] - 1] = True
        edges = np.flatnonzero(cuts)
        stops = np.append(edges[1:], len(buf))
        last = np.searchsorted(edges, begin[easy]) + closed[easy]
        stops[last] = end[easy]
        simple = word_array(buf, edges, stops)
        split = [self.pattern.findall(c) for c in chunks.take(pa.array(hard)).to_pylist()]
        rest = pa.array([p.encode() for p in chain.from_iterable(split)], pa.binary())
        counts = np.concatenate([1 + closed[easy].astype(np.int64), np.array([len(p) for p in split], np.int64)])
        return pa.concat_arrays([simple, rest]), np.concatenate([easy, hard]), np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])

    def encode(self, texts: pa.Array) -> list[tuple[bytes, bytes]]:
        """Ids of every text (null: none), as little-endian 32-bit numbers and as decimals joined by commas."""
        chunks, codes, firsts = chunk_table(texts)
        if not len(chunks):
            return [(b"", b"")] * len(texts)
        pieces, order, first_piece = self.pieces(chunks)
        coded = pieces.dictionary_encode()
        ids = self.remembered("encoded", coded.dictionary, self.tokens)
        numbers, offs = text_bytes(ids)
        flat = np.ascontiguousarray(numbers).view("<i4")
        decimals, places = text_bytes(self.decimals.take(pa.array(flat)))
        shown = binary_array(np.ascontiguousarray(decimals), places[offs // 4])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place = pa.array(place[codes.to_numpy()])
        both = []
        for values in (ids, shown):
            buf, cut = gathered(values, coded.indices, first_piece)  # of the chunks
            buf, at = gathered(binary_array(np.ascontiguousarray(buf), cut), place, firsts)  # of the texts
            both.append((buf.tobytes(), at))
        (numbers, a), (shown, b) = both
        return [(numbers[a[i]:a[i + 1]], shown[b[i]:b[i + 1]].rstrip(b",")) for i in range(len(texts))]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of every id sequence, from the ids alone; sequences are cut
        before ids that stand for a blank and more, and each distinct run is decoded once."""
        flat = np.frombuffer(b"".join(ids), "<i4")
        if not len(flat):
            return [b""] * len(ids)
        if flat.min() < 0 or flat.max() >= len(self.opens):
            raise ValueError("id outside the vocabulary")
        offs = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(i) // 4 for i in ids])])
        cut = np.append(self.opens[flat], True)
        cut[offs] = True
        edges = np.flatnonzero(cut)
        coded = binary_array(np.ascontiguousarray(flat), 4 * edges).dictionary_encode()
        parts = self.remembered("decoded", coded.dictionary, self.bytes_of)
        whole, at = gathered(parts, coded.indices, np.searchsorted(edges, offs))
        whole = whole.tobytes()
        return [whole[at[i]:at[i + 1]] for i in range(len(ids))]

    def bytes_of(self, runs: pa.Array) -> pa.Array:
        """The bytes of every run of ids, by the ordered aggregate."""
        tokens, ends = text_bytes(runs)
        tokens = np.ascontiguousarray(tokens).view("<i4").astype(np.int64)
        run = np.repeat(np.arange(len(runs), dtype=np.int32), np.diff(ends) // 4)
        found = self._rows("ids", DECODE, run=run, pos=np.arange(len(tokens), dtype=np.int32), tok=tokens)
        if len(found) != len(runs):
            raise ValueError("id outside the vocabulary")
        decoded = found.column("decoded").combine_chunks().take(pc.sort_indices(found.column("run")))
        sizes = pc.utf8_length(decoded).to_numpy(zero_copy_only=False).astype(np.int64)
        data = text_bytes(decoded)[0].tobytes().decode().encode("latin-1")
        return binary_array(data, np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)]))


_CODECS: dict[str, Codec] = {}


def codec(ranks: dict[bytes, int], pattern: str, name: str) -> Codec:
    """The worker's codec of that name, built at first use."""
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec(ranks, pattern)
    return _CODECS[name]


def _per_slice(docs: DataFrame, key: str, value: str, kind: str, schema: str, work: Callable[[Codec, pa.Array], list[list]], types: list[pa.DataType],
               ranks_path: str, pattern: str) -> DataFrame:
    ranks = read_ranks(ranks_path)
    name = hashlib.sha256(repr(sorted(ranks.items())).encode() + pattern.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern, name)
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                part = batch.slice(a, b - a)
                cols = work(own, part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
                                                 names=["doc_id", *[f"c{i}" for i in range(len(types))]])

    fields = [f.strip().split()[0] for f in schema.split(",")]
    raw = ", ".join(f"{'doc_id' if i == 0 else f'c{i - 1}'} {f.strip().split()[1]}" for i, f in enumerate(schema.split(",")))
    return docs.select(docs[key].cast("long").alias("doc_id"), docs[value].cast(kind).alias("value")).mapInArrow(frugal(run), raw).toDF(*fields)


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every text as little-endian 32-bit numbers."""
    return _per_slice(docs, key, text, "string", "doc_id long, ids binary",
                      lambda own, texts: [[ids for ids, _ in own.encode(texts)]], [pa.binary()], ranks_path, pattern)


def decode(ids: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", column: str = "ids") -> DataFrame:
    """(doc_id, decoded): the bytes that every id sequence stands for."""
    return _per_slice(ids, key, column, "binary", "doc_id long, decoded binary",
                      lambda own, seqs: [own.decode([s or b"" for s in seqs.to_pylist()])], [pa.binary()], ranks_path, pattern)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text: number of ids, SHA-256 of the decimal ids joined by commas, SHA-256 of the bytes decoded from the ids."""

    def work(own: Codec, texts: pa.Array) -> list[list]:
        encoded = own.encode(texts)
        decoded = own.decode([ids for ids, _ in encoded])
        return [[len(ids) // 4 for ids, _ in encoded], [hashlib.sha256(s).hexdigest() for _, s in encoded],
                [hashlib.sha256(d).hexdigest() for d in decoded]]

    return _per_slice(docs, key, text, "string", "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                      work, [pa.int64(), pa.string(), pa.string()], ranks_path, pattern)
