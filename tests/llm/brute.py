"""Plain implementations of the operators' contracts, for small inputs only."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

from vireo.llm.fuzzy_lines import edit_distance as operator_distance

ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: str | None) -> bytes:
    return (text or "").encode().translate(ASCII_LOWER)


def fold(key, modulus: int) -> int:
    return zlib.crc32(str(key).encode()) % modulus


def groups(n: int, linked) -> list[int]:
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(n):
        for j in range(i + 1, n):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def majority(hashes: list[int]) -> int:
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows(docs: list[tuple], shingle: int = 3, bits: int = 3) -> list[tuple]:
    prints = []
    for _, text in docs:
        words = WORD.findall(lowered(text))
        shingles = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
        prints.append(majority([xxhash.xxh64_intdigest(s, 42) for s in shingles]))
    group = groups(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= bits)
    least = defaultdict(list)
    for (key, _), g in zip(docs, group, strict=True):
        least[g].append(key)
    return [(key, f"{p:016x}", min(least[g])) for (key, _), p, g in zip(docs, prints, group, strict=True)]


def contamination_rows(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    windows = defaultdict(set)
    for key, text in items:
        words = ALNUM.findall(lowered(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[i:i + window])].add(str(key))
    out = []
    for key, text in docs:
        words, hit, found = ALNUM.findall(lowered(text)), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i:i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[w]
        names = ",".join(sorted(found))
        out.append((key, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def edit_distance(a: str, b: str) -> int:
    above = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            row.append(min(above[j] + (x != y), above[j + 1] + 1, row[j] + 1))
        above = row
    return above[-1]


def normal_lines(docs: list[tuple], min_chars: int = 12) -> dict[str, list[tuple]]:
    """Normalised line -> places, in order of documents (null id last) and lines."""
    places = defaultdict(list)
    for row, (key, text) in sorted(enumerate(docs), key=lambda d: (d[1][0] is None, d[1][0] or 0, d[0])):
        for i, line in enumerate((text or "").encode().split(b"\n")):
            normal = b" ".join(re.findall(rb"[a-z\x80-\xff]+", line.translate(ASCII_LOWER))).decode()
            if len(normal) < min_chars:
                plain = b" ".join(line.translate(ASCII_LOWER).split()).decode()
                normal = "\n" + plain if len(plain) >= min_chars else ""
            if normal:
                places[normal].append((row, i))
    return places


def similar_pairs(lines: list[str], similarity: float) -> list[tuple[int, int]]:
    """All pairs whose edit similarity reaches ``similarity``, after bounds that no such pair exceeds.

    An edit changes at most three of a line's trigrams; trigrams are hashed,
    so that lines seem to share more of them than they do. The distance of the
    pairs left is the operator's own, which has a test against edit_distance().
    """
    size, buckets = np.array([len(x) for x in lines]), 8192
    held = np.zeros((len(lines), buckets), np.float32)
    for row, line in zip(held, lines, strict=True):
        row[[zlib.crc32(line[i:i + 3].encode()) % buckets for i in range(max(1, len(line) - 2))]] = 1
    count, out = held.sum(axis=1), []
    for i in range(len(lines) - 1):
        most = (1 - similarity) * np.maximum(size[i], size[i + 1:]) + 1e-9
        lost = np.maximum(count[i], count[i + 1:]) - held[i + 1:] @ held[i]
        for j in np.flatnonzero((np.abs(size[i] - size[i + 1:]) <= most) & (lost <= 3 * most)).tolist():
            if operator_distance(lines[i], lines[i + 1 + j], int(most[j])) <= most[j]:
                out.append((i, i + 1 + j))
    return out


def line_classes(docs: list[tuple], similarity: float = 0.8) -> list[list[tuple]]:
    """Places of every group of lines, the first one first, by edit similarity alone."""
    places = normal_lines(docs)
    fuzzy = [x for x in places if not x.startswith("\n")]
    joined, linked = defaultdict(list), defaultdict(set)
    for i, j in similar_pairs(fuzzy, similarity):
        linked[i].add(j)
        linked[j].add(i)
    seen: set[int] = set()
    for start in range(len(fuzzy)):
        stack = [] if start in seen else [start]
        while stack:
            i = stack.pop()
            if i not in seen:
                seen.add(i)
                joined[start] += places[fuzzy[i]]
                stack += linked[i]
    order = lambda p: (docs[p[0]][0] is None, docs[p[0]][0] or 0, *p)
    return [sorted(x, key=order) for x in (*joined.values(), *(v for k, v in places.items() if k.startswith("\n")))]


def deduped_texts(docs: list[tuple], similarity: float = 0.8) -> list[tuple]:
    """(key, lines, removed, text) of every document, in the order of ``docs``."""
    gone = {p for places in line_classes(docs, similarity) for p in places[1:]}
    out = []
    for row, (key, text) in enumerate(docs):
        pieces = [] if text is None else text.split("\n")
        kept = [x for i, x in enumerate(pieces) if (row, i) not in gone]
        out.append((key, len(pieces), len(pieces) - len(kept), None if text is None else "\n".join(kept)))
    return out


def base_rows(docs: list[tuple], holdout: tuple[int, int] = (5, 1)) -> dict:
    """key -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    count = Counter()
    for key, text in docs:
        if fold(key, holdout[0]) != holdout[1]:
            count.update([*WORD.findall(lowered(text)), None])
    total, distinct = sum(count.values()), len(count)
    out = {}
    for key, text in docs:
        tokens = [*WORD.findall(lowered(text)), None]
        base = sum(math.log10((count[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        out[key] = (fold(key, holdout[0]) == holdout[1], len(tokens), sum(count[t] > 0 for t in tokens), total, base)
    return out


def ppm_scores(docs: list[tuple], order: int, holdout: tuple[int, int] = (5, 1)) -> dict:
    """key -> log10 probability by walking the contexts from long to short, symbol by symbol."""
    def symbols(text):
        return [0] * order + [b + 1 for b in b" ".join(WORD.findall(lowered(text)))] + [257]
    trie = defaultdict(Counter)
    for key, text in docs:
        if fold(key, holdout[0]) != holdout[1]:
            s = symbols(text)
            for i in range(order, len(s)):
                for k in range(order + 1):
                    trie[tuple(s[i - k:i])][s[i]] += 1
    out = {}
    for key, text in docs:
        s, score = symbols(text), 0.0
        for i in range(order, len(s)):
            excluded = set()
            for k in range(order, -1, -1):
                seen = trie.get(tuple(s[i - k:i]), {})
                left = {x: n for x, n in seen.items() if x not in excluded}
                if s[i] in left:
                    score += math.log10((2 * left[s[i]] - 1) / (2 * sum(left.values())))
                    break
                if left:
                    score += math.log10(len(left) / (2 * sum(left.values())))
                excluded |= set(seen)
            else:
                score += math.log10(1 / (257 - len(trie.get((), {}))))
        out[key] = score
    return out


def quality_rows(docs: list[tuple]) -> dict:
    """key -> (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    out = {}
    for key, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        out[key] = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
                    len(words) < 50 or 100 * len(hit) > 50 * len(words))
    return out


def spelling_evidence(counted: list[tuple[str, int]], texts: list[str], order: int = 6, discount: float = 0.75, mix: float = 0.005) -> list[float]:
    """Mean log ratio of toxic to ordinary of the words of each text, by plain Kneser-Ney models of the classes of ``counted`` (text, class)."""
    words_of = lambda text: re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))
    grams_of = lambda word: [(b"\0" * (order - 1) + word + b"\0")[i:i + order] for i in range(len(word) + 1)]
    own: list[dict] = [{}, {}]  # class: context: byte: count
    for text, c in counted:
        for g in (g for w in words_of(text) for g in grams_of(w)):
            followers = own[c].setdefault(g[:-1], {})
            followers[g[-1]] = followers.get(g[-1], 0) + 1
    longer = {k + bytes([b]) for counts in own for k, followers in counts.items() for b in followers}
    shared: dict[bytes, dict] = {}  # context of a lower order: byte: different bytes seen before
    for _ in range(order - 1):
        for g in longer:
            followers = shared.setdefault(g[1:-1], {})
            followers[g[-1]] = followers.get(g[-1], 0) + 1
        longer = {g[1:] for g in longer}

    def smoothed(followers: dict, byte: int, lower: float) -> float:
        total = sum(followers.values())
        return lower if not total else max(followers.get(byte, 0) - discount, 0) / total + discount * len(followers) / total * lower

    def backoff(g: bytes) -> float:
        return smoothed(shared.get(g[:-1], {}), g[-1], backoff(g[1:])) if g else 1 / 256

    def ratio(word: bytes) -> float:
        at = 0.0
        for g in grams_of(word):
            lower = backoff(g[1:])
            at += math.log(smoothed(own[1].get(g[:-1], {}), g[-1], lower)) - math.log(smoothed(own[0].get(g[:-1], {}), g[-1], lower))
        return math.log(1 - mix + mix * math.exp(at))

    known: dict[bytes, float] = {}
    result = []
    for text in texts:
        words = words_of(text)
        known.update({w: ratio(w) for w in set(words) if w not in known})
        result.append(sum(known[w] for w in words) / max(1, len(words)))
    return result
