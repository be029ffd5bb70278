"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A list entry is a host with an optional path prefix (``example.net/en/``). A
URL is reduced to its host and path; every host suffix joined with every path
prefix that some entry could have is a lookup key. Keys go through a blocked
Bloom filter (one 256-bit block per key, eight bits set, so a probe touches
one row); the few that pass are joined with the list itself, which removes the
false positives. The longest entry decides; URLs without an entry get the
verdict of an unlisted URL.

Defined results: a null URL or one without ``://`` has empty host and path and
is unlisted. Repeated rows each get a row. Entries of equal length (they can
only differ in where the host ends) go by the greater text. An empty list
leaves every URL unlisted. Only the named columns of the inputs are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The salts of the split-block Bloom filter of the Parquet format.
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
BITS_PER_KEY = 16
BLOCK_BITS = 256
#: Bytes of a filter row (block number and eight words) and of what may be broadcast.
BLOCK_BYTES = 72
BROADCAST_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(blocks)).cast("int").alias("block")


def _bits(key: Column) -> list[Column]:
    """One bit of each of the eight 32-bit words of a block (27-bit odd multipliers: no overflow in a long)."""
    low = F.xxhash64(key).bitwiseAND(F.lit(0xFFFFFFFF))
    return [F.shiftright((low * F.lit(s >> 5 | 1)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int") for s in SALTS]


def bloom_blocks(keys: DataFrame, key: str = "key") -> tuple[DataFrame, int]:
    """The filter as rows (block, w0..w7) and its number of blocks, 16 bits a key."""
    blocks = max(1, -(-keys.count() * BITS_PER_KEY // BLOCK_BITS))
    words = [F.bit_or(F.expr(f"shiftleft(1L, b{i})")).alias(f"w{i}") for i in range(8)]
    rows = keys.select(_block(F.col(key), blocks), *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col(key)))])
    return rows.groupBy("block").agg(*words), blocks


def small(df: DataFrame, size: int) -> DataFrame:
    """``df`` marked for broadcast if its measured size is within the bound; else as it is, joined by a shuffle."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def maybe_listed(probes: DataFrame, bloom: DataFrame, blocks: int, key: str = "key") -> DataFrame:
    """Probe rows that pass the filter; the join goes by block where the filter is not small."""
    bloom = small(bloom, blocks * BLOCK_BYTES)
    with_block = probes.withColumns({"block": _block(F.col(key), blocks)} | {f"b{i}": b for i, b in enumerate(_bits(F.col(key)))})
    hit = F.lit(True)
    for i in range(8):
        hit = hit & (F.expr(f"shiftright(w{i}, b{i}) & 1") == 1)
    return with_block.join(bloom, "block").where(hit).select(*probes.columns)


def canonical_rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) as list keys: host lowered, host and path joined."""
    host = F.translate(F.coalesce(F.col("host"), F.lit("")), UPPER, LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    return (rules.where(F.col("host").isNotNull())
            .groupBy(F.concat(host, path).alias("key"), F.length(path).alias("path_len"))
            .agg(F.max("verdict").alias("verdict")))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", unlisted: str = "allow",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, host, path, rule and verdict of every row of ``urls``.

    ``rules`` has host, path and verdict. Lookup keys are made only for the
    path lengths that occur in the list.
    """
    listed = canonical_rules(rules)
    shapes = listed.groupBy("path_len").agg(F.sum(F.octet_length("key") + F.octet_length("verdict") + 24).alias("size")).collect()
    lengths, size = sorted(r.path_len for r in shapes), sum(r.size for r in shapes)  # rows bounded by the longest listed path
    parts = urls.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if not lengths:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(unlisted)})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    pairs = F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(F.concat(s, p).alias("key"), F.length(p).alias("path_len"))))
    probes = (parts.select("host", "path", F.explode(F.flatten(pairs)).alias("c"))
              .select("host", "path", "c.key", "c.path_len").where(F.col("key").isNotNull()))
    bloom, blocks = bloom_blocks(listed.select("key").distinct())
    best = (maybe_listed(probes, bloom, blocks).join(small(listed, size), ["key", "path_len"])
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("key").alias("n"), "key", "path_len", "verdict")).alias("best")))
    return (parts.join(best, ["host", "path"], "left")
            .select(*keep, "host", "path", F.col("best.key").alias("rule"),
                    F.coalesce("best.verdict", F.lit(unlisted)).alias("verdict")))
