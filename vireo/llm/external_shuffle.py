"""Sharding by a two-pass external shuffle: a seeded scatter into buckets, then Fisher-Yates inside each.

First pass: every row goes to one of many buckets by a seeded hash of its own
place in the input (file and row number, so copies and hot keys spread like
any other rows). A bucket holds ``BUCKET_BYTES`` of text on average, whatever
the size of the table. Second pass: the rows of a bucket are numbered, the
numbers are permuted by Spark's ``shuffle`` (an inside-out Fisher-Yates over a
seeded generator), and the rows are put in that order and written.

The buckets one after the other are one random order of all rows. It is cut
into shards of equal length (law ``rows``: counts at most one apart), so the
place of a row follows from the rows in the buckets before its own. These
counts come from a scan of no column at all, are written beside the shards as
an index, and are summed in blocks, never in one task. Texts cross the network
once, and only row numbers are ever gathered into an array.

The same table and seed give the same shards after any loss of executors: the
bucket, the number of a row and the order in which the generator meets the
buckets depend on written files only.

Defined results: a null text has no bytes (size 1 like an empty one). Null or
repeated keys, repeated rows, empty and very long texts are rows like others;
a text longer than a bucket makes its bucket longer. An empty table gives no
rows. Other columns are kept inside ``doc``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.llm.common import row_keyed, shuffle_width

LAW = "rows"
SEED = 11
#: Mean bytes of text in a bucket, and buckets that one task of the second pass works through.
BUCKET_BYTES = 64 << 20
BUCKETS_A_TASK = 4
#: Buckets whose counts are summed in one group.
BLOCK = 1024


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def bucket_index(rows: DataFrame) -> DataFrame:
    """(bucket, n, first): the rows of every bucket, and of all buckets before it."""
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("block", F.expr(f"bucket div {BLOCK}"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("block").agg(F.sum("n").alias("rows")).select(
        "block", F.coalesce(F.sum("rows").over(before.orderBy("block")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n").over(before.partitionBy("block").orderBy("bucket")), F.lit(0))
    return counts.withColumn("inside", inside).join(blocks, "block").select("bucket", "n", (F.col("base") + F.col("inside")).alias("first"))


def write(docs: DataFrame, path: str, shards: int = 16, seed: int = SEED, text: str = "text",
          bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write ``docs`` in random order below ``path``: ``shards`` (doc, slot) in folders shard=<number>, and ``index``.
    """
    spark = docs.sparkSession
    total = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(text_size(docs[text])), F.lit(0)).alias("bytes")).first()
    tasks = max(shuffle_width(spark), -(-total["bytes"] // (bucket_bytes * BUCKETS_A_TASK)))
    buckets, n = tasks * BUCKETS_A_TASK, max(1, total["n"])
    name = F.element_at(F.split("file", "/"), -1)
    scattered = row_keyed(docs).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), name, "row"), F.lit(buckets)))

    bucket_index(scattered.select("bucket")).sortWithinPartitions("bucket").write.parquet(f"{path}/index")
    index = spark.read.schema("bucket long, n long, first long").parquet(f"{path}/index")
    drawn = index.select("bucket", "first", F.shuffle(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")), F.lit(seed)).alias("order"))

    number = F.row_number().over(Window.partitionBy("bucket").orderBy("row", "file"))
    placed = (scattered.repartition(tasks, "bucket").withColumn("number", number).join(drawn, "bucket")
              .withColumn("place", F.col("first") + F.element_at("order", F.col("number")))
              .withColumn("shard", F.expr(f"(place * {shards}) div {n}").cast("int"))
              .withColumn("slot", F.expr(f"place - (shard * {n}L + {shards - 1}) div {shards}")))
    (placed.select("doc", "slot", "shard").sortWithinPartitions("shard", "slot")
     .write.option("compression", "zstd").partitionBy("shard").parquet(f"{path}/shards"))


def read(spark: SparkSession, path: str, doc: T.StructType) -> DataFrame:
    """(doc, slot, shard) of all shards below ``path``; ``doc`` is the schema of the documents."""
    schema = T.StructType([T.StructField("doc", doc), T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{path}/shards")
