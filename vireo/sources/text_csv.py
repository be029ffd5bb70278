"""All-text CSV loading with audit columns.

Raw files are read as text with the header's own column names (a UTF-8 BOM
is dropped by the CSV reader), as COPY reads CSV: a quoted field may hold
commas, line breaks and doubled quotes, an empty field is NULL, a quoted
empty one is an empty text. Two audit columns record when and from which file
each row was loaded. A manifest of tables is loaded all-or-nothing: every
table is written under one fresh version folder, its rows are counted while
they are written, and only then a commit names it, so readers never see a
half-loaded set, on any file system. Of two loads at once both commit, one
after the other; the later one is read, the earlier one stays readable by its
number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.sources.storage import CommitLog

LOADED_AT = "_loaded_at"
SOURCE_FILE = "_source_file"
#: Stands for a quoted empty field while a file is read (a private-use character that no text file should hold).
QUOTED_EMPTY = "\ue000"


def load_text_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read one CSV as all-text columns plus the two audit columns.

    A missing file is an error (Spark raises on the analysis of the scan).
    Line breaks inside quotes need a file to be read from its start by one
    task, so large tables should come in several files; without them
    ``multi_line=False`` lets Spark split a file.
    """
    df = (spark.read.option("header", True).option("inferSchema", False).option("quote", '"').option("escape", '"')
          .option("multiLine", multi_line).option("nullValue", "").option("emptyValue", QUOTED_EMPTY).option("encoding", "UTF-8").csv(path))
    texts = [F.when(F.col(f"`{c}`") == QUOTED_EMPTY, "").otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns]
    return df.select(*texts, F.current_timestamp().alias(LOADED_AT), F.col("_metadata.file_name").alias(SOURCE_FILE))


def load_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Seed table with a declared schema (no inference)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def load_manifest(spark: SparkSession, manifest: dict[str, str], target_root: str) -> dict[str, int]:
    """Load every table of ``manifest`` (name -> csv path) all-or-nothing.

    Tables go to ``target_root/v=<id>/<name>``; the rows of each table are
    counted by the write itself. Only after all writes succeed a commit names
    the version, so a failure leaves the previous one in place and a rerun is
    an idempotent full replace.
    """
    commits, version = CommitLog(spark, target_root), uuid.uuid4().hex
    counts: dict[str, int] = {}
    for name, path in manifest.items():
        seen = Observation()
        load_text_csv(spark, path).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{target_root}/v={version}/{name}")
        counts[name] = seen.get["rows"]
    commits.update(lambda last: {"version": version, "loaded_rows": counts})
    return counts


def _load(spark: SparkSession, target_root: str, number: int | None) -> dict:
    commits = CommitLog(spark, target_root)
    content = commits.latest()[1] if number is None else commits.read(number)
    if content is None:
        raise FileNotFoundError(f"nothing has been loaded to {target_root}")
    return content


def loaded_tables(spark: SparkSession, target_root: str, number: int | None = None) -> DataFrame:
    """(version, name, loaded_rows) of the last committed load, or of an earlier one by its number."""
    load = _load(spark, target_root, number)
    return spark.createDataFrame([(load["version"], name, n) for name, n in sorted(load["loaded_rows"].items())], "version string, name string, loaded_rows long")


def read_loaded(spark: SparkSession, target_root: str, name: str, number: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{target_root}/v={_load(spark, target_root, number)['version']}/{name}")
