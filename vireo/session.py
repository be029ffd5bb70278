"""Session construction and the few settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in the library is written against. AQE re-plans joins
# at shuffle boundaries (broadcast when the measured side is small, split
# skewed partitions of a hot key), coalesces small shuffle outputs, and ANSI
# mode makes bad casts fail loudly instead of silently producing NULL.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for a large cluster (hundreds of executors, tens of TB):
# start with many shuffle partitions and let AQE coalesce them to the advisory
# size; split skewed partitions at five times the median; read parquet in
# 256 MB splits; broadcast only what measures under 64 MB at run time.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "vireo", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster the caller passes its own master and a shuffle partition
    count sized to the data (about 128-256 MB per partition); tests use
    ``local[*]`` with 8 partitions.
    """
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is read
    from the session and used as is. Only when nothing is configured on a
    local master (tests) a fresh scratch folder is created and registered; on
    any other master that is an error, as executors could not see the folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="vireo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{os.urandom(6).hex()}")
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def clean_scratch(spark: SparkSession) -> int:
    """Delete what ``scratch_path`` has handed out so far, at the end of a session's work.

    Results that were read back from there cannot be read any more. Marts
    kept under a name are not scratch. Returns the number of paths.
    """
    from vireo.sources import storage
    paths = _SCRATCH[:]
    for path in paths:
        storage.delete(spark, path)
        _SCRATCH.remove(path)
    return len(paths)
