"""Driver parquet tables and a by-name source registry."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Sources:
    """Declared sources read by name (the registry a model reads from).

    Each name maps to a zero-argument loader; a DataFrame is created on first
    use and reused, so a plan that reads the same source twice shares one
    logical relation (and Spark can reuse the exchange).
    """

    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def driver(cls, spark: SparkSession, sf_dir: str) -> "Sources":
        return cls(spark, {n: (lambda n=n: read_table(spark, sf_dir, n)) for n in DRIVER_TABLES})

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaders:
            raise KeyError(f"unknown source {name!r}; declared: {self.names()}")
        if name not in self._frames:
            self._frames[name] = self._loaders[name]()
        return self._frames[name]

    def register(self, name: str, loader: Callable[[], DataFrame]) -> None:
        self._loaders[name] = loader
        self._frames.pop(name, None)
