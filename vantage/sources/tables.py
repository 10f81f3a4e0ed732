"""Access to the driver tables by name."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class TableResolver:
    """Maps dataset ids to DataFrames: explicit bindings first, then driver tables by name.

    A binding is a DataFrame or a zero-argument factory; factories run on first use only, so
    datasets a spec does not name are never opened.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 bindings: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.bindings: dict[str, DataFrame | Callable[[], DataFrame]] = dict(bindings or {})

    def bind(self, dataset_id: str, df: DataFrame | Callable[[], DataFrame]) -> "TableResolver":
        self.bindings[dataset_id] = df
        return self

    def __call__(self, dataset_id: str) -> DataFrame:
        if dataset_id in self.bindings:
            bound = self.bindings[dataset_id]
            if not isinstance(bound, DataFrame):
                bound = bound()
                self.bindings[dataset_id] = bound
            return bound
        if self.sf_dir and dataset_id in DRIVER_TABLES:
            return read_table(self.spark, self.sf_dir, dataset_id)
        raise KeyError(f"dataset {dataset_id!r} is not bound")
