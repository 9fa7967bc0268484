"""Named table scans over a directory of parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the tables the driver ships in every scale-factor directory.
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``source('raw', name)``: a lazy parquet scan; Catalyst prunes columns and
    pushes filters into it."""
    return spark.read.parquet(table_path(base, name))


def register_views(spark: SparkSession, base: str, names: Sequence[str] = TEST_TABLES) -> None:
    for n in names:
        load(spark, base, n).createOrReplaceTempView(n)
