"""Parquet table access for the driver's test tables (and any table folder
laid out as ``<dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Column pruning and filter pushdown reach the scan because callers only
    # select/filter lazily on top of this relation.
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_many(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: load(spark, sf_dir, n) for n in names}


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for n in TABLES:
        load(spark, sf_dir, n).createOrReplaceTempView(n)
