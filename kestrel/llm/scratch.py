"""Intermediate tables in the shared checkpoint folder, removed after use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from kestrel.session import ensure_checkpoint_dir


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written as Parquet to the shared folder and read again; the table is
    removed when the scope ends, so what is derived from it must be materialised
    inside.  (Unlike a checkpoint the table is columnar and compressed.)"""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table of this module through Spark's file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
