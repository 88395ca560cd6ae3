"""Corpus scoring and corpus ingest as Structured Streaming jobs.

Both read new parquet files from a folder as they arrive, keep their progress
in a checkpoint under the shared checkpoint folder and write through
``foreachBatch``.  A batch owns the folder ``epoch=<n>`` of its output and replaces
it, so a batch that is replayed after a failure leaves no row twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _run(spark: SparkSession, in_dir: str, schema, batch, ckpt: str, files_per_trigger: int | None) -> None:
    """Drains the folder, all new files at once or ``files_per_trigger`` at a time."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    q = reader.parquet(in_dir).writeStream.foreachBatch(batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()


def score_files(spark: SparkSession, in_dir: str, schema, coef: DataFrame, out_dir: str, ckpt: str,
                id_col: str = "doc_id", text: str = "text", files_per_trigger: int | None = None) -> None:
    """Score each micro-batch of new documents with a linear model stored as a
    materialised (term, weight) table of any size: tokenize, join on term, sum
    weights per document, tag the split and write JSON lines."""
    from kestrel.operators import text as X

    def batch(df: DataFrame, epoch: int) -> None:
        s = X.tokens(df, id_col, text).join(coef, "term").groupBy(id_col).agg(F.sum("weight").alias("score"))
        out = df.select(id_col).join(s, id_col, "left").na.fill(0.0, ["score"]) \
            .withColumn("split", F.when((F.col(id_col) % 100 * 7919) % 100 < 80, "train").otherwise("test"))
        out.write.mode("overwrite").json(f"{out_dir}/epoch={epoch}")

    _run(spark, in_dir, schema, batch, ckpt, files_per_trigger)


def ingest_dedup(spark: SparkSession, in_dir: str, schema, out_dir: str, ckpt: str, id_col: str, order: list[str],
                 files_per_trigger: int | None = None) -> None:
    """Append the new ids: within a batch the first row of an id by ``order``,
    and none for an id that an earlier batch stored, however long ago."""

    def batch(df: DataFrame, epoch: int) -> None:
        others = [c for c in df.columns if c != id_col]
        one = df.groupBy(id_col).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("r")).select(id_col, "r.*")
        if epoch:
            stored = spark.read.schema(f"{id_col} {df.schema[id_col].dataType.simpleString()}, epoch long").parquet(out_dir)
            one = one.join(stored.where(F.col("epoch") < epoch).select(id_col), id_col, "left_anti")
        one.select(*df.columns).write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")

    _run(spark, in_dir, schema, batch, ckpt, files_per_trigger)
