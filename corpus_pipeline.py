"""Training-data pipeline over ``documents``: each stage applies one operator of
``kestrel.llm`` to all its predecessor kept.  Stages but the last return the columns
of ``documents``; the last one returns the tokenised documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import bpe, decontam, linededup, quality, simhash
from kestrel.llm.queries import prepare, table, vocabulary_path
from kestrel.llm.scratch import remove


# Every stage: null and empty texts are documents like any other, rows repeated in full
# are judged each, an empty table gives an empty one, columns beside doc_id, text
# and n_chars are carried along whatever their names.


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.  Without labelled documents none does."""
    prepare(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks leave the texts, n_chars follows; no row goes, a text
    of which nothing is left is empty.  Null texts stay null."""
    prepare(spark)
    return linededup.dedup_lines(docs, counts=False, length="n_chars")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest id.  All null
    and wordless texts are one group; rows repeated in full leave one."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=3, radius=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; null and empty texts hold none."""
    prepare(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left, one row each; null texts
    count as empty."""
    prepare(spark)
    return bpe.round_trip(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: model fitting, XXH64 fingerprints and byte-pair encoding have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``; each stage's result is
    written to the shared folder and read again; a table goes when the next one is there."""
    prepare(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:  # (the last table stays: the result is read from it)
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
