"""Labelled rows for the classifiers: hashed hold-out fold and a bounded,
class-balanced training sample."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: most labelled rows of one class that a classifier is fitted on
PER_CLASS = 8_000


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def held_out(id_col: str, folds: int = 3, out: int = 1) -> Column:
    """True for the hold-out rows; a null id is never held out."""
    return F.coalesce(fold(id_col, folds) == out, F.lit(False))


def _smallest_hashes(rows: DataFrame, n: int, most: int) -> DataFrame:
    """The ``most`` rows of ``n`` with the smallest id hashes.  A bound on the hash leaves about
    half as many again, so that the one task that ranks them gets a bounded number
    of rows from however many partitions."""
    low = int(-2 ** 63 + min(1.5 * most / n, 1) * (2 ** 64 - 1)) if n > 2 * most else 2 ** 63 - 1
    return rows.withColumn("_h", F.xxhash64("_lid")).where(F.col("_h") <= low).orderBy("_h", "_lid").limit(most).drop("_h")


def training_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text: str = "text",
                    per_class: int = PER_CLASS, folds: int = 3, out: int = 1) -> DataFrame:
    """(_lid, _text, _label): texts of at most ``per_class`` labelled ids of each
    class outside the hold-out fold, the ones with the smallest id hashes, one row each.

    Null labels and ids are left out; so are ids whose labels contradict each
    other.  Of several rows of an id the one with the smallest text hash stands for it
    (found by an aggregate with map-side combine), so the sample is bounded in rows.  The
    ids are broadcast to the documents; only the sample's texts are shuffled."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out(id_col, folds, out)) \
        .groupBy(F.col(id_col).alias("_lid")).agg(F.min(label).alias("_label"), F.max(label).alias("_other")) \
        .where(F.col("_label") == F.col("_other")).select("_lid", "_label")
    sizes = {int(r["_label"]): r["count"] for r in one.groupBy("_label").count().collect()}
    picked = reduce(DataFrame.unionByName, [_smallest_hashes(one.where(F.col("_label") == c), sizes.get(c, 0), per_class) for c in (0, 1)])
    src = docs.select(F.col(id_col).alias("_lid"), F.col(text).alias("_text")).join(F.broadcast(picked), "_lid")
    first = F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("_one")
    return src.groupBy("_lid", "_label").agg(first).select("_lid", "_one._text", "_label")
