"""Connected components of an edge table by alternating star contraction.

Each round hangs every node's larger neighbours on its smallest neighbour
(large star), then every node's smaller neighbours on the smallest of them
(small star), until each node points at the smallest node of its component.
The rounds are joins and minimum aggregates (combined map-side); a node with
very many neighbours is a skewed join key, which adaptive execution splits.
Lineage is cut with a reliable checkpoint per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = cut_lineage(least.select("a", F.least("a", "m").alias("m")))  # stored: the join can split a hot node
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    least = cut_lineage(edges.groupBy("a").agg(F.min("b").alias("m")))
    hung = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): for every node with at least one edge, the smallest node
    of its component.  Null ends, self loops and repeated edges are ignored;
    an empty edge table gives an empty result."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    now = cut_lineage(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                      .select(hi.alias("a"), lo.alias("b")).distinct())
    state = _state(now)
    while state[0]:
        after = cut_lineage(_small(_large(now).distinct()).distinct())
        new = _state(after)
        if new == state:
            break
        now, state = after, new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
