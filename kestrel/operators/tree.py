"""Topic tree as edge table + closure table.

A taxonomy is ``edges(parent, child)``.  Everything else is derived with joins:
the closure ``(ancestor, descendant, dist)`` is built by repeated edge joins
until no row is left to extend, however deep the tree is; a cycle is an error
(the join rounds never touch document data).  Document-side operators join labels with
the closure, so a whole tree's worth of per-edge datasets is one shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

ROOT = "Root"


def clean_edges(raw: DataFrame, parent: str = "parent", child: str = "child") -> DataFrame:
    """Trim, drop blank / 'none' / 'nan' parents, dedup; a child keeps its
    first parent in lexicographic order."""
    e = raw.select(F.trim(F.col(parent)).alias("parent"), F.trim(F.col(child)).alias("child"))
    e = e.where(F.col("parent").isNotNull() & (F.col("parent") != "") &
                ~F.lower(F.col("parent")).isin("none", "nan") & F.col("child").isNotNull() & (F.col("child") != ""))
    w = Window.partitionBy("child").orderBy("parent")
    return e.distinct().withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("parent").alias("node")).union(edges.select(F.col("child").alias("node"))).distinct()


def _descend(start: DataFrame, edges: DataFrame) -> DataFrame:
    """``start`` (ancestor, descendant, dist) extended along the edges until the
    frontier is empty.  Raises ValueError if a node is its own descendant."""
    e = edges.select(F.col("parent").alias("_p"), F.col("child").alias("_c"))
    out = frontier = start
    while True:
        frontier = cut_lineage(frontier.join(e, frontier.descendant == e._p)
                               .select("ancestor", F.col("_c").alias("descendant"), (F.col("dist") + 1).alias("dist")))
        n, cycle = frontier.agg(F.count(F.lit(1)), F.max(F.col("ancestor") == F.col("descendant"))).first()
        if cycle:
            raise ValueError("the edges contain a cycle")
        if not n:
            return out
        out = out.unionByName(frontier)


def closure(edges: DataFrame) -> DataFrame:
    """(ancestor, descendant, dist) including (n, n, 0), over all levels."""
    return _descend(nodes(edges).select(F.col("node").alias("ancestor"), F.col("node").alias("descendant"), F.lit(0).alias("dist")),
                    edges)


def depth(edges: DataFrame, root: str = ROOT) -> DataFrame:
    """(node, depth) of everything below the root, walked from the root only."""
    top = nodes(edges).where(F.col("node") == root)
    d = _descend(top.select(F.col("node").alias("ancestor"), F.col("node").alias("descendant"), F.lit(0).alias("dist")), edges)
    return d.select(F.col("descendant").alias("node"), F.col("dist").alias("depth"))


def leaves(edges: DataFrame) -> DataFrame:
    return nodes(edges).join(edges.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")


def child_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))


def branching(edges: DataFrame) -> DataFrame:
    return child_counts(edges).where("n_children >= 2")


def edge_specs(edges: DataFrame, root: str = ROOT) -> DataFrame:
    """(parent, child, depth of parent) for edges whose parent branches."""
    b = branching(edges).select("parent")
    d = depth(edges, root).select(F.col("node").alias("parent"), "depth")
    return edges.join(b, "parent").join(d, "parent")


def paths(edges: DataFrame, root: str = ROOT, sep: str = ">") -> DataFrame:
    """(node, path) root -> node as a string."""
    c = closure(edges).join(depth(edges, root).select(F.col("node").alias("ancestor"), F.col("depth").alias("_ad")),
                            "ancestor")
    g = c.groupBy(F.col("descendant").alias("node")).agg(
        F.array_sort(F.collect_list(F.struct("_ad", "ancestor"))).alias("_s"))
    return g.select("node", F.concat_ws(sep, F.transform("_s", lambda s: s["ancestor"])).alias("path"))


def summary(edges: DataFrame, root: str = ROOT) -> DataFrame:
    cc = child_counts(edges)
    d = depth(edges, root)
    parts = [
        nodes(edges).agg(F.count(F.lit(1)).alias("v")).select(F.lit("nodes").alias("metric"), "v"),
        leaves(edges).agg(F.count(F.lit(1)).alias("v")).select(F.lit("leaves").alias("metric"), "v"),
        cc.where("n_children >= 2").agg(F.count(F.lit(1)).alias("v")).select(F.lit("branching").alias("metric"), "v"),
        edges.agg(F.count(F.lit(1)).alias("v")).select(F.lit("edges").alias("metric"), "v"),
        cc.agg(F.max("n_children").cast("bigint").alias("v")).select(F.lit("max_branching").alias("metric"), "v"),
        d.agg(F.max("depth").cast("bigint").alias("v")).select(F.lit("max_depth").alias("metric"), "v"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def deepest_label(labels: DataFrame, dep: DataFrame, id_col: str = "id", cat: str = "cat") -> DataFrame:
    """Single primary label per document: deepest, ties -> smallest code (S15)."""
    j = labels.join(dep.select(F.col("node").alias(cat), "depth"), cat)
    w = Window.partitionBy(id_col).orderBy(F.col("depth").desc(), F.col(cat))
    return j.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def spread_join(rows: DataFrame, table: DataFrame, on: str, id_col: str, parts: int = 64) -> DataFrame:
    """Inner join of document rows with a tree-sized table.  Few keys (the root, the first level) hold
    most documents, so each key is cut in ``parts`` by document and the table's rows go to each part."""
    cut = rows.withColumn("_part", F.pmod(F.xxhash64(id_col), F.lit(parts)).cast("int"))
    every = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return cut.join(every, [on, "_part"]).drop("_part")


def edge_gold(labels: DataFrame, edges: DataFrame, clos: DataFrame, id_col: str = "id",
              cat: str = "cat") -> DataFrame:
    """(parent, child, id, y) for every branching edge at once: y = 1 iff the
    document has a label in subtree(child); rows are the documents with a
    label in subtree(parent)."""
    specs = edges.join(branching(edges).select("parent"), "parent")
    # the nodes each document reaches, as one row; a null id is never found below a child
    reach = (spread_join(labels.select(id_col, F.col(cat).alias("descendant")), clos.select("ancestor", "descendant"), "descendant", id_col)
             .groupBy(id_col).agg(F.collect_set("ancestor").alias("_nodes")))
    rows = spread_join(reach.select(id_col, "_nodes", F.explode("_nodes").alias("parent")), specs.select("parent", "child"), "parent", id_col)
    return rows.select("parent", "child", id_col, (F.col(id_col).isNotNull() & F.array_contains("_nodes", F.col("child"))).cast("int").alias("y"))


def route(preds: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """Multilabel top-down routing: from the root follow every edge predicted
    1; a node with a single child passes through.  Level-wise joins until no
    document moves on; returns the reached (id, node) pairs."""
    pos = preds.where(F.col("pred") == 1).select(id_col, F.col("parent").alias("_par"), F.col("child").alias("_ch")).distinct()
    unary = edges.join(branching(edges).select("parent"), "parent", "left_anti") \
        .select(F.col("parent").alias("_upar"), F.col("child").alias("_uch"))
    frontier = preds.select(id_col).distinct().withColumn("node", F.lit(ROOT))
    reached = None
    while True:
        a = frontier.join(pos, [id_col]).where(F.col("node") == F.col("_par")).select(id_col, F.col("_ch").alias("node"))
        b = frontier.join(unary, F.col("node") == F.col("_upar")).select(id_col, F.col("_uch").alias("node"))
        step = a.unionByName(b).distinct()
        if reached is not None:
            step = step.join(reached, [id_col, "node"], "left_anti")
        frontier = cut_lineage(step)
        if frontier.isEmpty():
            return frontier if reached is None else reached
        reached = frontier if reached is None else reached.unionByName(frontier)
