"""Evaluation queries (survey 2.12) plus threshold tuning, routing and the
prediction table (2.11) on deterministic score / prediction tables derived
from ``labels`` and the edge gold table, so every metric is SQL-checkable."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import evaluate as E
from kestrel.operators import tree as T
from kestrel.plans.registry import query
from kestrel.plans.sqlbind import CLOSURE, LABELS_LONG, TAXONOMY, with_rec
from kestrel.plans.tree_queries import _GOLD, _edges, gold_edges
from kestrel.sources.tables import load

_SCORES = """WITH scores AS (
  SELECT 'quality' AS label, l.doc_id AS id, l.quality AS y, ((l.doc_id * 37 + d.n_chars) % 1000) / 1000.0 AS score
  FROM labels l JOIN documents d USING (doc_id)
  UNION ALL
  SELECT 'toxic', l.doc_id, l.toxic, ((l.doc_id * 53 + d.n_chars * 7) % 1000) / 1000.0
  FROM labels l JOIN documents d USING (doc_id)),
sp AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS pred FROM scores)
"""


def scores(spark, sf):
    """(label, id, y, score, pred): deterministic pseudo-scores per label."""
    l = load(spark, sf, "labels")
    d = load(spark, sf, "documents").select("doc_id", "n_chars")
    j = l.join(d, "doc_id")
    q = j.select(F.lit("quality").alias("label"), F.col("doc_id").alias("id"), F.col("quality").alias("y"),
                 (((F.col("doc_id") * 37 + F.col("n_chars")) % 1000) / 1000.0).alias("score"))
    t = j.select(F.lit("toxic").alias("label"), F.col("doc_id").alias("id"), F.col("toxic").alias("y"),
                 (((F.col("doc_id") * 53 + F.col("n_chars") * 7) % 1000) / 1000.0).alias("score"))
    return q.unionByName(t).withColumn("pred", (F.col("score") >= 0.5).cast("int"))


_CONF_SQL = """count(CASE WHEN y = 1 AND pred = 1 THEN 1 END) AS tp, count(CASE WHEN y = 0 AND pred = 1 THEN 1 END) AS fp,
count(CASE WHEN y = 1 AND pred = 0 THEN 1 END) AS fn, count(CASE WHEN y = 0 AND pred = 0 THEN 1 END) AS tn"""


def _ratios_sql(src: str) -> str:
    return f"""SELECT *, CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0.0 END AS accuracy,
CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM {src}"""


_RAT = ["accuracy", "precision", "recall", "f1"]


@query("eval_binary", rnd=_RAT, sql=_SCORES + f", c AS (SELECT label, {_CONF_SQL} FROM sp GROUP BY label)\n" + _ratios_sql("c"))
def eval_binary(spark, sf):
    return E.binary_metrics(scores(spark, sf), "y", "pred", by=["label"])


@query("eval_roc_auc", rnd=["auc"], sql=_SCORES + """
, r AS (SELECT label, y, rank() OVER (PARTITION BY label ORDER BY score) + (count(*) OVER (PARTITION BY label, score) - 1) / 2.0 AS rk FROM scores)
SELECT label, count(CASE WHEN y = 1 THEN 1 END) AS n_pos, count(CASE WHEN y = 0 THEN 1 END) AS n_neg,
  (sum(CASE WHEN y = 1 THEN rk END) - count(CASE WHEN y = 1 THEN 1 END) * (count(CASE WHEN y = 1 THEN 1 END) + 1) / 2.0)
  / (count(CASE WHEN y = 1 THEN 1 END) * count(CASE WHEN y = 0 THEN 1 END)) AS auc FROM r GROUP BY label""")
def eval_roc_auc(spark, sf):
    return E.roc_auc(scores(spark, sf), "y", "score", by=["label"])


_THR = _SCORES + """
, ds AS (SELECT label, score, count(CASE WHEN y = 1 THEN 1 END) AS p, count(CASE WHEN y = 0 THEN 1 END) AS n FROM scores GROUP BY label, score),
th AS (SELECT label, score AS thr,
         sum(p) OVER (PARTITION BY label ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         sum(n) OVER (PARTITION BY label ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
         sum(p) OVER (PARTITION BY label) AS pos FROM ds)
"""


@query("eval_avg_precision", rnd=["ap"], sql=_THR + """
, pr AS (SELECT label, thr, tp / pos AS rec, tp / (tp + fp) AS prec FROM th),
d AS (SELECT label, prec, rec - coalesce(lag(rec) OVER (PARTITION BY label ORDER BY thr DESC), 0.0) AS drec FROM pr)
SELECT label, sum(drec * prec) AS ap FROM d GROUP BY label""")
def eval_avg_precision(spark, sf):
    return E.average_precision(scores(spark, sf), "y", "score", by=["label"])


@query("clf_threshold_tune", rnd=["thr", "f1"], sql=_THR + """
, f AS (SELECT label, thr, tp, fp, pos, CASE WHEN tp + fp + pos > 0 THEN 2 * tp / (tp + fp + pos) ELSE 0.0 END AS f1 FROM th)
SELECT label, thr, f1, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(pos AS BIGINT) AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, thr ASC) AS r FROM f) AS _x WHERE r = 1""")
def clf_threshold_tune(spark, sf):
    """Best-F1 threshold over the unique scores; first maximum wins."""
    return E.best_f1_threshold(scores(spark, sf), "y", "score", by=["label"])


_SUM_COLS = ["micro_precision", "micro_recall", "micro_f1", "micro_accuracy", "macro_precision", "macro_recall",
             "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]


def _summary_sql(src: str, key: str = "") -> str:
    g = f"{key}, " if key else ""
    return f"""
, rr AS ({_ratios_sql(src)}),
rr2 AS (SELECT *, tp + fn AS pos_, (tp + fn > 0 AND tp + fn < tp + fp + fn + tn) AS two FROM rr)
SELECT {g}count(*) AS units, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
  CAST(sum(tn) AS BIGINT) AS tn,
  CASE WHEN sum(tp) + sum(fp) > 0 THEN sum(tp) / (sum(tp) + sum(fp)) ELSE 0.0 END AS micro_precision,
  CASE WHEN sum(tp) + sum(fn) > 0 THEN sum(tp) / (sum(tp) + sum(fn)) ELSE 0.0 END AS micro_recall,
  CASE WHEN 2 * sum(tp) + sum(fp) + sum(fn) > 0 THEN 2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) ELSE 0.0 END AS micro_f1,
  CASE WHEN sum(tp) + sum(fp) + sum(fn) + sum(tn) > 0 THEN (sum(tp) + sum(tn)) / (sum(tp) + sum(fp) + sum(fn) + sum(tn)) ELSE 0.0 END AS micro_accuracy,
  avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
  sum(CASE WHEN two THEN pos_ * precision END) / sum(CASE WHEN two THEN pos_ END) AS weighted_precision,
  sum(CASE WHEN two THEN pos_ * recall END) / sum(CASE WHEN two THEN pos_ END) AS weighted_recall,
  sum(CASE WHEN two THEN pos_ * f1 END) / sum(CASE WHEN two THEN pos_ END) AS weighted_f1
FROM rr2 {"GROUP BY " + key if key else ""}"""


@query("eval_macro_micro", rnd=_SUM_COLS, sql=_SCORES + f", c AS (SELECT label, {_CONF_SQL} FROM sp GROUP BY label)" + _summary_sql("c"))
def eval_macro_micro(spark, sf):
    """Macro means and micro metrics from pooled counts over labels."""
    return E.summarize(E.confusion(scores(spark, sf), "y", "pred", by=["label"]))


# ---------------------------------------------------- edge-level metrics -----
_EDGE = _GOLD + """
, ep AS (SELECT parent, child, id, y, CASE WHEN (id + length(child)) % 5 = 0 THEN 1 - y ELSE y END AS pred FROM gold),
ec AS (SELECT parent, child, count(CASE WHEN y = 1 AND pred = 1 THEN 1 END) AS tp, count(CASE WHEN y = 0 AND pred = 1 THEN 1 END) AS fp,
              count(CASE WHEN y = 1 AND pred = 0 THEN 1 END) AS fn, count(CASE WHEN y = 0 AND pred = 0 THEN 1 END) AS tn
       FROM ep GROUP BY parent, child),
ecd AS (SELECT ec.*, d.depth FROM ec JOIN depth d ON d.node = ec.parent)
"""


def edge_preds(spark, sf):
    """Deterministic per-edge predictions: gold flipped for one row in five."""
    g = gold_edges(spark, sf)
    flip = (F.col("id") + F.length("child")) % 5 == 0
    return g.withColumn("pred", F.when(flip, 1 - F.col("y")).otherwise(F.col("y")))


def edge_confusion(spark, sf):
    c = E.confusion(edge_preds(spark, sf), "y", "pred", by=["parent", "child"])
    dep = T.depth(_edges(spark, sf)).select(F.col("node").alias("parent"), "depth")
    return c.join(dep, "parent")


@query("eval_pooled_edges", rnd=_SUM_COLS, bench=True, sql=_EDGE + _summary_sql("ecd"))
def eval_pooled_edges(spark, sf):
    """Pooled / macro / positive-weighted metrics and confusion over all edges."""
    return E.summarize(edge_confusion(spark, sf).drop("depth"))


@query("eval_pos_weighted", rnd=["weighted_precision", "weighted_recall", "weighted_f1"],
       sql=_EDGE + "SELECT weighted_precision, weighted_recall, weighted_f1 FROM (" +
       _summary_sql("ecd")[2:].replace("rr AS", "WITH rr AS", 1) + ") AS _s")
def eval_pos_weighted(spark, sf):
    return E.summarize(edge_confusion(spark, sf).drop("depth")).select("weighted_precision", "weighted_recall", "weighted_f1")


@query("eval_by_depth", rnd=_SUM_COLS, sql=_EDGE + _summary_sql("ecd", "depth"))
def eval_by_depth(spark, sf):
    return E.summarize(edge_confusion(spark, sf), key=["depth"])


@query("eval_h1", rnd=_RAT, sql=_EDGE + ", h1 AS (SELECT * FROM ec WHERE parent = 'Root')\n" + _ratios_sql("h1"))
def eval_h1(spark, sf):
    """Root-level rows with confusion and ratios."""
    c = edge_confusion(spark, sf).where(F.col("parent") == T.ROOT).drop("depth")
    return E.ratios(c)


@query("eval_best_worst_labels", rnd=_RAT, sql=_EDGE + """
, r AS (""" + _ratios_sql("ec") + """)
SELECT * FROM (SELECT *, 'best' AS side FROM r ORDER BY f1 DESC, recall DESC, precision DESC, child LIMIT 15) AS _b
UNION ALL SELECT * FROM (SELECT *, 'worst' AS side FROM r ORDER BY f1 ASC, recall ASC, precision ASC, child LIMIT 15) AS _w""")
def eval_best_worst_labels(spark, sf):
    """Top / bottom 15 edges by F1, recall, precision (a top-k report)."""
    r = E.ratios(edge_confusion(spark, sf).drop("depth"))
    best = r.orderBy(F.col("f1").desc(), F.col("recall").desc(), F.col("precision").desc(), "child").limit(15)
    worst = r.orderBy("f1", "recall", "precision", "child").limit(15)
    return best.withColumn("side", F.lit("best")).unionByName(worst.withColumn("side", F.lit("worst")))


#: edge rows of a task that compares the two derivations
GOLD_ROWS = 500_000


@query("eval_gold_consistency", sql=_EDGE + """
, direct AS (SELECT s.parent, s.child, l.id, max(CASE WHEN l.cat = s.child OR starts_with(l.cat, s.child || '/') THEN 1 ELSE 0 END) AS y
             FROM specs s JOIN labels_long l ON l.cat = s.parent OR starts_with(l.cat, s.parent || '/') OR s.parent = 'Root'
             WHERE l.cat IN (SELECT node FROM nodes) GROUP BY s.parent, s.child, l.id)
SELECT count(*) AS n_mismatch FROM gold g FULL JOIN direct d ON g.parent = d.parent AND g.child = d.child AND g.id = d.id
WHERE g.y IS DISTINCT FROM d.y""")
def eval_gold_consistency(spark, sf):
    """Closure-derived edge gold vs a second derivation from the code prefix
    structure: the number of mismatches must be 0."""
    from kestrel.session import cut_lineage, stored
    e = _edges(spark, sf)
    specs = e.join(T.branching(e).select("parent"), "parent")
    from kestrel.sources import bindings as B
    lab = B.labels_long(spark, sf).join(T.nodes(e).select(F.col("node").alias("cat")), "cat")
    # parent scope: the node itself or a code below it (codes are '/'-qualified)
    lab_scope = lab.select("id", "cat", F.explode(F.array(F.col("cat"), F.split("cat", "/")[0], F.lit(T.ROOT))).alias("parent"))
    by_scope = lab_scope.groupBy("id", "parent").agg(F.collect_set("cat").alias("cats"))
    below = F.exists("cats", lambda c: (c == F.col("child")) | c.startswith(F.concat(F.col("child"), F.lit("/"))))
    direct = T.spread_join(by_scope, specs.select("parent", "child"), "parent", "id").select(
        "parent", "child", "id", F.coalesce(below, F.lit(False)).cast("int").alias("y_direct"))
    key = ["parent", "child", "id"]
    with stored(gold_edges(spark, sf)) as g, stored(direct) as d:
        parts = -(-g.count() // GOLD_ROWS) + 1
        m = g.repartition(parts, *key).join(d.repartition(parts, *key), key, "full")
        return cut_lineage(m.agg(F.count(F.when(~F.col("y").eqNullSafe(F.col("y_direct")), 1)).alias("n_mismatch")))


_LEAF = _TL_ = with_rec(TAXONOMY, CLOSURE, LABELS_LONG) + """
, lv AS (SELECT node AS cat FROM nodes WHERE node NOT IN (SELECT parent FROM edges)),
gl AS (SELECT l.id, l.cat FROM labels_long l JOIN lv USING (cat)),
pl AS (SELECT id, CASE WHEN id % 3 = 0 THEN split_part(cat, '/', 1) || '/src0' ELSE cat END AS cat FROM gl
       UNION SELECT id, split_part(cat, '/', 1) || '/src1' FROM gl WHERE id % 4 = 0)
"""


def leaf_gold_pred(spark, sf):
    from kestrel.sources import bindings as B
    e = _edges(spark, sf)
    lv = T.leaves(e).select(F.col("node").alias("cat"))
    gl = B.labels_long(spark, sf).join(lv, "cat")
    root = F.split("cat", "/")[0]
    p1 = gl.select("id", F.when(F.col("id") % 3 == 0, F.concat(root, F.lit("/src0"))).otherwise(F.col("cat")).alias("cat"))
    p2 = gl.where(F.col("id") % 4 == 0).select("id", F.concat(root, F.lit("/src1")).alias("cat"))
    return gl, p1.unionByName(p2).distinct(), lv


@query("eval_leaf_multilabel", rnd=["micro_f1", "macro_f1", "weighted_f1", "samples_f1"], sql=_LEAF + """
, j AS (SELECT coalesce(g.id, p.id) AS id, coalesce(g.cat, p.cat) AS cat, g.id IS NOT NULL AS ing, p.id IS NOT NULL AS inp
        FROM gl g FULL JOIN pl p ON g.id = p.id AND g.cat = p.cat),
bl AS (SELECT lv.cat, count(CASE WHEN ing AND inp THEN 1 END) AS tp, count(CASE WHEN inp AND NOT ing THEN 1 END) AS fp,
              count(CASE WHEN ing AND NOT inp THEN 1 END) AS fn FROM lv LEFT JOIN j USING (cat) GROUP BY lv.cat),
bl2 AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM bl),
bi AS (SELECT id, count(CASE WHEN ing AND inp THEN 1 END) AS tp, count(CASE WHEN inp AND NOT ing THEN 1 END) AS fp,
              count(CASE WHEN ing AND NOT inp THEN 1 END) AS fn FROM j GROUP BY id)
SELECT CASE WHEN 2 * sum(tp) + sum(fp) + sum(fn) > 0 THEN 2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) ELSE 0.0 END AS micro_f1,
       avg(f1) AS macro_f1,
       CASE WHEN sum(tp + fn) > 0 THEN sum((tp + fn) * f1) / sum(tp + fn) ELSE 0.0 END AS weighted_f1,
       (SELECT avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END) FROM bi) AS samples_f1
FROM bl2""")
def eval_leaf_multilabel(spark, sf):
    """Leaf micro / macro (all taxonomy leaves count) / weighted / samples F1."""
    gl, pl, lv = leaf_gold_pred(spark, sf)
    return E.multilabel_f1(gl, pl, "id", "cat", lv)


@query("clf_apply_table", sql=_LEAF + """
SELECT id, string_agg(cat, ';' ORDER BY cat) AS predicted_leaves, count(*) AS n_predicted_leaves FROM pl GROUP BY id""")
def clf_apply_table(spark, sf):
    """predicted_leaves / n_predicted_leaves per document."""
    _, pl, _ = leaf_gold_pred(spark, sf)
    return pl.groupBy("id").agg(F.concat_ws(";", F.array_sort(F.collect_list("cat"))).alias("predicted_leaves"),
                                F.count(F.lit(1)).alias("n_predicted_leaves"))


@query("eval_path_recall", rnd=["path_recall"], sql=_EDGE + """
, prim_leaf AS (SELECT l.id, l.cat FROM labels_long l WHERE l.cat IN (SELECT node FROM nodes WHERE node NOT IN (SELECT parent FROM edges))),
req AS (SELECT DISTINCT p.id, s.parent, s.child FROM prim_leaf p JOIN closure c ON c.descendant = p.cat
        JOIN specs s ON s.child = c.ancestor)
SELECT count(*) AS n_required, count(CASE WHEN ep.pred = 1 THEN 1 END) AS n_hit,
       count(CASE WHEN ep.pred = 1 THEN 1 END) / count(*) AS path_recall
FROM req LEFT JOIN ep ON ep.id = req.id AND ep.parent = req.parent AND ep.child = req.child""")
def eval_path_recall(spark, sf):
    """Share of branching edges on gold leaf paths that are predicted 1."""
    from kestrel.sources import bindings as B
    e = _edges(spark, sf)
    specs = e.join(T.branching(e).select("parent"), "parent")
    gl = B.labels_long(spark, sf).join(T.leaves(e).select(F.col("node").alias("cat")), "cat")
    req = (gl.select("id", F.col("cat").alias("descendant")).join(T.closure(e), "descendant")
           .join(specs, F.col("ancestor") == F.col("child")).select("id", "parent", "child").distinct())
    j = req.join(edge_preds(spark, sf).select("id", "parent", "child", "pred"), ["id", "parent", "child"], "left")
    n_hit = F.count(F.when(F.col("pred") == 1, 1))
    return j.agg(F.count(F.lit(1)).alias("n_required"), n_hit.alias("n_hit"), (n_hit / F.count(F.lit(1))).alias("path_recall"))


@query("clf_route_multilabel", sql=_EDGE + """
, pos AS (SELECT DISTINCT id, parent, child FROM ep WHERE pred = 1),
un AS (SELECT parent, child FROM edges WHERE parent NOT IN (SELECT parent FROM br)),
starts AS (SELECT DISTINCT id FROM ep),
walk AS (SELECT id, 'Root' AS node FROM starts
          UNION
          SELECT r.id, n.child FROM walk r JOIN (SELECT id, parent, child FROM pos UNION ALL SELECT s.id, u.parent, u.child FROM starts s CROSS JOIN un u) n
          ON n.id = r.id AND n.parent = r.node)
SELECT id, node FROM walk WHERE node <> 'Root'""")
def clf_route_multilabel(spark, sf):
    """Follow every positive edge from the root (unary nodes pass through),
    level by level with joins: every (id, node) that is reached."""
    return T.route(edge_preds(spark, sf), _edges(spark, sf), "id")


# ------------------------------------------------- model comparison ---------
_MODELS = _SCORES + """
, mp AS (SELECT 'rule_a' AS model, label, id, y, CAST(score >= 0.5 AS INTEGER) AS pred FROM scores
         UNION ALL SELECT 'rule_b', label, id, y, CAST(score >= 0.3 AS INTEGER) FROM scores),
mc AS (SELECT model, label, count(CASE WHEN y = 1 AND pred = 1 THEN 1 END) AS tp, count(CASE WHEN y = 0 AND pred = 1 THEN 1 END) AS fp,
              count(CASE WHEN y = 1 AND pred = 0 THEN 1 END) AS fn, count(CASE WHEN y = 0 AND pred = 0 THEN 1 END) AS tn
       FROM mp GROUP BY model, label),
mr AS (""" + _ratios_sql("mc") + ")\n"


def model_metrics(spark, sf):
    s = scores(spark, sf)
    mp = (s.select(F.lit("rule_a").alias("model"), "label", "id", "y", (F.col("score") >= 0.5).cast("int").alias("pred"))
          .unionByName(s.select(F.lit("rule_b").alias("model"), "label", "id", "y",
                                (F.col("score") >= 0.3).cast("int").alias("pred"))))
    return E.binary_metrics(mp, "y", "pred", by=["model", "label"])


@query("eval_compare_table", rnd=["value", "delta_vs_rule_a"], sql=_MODELS + """
, u AS (UNPIVOT mr ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)
SELECT u.model, u.label, u.metric, u.value, u.value - b.value AS delta_vs_rule_a,
       u.value = max(u.value) OVER (PARTITION BY u.label, u.metric) AS is_best
FROM u JOIN u b ON b.model = 'rule_a' AND b.label = u.label AND b.metric = u.metric""")
def eval_compare_table(spark, sf):
    """Model comparison: unpivot metrics, delta vs a baseline, best per column."""
    m = model_metrics(spark, sf)
    u = m.unpivot(["model", "label"], ["accuracy", "precision", "recall", "f1"], "metric", "value")
    base = u.where(F.col("model") == "rule_a").select("label", "metric", F.col("value").alias("_b"))
    w = Window.partitionBy("label", "metric")   # one row per model: tiny groups
    return (u.join(base, ["label", "metric"]).withColumn("delta_vs_rule_a", F.col("value") - F.col("_b"))
             .withColumn("is_best", F.col("value") == F.max("value").over(w)).drop("_b"))


@query("eval_winner_per_topic", rnd=["best_f1"], sql=_MODELS + """
SELECT label, arg_max(model, f1 * 1000000 - CASE WHEN model = 'rule_a' THEN 0 ELSE 1 END) AS best_model, max(f1) AS best_f1
FROM mr GROUP BY label""")
def eval_winner_per_topic(spark, sf):
    """Best model per label by F1 (ties to the first model name)."""
    m = model_metrics(spark, sf)
    w = Window.partitionBy("label").orderBy(F.col("f1").desc(), "model")
    return m.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "label", F.col("model").alias("best_model"), F.col("f1").alias("best_f1"))


@query("eval_logloss", rnd=["logloss", "mse", "rmse", "mae"], sql=_SCORES + """
, c AS (SELECT label, y, least(greatest(score, 1e-15), 1 - 1e-15) AS p FROM scores)
SELECT label, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS logloss, avg((y - p) * (y - p)) AS mse,
       sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae FROM c GROUP BY label""")
def eval_logloss(spark, sf):
    s = scores(spark, sf).withColumn("p", F.least(F.greatest("score", F.lit(1e-15)), F.lit(1 - 1e-15)))
    e = F.col("y") - F.col("p")
    return s.groupBy("label").agg(
        F.avg(-(F.col("y") * F.log("p") + (1 - F.col("y")) * F.log(1 - F.col("p")))).alias("logloss"),
        F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def _full_tree_sql():
    from kestrel.plans.registry import ORACLE
    return ("SELECT 'edge_micro_f1' AS metric, micro_f1 AS value FROM (" + ORACLE["eval_pooled_edges"] + ") AS _a "
            "UNION ALL SELECT 'edge_macro_f1', macro_f1 FROM (" + ORACLE["eval_pooled_edges"] + ") AS _b "
            "UNION ALL SELECT 'leaf_micro_f1', micro_f1 FROM (" + ORACLE["eval_leaf_multilabel"] + ") AS _c "
            "UNION ALL SELECT 'leaf_samples_f1', samples_f1 FROM (" + ORACLE["eval_leaf_multilabel"] + ") AS _d "
            "UNION ALL SELECT 'path_recall', path_recall FROM (" + ORACLE["eval_path_recall"] + ") AS _e")


@query("eval_full_tree", rnd=["value"], sql=_full_tree_sql())
def eval_full_tree(spark, sf):
    """One combined full-tree summary: edge pooled / macro F1, leaf micro /
    samples F1 and path recall, as (metric, value) rows."""
    e = eval_pooled_edges(spark, sf)
    lf = eval_leaf_multilabel(spark, sf)
    pr = eval_path_recall(spark, sf)
    return (e.select(F.lit("edge_micro_f1").alias("metric"), F.col("micro_f1").alias("value"))
            .unionByName(e.select(F.lit("edge_macro_f1").alias("metric"), F.col("macro_f1").alias("value")))
            .unionByName(lf.select(F.lit("leaf_micro_f1").alias("metric"), F.col("micro_f1").alias("value")))
            .unionByName(lf.select(F.lit("leaf_samples_f1").alias("metric"), F.col("samples_f1").alias("value")))
            .unionByName(pr.select(F.lit("path_recall").alias("metric"), F.col("path_recall").alias("value"))))
