"""Metrics against brute force, tree closure, smoothed TF-IDF by hand."""

import math

from pyspark.sql import functions as F

from kestrel.operators import evaluate as E
from kestrel.operators import text as X
from kestrel.operators import tree as T


def test_auc_ties_brute_force(spark):
    data = [(1, 0.9), (1, 0.7), (0, 0.7), (1, 0.5), (0, 0.3), (0, 0.3), (1, 0.3), (0, 0.1)]
    df = spark.createDataFrame(data, "y int, score double")
    auc = E.roc_auc(df, "y", "score").first().auc
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12


def test_best_threshold_first_max_and_zero_division(spark):
    data = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2)]
    df = spark.createDataFrame(data, "y int, score double")
    best = E.best_f1_threshold(df, "y", "score").first()
    brute = []
    for thr in sorted({s for _, s in data}):
        tp = sum(1 for y, s in data if s >= thr and y == 1)
        fp = sum(1 for y, s in data if s >= thr and y == 0)
        fn = sum(1 for y, s in data if s < thr and y == 1)
        brute.append((2 * tp / (2 * tp + fp + fn), thr))
    mx = max(f for f, _ in brute)
    assert abs(best.f1 - mx) < 1e-12 and best.thr == min(t for f, t in brute if f == mx)
    z = E.binary_metrics(spark.createDataFrame([(0, 0)], "y int, p int"), "y", "p").first()
    assert z.precision == 0.0 and z.f1 == 0.0


def test_closure_and_edge_gold(spark):
    edges = spark.createDataFrame([("Root", "a"), ("Root", "b"), ("a", "a1"), ("a", "a2"), ("b", "b1")], "parent string, child string")
    c = T.closure(edges)
    assert c.where("ancestor = descendant").count() == 6
    assert c.where("ancestor = 'Root' AND descendant = 'a2'").first().dist == 2
    labels = spark.createDataFrame([(1, "a1"), (2, "b1"), (3, "a")], "id long, cat string")
    g = {(r.parent, r.child, r.id): r.y for r in T.edge_gold(labels, edges, c).collect()}
    assert g[("Root", "a", 1)] == 1 and g[("Root", "b", 1)] == 0 and g[("a", "a1", 1)] == 1
    assert g[("a", "a2", 3)] == 0 and ("a", "a1", 2) not in g   # doc 2 not under a
    # unary node b passes through when routing
    preds = spark.createDataFrame([(1, "Root", "b", 1), (1, "Root", "a", 0)], "id long, parent string, child string, pred int")
    reached = {r.node for r in T.route(preds, edges).collect()}
    assert reached == {"b", "b1"}


def test_deep_chain_keeps_every_level(spark):
    chain = ["Root"] + [f"n{i}" for i in range(8)] + ["n7x"]
    pairs = list(zip(chain, chain[1:]))[:8] + [("n6", "n7x")]       # the last node branches
    edges = spark.createDataFrame(pairs, "parent string, child string")
    d = {r.node: r.depth for r in T.depth(edges).collect()}
    assert d == {"Root": 0, **{f"n{i}": i + 1 for i in range(8)}, "n7x": 8}
    labels = spark.createDataFrame([(1, "n7"), (2, "n7x")], "id long, cat string")
    gold = {(r.child, r.id): r.y for r in T.edge_gold(labels, edges, T.closure(edges)).collect()}
    assert gold == {("n7", 1): 1, ("n7x", 1): 0, ("n7", 2): 0, ("n7x", 2): 1}
    preds = spark.createDataFrame([(1, "n6", "n7", 1)], "id long, parent string, child string, pred int")
    assert {r.node for r in T.route(preds, edges).collect()} == {f"n{i}" for i in range(8)}


def test_cycle_is_an_error(spark):
    import pytest
    with pytest.raises(ValueError):
        T.closure(spark.createDataFrame([("a", "b"), ("b", "a")], "parent string, child string"))


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "aa bb bb"), (2, "aa cc"), (3, "aa bb")], "id long, text string")
    tf = X.term_counts(X.tokens(docs, "id", "text"), "id")
    v = X.vocabulary(X.term_stats(docs, "text"), min_df=1)
    w = {(r.id, r.term): r.w for r in X.weights(tf, v, "id", docs.agg(F.count(F.lit(1)).alias("n")), "tfidf").collect()}
    idf = lambda df: math.log((1 + 3) / (1 + df)) + 1
    raw = {"aa": 1 * idf(3), "bb": 2 * idf(2)}
    nrm = math.sqrt(sum(x * x for x in raw.values()))
    assert abs(w[(1, "bb")] - raw["bb"] / nrm) < 1e-12


def test_edge_gold_spreads_hot_nodes_and_keeps_rows_without_id(spark):
    from kestrel.operators import tree as T
    edges = spark.createDataFrame([("Root", "a"), ("Root", "b"), ("a", "a/x"), ("a", "a/y")], "parent string, child string")
    labels = spark.createDataFrame([(i, "a/x") for i in range(50)] + [(None, "b"), (7, "b"), (7, "b"), (3, "misc")], "id long, cat string")
    got = T.edge_gold(labels, edges, T.closure(edges)).collect()
    want = {("Root", "a", i): 1 for i in range(50)} | {("Root", "b", i): int(i == 7) for i in range(50)} \
        | {("a", "a/x", i): 1 for i in range(50)} | {("a", "a/y", i): 0 for i in range(50)} | {("Root", "a", None): 0, ("Root", "b", None): 0}
    assert len(got) == len(want) and {(r.parent, r.child, r.id): r.y for r in got} == want
    rows = spark.range(1000).selectExpr("id", "'Root' AS node")
    one = spark.createDataFrame([("Root", 1), ("Root", 2)], "node string, n int")
    out = T.spread_join(rows, one, "node", "id")
    assert out.count() == 2000 and set(out.columns) == {"id", "node", "n"}


def test_text_weights_count_by_id_without_moving_tokens(spark, tmp_path):
    from kestrel.plans import QUERIES, load_all
    load_all()
    rows = [(1, "red red green"), (2, "green blue"), (2, "green red"), (None, "blue blue"), (4, None), (5, "once")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.term): round(r.w, 6) for r in QUERIES["text_tf_l2"](spark, str(tmp_path)).collect()}
    assert got == {(1, "red"): 0.894427, (1, "green"): 0.447214, (2, "green"): 0.816497, (2, "blue"): 0.408248, (2, "red"): 0.408248, (None, "blue"): 1.0}
    plan = QUERIES["text_tf_l2"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(doc_id, term" not in plan.replace("#", " ").replace("L", "")
