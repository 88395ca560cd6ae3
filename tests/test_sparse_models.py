"""Block-wise products, the truncated SVD and the edge models against NumPy on
whole small matrices; rows without features are kept everywhere."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import linear, sparse
from kestrel.operators import text as X
from kestrel.plans import QUERIES, load_all

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(0, "red red green blue sky"), (1, "green blue"), (2, None), (3, ""), (4, "once"), (5, "red sky sky"), (6, "blue blue green sky x"),
            (7, "sun moon star"), (8, "sun star star red"), (9, "moon sun"), (10, "star moon blue"), (11, "red green")]
    return spark.createDataFrame(rows, "id long, text string")


def dense(rows):
    rows = sorted(rows, key=lambda r: r.id)
    keys = sorted({k for r in rows for k in r["keys"]})
    a = np.zeros((len(rows), len(keys)))
    for i, r in enumerate(rows):
        for k, v in zip(r["keys"], r["values"]):
            a[i, keys.index(k)] = v
    return a, keys


def test_counts_inside_rows(spark, texts):
    got = {(r.id, r.term): r.tf for r in X.row_counts(texts, "id", "text").collect()}
    want = {(r.id, r.term): r.tf for r in X.term_counts(X.tokens(texts, "id", "text"), "id").collect()}
    assert got == want and got[0, "red"] == 2


def test_tfidf_rows(spark, texts):
    with sparse.tfidf_rows(texts, "id", "text") as (rows, vocabulary):
        got, terms = {r.id: r for r in rows.collect()}, {r.key: (r.term, r.df) for r in vocabulary.collect()}
    assert len(got) == 12 and all(list(got[i]["keys"]) == [] for i in (2, 3, 4))
    assert all(df >= 2 for _, df in terms.values()) and ("once", 1) not in terms.values()
    r = got[0]
    raw = {"red": 2, "green": 1, "blue": 1, "sky": 1}
    w = {t: n * (np.log(13 / (1 + dict(terms.values())[t])) + 1) for t, n in raw.items()}
    norm = np.sqrt(sum(x * x for x in w.values()))
    assert {terms[k][0]: round(v, 12) for k, v in zip(r["keys"], r["values"])} == {t: round(x / norm, 12) for t, x in w.items()}


@pytest.mark.parametrize("entries", [10, 1000])
def test_svd_equals_numpy(spark, texts, entries):
    with sparse.tfidf_rows(texts, "id", "text") as (rows, _):
        a, keys = dense(rows.collect())
        with sparse.truncated_svd(rows, "id", 4, oversample=3, block_entries=entries) as (s, left, right):
            coordinates = {r.id: r.vec for r in left.collect()}
            v = {r.key: r.vec for r in right.collect()}
    u, want, _ = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(s, want[:4], atol=1e-7)
    got = np.array([coordinates[i] for i in range(12)])
    assert np.allclose(np.abs(got), np.abs(u[:, :4] * want[:4]), atol=1e-5)
    v = np.array([v[k] for k in keys])
    assert np.allclose(a @ v, got, atol=1e-8) and (v.sum(0) >= -1e-9).all()


def minimum(a, y, c):
    """Least |w|^2 / 2 + C sum of squared hinges by Newton steps with halving."""
    def value(w):
        return w @ w / 2 + c * (np.maximum(1 - y * (a @ w), 0) ** 2).sum()
    w = np.zeros(a.shape[1])
    for _ in range(200):
        gap = 1 - y * (a @ w)
        on = gap > 0
        grad = w - 2 * c * a[on].T @ (y[on] * gap[on])
        step = np.linalg.solve(np.eye(len(w)) + 2 * c * a[on].T @ a[on], grad)
        t = 1.0
        while value(w - t * step) > value(w) and t > 1e-10:
            t /= 2
        w = w - t * step
    return w


@pytest.mark.parametrize("entries, costs, near", [(1000, [0.5, 4.0], 2e-3), (40, [0.5], 2e-2)])   # one block a unit, several
def test_edge_models_are_the_minimum(spark, texts, entries, costs, near):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(12):
        for parent, children in (("Root", ["a", "b", "c"]), ("a", [f"a{j}" for j in range(9)])):
            rows += [(parent, ch, i, int(rng.random() < .4), "train" if i % 4 else "test") for ch in children]
    rows += [("b", "only", i, 1, "train") for i in range(12)]     # one class: no model
    gold = spark.createDataFrame(rows, "parent string, child string, id long, y int, split string")
    with sparse.tfidf_rows(texts, "id", "text") as (features, _):
        a, _keys = dense(features.collect())
        with linear.trained(gold, features, costs, tolerance=near / 1000, max_rounds=30, block_entries=entries) as (w, slots, blocks):
            got = {(r.parent, r.child, r.c, r.id): (r.margin, r.y) for r in linear.margins(w, slots, blocks, costs).collect()}
    a = np.column_stack([np.ones(12), a])
    edges = {(p, ch) for p, ch, *_ in rows}
    seen = 0
    for p, ch in edges:
        mine = {i: (y, s) for q, k, i, y, s in rows if (q, k) == (p, ch)}
        train = [i for i in mine if mine[i][1] == "train"]
        y = np.array([2.0 * mine[i][0] - 1 for i in train])
        if len(set(y)) < 2:
            assert (p, ch, 0.5, 0) not in got
            continue
        for c in costs:
            w_ = minimum(a[train], y, c)
            assert np.allclose([got[p, ch, c, i][0] for i in range(12)], a @ w_, atol=near), (p, ch, c)
            assert [got[p, ch, c, i][1] for i in range(12)] == [mine[i][0] for i in range(12)]
            seen += 12
    assert len(got) == seen


def test_edge_queries_count_every_document(spark):
    load_all()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    test_rows = spark.read.parquet(f"{SF}/documents.parquet").where((F.col("doc_id") % 100 * 7919) % 100 >= 80).count()
    from kestrel.plans import ml_queries as M
    c = M.edge_confusion(spark, SF, [1.0], M.C.hash_split)
    per = c.where("parent = 'Root'").groupBy("child", "split").agg(F.sum(F.expr("tp + fp + fn + tn")).alias("n")).collect()
    assert per and all(r.n == (test_rows if r.split == "test" else n - test_rows) for r in per)
    r = QUERIES["clf_c_by_depth"](spark, SF).collect()
    assert r and all(x.c in M.COSTS and 0 <= x.val_f1 <= 1 for x in r)


def test_text_svd_has_every_document(spark):
    load_all()
    out = QUERIES["text_svd"](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.count() == n * 20 and out.select("doc_id").distinct().count() == n
    sums = out.groupBy("component").agg(F.sum(F.col("coordinate") ** 2).alias("sq"), F.first("singular_value").alias("s")).collect()
    assert all(abs(r.sq - r.s ** 2) < 1e-2 for r in sums)


def test_svd_keeps_the_tables_of_one_round(spark, texts):
    import os
    from kestrel.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    with sparse.tfidf_rows(texts, "id", "text") as (rows, _):
        before = set(os.listdir(folder))
        with sparse.truncated_svd(rows, "id", 4, oversample=3) as _:
            # blocks, their terms, the last round, the coordinates
            assert len([x for x in set(os.listdir(folder)) - before if x.startswith("table-")]) == 4
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"


def test_a_term_twice_in_a_row_counts_with_its_sum():
    import pyarrow as pa
    csr = sparse.Csr(pa.array([[1, 1, 4], [], [4]], pa.list_(pa.int64())), pa.array([[1.0, 2.0, 3.0], [], [5.0]], pa.list_(pa.float64())))
    a = np.array([[3.0, 3.0], [0, 0], [0, 5.0]])
    d, e = np.array([[1.0, 2], [3, 4]]), np.array([[1.0], [2], [3]])
    assert np.allclose(csr.times(d), a @ d) and np.allclose(csr.transposed_times(e), a.T @ e) and np.allclose(csr.squares(e), (a * a).T @ e)


def test_edge_models_keep_the_tables_of_one_round(spark, texts):
    import os
    from kestrel.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    gold = spark.createDataFrame([("Root", f"c{j}", i, int(i % 9 == j), "train") for i in range(12) for j in range(9)],
                                 "parent string, child string, id long, y int, split string")
    with sparse.tfidf_rows(texts, "id", "text") as (features, _):
        before = set(os.listdir(folder))
        with linear.trained(gold, features, [1.0], passes=1, tolerance=1e-9, max_rounds=3) as (_, slots, blocks):
            # slots, rows, blocks, their terms; changes, weights and unsettled units of the last round
            assert len([x for x in set(os.listdir(folder)) - before if x.startswith("table-")]) <= 7
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
            assert slots.select("unit").distinct().count() == 1 and blocks.rows.count() == 12    # a document comes once for nine edges


def test_blocks_damp_only_the_terms_they_share():
    import pyarrow as pa
    lists = (pa.array([[1, 2], [3, 4]], pa.list_(pa.int64())), pa.array([[.6, .8], [.8, .6]], pa.list_(pa.float64())))
    csr, y, costs = sparse.Csr(*lists), np.array([[1.0], [-1.0]]), np.array([1.0])
    got = {}
    for name, damping in (("alone", np.ones(4)), ("shared", np.array([1.0, 1, 2, 2]))):   # blocks with terms 1 to 4
        alpha, w = np.zeros((2, 1)), np.zeros((4, 1))
        linear.coordinate_pass(csr, y, np.ones((2, 1), bool), alpha, w, costs, damping, 50, 0)
        got[name] = alpha[:, 0]
        assert np.allclose(w[:, 0] / damping, (csr.transposed_times(alpha * y))[:, 0])
    # each alpha is at its minimum: alpha (damped square + 1 / 2C) = 1
    assert np.allclose(got["alone"], 1 / 1.5) and np.allclose(got["shared"], [1 / 1.5, 1 / 2.5])


def block_input(rows, y):
    import pyarrow as pa
    sizes = np.array([len(r) for r in rows])
    return pa.record_batch({"keys": pa.array([sorted(r) for r in rows], pa.list_(pa.int64())), "y": pa.array(y, pa.list_(pa.int32())),
                            "values": pa.array([[r[k] for k in sorted(r)] for r in rows], pa.list_(pa.float64()))}) if len(sizes) else None


def test_a_block_is_solved_whatever_most_rows_share():
    """The constant and a few common terms make the problem ill-conditioned: a few steps must do, with several strips of rows."""
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(300):
        r = {int(k): rng.random() + .1 for k in rng.choice(60, 6, replace=False) + 10} | {k: 1.0 for k in range(3)}
        norm = np.sqrt(sum(x * x for x in r.values()))
        rows.append({-1: 1.0} | {k: x / norm for k, x in r.items()})
    y = [[int(rng.random() < .2), int(rng.random() < .5), None] for _ in rows]
    block, costs = linear.Block(3, np.array([0.5, 4.0])), np.array([0.5, 4.0])
    steps, old = [0], linear.Rows.transposed_times
    for a in range(0, 300, 97):
        block.documents(block_input(rows[a:a + 97], y[a:a + 97]))
    try:
        linear.Rows.transposed_times = lambda *a: steps.__setitem__(0, steps[0] + 1) or old(*a)
        keys, w, _, _ = block.solved(1e-4)
    finally:
        linear.Rows.transposed_times = old
    a = np.zeros((300, len(keys)))
    for i, r in enumerate(rows):
        for k, x in r.items():
            a[i, np.flatnonzero(keys == k)[0]] = x
    for slot in range(2):
        sign = np.array([2.0 * t[slot] - 1 for t in y])
        for j, c in enumerate(costs):
            assert np.allclose(a @ w[:, slot * 2 + j], a @ minimum(a, sign, c), atol=2e-3)
    assert not w[:, 4:].any() and steps[0] < 60


def test_a_shared_block_has_the_minimum_of_the_damped_problem():
    import pyarrow as pa
    block = linear.Block(1, np.array([1.0]))
    none = pa.nulls(4, pa.list_(pa.float64()))
    block.dense(pa.record_batch({"key": pa.array([4, 1, 2, 3], pa.int64()), "holders": pa.array([2, 1, 1, 2], pa.int64()), "vec": none, "own": none}))
    block.documents(block_input([{1: .6, 2: .8}, {3: .8, 4: .6}], [[1], [0]]))
    keys, w, moved, size = block.solved(1e-6)
    got = dict(zip(keys.tolist(), w[:, 0]))       # alpha times y times x, with the alpha of test_blocks_damp_only_the_terms_they_share
    want = {1: .6 / 1.5, 2: .8 / 1.5, 3: -.8 / 2.5, 4: -.6 / 2.5}
    assert all(np.isclose(got[k], x, atol=1e-5) for k, x in want.items()) and size == 0 and np.isclose(moved, sum(x * x for x in want.values()), atol=1e-5)


def test_units_of_one_block_take_one_round(spark, texts, monkeypatch):
    gold = spark.createDataFrame([("Root", f"c{j}", i, int(i % 3 == j), "train") for i in range(12) for j in range(3)],
                                 "parent string, child string, id long, y int, split string")
    monkeypatch.setattr(linear, "add_vectors", lambda *a: pytest.fail("a round of sums"))
    with sparse.tfidf_rows(texts, "id", "text") as (features, _):
        with linear.trained(gold, features, [1.0]) as (weights, _, blocks):
            assert blocks.needs.isEmpty() and weights.count() > 0
