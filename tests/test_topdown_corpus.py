"""Top-down walk against brute force; merged corpora, label vectors, cross table and stratified
split; wide files, audited uploads; regressions on a common sample; empty grid cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import corpus as C
from kestrel.operators import quality as Q
from kestrel.operators import regression as R
from kestrel.operators import sparse, topdown
from kestrel.operators import tree as T
from kestrel.sources import files as FS
from tests.test_sparse_models import dense, minimum

EDGES = [("Root", "x"), ("Root", "y"), ("x", "x1"), ("x", "x2"), ("x", "x3"), ("y", "only"), ("only", "o1"), ("only", "o2")]
WORDS = {"x1": "ruby scarlet crimson", "x2": "ruby navy azure", "x3": "ruby lime moss", "o1": "snow chalk ivory", "o2": "snow soot coal"}


@pytest.fixture(scope="module")
def walked(spark):
    rng = np.random.default_rng(3)
    leaf = {i: ["x1", "x2", "o1"][i % 3] for i in range(48)}    # nobody in x3 and o2
    noise = ["plum", "rope", "lamp", "desk"]
    texts = {i: " ".join([*rng.choice(WORDS[c].split(), 3), *rng.choice(noise, 2)]) for i, c in leaf.items()}
    texts |= {48: None, 49: "", 50: "unheard"}
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    edges = spark.createDataFrame(EDGES, "parent string, child string")
    primary = spark.createDataFrame([*leaf.items(), (48, "gone")], "id long, cat string")
    hops = topdown.next_hops(primary, edges, T.closure(edges))
    gold = topdown.node_gold(hops, edges).withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    with sparse.tfidf_rows(docs, "id", "text") as (features, _):
        rows = sorted(features.collect(), key=lambda r: r.id)
        out = {n: {r.id: (r.node, r.path) for r in topdown.walk(gold, hops.where("id % 4 <> 0"), edges, features, block_entries=n).collect()}
               for n in (1000, 60)}
    return leaf, rows, hops.collect(), out


def test_hops_follow_the_primary_path(walked):
    leaf, _, hops, _ = walked
    got = {(r.id, r.node): r.next_hop for r in hops}
    assert got[0, "Root"] == "x" and got[0, "x"] == "x1"
    assert (got[2, "Root"], got[2, "y"], got[2, "only"]) == ("y", "only", "o1")
    assert not any(i == 48 for i, _ in got) and len(got) == sum(3 if c == "o1" else 2 for c in leaf.values())


@pytest.mark.parametrize("entries", [1000, 60])      # one block a node, several
def test_walk_equals_brute_force(walked, entries):
    leaf, rows, hops, out = walked
    a, _ = dense(rows)
    a = np.column_stack([np.ones(len(rows)), a])
    hop = {(r.id, r.node): r.next_hop for r in hops}
    children = {}
    for p, c in EDGES:
        children.setdefault(p, []).append(c)
    models = {}
    for p, cs in children.items():
        train = [i for i in leaf if i % 4 and (i, p) in hop]
        for c in cs:
            y = np.array([1.0 if hop[i, p] == c else -1.0 for i in train])
            if len(set(y)) == 2:
                models[p, c] = minimum(a[train], y, 1.0)
    assert {p for p, _ in models} == {"Root", "x"} and ("x", "x3") not in models     # unseen children have none
    for i in range(len(rows)):
        node, path, clear = "Root", ["Root"], True
        while node in children:
            m = sorted(((-(a[i] @ w), c) for (p, c), w in models.items() if p == node))
            clear &= not m or m[1][0] - m[0][0] > 0.05
            seen = [hop[k, node] for k in leaf if k % 4 and (k, node) in hop]
            node = m[0][1] if m else min(children[node], key=lambda c: (-seen.count(c), c))
            path.append(node)
        assert clear, i
        assert out[entries][i] == (node, ">".join(path))
    assert len(out[entries]) == len(rows)
    assert np.mean([out[entries][i][0] == c for i, c in leaf.items()]) > 0.9


def test_walk_without_documents(spark):
    edges = spark.createDataFrame(EDGES, "parent string, child string")
    hops = spark.createDataFrame([], "id long, node string, next_hop string")
    gold = topdown.node_gold(hops, edges).withColumn("split", F.lit("train"))
    features = spark.createDataFrame([], "id long, keys array<long>, values array<double>")
    assert topdown.walk(gold, hops, edges, features).count() == 0


def test_merge_split_policies(spark):
    tr = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], "id long, text string")
    te = spark.createDataFrame([(2, "other", "t"), (3, "c", "t"), (None, "m", "t")], "id long, text string, topic string")

    def rows(**kw):
        return sorted(((r.id or 0, r.text, r.split, r.fit, r.topic) for r in C.merge_split(tr, te, "id", **kw).collect()), key=str)
    mine = [(1, "a", "train", True, None), (1, "a", "train", True, None), (2, "b", "train", True, None), (0, "n", "train", False, None)]
    assert rows() == sorted([*mine, (3, "c", "test", True, "t"), (0, "m", "test", False, "t")], key=str)
    assert rows(pool="train_only") == sorted([*mine, (3, "c", "test", False, "t"), (0, "m", "test", False, "t")], key=str)
    both = rows(exclude_overlap=False, pool="train_only")
    assert (2, "other", "test", True, "t") in both and (3, "c", "test", False, "t") in both and len(both) == 7
    with pytest.raises(ValueError):
        C.merge_split(tr, te, "id", pool="all")


def test_label_vectors_and_crosstab(spark):
    lab = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c"), (3, None)], "id long, cat string")
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    d = C.label_dictionary(lab)
    assert {(r.cat, r.idx) for r in d.collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert {r.id: list(r.indices) for r in C.label_vectors(ids, lab, d).collect()} == {1: [0, 1], 2: [2], 3: [], 4: []}
    cats = spark.createDataFrame([("a",), ("z",)], "cat string")
    got = {(r.id, r.cat): r.n for r in C.crosstab(ids, lab, cats).collect()}
    assert got == {(i, c): 2 if (i, c) == (1, "a") else 0 for i in (1, 2, 3, 4) for c in "az"}
    none = lab.where("false")
    assert C.label_dictionary(none).count() == 0 and C.label_vectors(ids, none, C.label_dictionary(none)).count() == 4


def test_stratified_split_is_exact(spark):
    rows = [(i, "hot" if i < 333 else "b" if i < 340 else None) for i in range(341)]
    out = C.stratified_split(spark.createDataFrame(rows, "id long, s string"), "s", "id").collect()
    train = [r.s for r in out if r.split == "train"]
    assert len(out) == 341 and [train.count(x) for x in ("hot", "b", None)] == [266, 6, 1]


def test_wide_dates_round_trip(spark, tmp_path):
    rows = [(1, "2020-01-01", 1.5), (1, "2020-03-01", None), (2, "2020-02-01", -2.25), (3, "2020-03-01", 1e-7)]
    long = spark.createDataFrame(rows, "region long, d string, y double").withColumn("d", F.col("d").cast("date"))
    FS.write_wide_dates(long, "region", "d", "y", f"{tmp_path}/w")
    out = FS.read_wide_dates(spark, f"{tmp_path}/w")
    assert {(r.region, str(r.t), r.y) for r in out.collect()} == {(str(a), b, c) for a, b, c in rows if c is not None}


def test_wide_dates_finds_its_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,2020-01-31,name,2020-13-01,2020-02-29,total\n7,1,\"x, y\",5,n/a,9\n8,,z,5,2.5,9\n")
    out = FS.read_wide_dates(spark, str(tmp_path / "a.csv"))
    assert out.columns == ["id", "name", "total", "t", "y"]
    assert {(r.id, r.name, str(r.t), r.y) for r in out.collect()} == {("7", "x, y", "2020-01-31", 1.0), ("8", "z", "2020-02-29", 2.5)}
    (tmp_path / "b.csv").write_text("id,name\n7,x\n")
    assert FS.read_wide_dates(spark, str(tmp_path / "b.csv")).count() == 0


def test_upload_is_committed_only_after_its_audit(spark, tmp_path):
    def audit(df):
        return Q.validate_upload(df, ["id"], "w")
    good = spark.createDataFrame([(1, .5), (2, -.5)], "id long, w double")
    path = f"{tmp_path}/up"
    for bad in ([(1, 0.0)], [(1, float("nan"))], [(1, None)], [(1, float("inf"))], [(1, .5), (1, .5)]):
        with pytest.raises(ValueError, match="refused"):
            FS.commit_upload(spark.createDataFrame(bad, "id long, w double"), path, audit)
        assert not list(tmp_path.iterdir())
    assert FS.commit_upload(good, path, audit).n_rows == 2
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, .5), (2, -.5)}
    with pytest.raises(FileExistsError):
        FS.commit_upload(good, path, audit)
    assert [p.name for p in tmp_path.iterdir()] == ["up"]


def test_specs_share_one_sample(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 3))
    y = x @ [1.0, 2.0, 0.0] + rng.normal(size=60)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    rows += [(1.0, 1.0, None, 50.0), (None, 1.0, 1.0, 50.0), (1.0, 1.0, 1.0, None)]    # outside the common sample
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    got = {(r.spec, r.term): r for r in R.ols_specs(df, {"one": ["a"], "back": ["b", "a"], "all": ["a", "b", "c"]}, "y").collect()}
    for name, cols in (("one", [0]), ("back", [0, 1]), ("all", [0, 1, 2])):
        m = np.column_stack([np.ones(60), x[:, cols]])
        b, *_ = np.linalg.lstsq(m, y, rcond=None)
        rss = float(((y - m @ b) ** 2).sum())
        se = np.sqrt(np.diag(np.linalg.inv(m.T @ m)) * rss / (60 - m.shape[1]))
        for k, term in enumerate(["const", *("abc"[c] for c in cols)]):
            r = got[name, term]
            assert r.n == 60 and np.allclose([r.coef, r.se, r.rss], [b[k], se[k], rss], atol=1e-8)
    assert len(got) == 9


def test_empty_cells(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, None), (1, 2, 2.0), (2, 1, None), (2, 1, None), (3, 3, 1.0)], "d int, id int, ret double")
    r = Q.empty_cells(df, "d", "id", "ret").first()
    assert (r.empty_ret_cells, r.max_empty_ret_per_date) == (6, 3)
