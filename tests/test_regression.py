"""Inference invariants: NW 2x2 SQL sandwich == NumPy HAC; moment solve ==
lstsq; Fama-MacBeth skip rule."""

import numpy as np
from pyspark.sql import functions as F

from kestrel.operators import regression as R


def _series(spark, n=200, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    e = np.convolve(rng.normal(size=n + 2), [1, 0.5, 0.25])[:n]
    y = 2 + 3 * x + e
    return spark.createDataFrame([(i, float(a), float(b), "g") for i, (a, b) in enumerate(zip(x, y))],
                                 "t long, x double, y double, g string"), x, y


def test_hac_simple_matches_numpy(spark):
    df, x, y = _series(spark)
    a = R.hac_simple(df, "t", "x", "y", by=["g"]).first()
    b = {r.term: r for r in R.hac_multi(df, "t", ["x"], "y", by=["g"]).collect()}
    assert abs(a.beta - b["x"].coef) < 1e-9
    assert abs(a.nw_se_beta - b["x"].nw_se) < 1e-9
    assert abs(a.nw_se_alpha - b["const"].nw_se) < 1e-9


def test_moment_solve_matches_lstsq(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(100, 3))
    y = X @ [1.0, -2.0, 0.5] + 0.3 + rng.normal(size=100) * 0.1
    df = spark.createDataFrame([tuple(map(float, r)) + (float(v),) for r, v in zip(X, y)], "a double, b double, c double, y double")
    got = {r.term: r.coef for r in R.ols_multi(df, ["a", "b", "c"], "y").collect()}
    ref, *_ = np.linalg.lstsq(np.column_stack([np.ones(100), X]), y, rcond=None)
    for k, v in zip(["const", "a", "b", "c"], ref):
        assert abs(got[k] - v) < 1e-8


def test_fama_macbeth_skips_small_months(spark):
    rows = [("m1", 1.0, 2.0), ("m1", 2.0, 4.1), ("m1", 3.0, 5.9), ("m2", 1.0, 1.0), ("m2", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "d string, x double, y double")
    r = R.fama_macbeth(df, "d", "x", "y").first()
    assert r.n_months == 1


def test_specs_equal_numpy_per_date(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    rows = []
    for d in range(6):
        for i in range([3, 4, 12, 40, 40, 9][d]):
            x, z = rng.normal(), rng.normal()
            rows.append((d, 2 * x if d != 4 else 5.0, None if rng.random() < .1 else z, None if rng.random() < .1 else x - z + rng.normal(), rng.random() - .1))
    df = spark.createDataFrame([tuple(None if v is None else float(v) if i else v for i, v in enumerate(r)) for r in rows],
                               "d long, x double, z double, y double, w double")
    specs = {"a": ("y", ["x"], None), "b": ("y", ["x", "z"], None), "c": ("y", ["x", "z"], "w"), "e": ("y", ["z", "x", "w"], None)}
    got = {(r.spec, r.d, r.term): r.coef for r in R.cross_section_specs(df, "d", specs).collect()}
    seen = 0
    for name, (_, xs, weight) in specs.items():
        for d in range(6):
            use = [dict(zip("dxzyw", r)) for r in rows if r[0] == d]
            use = [r for r in use if r["y"] is not None and all(r[c] is not None for c in xs) and (not weight or r["w"] > 0)]
            if len(use) < len(xs) + 2:
                assert (name, d, "const") not in got
                continue
            if d == 4 and "x" in xs:      # x does not vary
                assert got[name, d, "x"] is None
                seen += len(xs) + 1
                continue
            a = np.array([[1.0] + [r[c] for c in xs] for r in use])
            s = np.sqrt([r["w"] if weight else 1.0 for r in use])
            want = np.linalg.lstsq(a * s[:, None], np.array([r["y"] for r in use]) * s, rcond=None)[0]
            for t, v in zip(["const", *xs], want):
                assert abs(got[name, d, t] - v) < 1e-8
                seen += 1
    assert seen == len(got)
