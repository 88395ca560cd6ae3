"""Expanding refits from running moments, ARMAX fits and unit-root tests against
plain NumPy refits and published values."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import forecast as FC

DAY0 = datetime.date(2000, 1, 1)


def months(n):
    return [datetime.date(2000 + i // 12, 1 + i % 12, 1) for i in range(n)]


def make(seed, n=60):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    y = np.zeros(n)
    for t in range(n):
        y[t] = 0.5 * y[t - 1] + 0.8 * x[t] + rng.normal() if t else rng.normal()
    return 1e6 * (5 + y + 0.05 * np.arange(n)), 0.1 + 0.01 * x


def refit(y, x, n_train, p):
    """Errors by a fresh least-squares fit at every test date."""
    def rows(end):
        a = np.column_stack([np.ones(end - p)] + [y[p - j:end - j] for j in range(1, p + 1)] + ([x[p:end]] if x is not None else []))
        return a, y[p:end]

    def one(b, past, t):
        return b[0] + sum(b[j] * past[t - j] for j in range(1, p + 1)) + (b[-1] * x[t] if x is not None else 0)
    a, v = rows(n_train)
    beta = np.linalg.lstsq(a, v, rcond=None)[0]
    path, long, roll = list(y[:n_train]), [], []
    for t in range(n_train, len(y)):
        path.append(one(beta, path, t))
        long.append(y[t] - path[-1])
        roll.append(y[t] - one(np.linalg.lstsq(*rows(t), rcond=None)[0], y, t))
    return ((v - a @ beta) ** 2).mean(), np.mean(np.square(long)), np.mean(np.square(roll))


@pytest.fixture(scope="module")
def frame(spark):
    rows = []
    for s in (1, 2):
        y, x = make(s)
        rows += [(s, t, float(a), float(b)) for t, a, b in zip(months(60), y, x)]
    rows += [(3, t, 7.0, 1.0) for t in months(60)] + [(4, t, float(i), 1.0) for i, t in enumerate(months(5))]   # constant, too short
    return spark.createDataFrame(rows, "series_id long, t date, y double, x double")


@pytest.mark.parametrize("p", [1, 4])
@pytest.mark.parametrize("exog", [False, True])
def test_running_moments_equal_refits(frame, p, exog):
    d = frame.withColumn("split", F.explode(F.array(*[F.lit(x).cast("date") for x in ("2002-12-31", "2003-06-30")])))
    got = {(r.series_id, r.split): r for r in FC.evaluate_splits(d, ["series_id", "split"], p, exog).collect()}
    assert {k[0] for k in got} == {1, 2, 3}
    for (s, split), r in got.items():
        n_train = sum(t <= split for t in months(60))
        assert (r.n_train, r.n_test, r.p, r.exog) == (n_train, 60 - n_train, p, exog)
        if s == 3:
            assert abs(r.train_mse) + abs(r.rolling_mse) < 1e-12
            continue
        y, x = make(s)
        want = refit(y, x if exog else None, n_train, p)
        assert np.allclose([r.train_mse, r.long_mse, r.rolling_mse], want, rtol=1e-6)


def test_detrending_sees_training_rows_only(frame):
    d = FC.detrend_on_train(frame.where("series_id = 1").withColumn("split", F.lit("2003-06-30").cast("date")), ["series_id"])
    y, _ = make(1)
    n = sum(t <= datetime.date(2003, 6, 30) for t in months(60))
    i = np.arange(1, 61)
    b, a = np.polyfit(i[:n], y[:n], 1)
    got = np.array([r.y for r in d.orderBy("t").collect()])
    assert np.allclose(got, y - a - b * i, rtol=1e-6, atol=1e-3)


def test_armax_reaches_the_least_squares(spark):
    rng = np.random.default_rng(8)
    n, x, e = 400, rng.normal(size=400), rng.normal(size=400)
    y = np.zeros(n)
    for t in range(1, n):
        y[t] = 2 + 0.6 * y[t - 1] + e[t] + 0.4 * e[t - 1] + 1.5 * x[t]
    train, test, rows = FC.armax(y, x, 300, 1, 1)
    assert rows == 299 and 0.8 < train < 1.25 and 0.7 < test < 1.4
    without, *_ = FC.armax(y, None, 300, 1, 1)
    assert without > 2 * train
    # no other parameters near the optimum do better: random search around the truth
    z, v = y[:300], x[:300]
    best = min(float((FC._residuals(np.array([2, .6, .4, 1.5]) + rng.normal(size=4) * s, z, v, 1, 1) ** 2)[1:].mean())
               for s in (.02, .05, .1) for _ in range(60))
    assert train <= best * 1.000001
    b, h = np.array([2, .6, -.3, .4, .2, 1.5]), 1e-6
    e = FC._residuals(b, z, v, 2, 2)
    plain = np.zeros(300)
    for t in range(2, 300):
        plain[t] = z[t] - 2 - .6 * z[t - 1] + .3 * z[t - 2] - .4 * plain[t - 1] - .2 * plain[t - 2] - 1.5 * v[t]
    assert np.allclose(e, plain)
    slope = np.column_stack([(FC._residuals(b + h * u, z, v, 2, 2) - e) / h for u in np.eye(6)])[2:]
    assert np.allclose(FC._derivatives(b, e, z, v, 2, 2), slope, atol=1e-3)
    assert FC.armax(y[:20], x[:20], 15, 4, 10) is None and FC.armax(np.full(60, np.nan), None, 40, 1, 1) is None


def test_adf_against_plain_regressions_and_published_values():
    rng = np.random.default_rng(2)
    y = np.cumsum(rng.normal(size=200))
    r = FC.adf(y, max_lag=0)
    a = np.column_stack([y[:-1], np.ones(199)])
    b, res, *_ = np.linalg.lstsq(a, np.diff(y), rcond=None)
    t = b[0] / np.sqrt(res[0] / 197 * np.linalg.inv(a.T @ a)[0, 0])
    assert abs(r["adf_t"] - t) < 1e-9 and r["n"] == 199 and r["lag"] == 0
    assert FC.adf(rng.normal(size=200))["p_value"] < 0.01 < FC.adf(y)["p_value"]
    assert 0 <= FC.adf(y)["lag"] <= 15
    for level, t in ((0.01, -3.43), (0.05, -2.86), (0.10, -2.57)):     # asymptotic table
        assert abs(FC.adf_p_value(t) - level) < 0.002 and abs(FC.adf_critical(int(level * 100), 10 ** 6) - t) < 0.01
    assert abs(FC.adf_critical(5, 100) + 2.89) < 0.01 and abs(FC.adf_critical(5, 25) + 2.99) < 0.01
    assert FC.adf_p_value(3.0) == 1.0 and FC.adf_p_value(-20.0) == 0.0
    for bad in ([5.0] * 40, [0.0], [1.0, float("nan")] * 20, []):
        assert FC.adf(np.array(bad, float))["adf_t"] is None
