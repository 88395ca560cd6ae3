"""Autoregressions with and without an exogenous column, refitted at every date.

A least-squares fit only needs the moments X'X and X'y.  Running sums of the
products of each row's regressors give the moments of all rows before every date
in one window per series, so an expanding refit is one small solve per date and the
fit on the training rows is that of the first test date.  Series are centred and scaled
first (an intercept is fitted, so results do not depend on it)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIELDS = "p int, exog boolean, n_train int, n_test int, train_mse double, long_mse double, rolling_mse double"


def detrend_on_train(df: DataFrame, by: list[str], split: str = "split") -> DataFrame:
    """``y`` without the line fitted to the rows up to ``split`` only, test rows included."""
    w = Window.partitionBy(*by).orderBy("t")
    d = df.withColumn("_i", F.row_number().over(w).cast("double"))
    train = d.where(F.col("t") <= F.col(split))
    line = train.groupBy(*by).agg(F.regr_slope("y", "_i").alias("_b"), F.regr_intercept("y", "_i").alias("_a"))
    return d.join(line, by).withColumn("y", F.col("y") - F.col("_a") - F.col("_b") * F.col("_i")).drop("_i", "_a", "_b")


def prefix_moments(df: DataFrame, by: list[str], p: int, exog: bool) -> DataFrame:
    """``df`` with lags 1..p (``l1``..), the row number ``idx`` and, over all earlier rows that have p
    lags, the sums ``xx_i_j`` (i <= j), ``xy_i``, ``yy`` and ``n_fit``; regressors are the
    constant, the lags and ``x``."""
    w = Window.partitionBy(*by).orderBy("t")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    level = df.groupBy(*by).agg(F.avg("y").alias("_m"), F.coalesce(F.nullif(F.stddev_pop("y"), F.lit(0.0)), F.lit(1.0)).alias("scale"))
    d = df.join(level, by).withColumn("y", (F.col("y") - F.col("_m")) / F.col("scale"))
    if exog:
        unit = df.groupBy(*by).agg(F.avg("x").alias("_mx"), F.coalesce(F.nullif(F.stddev_pop("x"), F.lit(0.0)), F.lit(1.0)).alias("_sx"))
        d = d.join(unit, by).withColumn("x", (F.col("x") - F.col("_mx")) / F.col("_sx"))
    d = d.select("*", F.row_number().over(w).alias("idx"), *[F.lag("y", j).over(w).alias(f"l{j}") for j in range(1, p + 1)])
    usable = F.col(f"l{p}").isNotNull()
    cols = [F.lit(1.0), *[F.col(f"l{j}") for j in range(1, p + 1)], *([F.col("x")] if exog else [])]
    k = len(cols)
    sums = {f"xx_{i}_{j}": cols[i] * cols[j] for i in range(k) for j in range(i, k)}
    sums.update({f"xy_{i}": cols[i] * F.col("y") for i in range(k)}, yy=F.col("y") * F.col("y"), n_fit=F.lit(1.0))
    return d.select("*", *[F.coalesce(F.sum(F.when(usable, v)).over(before), F.lit(0.0)).alias(c) for c, v in sums.items()])


def evaluate_splits(df: DataFrame, by: list[str], p: int, exog: bool = False, split: str = "split") -> DataFrame:
    """(by, p, exog, n_train, n_test, train_mse, long_mse, rolling_mse) for the split date in
    column ``split``: the fit on rows up to it, its recursive path over the test rows, and one-step
    forecasts by the fit on all rows before each test date.  A series without test rows or
    with p + 2 training rows or fewer has no row.  Test rows of a series are one group
    (one per calendar step)."""
    k = p + 1 + exog
    test = prefix_moments(df, by, p, exog).where(F.col("t") > F.col(split))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        n_train = int(pdf["idx"].iloc[0]) - 1
        if n_train <= p + 2:
            return pd.DataFrame([])
        n = len(pdf)
        xx, xy = np.empty((n, k, k)), np.empty((n, k))
        for i in range(k):
            xy[:, i] = pdf[f"xy_{i}"]
            for j in range(i, k):
                xx[:, i, j] = xx[:, j, i] = pdf[f"xx_{i}_{j}"]
        beta = (np.linalg.pinv(xx, hermitian=True) @ xy[:, :, None])[:, :, 0]
        y = pdf["y"].to_numpy(float)
        lags = pdf[[f"l{j}" for j in range(1, p + 1)]].to_numpy(float)
        extra = pdf[["x"]].to_numpy(float) if exog else np.empty((n, 0))
        rolling = y - (np.column_stack([np.ones(n), lags, extra]) * beta).sum(1)
        first, unit = beta[0], float(pdf["scale"].iloc[0]) ** 2
        train = float(pdf["yy"].iloc[0]) - 2 * first @ xy[0] + first @ xx[0] @ first
        path, history = np.empty(n), list(lags[0][::-1])     # oldest first
        for t in range(n):
            path[t] = first[0] + first[1:p + 1] @ np.array(history[::-1][:p]) + (first[p + 1:] @ extra[t])
            history.append(path[t])
        row = {c: pdf[c].iloc[0] for c in by}
        row.update(p=p, exog=exog, n_train=n_train, n_test=n, train_mse=max(train, 0.0) / pdf["n_fit"].iloc[0] * unit,
                   long_mse=float(((y - path) ** 2).mean()) * unit, rolling_mse=float((rolling ** 2).mean()) * unit)
        return pd.DataFrame([row])

    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name in by)
    return test.groupBy(*by).applyInPandas(lambda pdf: solve(pdf), f"{keys}, {FIELDS}")


# ---- ARMAX -------------------------------------------------------------
def _inverse(ma: np.ndarray, n: int) -> np.ndarray:
    """First n coefficients of 1 / (1 + ma_1 B + ma_2 B^2 + ...)."""
    out, back = [1.0], ma[::-1].tolist()
    for t in range(1, n):
        past = out[max(0, t - len(back)):]
        out.append(-sum(a * b for a, b in zip(back[len(back) - len(past):], past)))
    return np.array(out)


def _residuals(params: np.ndarray, y: np.ndarray, x: np.ndarray, p: int, q: int) -> np.ndarray:
    """One-step residuals; rows before the largest lag have residual zero.  Parameters: constant,
    p lags, q residual lags, x if there is one more."""
    first = max(p, q)
    u = y[first:] - params[0]
    for j in range(1, p + 1):
        u = u - params[j] * y[first - j:len(y) - j]
    if len(params) > 1 + p + q:
        u = u - params[-1] * x[first:]
    return np.concatenate([np.zeros(first), np.convolve(_inverse(params[p + 1:p + 1 + q], len(u)), u)[:len(u)]])


def _derivatives(params: np.ndarray, e: np.ndarray, y: np.ndarray, x: np.ndarray, p: int, q: int) -> np.ndarray:
    """Derivatives of the residuals by the parameters (rows from the largest lag on)."""
    first, n = max(p, q), len(y)
    columns = [np.ones(n - first), *[y[first - j:n - j] for j in range(1, p + 1)], *[e[first - j:n - j] for j in range(1, q + 1)],
               *([x[first:]] if len(params) > 1 + p + q else [])]
    inverse = _inverse(params[p + 1:p + 1 + q], n - first)
    return -np.column_stack([np.convolve(inverse, c)[:n - first] for c in columns])


def armax(y: np.ndarray, x: np.ndarray | None, n_train: int, p: int, q: int, long_ar: int = 12, rounds: int = 40):
    """(train mse, test mse, rows of the fit) of an ARMAX(p, q).

    Hannan-Rissanen: a long autoregression gives residuals, a regression on lagged
    values, lagged residuals and x the first parameters; the third stage repeats regressions of the
    model's own residuals on their derivatives (halving a step that does not help)
    until the sum of squares settles.  Test errors are one step ahead with the parameters
    of the training rows.  None where the training rows are too few."""
    first, lead = max(p, q), long_ar + max(p, q)
    extra = np.zeros((len(y), 0)) if x is None else x[:, None]
    k = 1 + p + q + extra.shape[1]
    if n_train - lead <= k or not np.isfinite(y).all() or not np.isfinite(extra).all():
        return None
    middle, unit = y[:n_train].mean(), y[:n_train].std() or 1.0
    z = (y - middle) / unit
    v = np.zeros(len(y)) if x is None else (x - x[:n_train].mean()) / (x[:n_train].std() or 1.0)
    tr, xt = z[:n_train], v[:n_train]

    def lagged(s, lags, start):
        return np.column_stack([s[start - j:len(s) - j] for j in range(1, lags + 1)])
    design = np.column_stack([np.ones(n_train - long_ar), lagged(tr, long_ar, long_ar), *([xt[long_ar:]] if x is not None else [])])
    residual = np.concatenate([np.zeros(long_ar), tr[long_ar:] - design @ np.linalg.lstsq(design, tr[long_ar:], rcond=None)[0]])
    design = np.column_stack([np.ones(n_train - lead), lagged(tr, p, lead), lagged(residual, q, lead), *([xt[lead:]] if x is not None else [])])
    params = np.linalg.lstsq(design, tr[lead:], rcond=None)[0]

    def loss(b):
        with np.errstate(all="ignore"):
            e = _residuals(b, tr, xt, p, q)
            s = float(e @ e)
        return (s, e) if np.isfinite(s) else (np.inf, e)
    now = loss(params)
    while now[0] > 4 * n_train and np.abs(params[p + 1:p + 1 + q]).max(initial=0) > 1e-6:   # a start that explodes: damp it
        params = params.copy()
        params[p + 1:p + 1 + q] /= 2
        now = loss(params)
    for _ in range(rounds):
        with np.errstate(all="ignore"):
            slope = _derivatives(params, now[1], tr, xt, p, q)
        if not np.isfinite(now[0]) or not np.isfinite(slope).all():
            return None
        step = -np.linalg.lstsq(slope, now[1][first:], rcond=None)[0]
        size, then = 1.0, loss(params + step)
        while then[0] > now[0] and size > 1e-4:
            size /= 2
            then = loss(params + size * step)
        if then[0] > now[0]:
            break
        gain, params, now = now[0] - then[0], params + size * step, then
        if gain <= 1e-10 * now[0]:
            break
    with np.errstate(all="ignore"):
        e = _residuals(params, z, v, p, q)
        train, test = e[first:n_train] ** 2, e[n_train:] ** 2
        return float(train.mean() * unit ** 2), float(test.mean() * unit ** 2) if len(test) else float("nan"), n_train - first


# ---- unit roots --------------------------------------------------------
# Published response surfaces of the Dickey-Fuller t statistic with a constant.
# Distribution (for small and for large statistics, from P_SWITCH on): probit of the p-value as a polynomial.
P_SMALL, P_LARGE = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)
P_MIN, P_SWITCH, P_MAX = -18.83, -1.61, 2.74
# Critical values: polynomials in 1 / n.
CRITICAL = {1: (-3.43035, -6.5393, -16.786, -79.433), 5: (-2.86154, -2.8903, -4.234, -40.040), 10: (-2.56677, -1.5384, -2.809, 0.0)}


def adf_p_value(t: float) -> float:
    from math import erf, sqrt
    if t > P_MAX:
        return 1.0
    if t < P_MIN:
        return 0.0
    z = sum(c * t ** i for i, c in enumerate(P_SMALL if t <= P_SWITCH else P_LARGE))
    return 0.5 * (1 + erf(z / sqrt(2)))


def adf_critical(level: int, n: int) -> float:
    return sum(c / n ** i for i, c in enumerate(CRITICAL[level]))


def adf(y: np.ndarray, max_lag: int | None = None) -> dict:
    """Augmented Dickey-Fuller test with a constant: lag (by AIC on the rows that all lags share, up
    to ceil(12 (n / 100)^(1/4)) unless given), t statistic of the refit on all rows for that lag,
    p-value and 5 % critical value by response surfaces.  Null statistics for a series that
    is too short or does not vary."""
    n = len(y)
    bound = int(np.ceil(12 * (n / 100) ** 0.25)) if max_lag is None else max_lag
    bound = min(bound, n // 2 - 2)
    nothing = {"lag": None, "adf_t": None, "p_value": None, "n": 0, "crit_5pct": None}
    if bound < 0 or not np.isfinite(y).all() or np.ptp(y) == 0:
        return nothing
    change = np.diff(y)

    def design(lag, start):
        past = [change[start - j:len(change) - j] for j in range(1, lag + 1)]
        return np.column_stack([y[start:-1], np.ones(len(change) - start), *past]), change[start:]

    def fit(lag, start):
        a, b = design(lag, start)
        beta, _, rank, _ = np.linalg.lstsq(a, b, rcond=None)
        r = b - a @ beta
        return a, beta, float(r @ r), rank == a.shape[1] and len(b) > a.shape[1]
    best = None
    for lag in range(bound + 1):
        a, _, rss, full = fit(lag, bound)
        if full and rss > 0:
            aic = len(a) * np.log(rss / len(a)) + 2 * a.shape[1]
            best = min(best or (np.inf, 0), (aic, lag))
    if best is None:
        return nothing
    a, beta, rss, full = fit(best[1], best[1])
    if not full:
        return nothing
    error = np.sqrt(rss / (len(a) - a.shape[1]) * np.linalg.inv(a.T @ a)[0, 0])
    t = float(beta[0] / error)
    return {"lag": best[1], "adf_t": t, "p_value": adf_p_value(t), "n": len(a), "crit_5pct": adf_critical(5, len(a))}
