"""Regression & inference as distributed sufficient statistics.

Simple regressions use the SQL ``regr_*`` aggregates (partial aggregation, any
group count).  Multi-regressor fits aggregate the moment matrix ``X'X, X'y,
y'y`` per group with ``groupBy().agg`` and solve the k x k system in a grouped
pandas function that only ever sees one row of moments per group.  Newey-West
covariances sum lagged score cross-products with an explode + equi-join on the
observation index, so no series is collected anywhere.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage


# ----------------------------------------------------------- simple OLS -----
def ols_simple(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """slope, intercept, R^2, classical SE and t of the slope."""
    by = by or []
    g = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by)
    s = g.agg(F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("beta"), F.regr_intercept(y, x).alias("alpha"),
              F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"),
              F.regr_sxy(y, x).alias("_sxy"))
    se = F.sqrt((F.col("_syy") - F.col("beta") * F.col("_sxy")) / (F.col("n") - 2) / F.col("_sxx"))
    return s.select(*by, "n", "beta", "alpha", "r2", se.alias("se_beta"),
                    (F.col("beta") / se).alias("t_beta"))


def cross_section_betas(df: DataFrame, d: str, x: str, y: str, weight: str | None = None,
                        min_n: int = 3, by: list[str] | None = None) -> DataFrame:
    """Per-date (and per ``by``) OLS or WLS slope/intercept from sums."""
    by = by or []
    m = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if weight is None:
        g = m.groupBy(*by, d).agg(F.regr_slope(y, x).alias("beta"), F.regr_intercept(y, x).alias("alpha"),
                                  F.count(F.lit(1)).alias("n"))
    else:
        w, X, Y = F.col(weight), F.col(x), F.col(y)
        s = m.groupBy(*by, d).agg(F.sum(w).alias("sw"), F.sum(w * X).alias("swx"), F.sum(w * Y).alias("swy"),
                                  F.sum(w * X * X).alias("swxx"), F.sum(w * X * Y).alias("swxy"),
                                  F.count(F.lit(1)).alias("n"))
        den = F.nullif(F.col("sw") * F.col("swxx") - F.col("swx") * F.col("swx"), F.lit(0.0))
        beta = (F.col("sw") * F.col("swxy") - F.col("swx") * F.col("swy")) / den
        g = s.select(*by, d, "n", beta.alias("beta"),
                     ((F.col("swy") - beta * F.col("swx")) / F.col("sw")).alias("alpha"))
    return g.where(F.col("n") >= min_n)


def fama_macbeth(df: DataFrame, d: str, x: str, y: str, by: list[str] | None = None,
                 weight: str | None = None, min_n: int = 3) -> DataFrame:
    """Time-series mean of per-date slopes; t = mean / (sd / sqrt(T))."""
    by = by or []
    b = cross_section_betas(df, d, x, y, weight, min_n, by).where(F.col("beta").isNotNull())
    se = F.stddev_samp("beta") / F.sqrt(F.count("beta"))
    return b.groupBy(*by).agg(F.count("beta").alias("n_months"), F.avg("beta").alias("mean_beta"),
                              se.alias("se_beta"), (F.avg("beta") / se).alias("t_stat"),
                              F.avg("alpha").alias("mean_alpha"))


# ------------------------------------- several regressors, several specs ---
def cross_section_specs(df: DataFrame, d: str, specs: dict[str, tuple[str, list[str], str | None]]) -> DataFrame:
    """(spec, d, term, coef): least squares of y on a constant and the regressors for every date
    and every spec ``name: (y, regressors, weight or None)``.

    All specs come from one aggregation by date: each has the weighted moments of its own listwise
    sample (positive weights) in an array.  Dates with fewer than k + 2 rows have no coefficients;
    collinear ones null."""
    aggs, terms = [], {}
    for name, (y, xs, weight) in specs.items():
        use, cols = F.col(y).isNotNull(), [F.lit(1.0), *[F.col(x) for x in xs], F.col(y)]
        for x in xs:
            use = use & F.col(x).isNotNull()
        w = F.lit(1.0)
        if weight:
            w, use = F.col(weight), use & (F.col(weight) > 0)
        sums = [F.sum(F.when(use, w * a * b)) for i, a in enumerate(cols) for b in cols[i:]]
        aggs.append(F.array(F.count(F.when(use, 1)).cast("double"), *sums).alias(name))
        terms[name] = ["const", *xs]
    moments = df.groupBy(d).agg(*aggs)

    def solve(batches):
        for pdf in batches:
            out = []
            for name, names in terms.items():
                k = len(names)
                m = np.array([np.array([np.nan if v is None else v for v in r], float) for r in pdf[name]]).reshape(len(pdf), -1)
                keep = m[:, 0] >= k + 1       # k counts the constant: rows >= regressors + 2
                m, dates = m[keep], pdf[d][keep].to_numpy()
                if not len(m):
                    continue
                full = np.empty((len(m), k + 1, k + 1))
                at = 1
                for i in range(k + 1):
                    for j in range(i, k + 1):
                        full[:, i, j] = full[:, j, i] = m[:, at]
                        at += 1
                total, mean = full[:, 0, 0], full[:, 0, 1:] / full[:, :1, 0]
                around = full[:, 1:, 1:] - total[:, None, None] * mean[:, :, None] * mean[:, None, :]
                xx, xy = around[:, :-1, :-1], around[:, :-1, -1]
                size = np.sqrt(np.maximum(np.einsum("nii->ni", xx), 0))
                unit = np.where(size > 0, size, 1.0)
                corr = xx / unit[:, :, None] / unit[:, None, :]
                bad = (size == 0).any(1) | (np.abs(np.linalg.det(corr)) < 1e-12)
                corr[bad] = np.eye(k - 1)
                beta = np.linalg.solve(corr, (xy / unit)[:, :, None])[:, :, 0] / unit
                beta[bad] = np.nan
                const = mean[:, -1] - (beta * mean[:, :-1]).sum(1)
                for term, values in zip(names, np.column_stack([const, beta]).T):
                    out.append(pd.DataFrame({"spec": name, d: dates, "term": term, "coef": values}))
            if out:
                yield pd.concat(out)

    schema = f"spec string, {d} {df.schema[d].dataType.simpleString()}, term string, coef double"
    return moments.mapInPandas(solve, schema).withColumn("coef", F.when(~F.isnan("coef"), F.col("coef")))


def fama_macbeth_specs(df: DataFrame, d: str, specs: dict[str, tuple[str, list[str], str | None]]) -> DataFrame:
    """(spec, term, n_months, mean_beta, se_beta, t_stat) over the dates of each spec."""
    b = cross_section_specs(df, d, specs).where(F.col("coef").isNotNull())
    se = F.stddev_samp("coef") / F.sqrt(F.count("coef"))
    return b.groupBy("spec", "term").agg(F.count("coef").alias("n_months"), F.avg("coef").alias("mean_beta"), se.alias("se_beta"),
                                         (F.avg("coef") / se).alias("t_stat"))


# ------------------------------------------------------------ Newey-West -----
def nw_lag(n: Column) -> Column:
    """floor(4 (n/100)^(2/9))."""
    return F.floor(4 * F.pow(n / 100.0, 2.0 / 9.0)).cast("int")


def hac_simple(df: DataFrame, order: str, x: str, y: str, by: list[str] | None = None,
               lags: int | None = None) -> DataFrame:
    """OLS y = a + b x with Newey-West (Bartlett) covariance, no small-sample
    correction, lag = floor(4 (n/100)^(2/9)) unless given.

    Residual scores g_t = u_t (1, x_t); Gamma_l = sum_t g_t g_{t-l}'.  The lag
    sums are an explode of l = 0..L and an equi-join on (group, t - l)."""
    by = by or []
    m = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, order, x, y)
    fit = m.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("beta"),
                             F.regr_intercept(y, x).alias("alpha"), F.regr_r2(y, x).alias("r2"),
                             F.sum(x).alias("sx"), F.sum(F.col(x) * F.col(x)).alias("sxx"))
    L = F.lit(lags) if lags is not None else nw_lag(F.col("n"))
    fit = fit.withColumn("nlags", L)
    # series index per group: one row per observation date (calendar-bounded)
    w = Window.partitionBy(*by).orderBy(order)
    u = _attach(m, fit.select(*by, "alpha", "beta", "nlags"), by)
    u = u.select(*by, F.row_number().over(w).alias("t"), F.col(x).alias("x"),
                 (F.col(y) - F.col("alpha") - F.col("beta") * F.col(x)).alias("u"), "nlags")
    lagged = u.select(*by, "t", "x", "u", F.explode(F.sequence(F.lit(0), F.col("nlags"))).alias("lag"), "nlags")
    prev = u.select(*[F.col(c).alias(f"_p_{c}") for c in by], F.col("t").alias("tp"),
                    F.col("x").alias("xp"), F.col("u").alias("up"))
    cond = [F.col(c) == F.col(f"_p_{c}") for c in by] + [F.col("t") - F.col("lag") == F.col("tp")]
    j = lagged.join(prev, cond)
    wt = F.when(F.col("lag") == 0, F.lit(0.5)).otherwise(1 - F.col("lag") / (F.col("nlags") + 1))
    # S = G0 + sum_l w_l (G_l + G_l'); with w_0 = 1/2 the symmetric sum covers l = 0 too
    agg = j.groupBy(*by).agg(
        F.sum(wt * 2 * F.col("u") * F.col("up")).alias("s00"),
        F.sum(wt * F.col("u") * F.col("up") * (F.col("x") + F.col("xp"))).alias("s01"),
        F.sum(wt * 2 * F.col("u") * F.col("x") * F.col("up") * F.col("xp")).alias("s11"))
    out = _attach(fit, agg, by)
    # H = (X'X)^-1 for X = [1, x]
    det = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    h00, h01, h11 = F.col("sxx") / det, -F.col("sx") / det, F.col("n") / det
    s00, s01, s11 = F.col("s00"), F.col("s01"), F.col("s11")
    # V = H S H, only the diagonal is needed
    v11 = h01 * h01 * s00 + 2 * h01 * h11 * s01 + h11 * h11 * s11
    v00 = h00 * h00 * s00 + 2 * h00 * h01 * s01 + h01 * h01 * s11
    return out.select(*by, "n", F.col("nlags").alias("L"), "alpha", "beta", "r2", F.sqrt(v00).alias("nw_se_alpha"),
                      F.sqrt(v11).alias("nw_se_beta"), (F.col("alpha") / F.sqrt(v00)).alias("nw_t_alpha"),
                      (F.col("beta") / F.sqrt(v11)).alias("nw_t_beta"))


def _attach(df: DataFrame, per_group: DataFrame, by: list[str]) -> DataFrame:
    """Attach per-group values: an equi-join on the group keys, or with no
    keys the one-row aggregate as a scalar subquery (no join at all)."""
    if by:
        return df.join(per_group, by)
    from kestrel.functions import attach_scalars
    return attach_scalars(df, per_group)


# -------------------------------------------------------- k-regressor OLS ---
def moments(df: DataFrame, xs: list[str], y: str, by: list[str] | None = None,
            weight: str | None = None) -> DataFrame:
    """Per group: n, sum of x_i x_j (i <= j, with the constant), x_i y, y y."""
    by = by or []
    cols = ["_one", *xs]
    m = df.where(F.col(y).isNotNull())
    for c in xs:
        m = m.where(F.col(c).isNotNull())   # listwise deletion
    m = m.withColumn("_one", F.lit(1.0))
    wv = F.col(weight) if weight else F.lit(1.0)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.sum(wv * F.col(a) * F.col(b)).alias(f"xx__{a}__{b}"))
        aggs.append(F.sum(wv * F.col(a) * F.col(y)).alias(f"xy__{a}"))
    aggs.append(F.sum(wv * F.col(y) * F.col(y)).alias("yy"))
    aggs.append(F.sum(wv * F.col(y)).alias("sy"))
    aggs.append(F.sum(wv).alias("sw"))
    return m.groupBy(*by).agg(*aggs)


def solve_moments(mom: DataFrame, xs: list[str], by: list[str] | None = None, model_col: str | None = None) -> DataFrame:
    """Solve the normal equations for each group's single moment row:
    returns (by..., term, coef, se, t, n, r2, ser)."""
    by = list(by or [])
    cols = ["_one", *xs]
    names = ["const", *xs]
    k = len(cols)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():          # one row per group
            A = np.zeros((k, k))
            b = np.zeros(k)
            for i, a in enumerate(cols):
                for j, c in enumerate(cols):
                    lo, hi = (a, c) if i <= j else (c, a)
                    A[i, j] = r[f"xx__{lo}__{hi}"]
                b[i] = r[f"xy__{a}"]
            n = int(r["n"])
            try:
                beta = np.linalg.solve(A, b)
                rss = float(r["yy"] - 2 * beta @ b + beta @ A @ beta)
                dof = n - k
                s2 = rss / dof if dof > 0 else float("nan")
                cov = s2 * np.linalg.inv(A)
                se = np.sqrt(np.diag(cov))
                tss = float(r["yy"] - r["sy"] ** 2 / r["sw"])
                r2 = 1 - rss / tss if tss > 0 else float("nan")
            except np.linalg.LinAlgError:
                beta = np.full(k, np.nan)
                se = np.full(k, np.nan)
                rss, r2, s2 = float("nan"), float("nan"), float("nan")
            for i, nm in enumerate(names):
                rec = {c: r[c] for c in by}
                rec.update(term=nm, coef=float(beta[i]), se=float(se[i]),
                           t=float(beta[i] / se[i]) if se[i] else float("nan"),
                           n=n, r2=r2, rss=rss, ser=math.sqrt(s2) if s2 == s2 and s2 >= 0 else float("nan"))
                out.append(rec)
        return pd.DataFrame(out, columns=[*by, "term", "coef", "se", "t", "n", "r2", "rss", "ser"])

    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in mom.schema.fields if f.name in by)
    schema = (key_schema + ", " if key_schema else "") + \
        "term string, coef double, se double, t double, n long, r2 double, rss double, ser double"
    if not by:
        mom = mom.withColumn("_g", F.lit(1))
        return mom.groupBy("_g").applyInPandas(lambda p: solve(p.drop(columns=["_g"])), schema)
    # one-argument wrapper: applyInPandas passes (key, pdf) to 2-arg functions
    return mom.groupBy(*by).applyInPandas(lambda p: solve(p), schema)


def ols_multi(df: DataFrame, xs: list[str], y: str, by: list[str] | None = None,
              weight: str | None = None) -> DataFrame:
    return solve_moments(moments(df, xs, y, by, weight), xs, by)


def ols_specs(df: DataFrame, specs: dict[str, list[str]], y: str) -> DataFrame:
    """(spec, term, coef, se, t, n, r2, rss, ser): regressions of ``y`` on several regressor lists over
    one common sample, the rows where ``y`` and every regressor of every list are known.  The
    moments of all regressors come from one scan; each list is a sub-matrix of them."""
    every = list(dict.fromkeys(x for xs in specs.values() for x in xs))
    table = cut_lineage(moments(df, every, y))      # one row
    fits = [solve_moments(table, sorted(xs, key=every.index)).withColumn("spec", F.lit(name)) for name, xs in specs.items()]
    return reduce(DataFrame.unionByName, fits)


def hac_multi(df: DataFrame, order: str, xs: list[str], y: str, by: list[str] | None = None) -> DataFrame:
    """k-regressor OLS with Newey-West covariance.  Each group is one time
    series (one row per date), handed whole to a grouped pandas function; the
    group size is bounded by the calendar, not by the data volume."""
    by = list(by or [])
    names = ["const", *xs]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order).dropna(subset=[*xs, y])
        n = len(pdf)
        X = np.column_stack([np.ones(n), pdf[xs].to_numpy(float)])
        yv = pdf[y].to_numpy(float)
        H = np.linalg.inv(X.T @ X)
        beta = H @ X.T @ yv
        u = yv - X @ beta
        L = int(math.floor(4 * (n / 100.0) ** (2.0 / 9.0)))
        g = X * u[:, None]
        S = g.T @ g
        for lag in range(1, L + 1):
            G = g[lag:].T @ g[:-lag]
            S += (1 - lag / (L + 1)) * (G + G.T)
        V = H @ S @ H
        se = np.sqrt(np.diag(V))
        tss = float(((yv - yv.mean()) ** 2).sum())
        r2 = 1 - float(u @ u) / tss if tss > 0 else float("nan")
        keys = {c: pdf[c].iloc[0] for c in by}
        return pd.DataFrame([{**keys, "term": nm, "coef": beta[i], "nw_se": se[i], "nw_t": beta[i] / se[i],
                              "n": n, "L": L, "r2": r2} for i, nm in enumerate(names)])

    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name in by)
    schema = (key_schema + ", " if key_schema else "") + \
        "term string, coef double, nw_se double, nw_t double, n long, L int, r2 double"
    sel = df.select(*by, order, *xs, y)
    if not by:
        sel = sel.withColumn("_g", F.lit(1))
        return sel.groupBy("_g").applyInPandas(lambda p: fit(p.drop(columns=["_g"])), schema)
    return sel.groupBy(*by).applyInPandas(lambda p: fit(p), schema)


def nested_f(full: DataFrame, restricted: DataFrame, q: int) -> DataFrame:
    """F = ((RSS_r - RSS_f)/q) / (RSS_f/(n-k)) from two solve_moments outputs."""
    f = full.groupBy().agg(F.first("rss").alias("rss_f"), F.first("n").alias("n"), F.count(F.lit(1)).alias("k"))
    r = restricted.groupBy().agg(F.first("rss").alias("rss_r"))
    j = _attach(f, r, [])
    return j.select("n", "k", F.lit(q).alias("q"), "rss_f", "rss_r",
                    (((F.col("rss_r") - F.col("rss_f")) / q) / (F.col("rss_f") / (F.col("n") - F.col("k")))).alias("F"))
