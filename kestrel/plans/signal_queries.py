"""Per-entity windows and signals (survey 2.6) and the cross-sectional
regression family built on them (Fama-MacBeth OLS / WLS / batch)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import panel as P
from kestrel.operators import regression as R
from kestrel.plans.registry import query
from kestrel.plans.sqlbind import PANEL_M, PANEL_Q, PANEL_R, PANEL_S, with_
from kestrel.sources import bindings as B

SIGNALS = ["ret_t12", "ret_t12m1", "ret_t12_1m", "vol_t12m1", "sr_t12m1"]
TARGETS = ["ret_f1m", "ret_f3m", "ret_f6m"]

_SIG = with_(PANEL_M, PANEL_R) + """
, sig0 AS (
  SELECT id, d, ret, price, vol,
    CASE WHEN count(ret) OVER w12 = 12 THEN product(1 + ret) OVER w12 - 1 END AS ret_t12,
    CASE WHEN count(ret) OVER w11s = 11 THEN product(1 + ret) OVER w11s - 1 END AS ret_t12m1,
    lag(ret, 12) OVER w AS ret_t12_1m,
    CASE WHEN count(ret) OVER w11s = 11 THEN stddev_samp(ret) OVER w11s END AS vol_t12m1,
    lead(ret, 1) OVER w AS ret_f1m,
    CASE WHEN count(ret) OVER f3 = 3 THEN product(1 + ret) OVER f3 - 1 END AS ret_f3m,
    CASE WHEN count(ret) OVER f6 = 6 THEN product(1 + ret) OVER f6 - 1 END AS ret_f6m
  FROM panel_r
  WINDOW w AS (PARTITION BY id ORDER BY d),
         w12 AS (PARTITION BY id ORDER BY d ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
         w11s AS (PARTITION BY id ORDER BY d ROWS BETWEEN 11 PRECEDING AND 1 PRECEDING),
         f3 AS (PARTITION BY id ORDER BY d ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING),
         f6 AS (PARTITION BY id ORDER BY d ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING)),
sig AS (SELECT *, ret_t12m1 / nullif(vol_t12m1, 0) AS sr_t12m1 FROM sig0)
"""


#: with the second return stream: the eleven signals of the coverage table
ALL_SIGNALS = ["ret_t12", "retx_t12", "ret_t12m1", "retx_t12m1", "ret_t12_1m", "retx_t12_1m", "volx_t12m1", "srx_t12m1", *TARGETS]
_SIG2 = _SIG.replace(PANEL_M, PANEL_S).replace(", " + PANEL_R, "").replace("FROM panel_r", "FROM panel_s").replace(
    "SELECT id, d, ret, price, vol,", """SELECT id, d, ret, retx, price, vol, ln(price * vol / 1000.0) AS w,
    CASE WHEN count(retx) OVER w12 = 12 THEN product(1 + retx) OVER w12 - 1 END AS retx_t12,
    CASE WHEN count(retx) OVER w11s = 11 THEN product(1 + retx) OVER w11s - 1 END AS retx_t12m1,
    lag(retx, 12) OVER w AS retx_t12_1m,
    CASE WHEN count(retx) OVER w11s = 11 THEN stddev_samp(retx) OVER w11s END AS volx_t12m1,""").replace(
    "AS sr_t12m1 FROM sig0", "AS sr_t12m1, retx_t12m1 / nullif(volx_t12m1, 0) AS srx_t12m1 FROM sig0")


def signals(spark, sf):
    """Momentum signals per supplier, materialised once (the regression queries
    read them several times)."""
    from kestrel.session import cut_lineage
    return cut_lineage(P.momentum_signals(B.panel_returns(spark, sf)))


def all_signals(spark, sf):
    """The signals of both return streams, and the log of price x volume as weight ``w``."""
    both = P.price_stream_signals(P.momentum_signals(B.panel_streams(spark, sf)))
    cap = F.col("price") * F.col("vol") / 1000.0
    return both.withColumn("w", F.when(cap > 0, F.log(cap)))


def _sel(*cols):
    return lambda spark, sf: signals(spark, sf).select("id", "d", *cols)


@query("win_simple_return", rnd=["ret"], sql=with_(PANEL_M, PANEL_R) + "SELECT id, d, ret FROM panel_r")
def win_simple_return(spark, sf):
    return B.panel_returns(spark, sf).select("id", "d", "ret")


@query("win_diff", rnd=["dprice", "logret"], sql=with_(PANEL_M) + """
SELECT id, d, price - lag(price) OVER (PARTITION BY id ORDER BY d) AS dprice,
       ln(price) - ln(lag(price) OVER (PARTITION BY id ORDER BY d)) AS logret FROM panel_m""")
def win_diff(spark, sf):
    m = B.panel_monthly(spark, sf)
    m = P.diff(m, "price", "id", "d", "dprice")
    return P.log_returns(m, out="logret").select("id", "d", "dprice", "logret")


@query("log_transforms", rnd=["ln_price", "log1p_ret", "growth"], sql=with_(PANEL_M, PANEL_R) + """
SELECT id, d, ln(price) AS ln_price, ln(1 + ret) AS log1p_ret,
       100 * (ln(price) - ln(lag(price) OVER (PARTITION BY id ORDER BY d))) AS growth FROM panel_r""")
def log_transforms(spark, sf):
    r = B.panel_returns(spark, sf)
    w = Window.partitionBy("id").orderBy("d")
    return r.select("id", "d", F.log("price").alias("ln_price"), F.log1p("ret").alias("log1p_ret"),
                    (100 * (F.log("price") - F.log(F.lag("price").over(w)))).alias("growth"))


@query("win_trailing_compound", rnd=["ret_t12", "retx_t12"], sql=_SIG2 + "SELECT id, d, ret_t12, retx_t12 FROM sig")
def win_trailing_compound(spark, sf):
    """12-row compounded return of both streams, NULL unless 12 non-null returns (S6)."""
    return all_signals(spark, sf).select("id", "d", "ret_t12", "retx_t12")


@query("udf_rolling_apply", rnd=["ret_t12"], sql=_SIG + "SELECT id, d, ret_t12 FROM sig")
def udf_rolling_apply(spark, sf):
    """The reference's rolling .apply(np.prod) as a built-in product over a
    row frame (no Python UDF)."""
    r = B.panel_returns(spark, sf)
    return r.select("id", "d", P.trailing_compound("id", "d", "ret", 12).alias("ret_t12"))


@query("win_trailing_skip", rnd=["ret_t12m1", "retx_t12m1"], sql=_SIG2 + "SELECT id, d, ret_t12m1, retx_t12m1 FROM sig")
def win_trailing_skip(spark, sf):
    """11-row compounded return lagged by one row, of both streams."""
    return all_signals(spark, sf).select("id", "d", "ret_t12m1", "retx_t12m1")


@query("win_lag_k", rnd=["ret_t12_1m", "retx_t12_1m"], sql=_SIG2 + "SELECT id, d, ret_t12_1m, retx_t12_1m FROM sig")
def win_lag_k(spark, sf):
    """The return twelve rows ago, of both streams."""
    return all_signals(spark, sf).select("id", "d", "ret_t12_1m", "retx_t12_1m")


@query("win_signal_vol_sharpe", rnd=["vol_t12m1", "sr_t12m1"], sql=_SIG + "SELECT id, d, vol_t12m1, sr_t12m1 FROM sig")
def win_signal_vol_sharpe(spark, sf):
    return _sel("vol_t12m1", "sr_t12m1")(spark, sf)


@query("win_forward_compound", rnd=TARGETS, sql=_SIG + "SELECT id, d, ret_f1m, ret_f3m, ret_f6m FROM sig")
def win_forward_compound(spark, sf):
    return _sel(*TARGETS)(spark, sf)


@query("win_signal_coverage", rnd=["mean", "sd", "min", "max"], sql=_SIG2 + " UNION ALL ".join(
    f"SELECT '{c}' AS signal, count({c}) AS n, count(*) AS n_rows, avg({c}) AS mean, stddev_samp({c}) AS sd, min({c}) AS min, max({c}) AS max FROM sig"
    for c in ALL_SIGNALS))
def win_signal_coverage(spark, sf):
    """Non-null count, mean, deviation and range of all eleven signals."""
    s = all_signals(spark, sf).unpivot([], ALL_SIGNALS, "signal", "x")
    return s.groupBy("signal").agg(F.count("x").alias("n"), F.count(F.lit(1)).alias("n_rows"), F.avg("x").alias("mean"),
                                   F.stddev_samp("x").alias("sd"), F.min("x").alias("min"), F.max("x").alias("max"))


@query("win_lag_matrix", rnd=[f"lag_{j}" for j in range(7)], sql=with_(PANEL_M, PANEL_R) + "SELECT id, d, " + ", ".join(
    f"lag(ret, {j}) OVER (PARTITION BY id ORDER BY d) AS lag_{j}" for j in range(7)) + " FROM panel_r")
def win_lag_matrix(spark, sf):
    """Lags 0..6 as feature columns (one window stage)."""
    r = B.panel_returns(spark, sf)
    w = Window.partitionBy("id").orderBy("d")
    return r.select("id", "d", *[F.lag("ret", j).over(w).alias(f"lag_{j}") for j in range(7)])


@query("win_ffill_bfill", rnd=["price_filled"], sql=with_(PANEL_M, PANEL_Q) + """
SELECT id, d, coalesce(
  last_value(price IGNORE NULLS) OVER (PARTITION BY id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(price IGNORE NULLS) OVER (PARTITION BY id ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  AS price_filled FROM panel_q""")
def win_ffill_bfill(spark, sf):
    q = B.panel_quality(spark, sf)
    return q.select("id", "d", P.ffill_bfill("price", ["id"], "d").alias("price_filled"))


_SIG_LONG = _SIG + """
, sl AS (UNPIVOT sig ON ret_t12, ret_t12m1, ret_t12_1m, vol_t12m1, sr_t12m1 INTO NAME signal VALUE x)
"""


@query("agg_pctile_of_pctile", rnd=["median_p5", "median_p25", "median_p50", "median_p75", "median_p95"],
       sql=_SIG_LONG + """
, per AS (SELECT signal, d, quantile_cont(x, 0.05) AS p5, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50,
                 quantile_cont(x, 0.75) AS p75, quantile_cont(x, 0.95) AS p95 FROM sl WHERE x IS NOT NULL GROUP BY signal, d)
SELECT signal, quantile_cont(p5, 0.5) AS median_p5, quantile_cont(p25, 0.5) AS median_p25, quantile_cont(p50, 0.5) AS median_p50,
       quantile_cont(p75, 0.5) AS median_p75, quantile_cont(p95, 0.5) AS median_p95 FROM per GROUP BY signal""")
def agg_pctile_of_pctile(spark, sf):
    """Median over dates of each per-date percentile, per signal: one unpivot,
    one groupBy(signal, d), one groupBy(signal)."""
    s = signals(spark, sf).unpivot(["id", "d"], SIGNALS, "signal", "x").where(F.col("x").isNotNull())
    from kestrel.operators.quality import exact_percentiles
    qs, names = [0.05, 0.25, 0.5, 0.75, 0.95], ["p5", "p25", "p50", "p75", "p95"]
    per = exact_percentiles(s, ["signal", "d"], "x", qs, names)
    # second level has one row per (signal, date): calendar-bounded groups
    return per.groupBy("signal").agg(*[F.percentile(n, 0.5).alias(f"median_{n}") for n in names])


# ------------------------------------------------------ Fama-MacBeth ---------
_FM_COLS = ["mean_beta", "se_beta", "t_stat"]


def _spec_sql(name: str, y: str, xs: list[str], weight: str | None) -> str:
    """(spec, term, d, coef) of one spec: closed forms for one or two regressors."""
    w = weight or "1.0"
    x1, x2 = xs[0], xs[-1]
    use = " AND ".join(f"{c} IS NOT NULL" for c in (y, *xs)) + (f" AND {w} > 0" if weight else "")
    pair = {"1": x1, "2": x2, "y": y}
    sums = ", ".join(f"sum({w} * {v}) / sum({w}) AS m{k}" for k, v in pair.items())
    cross = ", ".join(f"sum(w * (a{i} - m{i}) * (a{j} - m{j})) AS s{i}{j}" for i, j in ("11", "12", "22", "1y", "2y"))
    if len(xs) == 1:
        b1, b2, rest = "s1y / nullif(s11, 0)", "0", ""
    else:
        b1, b2 = (f"({n}) / nullif(s11 * s22 - s12 * s12, 0)" for n in ("s1y * s22 - s2y * s12", "s2y * s11 - s1y * s12"))
        rest = f" UNION ALL SELECT '{name}', '{x2}', d, {b2} FROM g"
    return f"""SELECT * FROM (WITH r AS (SELECT d, {w} AS w, {x1} AS a1, {x2} AS a2, {y} AS ay FROM sig WHERE {use}),
mm AS (SELECT d, {sums} FROM sig WHERE {use} GROUP BY d),
g AS (SELECT d, any_value(m1) AS m1, any_value(m2) AS m2, any_value(my) AS my, {cross} FROM r JOIN mm USING (d) GROUP BY d HAVING count(*) >= {len(xs) + 2})
SELECT '{name}' AS spec, '{x1}' AS term, d, {b1} AS coef FROM g UNION ALL SELECT '{name}', 'const', d, my - ({b1}) * m1 - ({b2}) * m2 FROM g{rest}) AS _{name}"""


def _fm_sql(specs: dict) -> str:
    return _SIG2 + ", betas AS (" + " UNION ALL ".join(_spec_sql(n, *v) for n, v in specs.items()) + """)
SELECT spec, term, count(coef) AS n_months, avg(coef) AS mean_beta, stddev_samp(coef) / sqrt(count(coef)) AS se_beta,
       avg(coef) / (stddev_samp(coef) / sqrt(count(coef))) AS t_stat FROM betas WHERE coef IS NOT NULL GROUP BY spec, term"""


_MOMENTUM = {"one": ("ret_f1m", ["ret_t12m1"], None), "two": ("ret_f1m", ["retx", "retx_t12m1"], None)}
_WEIGHTED = {n: (y, xs, "w") for n, (y, xs, _) in _MOMENTUM.items()}
# The specifications of the batch: single regressors, pairs, and the overlapping forward returns.
_BATCH = {f"s{i}": ("ret_f1m", xs, None) for i, xs in enumerate([
    ["retx"], ["ret"], ["ret_t12"], ["retx_t12"], ["ret_t12m1"], ["retx_t12m1"], ["ret_t12_1m"], ["retx_t12_1m"], ["srx_t12m1"],
    ["retx", "retx_t12m1"], ["ret", "retx_t12m1"], ["ret", "retx_t12"], ["ret", "srx_t12m1"], ["ret_f3m"], ["ret_f6m"]], 1)}


@query("reg_fama_macbeth", rnd=_FM_COLS, bench=True, sql=_fm_sql(_MOMENTUM))
def reg_fama_macbeth(spark, sf):
    """Per-month OLS of the forward return on the 12-1 momentum signal, and on the month's price
    return and the signal together; t of the time-series mean of each coefficient."""
    return R.fama_macbeth_specs(all_signals(spark, sf), "d", _MOMENTUM)


@query("reg_fm_batch", rnd=_FM_COLS, sql=_fm_sql(_BATCH))
def reg_fm_batch(spark, sf):
    """All fifteen specifications in one aggregation by month."""
    return R.fama_macbeth_specs(all_signals(spark, sf), "d", _BATCH)


@query("reg_fm_wls", rnd=_FM_COLS, sql=_fm_sql(_WEIGHTED))
def reg_fm_wls(spark, sf):
    """The same two regressions with weights ln(mcap), mcap > 0 and the weight positive."""
    return R.fama_macbeth_specs(all_signals(spark, sf), "d", _WEIGHTED)


@query("reg_coef_stability", rnd=["share_positive", "mean_beta", "min_beta", "max_beta"], sql=_SIG + """
, m AS (SELECT d, regr_slope(ret_f1m, ret_t12m1) AS beta FROM sig WHERE ret_t12m1 IS NOT NULL AND ret_f1m IS NOT NULL
        GROUP BY d HAVING count(*) >= 3)
SELECT count(beta) AS n_months, avg(CASE WHEN beta > 0 THEN 1.0 ELSE 0.0 END) AS share_positive, avg(beta) AS mean_beta,
       min(beta) AS min_beta, max(beta) AS max_beta FROM m WHERE beta IS NOT NULL""")
def reg_coef_stability(spark, sf):
    b = R.cross_section_betas(signals(spark, sf), "d", "ret_t12m1", "ret_f1m").where(F.col("beta").isNotNull())
    return b.agg(F.count("beta").alias("n_months"), F.avg(F.when(F.col("beta") > 0, 1.0).otherwise(0.0)).alias("share_positive"),
                 F.avg("beta").alias("mean_beta"), F.min("beta").alias("min_beta"), F.max("beta").alias("max_beta"))


@query("reg_cross_section", rnd=["beta", "alpha", "r2", "se_beta", "t_beta"], sql=_SIG + """
, c AS (SELECT ret_t12m1 AS x, ret_f1m AS y FROM sig WHERE d = DATE '1999-11-01' AND ret_t12m1 IS NOT NULL AND ret_f1m IS NOT NULL),
s AS (SELECT count(*) AS n, regr_slope(y, x) AS beta, regr_intercept(y, x) AS alpha, regr_r2(y, x) AS r2,
             regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy FROM c)
SELECT n, beta, alpha, r2, sqrt((syy - beta * sxy) / (n - 2) / sxx) AS se_beta,
       beta / sqrt((syy - beta * sxy) / (n - 2) / sxx) AS t_beta FROM s""")
def reg_cross_section(spark, sf):
    """One-date cross-sectional OLS with slope standard error and t."""
    s = signals(spark, sf).where(F.col("d") == F.lit("1999-11-01").cast("date"))
    return R.ols_simple(s.where(F.col("ret_t12m1").isNotNull() & F.col("ret_f1m").isNotNull()), "ret_t12m1", "ret_f1m")
