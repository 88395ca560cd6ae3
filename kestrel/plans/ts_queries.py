"""Time series & spectra (survey 2.9) over 25 monthly nation revenue series
(and a monthly exogenous discount series), all series in parallel."""

from __future__ import annotations

import datetime
import math

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import forecast as FC
from kestrel.operators import timeseries as TS
from kestrel.plans.registry import query
from kestrel.plans.sqlbind import NATION_SERIES, with_
from kestrel.sources import bindings as B
from kestrel.sources.tables import load

_NS = with_(NATION_SERIES) + """
, ns AS (SELECT series_id, t, y, row_number() OVER (PARTITION BY series_id ORDER BY t) AS idx FROM nseries)
"""


def series(spark, sf):
    """Indexed nation series, materialised once (ACF / periodogram read it twice)."""
    from kestrel.session import cut_lineage
    return cut_lineage(TS.indexed(B.nation_series(spark, sf)))


@query("ts_growth", rnd=["growth"], sql=_NS + """
SELECT series_id, t, 100 * (ln(y) - ln(lag(y) OVER (PARTITION BY series_id ORDER BY t))) AS growth FROM ns""")
def ts_growth(spark, sf):
    s = series(spark, sf)
    w = Window.partitionBy("series_id").orderBy("t")
    return s.select("series_id", "t", (100 * (F.log("y") - F.log(F.lag("y").over(w)))).alias("growth"))


@query("ts_detrend_linear", rnd=["resid"], dp=3, sql=_NS + """
, fit AS (SELECT series_id, regr_slope(y, idx) AS b, regr_intercept(y, idx) AS a FROM ns GROUP BY series_id)
SELECT series_id, t, y - a - b * idx AS resid FROM ns JOIN fit USING (series_id)""")
def ts_detrend_linear(spark, sf):
    return TS.detrend_linear(series(spark, sf)).select("series_id", "t", "resid")


_ACF = _NS + """
, m AS (SELECT series_id, avg(y) AS mu, count(*) AS n FROM ns GROUP BY series_id),
c AS (SELECT ns.series_id, idx, y - mu AS e, n FROM ns JOIN m USING (series_id)),
lg AS (SELECT series_id, idx, e, unnest(generate_series(0, 12)) AS lag FROM c),
num AS (SELECT a.series_id, a.lag, sum(a.e * b.e) AS num FROM lg a JOIN c b ON b.series_id = a.series_id AND b.idx = a.idx + a.lag
        GROUP BY a.series_id, a.lag),
acf AS (SELECT num.series_id, num.lag, num.num / d.num AS acf, m.n FROM num JOIN num d ON d.series_id = num.series_id AND d.lag = 0
        JOIN m ON m.series_id = num.series_id)
"""


@query("ts_acf", rnd=["acf"], sql=_ACF + "SELECT series_id, lag, acf, n FROM acf")
def ts_acf(spark, sf):
    """Autocorrelation at lags 0..12 for every series (explode + index join)."""
    return TS.acf(series(spark, sf), 12)


@query("ts_ljung_box", rnd=["q_stat"], sql=_ACF + """
SELECT series_id, first(n) * (first(n) + 2) * sum(acf * acf / (n - lag)) AS q_stat, 10 AS lags FROM acf
WHERE lag BETWEEN 1 AND 10 GROUP BY series_id""")
def ts_ljung_box(spark, sf):
    return TS.ljung_box(TS.acf(series(spark, sf), 12), 10)


@query("ts_periodogram", rnd=["freq", "power"], dp=4, bench=True, sql=_NS + f"""
, m AS (SELECT series_id, avg(y) AS mu, count(*) AS n FROM ns GROUP BY series_id),
c AS (SELECT ns.series_id, idx - 1 AS t0, (y - mu) / 1e6 AS e, n FROM ns JOIN m USING (series_id)),
k AS (SELECT *, unnest(generate_series(1, CAST(floor(n / 2) AS INTEGER))) AS k FROM c),
s AS (SELECT series_id, k, sum(e * cos(2 * {math.pi!r} * k * t0 / n)) AS re, sum(e * sin(2 * {math.pi!r} * k * t0 / n)) AS im,
             first(n) AS n FROM k GROUP BY series_id, k)
SELECT series_id, k, k / n AS freq, (re * re + im * im) / n AS power FROM s""")
def ts_periodogram(spark, sf):
    """|DFT|^2 / n of the demeaned series (revenue in millions) at
    k = 1..n/2, all series at once."""
    return TS.periodogram(series(spark, sf).withColumn("y", F.col("y") / 1e6))


@query("ts_cross_correlation", rnd=["peak_ccf"], sql=_NS + """
, tot AS (SELECT t, sum(y) AS z FROM nseries GROUP BY t),
al AS (SELECT ns.series_id, ns.t, ns.y AS x, tot.z, row_number() OVER (PARTITION BY ns.series_id ORDER BY ns.t) AS i
       FROM ns JOIN tot USING (t)),
st AS (SELECT series_id, avg(x) AS mx, avg(z) AS mz, stddev_pop(x) AS sx, stddev_pop(z) AS sz, count(*) AS n FROM al GROUP BY series_id),
c AS (SELECT al.series_id, i, x - mx AS ex, z - mz AS ez, n, sx, sz FROM al JOIN st USING (series_id)),
lg AS (SELECT series_id, i, ex, n, sx, sz, unnest(generate_series(-6, 6)) AS lag FROM c),
cc AS (SELECT a.series_id, a.lag, sum(a.ex * b.ez) / (first(a.n) * first(a.sx) * first(a.sz)) AS ccf
       FROM lg a JOIN c b ON b.series_id = a.series_id AND b.i = a.i + a.lag GROUP BY a.series_id, a.lag)
SELECT series_id, lag AS peak_lag, ccf AS peak_ccf FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY abs(ccf) DESC, abs(lag), lag) AS r FROM cc) AS _x WHERE r = 1""")
def ts_cross_correlation(spark, sf):
    """Standardised CCF of each nation series with the total at lags -6..6;
    the lag of the largest |ccf| (ties: smallest |lag|)."""
    s = B.nation_series(spark, sf)
    tot = s.groupBy("t").agg(F.sum("y").alias("z"))
    al = s.join(tot, "t").withColumn("i", F.row_number().over(Window.partitionBy("series_id").orderBy("t")))
    st = al.groupBy("series_id").agg(F.avg("y").alias("mx"), F.avg("z").alias("mz"), F.stddev_pop("y").alias("sx"),
                                     F.stddev_pop("z").alias("sz"), F.count(F.lit(1)).alias("n"))
    c = al.join(st, "series_id").select("series_id", "i", (F.col("y") - F.col("mx")).alias("ex"),
                                        (F.col("z") - F.col("mz")).alias("ez"), "n", "sx", "sz")
    a = c.select("series_id", "i", "ex", "n", "sx", "sz", F.explode(F.sequence(F.lit(-6), F.lit(6))).alias("lag"))
    b = c.select(F.col("series_id").alias("_s"), F.col("i").alias("_i"), F.col("ez").alias("_ez"))
    j = a.join(b, (F.col("series_id") == F.col("_s")) & (F.col("i") + F.col("lag") == F.col("_i")))
    cc = j.groupBy("series_id", "lag").agg(
        (F.sum(F.col("ex") * F.col("_ez")) / (F.first("n") * F.first("sx") * F.first("sz"))).alias("ccf"))
    w = Window.partitionBy("series_id").orderBy(F.abs("ccf").desc(), F.abs("lag"), "lag")
    return cc.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "series_id", F.col("lag").alias("peak_lag"), F.col("ccf").alias("peak_ccf"))


@query("ts_resample_align", rnd=["x"], sql="""
WITH wk AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS w, avg(l_discount) AS x FROM lineitem GROUP BY 1),
mo AS (SELECT CAST(date_trunc('month', w) AS DATE) AS t, avg(x) AS x FROM wk GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(t) FROM mo), (SELECT max(t) FROM mo), INTERVAL 1 MONTH)) AS DATE) AS t),
j AS (SELECT cal.t, mo.x FROM cal LEFT JOIN mo USING (t))
SELECT t, coalesce(last_value(x IGNORE NULLS) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                   first_value(x IGNORE NULLS) OVER (ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x FROM j""")
def ts_resample_align(spark, sf):
    """Weekly -> monthly mean, reindexed onto all months from the first to the last, ffill then bfill."""
    return exog_monthly(spark, sf)


def exog_monthly(spark, sf):
    from kestrel.operators.panel import ffill_bfill
    li = load(spark, sf, "lineitem")
    wk = li.groupBy(F.to_date(F.date_trunc("week", "l_shipdate")).alias("w")).agg(F.avg("l_discount").alias("x"))
    mo = wk.groupBy(F.trunc("w", "month").alias("t")).agg(F.avg("x").alias("x"))
    cal = mo.agg(F.min("t").alias("a"), F.max("t").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("t"))
    j = cal.join(mo, "t", "left").withColumn("_s", F.lit(1))   # one series: calendar-bounded window
    return j.select("t", ffill_bfill("x", ["_s"], "t").alias("x"))


# ----------------------------------------------------- grouped fits ----------
def _by_series(df, fn, schema):
    # one-argument wrapper: applyInPandas passes (key, pdf) to 2-arg functions
    return df.groupBy("series_id").applyInPandas(lambda pdf: fn(pdf), schema)


@query("ts_pacf", rnd=["pacf"])
def ts_pacf(spark, sf):
    """Durbin-Levinson on each series' ACF row (12 values per group)."""
    a = TS.acf(series(spark, sf), 12)
    return _by_series(a, TS.pacf_dl, "series_id long, lag int, pacf double")


_AR_SCHEMA = "series_id long, p int, n int, mse double, aic double, bic double"


@query("ts_ar_fit", rnd=["mse", "aic", "bic"], dp=3)
def ts_ar_fit(spark, sf):
    """AR(1..5) by conditional least squares per series, MSE / AIC / BIC."""
    s = B.nation_series(spark, sf).select("series_id", "t", "y")
    return _by_series(s, TS.ar_order_search, _AR_SCHEMA)


@query("ts_ma_fit", rnd=["mse", "aic"], dp=3)
def ts_ma_fit(spark, sf):
    """MA(2) by Hannan-Rissanen per series."""
    s = B.nation_series(spark, sf).select("series_id", "t", "y")
    return _by_series(s, lambda p: TS.hannan_rissanen(p, 0, 2), "series_id long, p int, q int, n int, mse double, aic double")


@query("ts_armax_grid", rnd=["train_mse", "test_mse"], dp=3)
def ts_armax_grid(spark, sf):
    """p in 1..4 x q in {1, 5, 10} with the exogenous column, fitted up to the split date: train
    and one-step test error, and the orders with the least of each per series.  Each
    (series, p, q) is its own group."""
    d = _arx_frame(spark, sf).withColumn("p", F.explode(F.array(*[F.lit(p) for p in (1, 2, 3, 4)]))) \
        .withColumn("q", F.explode(F.array(*[F.lit(q) for q in (1, 5, 10)])))

    def fit(pdf):
        pdf = pdf.sort_values("t")
        n_train = int((pdf["t"] <= datetime.date.fromisoformat(SPLIT)).sum())
        p, q = int(pdf["p"].iloc[0]), int(pdf["q"].iloc[0])
        found = FC.armax(pdf["y"].to_numpy(float), pdf["x"].to_numpy(float), n_train, p, q)
        train, test, n = found or (None, None, 0)
        return pd.DataFrame([{"series_id": pdf["series_id"].iloc[0], "p": p, "q": q, "n_train": n, "n_test": len(pdf) - n_train,
                              "train_mse": train, "test_mse": test}])
    out = d.groupBy("series_id", "p", "q").applyInPandas(
        lambda pdf: fit(pdf), "series_id long, p int, q int, n_train int, n_test int, train_mse double, test_mse double")
    w = Window.partitionBy("series_id")     # twelve rows a series
    return out.select("*", F.coalesce(F.col("train_mse") == F.min("train_mse").over(w), F.lit(False)).alias("best_train"),
                      F.coalesce(F.col("test_mse") == F.min("test_mse").over(w), F.lit(False)).alias("best_test"))


SPLIT = "2000-06-30"


def _split_on(df, date=SPLIT):
    return df.withColumn("split", F.lit(date).cast("date"))


@query("ts_forecast_rolling", rnd=["train_mse", "rolling_mse"], dp=0)
def ts_forecast_rolling(spark, sf):
    """AR(4) up to 2000-06; one-step forecasts of the test months, each from the fit on all
    months before (running moments, one solve a month)."""
    s = _split_on(B.nation_series(spark, sf).select("series_id", "t", "y"))
    return FC.evaluate_splits(s, ["series_id"], 4).select("series_id", "p", "n_train", "n_test", "train_mse", "rolling_mse")


@query("ts_forecast_long", rnd=["train_mse", "long_mse"], dp=0)
def ts_forecast_long(spark, sf):
    """AR(4) up to 2000-06 and its recursive path over the test months."""
    s = _split_on(B.nation_series(spark, sf).select("series_id", "t", "y"))
    return FC.evaluate_splits(s, ["series_id"], 4).select("series_id", "p", "n_train", "n_test", "train_mse", "long_mse")


def _arx_frame(spark, sf):
    x = exog_monthly(spark, sf)
    return B.nation_series(spark, sf).join(x, "t").select("series_id", "t", "y", "x")


@query("ts_arx_fit", rnd=["train_mse", "long_mse", "rolling_mse"], dp=0)
def ts_arx_fit(spark, sf):
    """AR(p) + exogenous discount, p = 1..4: errors per order, and the order with the least
    one-step test error per series."""
    from kestrel.session import cut_lineage
    d = _split_on(cut_lineage(_arx_frame(spark, sf)))
    out = None
    for p in (1, 2, 3, 4):
        part = FC.evaluate_splits(d, ["series_id"], p, exog=True)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("best", F.col("rolling_mse") == F.min("rolling_mse").over(Window.partitionBy("series_id")))


@query("ts_strategy_compare", rnd=["pct_change"], dp=3)
def ts_strategy_compare(spark, sf):
    """Rolling vs long-horizon and AR vs ARX: % change and a 5 % verdict."""
    from kestrel.session import cut_lineage
    d = _split_on(cut_lineage(_arx_frame(spark, sf)))
    ar = FC.evaluate_splits(d, ["series_id"], 4).select("series_id", F.col("rolling_mse").alias("ar_mse"), "long_mse")
    arx = FC.evaluate_splits(d, ["series_id"], 4, exog=True).select("series_id", F.col("rolling_mse").alias("arx_mse"))
    j = ar.join(arx, "series_id")
    pct = (F.col("arx_mse") - F.col("ar_mse")) / F.col("ar_mse") * 100
    verdict = F.when(pct < -5, "improved").when(pct > 5, "degraded").otherwise("unchanged")
    return j.select("series_id", pct.alias("pct_change"), verdict.alias("arx_vs_ar"),
                    F.when(F.col("ar_mse") < F.col("long_mse"), "rolling").otherwise("long").alias("better_horizon"))


@query("ts_split_runner", rnd=["train_mse", "long_mse", "rolling_mse"], dp=0)
def ts_split_runner(spark, sf):
    """AR(4) and ARX(4) for several train/test splits (the split is a key), raw and without
    the line fitted to the split's training months."""
    from kestrel.session import cut_lineage
    d = cut_lineage(_arx_frame(spark, sf))
    splits = F.array(*[F.lit(x).cast("date") for x in ("1999-12-31", "2000-06-30", "2000-12-31")])
    raw = d.withColumn("split", F.explode(splits))
    by = ["series_id", "split"]
    both = raw.withColumn("detrended", F.lit(False)).unionByName(FC.detrend_on_train(raw, by).withColumn("detrended", F.lit(True)))
    both, by = cut_lineage(both), [*by, "detrended"]
    return FC.evaluate_splits(both, by, 4).unionByName(FC.evaluate_splits(both, by, 4, exog=True))


@query("ts_adf", rnd=["adf_t", "p_value", "crit_5pct"], dp=4)
def ts_adf(spark, sf):
    """Augmented Dickey-Fuller test per series, raw and after linear detrending: lag by AIC
    up to the automatic bound, p-value and critical value by response surfaces."""
    raw = B.nation_series(spark, sf).select("series_id", "t", "y")
    det = TS.detrend_linear(series(spark, sf)).select("series_id", "t", F.col("resid").alias("y"))

    def fit(pdf):
        found = FC.adf(pdf.sort_values("t")["y"].to_numpy(float))
        return pd.DataFrame([{"series_id": pdf["series_id"].iloc[0], **found}])
    sch = "series_id long, lag int, adf_t double, p_value double, n int, crit_5pct double"
    return (_by_series(raw, fit, sch).withColumn("variant", F.lit("raw"))
            .unionByName(_by_series(det, fit, sch).withColumn("variant", F.lit("detrended"))))


@query("ts_detrend_poly", rnd=["resid"], dp=2)
def ts_detrend_poly(spark, sf):
    """Degree-2 and degree-3 polynomial trend residuals (centred t) per series,
    a least-squares fit of each whole series."""
    import numpy as np

    def fit(pdf):
        pdf = pdf.sort_values("t")
        y = pdf["y"].to_numpy(float)
        t = np.arange(len(y), dtype=float)
        t -= t.mean()
        out = []
        for deg in (2, 3):
            V = np.vander(t, deg + 1)
            b, *_ = np.linalg.lstsq(V, y, rcond=None)
            out.append(pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "t": pdf["t"].to_numpy(), "degree": deg,
                                     "resid": y - V @ b}))
        return pd.concat(out)
    s = B.nation_series(spark, sf).select("series_id", "t", "y")
    return _by_series(s, fit, "series_id long, t date, degree int, resid double")


@query("ts_welch", rnd=["freq", "psd"], dp=2)
def ts_welch(spark, sf):
    s = B.nation_series(spark, sf).select("series_id", "t", "y")
    return _by_series(s, TS.welch, "series_id long, k long, freq double, psd double")


@query("ts_find_peaks", rnd=["power", "prominence"], dp=2)
def ts_find_peaks(spark, sf):
    pg = TS.periodogram(series(spark, sf))
    return _by_series(pg.select("series_id", "k", "power"), TS.find_peaks,
                      "series_id long, k long, power double, prominence double, lowest4 boolean, tallest4 boolean")


@query("ts_fft_filter", rnd=["y_filtered"], dp=2, sql=_NS + """
, z AS (SELECT series_id, t, y, row_number() OVER (PARTITION BY series_id ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n FROM ns),
f AS (SELECT series_id, k, sum(y * cos(2 * pi() * k * i / n)) AS re, sum(y * sin(2 * pi() * k * i / n)) AS im
      FROM z CROSS JOIN generate_series(1, 9) AS g(k) GROUP BY series_id, k),
m AS (SELECT series_id, avg(y) AS m FROM z GROUP BY series_id)
SELECT z.series_id, z.t, any_value(m.m) + 2.0 / any_value(n) * sum(re * cos(2 * pi() * k * i / n) + im * sin(2 * pi() * k * i / n)) AS y_filtered
FROM z JOIN f USING (series_id) JOIN m USING (series_id) GROUP BY z.series_id, z.t""")
def ts_fft_filter(spark, sf):
    """Zero the high-frequency DFT bins 10..n/2 of each series and invert."""
    s = B.nation_series(spark, sf).select("series_id", "t", "y")
    return _by_series(s, lambda p: TS.fft_filter(p, 10, len(p) // 2), "series_id long, t date, y_filtered double")
