"""Regression & inference queries (survey 2.8) and the pair/instrument
family: inner date joins, pair report with Newey-West t, CAPM, factor model,
difference-in-differences and nested tests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel import functions as K
from kestrel.functions import stats as S
from kestrel.operators import panel as P
from kestrel.operators import regression as R
from kestrel.plans.registry import query
from kestrel.plans.sqlbind import (DID, FACTORS, LEG_RET, LEGS, PAIR_RET, PRIO_REV, with_)
from kestrel.plans.strategy_queries import _BASE, baseline_pi
from kestrel.sources import bindings as B
from kestrel.sources.tables import load

_PAIRS = with_(LEGS, LEG_RET, PAIR_RET)


def pair_frame(spark, sf):
    """Pair returns materialised once per query (several consumers)."""
    from kestrel.session import cut_lineage
    return cut_lineage(B.pair_returns(spark, sf))


def _hac_sql(src: str, x: str, y: str, by: str) -> str:
    """Newey-West 2x2 sandwich written out in SQL (oracle side)."""
    return f"""
, fit AS (SELECT {by}, count(*) AS n, regr_slope({y}, {x}) AS beta, regr_intercept({y}, {x}) AS alpha,
                 regr_r2({y}, {x}) AS r2, sum({x}) AS sx, sum({x} * {x}) AS sxx,
                 CAST(floor(4 * pow(count(*) / 100.0, 2.0 / 9.0)) AS INTEGER) AS nlags
          FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY {by}),
uu AS (SELECT s.{by}, row_number() OVER (PARTITION BY s.{by} ORDER BY s.d) AS t, s.{x} AS x,
              s.{y} - f.alpha - f.beta * s.{x} AS u, f.nlags
       FROM {src} s JOIN fit f USING ({by}) WHERE s.{x} IS NOT NULL AND s.{y} IS NOT NULL),
lg AS (SELECT {by}, t, x, u, nlags, unnest(generate_series(0, nlags)) AS lag FROM uu),
jj AS (SELECT a.{by}, a.lag, a.nlags, a.u, a.x, b.u AS up, b.x AS xp,
              CASE WHEN a.lag = 0 THEN 0.5 ELSE 1 - a.lag / (a.nlags + 1) END AS wt
       FROM lg a JOIN uu b ON b.{by} = a.{by} AND b.t = a.t - a.lag),
ss AS (SELECT {by}, sum(wt * 2 * u * up) AS s00, sum(wt * u * up * (x + xp)) AS s01,
              sum(wt * 2 * u * x * up * xp) AS s11 FROM jj GROUP BY {by}),
hh AS (SELECT f.*, ss.s00, ss.s01, ss.s11, n * sxx - sx * sx AS det FROM fit f JOIN ss USING ({by})),
hac AS (SELECT {by}, n, nlags AS L, alpha, beta, r2,
          sqrt((sxx / det) * (sxx / det) * s00 + 2 * (sxx / det) * (-sx / det) * s01 + (-sx / det) * (-sx / det) * s11) AS nw_se_alpha,
          sqrt((-sx / det) * (-sx / det) * s00 + 2 * (-sx / det) * (n / det) * s01 + (n / det) * (n / det) * s11) AS nw_se_beta
        FROM hh)
"""


_HAC_COLS = ["alpha", "beta", "r2", "nw_se_alpha", "nw_se_beta", "nw_t_alpha", "nw_t_beta"]


@query("reg_hac_nw", rnd=_HAC_COLS, sql=_PAIRS + _hac_sql("pair_ret", "ret_a", "ret_b", "pair") + """
SELECT pair, n, L, alpha, beta, r2, nw_se_alpha, nw_se_beta, alpha / nw_se_alpha AS nw_t_alpha,
       beta / nw_se_beta AS nw_t_beta FROM hac""")
def reg_hac_nw(spark, sf):
    """OLS of leg b on leg a per pair with Newey-West (Bartlett) errors."""
    return R.hac_simple(pair_frame(spark, sf), "d", "ret_a", "ret_b", by=["pair"])


@query("reg_pair_report", rnd=["corr", "beta", "alpha", "r2", "nw_t_beta", "tracking_err", "mean_spread"],
       bench=True, sql=_PAIRS + _hac_sql("pair_ret", "ret_a", "ret_b", "pair") + """
, st AS (SELECT pair, corr(ret_a, ret_b) AS corr, stddev_samp(ret_b - ret_a) AS tracking_err,
                avg(ret_b - ret_a) AS mean_spread FROM pair_ret GROUP BY pair)
SELECT pair, corr, beta, alpha, r2, beta / nw_se_beta AS nw_t_beta, tracking_err, mean_spread, n
FROM hac JOIN st USING (pair)""")
def reg_pair_report(spark, sf):
    """All pairs in one job: corr, beta, alpha, R^2, NW t, tracking error,
    mean spread, N."""
    pr = pair_frame(spark, sf)
    hac = R.hac_simple(pr, "d", "ret_a", "ret_b", by=["pair"])
    sp = F.col("ret_b") - F.col("ret_a")
    st = pr.groupBy("pair").agg(F.corr("ret_a", "ret_b").alias("corr"), F.stddev_samp(sp).alias("tracking_err"),
                                F.avg(sp).alias("mean_spread"))
    return hac.join(st, "pair").select("pair", "corr", "beta", "alpha", "r2", "nw_t_beta", "tracking_err",
                                       "mean_spread", "n")


@query("join_inner_date", rnd=["ret_a", "ret_b"], sql=_PAIRS + "SELECT pair, d, ret_a, ret_b FROM pair_ret")
def join_inner_date(spark, sf):
    """Two legs inner-joined on date with NULL returns dropped."""
    return pair_frame(spark, sf)


@query("join_index_align", sql=_PAIRS + """
SELECT count(*) AS n_common FROM (SELECT d FROM leg_ret WHERE instrument = 'A' INTERSECT SELECT d FROM leg_ret WHERE instrument = 'R') AS _i""")
def join_index_align(spark, sf):
    """Intersection of two legs' date indexes."""
    r = B.leg_returns(spark, sf)
    a = r.where(F.col("instrument") == "A").select("d")
    b = r.where(F.col("instrument") == "R").select("d")
    return a.intersect(b).agg(F.count(F.lit(1)).alias("n_common"))


@query("src_multi_series", rnd=["px"], sql=with_(LEGS) + """
SELECT instrument, d, px FROM legs WHERE d BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND px IS NOT NULL""")
def src_multi_series(spark, sf):
    """N instruments as one long table with an instrument column, date window
    filtered before returns are computed."""
    lp = B.leg_prices(spark, sf)
    return lp.where(K.between_dates("d", "1996-01-01", "2000-12-31") & F.col("px").isNotNull())


_SPREAD = _PAIRS + """
, sp AS (SELECT pair, d, ret_a, ret_b, ret_b - ret_a AS spread FROM pair_ret),
z AS (SELECT *, (spread - avg(spread) OVER (PARTITION BY pair)) / stddev_samp(spread) OVER (PARTITION BY pair) AS z FROM sp)
"""


def spread_outliers(spark, sf, k: float = 3.0):
    pr = pair_frame(spark, sf).withColumn("spread", F.col("ret_b") - F.col("ret_a"))
    st = pr.groupBy("pair").agg(F.avg("spread").alias("mu"), F.stddev_samp("spread").alias("sd"))
    z = pr.join(st, "pair").withColumn("z", (F.col("spread") - F.col("mu")) / F.col("sd"))
    return z.where(F.abs(F.col("spread") - F.col("mu")) > k * F.col("sd"))


@query("win_spread_outliers", rnd=["spread", "z"], sql=_SPREAD + "SELECT pair, d, spread, z FROM z WHERE abs(z) > 3")
def win_spread_outliers(spark, sf):
    """Spread beyond 3 sigma of its mean (ddof 1), per pair (groupBy + join)."""
    return spread_outliers(spark, sf).select("pair", "d", "spread", "z")


@query("win_stale_leg_flag", sql=_SPREAD + """
SELECT pair, d, (ret_a = 0 AND ret_b <> 0) OR (ret_b = 0 AND ret_a <> 0) AS stale_leg FROM z WHERE abs(z) > 3""")
def win_stale_leg_flag(spark, sf):
    o = spread_outliers(spark, sf)
    stale = ((F.col("ret_a") == 0) & (F.col("ret_b") != 0)) | ((F.col("ret_b") == 0) & (F.col("ret_a") != 0))
    return o.select("pair", "d", stale.alias("stale_leg"))


@query("win_expiry_flag", sql=_SPREAD + """
SELECT pair, d, (dayofweek(d) = 5 AND day(d) BETWEEN 15 AND 21 AND month(d) IN (3, 6, 9, 12)) AS expiry
FROM z WHERE abs(z) > 3""")
def win_expiry_flag(spark, sf):
    """Outliers on quarterly third-Friday expiry days."""
    return spread_outliers(spark, sf).select("pair", "d", K.third_friday("d").alias("expiry"))


@query("spread_pct_mid", rnd=["mid", "spread", "spread_pct"], sql=_PAIRS + """
, q AS (SELECT d, max(CASE WHEN instrument = 'A' THEN px END) AS bid, max(CASE WHEN instrument = 'R' THEN px END) AS ask
        FROM legs GROUP BY d)
SELECT d, (bid + ask) / 2 AS mid, ask - bid AS spread, (ask - bid) / nullif((bid + ask) / 2, 0) * 100 AS spread_pct
FROM q WHERE bid IS NOT NULL AND ask IS NOT NULL""")
def spread_pct_mid(spark, sf):
    """Quote snapshot: mid, spread and spread in % of mid (leg A as bid, R as ask)."""
    lp = B.leg_prices(spark, sf)
    q = lp.groupBy("d").agg(F.max(F.when(F.col("instrument") == "A", F.col("px"))).alias("bid"),
                            F.max(F.when(F.col("instrument") == "R", F.col("px"))).alias("ask"))
    q = q.where(F.col("bid").isNotNull() & F.col("ask").isNotNull())
    mid = (F.col("bid") + F.col("ask")) / 2
    return q.select("d", mid.alias("mid"), (F.col("ask") - F.col("bid")).alias("spread"),
                    (K.safe_ratio(F.col("ask") - F.col("bid"), mid) * 100).alias("spread_pct"))


@query("round_report", sql=_PAIRS + """
SELECT pair, round(corr(ret_a, ret_b), 4) AS corr4, round(regr_slope(ret_b, ret_a), 4) AS beta4,
       round(regr_intercept(ret_b, ret_a), 6) AS alpha6, count(*) AS n FROM pair_ret GROUP BY pair""")
def round_report(spark, sf):
    pr = pair_frame(spark, sf)
    return pr.groupBy("pair").agg(F.round(F.corr("ret_a", "ret_b"), 4).alias("corr4"),
                                  F.round(F.regr_slope("ret_b", "ret_a"), 4).alias("beta4"),
                                  F.round(F.regr_intercept("ret_b", "ret_a"), 6).alias("alpha6"),
                                  F.count(F.lit(1)).alias("n"))


@query("reg_ols_simple", rnd=["beta", "alpha", "r2", "se_beta", "t_beta"], sql="""
WITH s AS (SELECT l_returnflag AS flag, count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS beta,
                  regr_intercept(l_extendedprice, l_quantity) AS alpha, regr_r2(l_extendedprice, l_quantity) AS r2,
                  regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
                  regr_sxy(l_extendedprice, l_quantity) AS sxy FROM lineitem GROUP BY 1)
SELECT flag, n, beta, alpha, r2, sqrt((syy - beta * sxy) / (n - 2) / sxx) AS se_beta,
       beta / sqrt((syy - beta * sxy) / (n - 2) / sxx) AS t_beta FROM s""")
def reg_ols_simple(spark, sf):
    """Extended price on quantity per return flag over every lineitem row:
    regr_* aggregates, partial aggregation, no data movement beyond moments."""
    li = load(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_quantity", "l_extendedprice")
    return R.ols_simple(li, "l_quantity", "l_extendedprice", by=["flag"])


# ------------------------------------------------------- CAPM / factors -----
_CAPM = _BASE + "," + with_(PRIO_REV, FACTORS)[5:] + """
, cj AS (SELECT pi1.d, pi1.pi - f.rf AS ex_ret, f.mktrf AS x, f.smb, f.hml, f.umd, 'baseline' AS model
         FROM pi1 JOIN factors f USING (d))
"""


def capm_frame(spark, sf):
    pi, _, _ = baseline_pi(spark, sf)
    f = B.factors_monthly(spark, sf)
    return pi.join(f, "d").select("d", (F.col("pi") - F.col("rf")).alias("ex_ret"), F.col("mktrf").alias("x"),
                                  "smb", "hml", "umd", F.lit("baseline").alias("model"))


@query("reg_capm", rnd=_HAC_COLS + ["ann_alpha"], sql=_CAPM + _hac_sql("cj", "x", "ex_ret", "model") + """
SELECT model, n, L, alpha, beta, r2, nw_se_alpha, nw_se_beta, alpha / nw_se_alpha AS nw_t_alpha,
       beta / nw_se_beta AS nw_t_beta, alpha * 12 AS ann_alpha FROM hac""")
def reg_capm(spark, sf):
    """Strategy excess return on the market factor with NW errors."""
    h = R.hac_simple(capm_frame(spark, sf), "d", "x", "ex_ret")
    return h.withColumn("ann_alpha", F.col("alpha") * 12).withColumn("model", F.lit("baseline"))


@query("reg_factor4", rnd=["coef", "nw_se", "nw_t", "r2"])
def reg_factor4(spark, sf):
    """Four-factor regression with NW covariance (k = 5: grouped solve)."""
    c = capm_frame(spark, sf).withColumnRenamed("x", "mktrf")
    return R.hac_multi(c, "d", ["mktrf", "smb", "hml", "umd"], "ex_ret", by=["model"])


# ------------------------------------------------------------- DiD ---------
_DID = with_(DID)


@query("reg_did_2x2", rnd=["mean_pre", "mean_post", "did"], sql=_DID + """
, g AS (SELECT nj, avg(fte) AS mean_pre, avg(fte2) AS mean_post FROM did GROUP BY nj)
SELECT t.mean_pre, t.mean_post, (t.mean_post - t.mean_pre) - (c.mean_post - c.mean_pre) AS did, t.nj
FROM g t JOIN g c ON t.nj = 1 AND c.nj = 0
UNION ALL SELECT mean_pre, mean_post, NULL, nj FROM g WHERE nj = 0""")
def reg_did_2x2(spark, sf):
    """2x2 group means and the difference-in-differences estimate."""
    from kestrel.functions import scalar
    g = B.did_stores(spark, sf).groupBy("nj").agg(F.avg("fte").alias("mean_pre"), F.avg("fte2").alias("mean_post"))
    dc = scalar(g.where("nj = 0").select((F.col("mean_post") - F.col("mean_pre")).alias("dc")))
    did = F.when(F.col("nj") == 1, (F.col("mean_post") - F.col("mean_pre")) - dc)
    return g.select("mean_pre", "mean_post", did.alias("did"), "nj")


def _did_frame(spark, sf):
    d = B.did_stores(spark, sf).withColumn("demp", F.col("fte2") - F.col("fte"))
    for ch in ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]:   # AUTOMOBILE is the reference level
        d = d.withColumn(f"ch_{ch.lower()}", (F.col("chain") == ch).cast("double"))
    return d.withColumn("nj", F.col("nj").cast("double")).withColumn("co_owned", F.col("co_owned").cast("double"))


_CH = ["ch_building", "ch_furniture", "ch_household", "ch_machinery"]


@query("dummy_encode", sql=_DID + """
SELECT store, CAST(chain = 'BUILDING' AS DOUBLE) AS ch_building, CAST(chain = 'FURNITURE' AS DOUBLE) AS ch_furniture,
       CAST(chain = 'HOUSEHOLD' AS DOUBLE) AS ch_household, CAST(chain = 'MACHINERY' AS DOUBLE) AS ch_machinery FROM did""")
def dummy_encode(spark, sf):
    return _did_frame(spark, sf).select("store", *_CH)


@query("derived_totals", rnd=["fte_total", "change", "share_post"], sql=_DID + """
SELECT store, fte + 0.5 * co_owned + fte2 AS fte_total, fte2 - fte AS change,
       fte2 / nullif(fte + fte2, 0) AS share_post FROM did""")
def derived_totals(spark, sf):
    d = B.did_stores(spark, sf)
    return d.select("store", (F.col("fte") + 0.5 * F.col("co_owned") + F.col("fte2")).alias("fte_total"),
                    (F.col("fte2") - F.col("fte")).alias("change"),
                    K.safe_ratio("fte2", F.col("fte") + F.col("fte2")).alias("share_post"))


@query("case_ladder", sql=_DID + """
SELECT store, CASE WHEN nj = 0 THEN 0 WHEN gap = 0 THEN 1 WHEN gap < 0.25 THEN 2 ELSE 3 END AS band,
       CASE WHEN closed = 1 THEN 'closed' WHEN fte2 > fte THEN 'grew' WHEN fte2 = fte THEN 'flat' ELSE 'shrank' END AS status,
       CASE WHEN fte > 0 THEN (fte2 - fte) / fte * 100 END AS pct_change FROM did""")
def case_ladder(spark, sf):
    """Nested conditionals: exposure band, closed/grew/flat/shrank, guarded % change."""
    d = B.did_stores(spark, sf)
    band = F.when(F.col("nj") == 0, 0).when(F.col("gap") == 0, 1).when(F.col("gap") < 0.25, 2).otherwise(3)
    status = (F.when(F.col("closed") == 1, "closed").when(F.col("fte2") > F.col("fte"), "grew")
              .when(F.col("fte2") == F.col("fte"), "flat").otherwise("shrank"))
    pct = F.when(F.col("fte") > 0, (F.col("fte2") - F.col("fte")) / F.col("fte") * 100)
    return d.select("store", band.alias("band"), status.alias("status"), pct.alias("pct_change"))


@query("agg_by_group_means", rnd=["mean_fte", "sd_fte", "mean_fte2", "sd_fte2"], sql=_DID + """
SELECT nj, chain, count(*) AS n, avg(fte) AS mean_fte, stddev_samp(fte) AS sd_fte, avg(fte2) AS mean_fte2,
       stddev_samp(fte2) AS sd_fte2 FROM did GROUP BY nj, chain""")
def agg_by_group_means(spark, sf):
    d = B.did_stores(spark, sf)
    return d.groupBy("nj", "chain").agg(F.count(F.lit(1)).alias("n"), F.avg("fte").alias("mean_fte"),
                                        F.stddev_samp("fte").alias("sd_fte"), F.avg("fte2").alias("mean_fte2"),
                                        F.stddev_samp("fte2").alias("sd_fte2"))


@query("reg_sample_rule", rnd=["dwage"], sql=_DID + """
SELECT store, closed, dwage FROM (
  SELECT store, closed, (CASE WHEN store % 13 <> 0 THEN 5.05 + (store % 7) * 0.1 END)
                        - (CASE WHEN store % 11 <> 0 THEN 4.25 + (store % 20) * 0.05 END) AS dwage FROM did) w
WHERE closed = 1 OR dwage IS NOT NULL""")
def reg_sample_rule(spark, sf):
    """The regression sample: stores that closed, or whose starting wage is known in
    both waves.  The tables have no wage; it is derived from the store number, missing
    for every 11th store in the first wave and every 13th in the second."""
    s = F.col("store")
    before = F.when(s % 11 != 0, 4.25 + (s % 20) * 0.05)
    after = F.when(s % 13 != 0, 5.05 + (s % 7) * 0.1)
    d = B.did_stores(spark, sf).select("store", "closed", (after - before).alias("dwage"))
    return d.where((F.col("closed") == 1) | F.col("dwage").isNotNull())


def _ols_sql(specs: dict[str, list[str]], y: str, src: str, spec_col: bool = False) -> str:
    """Least squares in SQL (oracle side): the symmetric moment matrix of constant, regressors and
    outcome is swept on every regressor; what is left are minus the inverse, the
    coefficients and the residual sum of squares."""
    ctes, rows = [], []
    every = list(dict.fromkeys(x for xs in specs.values() for x in xs))
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*every, y])
    for s, (name, chosen) in enumerate(specs.items()):
        xs = sorted(chosen, key=every.index)
        cols, k = ["CAST(1 AS DOUBLE)", *xs, y], len(xs) + 1
        cells = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
        sums = ", ".join(f"sum({cols[i]} * {cols[j]}) AS a_{i}_{j}" for i, j in cells)
        ctes.append(f"w{s}_0 AS MATERIALIZED (SELECT count(*) AS n, sum({y} * {y}) - sum({y}) * sum({y}) / count(*) AS tss, {sums} "
                    f"FROM {src} WHERE {known})")

        def at(i, j):
            return f"a_{min(i, j)}_{max(i, j)}"

        for q in range(k):
            d = at(q, q)
            new = [f"{f'-1 / {d}' if i == j == q else f'{at(i, j)} / {d}' if q in (i, j) else f'{at(i, j)} - {at(i, q)} * {at(q, j)} / {d}'} AS {at(i, j)}"
                   for i, j in cells]
            ctes.append(f"w{s}_{q + 1} AS MATERIALIZED (SELECT n, tss, {', '.join(new)} FROM w{s}_{q})")
        rss, s2 = at(k, k), f"{at(k, k)} / (n - {k})"
        for i, term in enumerate(["const", *xs]):
            se = f"sqrt(-{at(i, i)} * {s2})"
            rows.append(f"SELECT '{term}' AS term, {at(i, k)} AS coef, {se} AS se, {at(i, k)} / {se} AS t, n, 1 - {rss} / tss AS r2, "
                        f"{rss} AS rss, sqrt({s2}) AS ser" + (f", '{name}' AS spec" if spec_col else "") + f" FROM w{s}_{k}")
    return ", " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(rows)


_STORE_SQL = _DID + """, store AS (
  SELECT store, CAST(nj AS DOUBLE) AS nj, CAST(co_owned AS DOUBLE) AS co_owned, fte, fte2, gap, fte2 - fte AS demp,
         CASE WHEN fte > 0 THEN (fte2 - fte) / fte * 100 END AS pct,
         CAST(chain = 'BUILDING' AS DOUBLE) AS ch_building, CAST(chain = 'FURNITURE' AS DOUBLE) AS ch_furniture,
         CAST(chain = 'HOUSEHOLD' AS DOUBLE) AS ch_household, CAST(chain = 'MACHINERY' AS DOUBLE) AS ch_machinery FROM did)"""
_EXPOSURE_SQL = _STORE_SQL + """, wave AS (
  SELECT o_custkey AS store, CAST(count(DISTINCT date_trunc('month', o_orderdate)) AS DOUBLE) AS hours,
         100 * avg(CAST(o_orderpriority = '1-URGENT' AS DOUBLE)) AS share_affected, avg(o_totalprice) / 10000 AS price
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01' GROUP BY o_custkey),
place AS (SELECT c_custkey AS store, CAST(n_regionkey = 1 AS DOUBLE) AS region_1, CAST(n_regionkey = 2 AS DOUBLE) AS region_2,
                 CAST(n_regionkey = 3 AS DOUBLE) AS region_3, CAST(n_regionkey = 4 AS DOUBLE) AS region_4
          FROM customer JOIN nation ON c_nationkey = n_nationkey),
exposure AS (SELECT * FROM store JOIN place USING (store) LEFT JOIN wave USING (store))"""


@query("reg_ols_multi", rnd=["coef", "se", "t", "r2", "rss", "ser"],
       sql=_STORE_SQL + _ols_sql({"": ["nj", *_CH, "co_owned"]}, "demp", "store"))
def reg_ols_multi(spark, sf):
    """demp ~ nj + chain dummies + co_owned (moments + grouped solve)."""
    return R.ols_multi(_did_frame(spark, sf), ["nj", *_CH, "co_owned"], "demp")


@query("reg_exposure_gap", rnd=["coef", "se", "t", "r2", "rss", "ser"],
       sql=_STORE_SQL + _ols_sql({"": ["gap", *_CH]}, "demp", "store"))
def reg_exposure_gap(spark, sf):
    """demp on continuous exposure gap with chain controls."""
    return R.ols_multi(_did_frame(spark, sf), ["gap", *_CH], "demp")


_REGIONS = [f"region_{k}" for k in range(1, 5)]   # region 0 is the reference level


def _exposure_frame(spark, sf):
    """The store frame with further controls from the first wave: months with orders (hours), share of
    urgent orders in per cent (share_affected), mean order value in 10,000s (price; null without
    orders), and region dummies."""
    from kestrel.sources.tables import load
    o = load(spark, sf, "orders").where(F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz"))
    wave = o.groupBy(F.col("o_custkey").alias("store")).agg(
        F.countDistinct(F.date_trunc("month", "o_orderdate")).cast("double").alias("hours"),
        (100 * F.avg((F.col("o_orderpriority") == "1-URGENT").cast("double"))).alias("share_affected"),
        (F.avg("o_totalprice") / 10000).alias("price"))
    n = load(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    place = load(spark, sf, "customer").join(n, "c_nationkey").select(
        F.col("c_custkey").alias("store"), *[(F.col("n_regionkey") == k).cast("double").alias(c) for k, c in enumerate(_REGIONS, 1)])
    return _did_frame(spark, sf).join(place, "store").join(wave, "store", "left")


_CONTROLS = ["gap", *_CH, "co_owned"]
ROBUSTNESS = {"m6_hours": [*_CONTROLS, "hours"], "m7_initial_size": [*_CONTROLS, "fte"], "m8_share_affected": [*_CONTROLS, "share_affected"],
              "m9_price": [*_CONTROLS, "price"], "m10_regions": [*_CONTROLS, *_REGIONS],
              "m11_all": [*_CONTROLS, *_REGIONS, "fte", "hours", "price"]}


@query("reg_robustness_table", rnd=["coef", "se", "t", "r2", "rss", "ser"],
       sql=_EXPOSURE_SQL + _ols_sql(ROBUSTNESS, "demp", "exposure", spec_col=True))
def reg_robustness_table(spark, sf):
    """Exposure gap with six sets of controls on one common listwise sample, from one moment matrix."""
    return R.ols_specs(_exposure_frame(spark, sf), ROBUSTNESS, "demp")


@query("reg_alt_outcome", rnd=["coef", "se", "t", "r2", "rss", "ser"],
       sql=_STORE_SQL + _ols_sql({"": ["nj", *_CH]}, "pct", "store"))
def reg_alt_outcome(spark, sf):
    """Percent-change outcome variant, stores with a positive base."""
    d = _did_frame(spark, sf).where(F.col("fte") > 0)
    d = d.withColumn("pct", (F.col("fte2") - F.col("fte")) / F.col("fte") * 100)
    return R.ols_multi(d, ["nj", *_CH], "pct")


@query("reg_nested_f", rnd=["rss_f", "rss_r", "F", "p_value"])
def reg_nested_f(spark, sf):
    """F test that the chain dummies are jointly zero."""
    d = _did_frame(spark, sf)
    full = R.ols_multi(d, ["nj", *_CH], "demp")
    rest = R.ols_multi(d, ["nj"], "demp")
    f = R.nested_f(full, rest, q=len(_CH))
    return f.withColumn("p_value", S.f_sf_col(F.col("F"), F.col("q").cast("double"), (F.col("n") - F.col("k")).cast("double")))


# ---------------------------------------------------- correlations ----------
@query("agg_corr_pvalue", rnd=["corr", "t", "p_value"])
def agg_corr_pvalue(spark, sf):
    """Pearson correlation with a two-sided t(n-2) p-value on the result rows."""
    pr = pair_frame(spark, sf)
    c = pr.groupBy("pair").agg(F.corr("ret_a", "ret_b").alias("corr"), F.count(F.lit(1)).alias("n"))
    t = F.col("corr") * F.sqrt((F.col("n") - 2) / (1 - F.col("corr") * F.col("corr")))
    c = c.withColumn("t", t)
    return c.withColumn("p_value", S.t_two_sided(F.col("t"), (F.col("n") - 2).cast("double")))


_RANKS = _PAIRS + """
, rk AS (SELECT pair, d, ret_a, ret_b,
            rank() OVER (PARTITION BY pair ORDER BY ret_a) + (count(*) OVER (PARTITION BY pair, ret_a) - 1) / 2.0 AS ra,
            rank() OVER (PARTITION BY pair ORDER BY ret_b) + (count(*) OVER (PARTITION BY pair, ret_b) - 1) / 2.0 AS rb
         FROM pair_ret)
"""


@query("agg_spearman", rnd=["spearman"], sql=_RANKS + "SELECT pair, corr(ra, rb) AS spearman FROM rk GROUP BY pair")
def agg_spearman(spark, sf):
    """Rank correlation with average ranks on ties (rank + (ties-1)/2)."""
    pr = pair_frame(spark, sf)
    ra = S.avg_rank(pr, "ret_a", ["pair"])
    rb = S.avg_rank(ra, "ret_b", ["pair"])
    return rb.groupBy("pair").agg(F.corr("ret_a_rank", "ret_b_rank").alias("spearman"))


@query("agg_corr_matrix", rnd=["corr"], sql=_PAIRS + """
, ll AS (SELECT pair, ret_a, ret_b, lead(ret_b, 1) OVER (PARTITION BY pair ORDER BY d) AS ret_b_lead1,
                lag(ret_b, 1) OVER (PARTITION BY pair ORDER BY d) AS ret_b_lag1 FROM pair_ret)
SELECT pair, 'level' AS kind, corr(ret_a, ret_b) AS corr FROM ll GROUP BY pair
UNION ALL SELECT pair, 'lead1', corr(ret_a, ret_b_lead1) FROM ll GROUP BY pair
UNION ALL SELECT pair, 'lag1', corr(ret_a, ret_b_lag1) FROM ll GROUP BY pair""")
def agg_corr_matrix(spark, sf):
    """Level / lead / lag pair grid: unpivot the lagged columns, one groupBy."""
    pr = pair_frame(spark, sf)
    w = Window.partitionBy("pair").orderBy("d")
    ll = pr.select("pair", "ret_a", F.col("ret_b").alias("level"), F.lead("ret_b", 1).over(w).alias("lead1"),
                   F.lag("ret_b", 1).over(w).alias("lag1"))
    u = ll.unpivot(["pair", "ret_a"], ["level", "lead1", "lag1"], "kind", "y")
    return u.groupBy("pair", "kind").agg(F.corr("ret_a", "y").alias("corr"))


@query("ts_lead_lag_corr", rnd=["corr_lead5", "spearman_lead5"], sql=_PAIRS + """
, ll AS (SELECT pair, ret_a, lead(ret_b, 5) OVER (PARTITION BY pair ORDER BY d) AS y FROM pair_ret),
l2 AS (SELECT * FROM ll WHERE y IS NOT NULL),
rk AS (SELECT pair, ret_a, y,
         rank() OVER (PARTITION BY pair ORDER BY ret_a) + (count(*) OVER (PARTITION BY pair, ret_a) - 1) / 2.0 AS ra,
         rank() OVER (PARTITION BY pair ORDER BY y) + (count(*) OVER (PARTITION BY pair, y) - 1) / 2.0 AS rb FROM l2)
SELECT pair, corr(ret_a, y) AS corr_lead5, corr(ra, rb) AS spearman_lead5 FROM rk GROUP BY pair""")
def ts_lead_lag_corr(spark, sf):
    """corr of leg a at t with leg b at t+5 (Pearson and Spearman)."""
    pr = pair_frame(spark, sf)
    w = Window.partitionBy("pair").orderBy("d")
    ll = pr.select("pair", "ret_a", F.lead("ret_b", 5).over(w).alias("y")).where(F.col("y").isNotNull())
    r = S.avg_rank(S.avg_rank(ll, "ret_a", ["pair"]), "y", ["pair"])
    return r.groupBy("pair").agg(F.corr("ret_a", "y").alias("corr_lead5"),
                                 F.corr("ret_a_rank", "y_rank").alias("spearman_lead5"))


# --------------------------------------------------- factor risk models -----
_FACTORS = ["mktrf", "smb", "hml", "umd"]


def _asset_factor_frame(spark, sf):
    r = B.panel_returns(spark, sf).where(F.col("ret").isNotNull()).select("id", "d", "ret")
    f = B.factors_monthly(spark, sf)
    return r.join(f, "d").withColumn("ex_ret", F.col("ret") - F.col("rf"))


@query("cov_factor_betas", rnd=["coef", "se", "t", "r2", "rss", "ser"])
def cov_factor_betas(spark, sf):
    """Per-asset time-series betas on the factors: one moment aggregation
    grouped by asset, one small solve per asset."""
    return R.ols_multi(_asset_factor_frame(spark, sf), _FACTORS, "ex_ret", by=["id"])


def factor_cov(spark, sf):
    """Long (fi, fj, cov) sample covariance of the factors (k x k, tiny)."""
    f = B.factors_monthly(spark, sf)
    pairs = [(a, b) for a in _FACTORS for b in _FACTORS]
    aggs = [F.covar_samp(a, b).alias(f"{a}__{b}") for a, b in pairs]
    return f.agg(*aggs).unpivot([], [f"{a}__{b}" for a, b in pairs], "pair", "cov") \
        .select(F.split("pair", "__")[0].alias("fi"), F.split("pair", "__")[1].alias("fj"), "cov")


@query("cov_factor_model", rnd=["factor_var", "idio_var", "total_var"], dp=8)
def cov_factor_model(spark, sf):
    """Factor-model variance of the contrarian portfolio per formation date,
    w' B S_f B' w + sum w_i^2 s_i^2, without materialising the asset x asset
    matrix: exposures e = B' w are a groupBy(d) sum, then a k x k quadratic form."""
    from kestrel.plans.strategy_queries import baseline_pi
    coef = cov_factor_betas(spark, sf)
    betas = coef.groupBy("id").pivot("term", _FACTORS).agg(F.first("coef"))
    resid = coef.groupBy("id").agg(F.first("ser").alias("ser"))
    _, _, w = baseline_pi(spark, sf)
    j = w.where(F.col("w").isNotNull()).select("id", "d", "w").join(betas, "id").join(resid, "id")
    expo = j.groupBy("d").agg(*[F.sum(F.col("w") * F.col(k)).alias(f"e_{k}") for k in _FACTORS],
                              F.sum(F.col("w") * F.col("w") * F.col("ser") * F.col("ser")).alias("idio_var"))
    cov = factor_cov(spark, sf)
    # quadratic form: explode exposures into (d, fi, e_i), join cov on fi, then fj
    ei = expo.select("d", "idio_var", F.explode(F.array(*[F.struct(F.lit(k).alias("fi"), F.col(f"e_{k}").alias("ei"))
                                                          for k in _FACTORS])).alias("x")).select("d", "idio_var", "x.*")
    ej = ei.select("d", F.col("fi").alias("fj"), F.col("ei").alias("ej"))
    q = ei.join(F.broadcast(cov), "fi").join(ej, ["d", "fj"])          # cov is k x k = 16 rows
    fv = q.groupBy("d", "idio_var").agg(F.sum(F.col("ei") * F.col("cov") * F.col("ej")).alias("factor_var"))
    return fv.select("d", "factor_var", "idio_var", (F.col("factor_var") + F.col("idio_var")).alias("total_var"))


@query("cov_shrinkage", rnd=["shrinkage", "mu"], dp=8, sql=with_(PRIO_REV, FACTORS) + """
, mf AS (SELECT avg(mktrf) AS m_mktrf, avg(smb) AS m_smb, avg(hml) AS m_hml, avg(umd) AS m_umd FROM factors),
c AS (SELECT mktrf - m_mktrf AS mktrf, smb - m_smb AS smb, hml - m_hml AS hml, umd - m_umd AS umd FROM factors CROSS JOIN mf),
m AS (SELECT count(*) AS T, avg(mktrf * mktrf) AS s__mktrf__mktrf, avg(pow(mktrf * mktrf, 2)) AS q__mktrf__mktrf, avg(mktrf * smb) AS s__mktrf__smb, avg(pow(mktrf * smb, 2)) AS q__mktrf__smb, avg(mktrf * hml) AS s__mktrf__hml, avg(pow(mktrf * hml, 2)) AS q__mktrf__hml, avg(mktrf * umd) AS s__mktrf__umd, avg(pow(mktrf * umd, 2)) AS q__mktrf__umd, avg(smb * mktrf) AS s__smb__mktrf, avg(pow(smb * mktrf, 2)) AS q__smb__mktrf, avg(smb * smb) AS s__smb__smb, avg(pow(smb * smb, 2)) AS q__smb__smb, avg(smb * hml) AS s__smb__hml, avg(pow(smb * hml, 2)) AS q__smb__hml, avg(smb * umd) AS s__smb__umd, avg(pow(smb * umd, 2)) AS q__smb__umd, avg(hml * mktrf) AS s__hml__mktrf, avg(pow(hml * mktrf, 2)) AS q__hml__mktrf, avg(hml * smb) AS s__hml__smb, avg(pow(hml * smb, 2)) AS q__hml__smb, avg(hml * hml) AS s__hml__hml, avg(pow(hml * hml, 2)) AS q__hml__hml, avg(hml * umd) AS s__hml__umd, avg(pow(hml * umd, 2)) AS q__hml__umd, avg(umd * mktrf) AS s__umd__mktrf, avg(pow(umd * mktrf, 2)) AS q__umd__mktrf, avg(umd * smb) AS s__umd__smb, avg(pow(umd * smb, 2)) AS q__umd__smb, avg(umd * hml) AS s__umd__hml, avg(pow(umd * hml, 2)) AS q__umd__hml, avg(umd * umd) AS s__umd__umd, avg(pow(umd * umd, 2)) AS q__umd__umd FROM c),
m2 AS (SELECT *, (s__mktrf__mktrf + s__smb__smb + s__hml__hml + s__umd__umd) / 4 AS mu FROM m),
m3 AS (SELECT T, mu, pow(s__mktrf__mktrf - mu, 2) + pow(s__mktrf__smb - 0.0, 2) + pow(s__mktrf__hml - 0.0, 2) + pow(s__mktrf__umd - 0.0, 2) + pow(s__smb__mktrf - 0.0, 2) + pow(s__smb__smb - mu, 2) + pow(s__smb__hml - 0.0, 2) + pow(s__smb__umd - 0.0, 2) + pow(s__hml__mktrf - 0.0, 2) + pow(s__hml__smb - 0.0, 2) + pow(s__hml__hml - mu, 2) + pow(s__hml__umd - 0.0, 2) + pow(s__umd__mktrf - 0.0, 2) + pow(s__umd__smb - 0.0, 2) + pow(s__umd__hml - 0.0, 2) + pow(s__umd__umd - mu, 2) AS d2, ((q__mktrf__mktrf - pow(s__mktrf__mktrf, 2)) + (q__mktrf__smb - pow(s__mktrf__smb, 2)) + (q__mktrf__hml - pow(s__mktrf__hml, 2)) + (q__mktrf__umd - pow(s__mktrf__umd, 2)) + (q__smb__mktrf - pow(s__smb__mktrf, 2)) + (q__smb__smb - pow(s__smb__smb, 2)) + (q__smb__hml - pow(s__smb__hml, 2)) + (q__smb__umd - pow(s__smb__umd, 2)) + (q__hml__mktrf - pow(s__hml__mktrf, 2)) + (q__hml__smb - pow(s__hml__smb, 2)) + (q__hml__hml - pow(s__hml__hml, 2)) + (q__hml__umd - pow(s__hml__umd, 2)) + (q__umd__mktrf - pow(s__umd__mktrf, 2)) + (q__umd__smb - pow(s__umd__smb, 2)) + (q__umd__hml - pow(s__umd__hml, 2)) + (q__umd__umd - pow(s__umd__umd, 2))) / T AS b2bar FROM m2)
SELECT T AS n_obs, mu, least(b2bar, d2) / d2 AS shrinkage FROM m3""")
def cov_shrinkage(spark, sf):
    """Ledoit-Wolf shrinkage of the factor covariance towards mu * I: the
    intensity comes from second and fourth moment aggregates (one pass)."""
    f = B.factors_monthly(spark, sf)
    means = f.agg(*[F.avg(k).alias(f"m_{k}") for k in _FACTORS])          # one-row aggregate
    c = R._attach(f, means, []).select(*[(F.col(k) - F.col(f"m_{k}")).alias(k) for k in _FACTORS])
    pairs = [(a, b) for a in _FACTORS for b in _FACTORS]
    aggs = [F.count(F.lit(1)).alias("T")]
    for a, b in pairs:
        aggs += [F.avg(F.col(a) * F.col(b)).alias(f"s__{a}__{b}"), F.avg(F.pow(F.col(a) * F.col(b), 2)).alias(f"q__{a}__{b}")]
    m = c.agg(*aggs)
    k = len(_FACTORS)
    mu = sum(F.col(f"s__{a}__{a}") for a in _FACTORS) / k
    d2 = sum(F.pow(F.col(f"s__{a}__{b}") - (mu if a == b else F.lit(0.0)), 2) for a, b in pairs)
    b2bar = sum(F.col(f"q__{a}__{b}") - F.pow(F.col(f"s__{a}__{b}"), 2) for a, b in pairs) / F.col("T")
    b2 = F.least(b2bar, d2)
    return m.select(F.col("T").alias("n_obs"), mu.alias("mu"), (b2 / d2).alias("shrinkage"))


@query("cov_noise_sensitivity", rnd=["mean_sharpe", "sd_sharpe", "base_sharpe"], dp=4)
def cov_noise_sensitivity(spark, sf):
    """Perturb returns with seeded hash noise in B = 20 replicates (explode, not
    a cross join) and compare the strategy Sharpe across replicates."""
    from kestrel.plans.strategy_queries import PERIODS, _in_sample
    from kestrel.operators import panel as P
    r = B.panel_returns(spark, sf)
    cal = P.calendar(r)
    rep = r.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(20))))
    noise = (F.pmod(F.xxhash64("id", "d", "b"), F.lit(10000)) / 10000.0 - 0.5) * 0.02
    rep = rep.withColumn("ret", F.when(F.col("b") == 0, F.col("ret")).otherwise(F.col("ret") + noise))
    pr = P.with_calendar(rep, cal)
    ex = pr.join(pr.groupBy("b", "d").agg(F.avg("ret").alias("mkt")), ["b", "d"]).withColumn("_raw", -(F.col("ret") - F.col("mkt")))
    w = P.long_short_normalize(ex, ["b", "d"], "_raw", "w")
    ws = w.select("b", "id", (F.col("date_idx") + 1).alias("date_idx"), "w")
    prod = ws.join(pr.select("b", "id", "date_idx", "ret"), ["b", "id", "date_idx"]).groupBy("b", "date_idx") \
        .agg(F.sum(F.col("w") * F.col("ret")).alias("pi"))
    base = P.expand(cal, "b", list(range(21)))
    pi = _in_sample(base.join(prod, ["b", "date_idx"], "left").withColumn("pi", F.coalesce("pi", F.lit(0.0))))
    st = pi.groupBy("b").agg((F.avg("pi") * PERIODS / (F.stddev_samp("pi") * PERIODS ** 0.5)).alias("sharpe"))
    return st.agg(F.avg(F.when(F.col("b") > 0, F.col("sharpe"))).alias("mean_sharpe"),
                  F.stddev_samp(F.when(F.col("b") > 0, F.col("sharpe"))).alias("sd_sharpe"),
                  F.max(F.when(F.col("b") == 0, F.col("sharpe"))).alias("base_sharpe"))


@query("reg_lagged_ml", rnd=["rmse_model", "rmse_baseline", "corr"], dp=5)
def reg_lagged_ml(spark, sf):
    """Six lags of leg a as features for leg b, 80/20 time split, scaler +
    linear regression vs a train-mean baseline (RMSE, correlation)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.regression import LinearRegression
    pr = pair_frame(spark, sf)
    w = Window.partitionBy("pair").orderBy("d")
    lags = [F.lag("ret_a", j).over(w).alias(f"l{j}") for j in range(1, 7)]
    x = pr.select("pair", "d", "ret_b", *lags, F.percent_rank().over(w).alias("_pos")).dropna()
    x = x.withColumn("split", F.when(F.col("_pos") <= 0.8, "train").otherwise("test"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=[f"l{j}" for j in range(1, 7)], outputCol="raw"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                            LinearRegression(labelCol="ret_b", regParam=0.0)])
    out = None
    for pair in [f"{a}-{b}" for a, b in B.PAIRS]:   # fixed pair list
        d = x.where(F.col("pair") == pair)
        tr = d.where("split = 'train'")
        m = pipe.fit(tr)
        mean_tr = tr.agg(F.avg("ret_b").alias("mb"))
        from kestrel.functions import attach_scalars
        p = attach_scalars(m.transform(d.where("split = 'test'")), mean_tr)
        r = p.agg(F.sqrt(F.avg(F.pow(F.col("ret_b") - F.col("prediction"), 2))).alias("rmse_model"),
                  F.sqrt(F.avg(F.pow(F.col("ret_b") - F.col("mb"), 2))).alias("rmse_baseline"),
                  F.corr("ret_b", "prediction").alias("corr")).withColumn("pair", F.lit(pair))
        out = r if out is None else out.unionByName(r)
    return out
