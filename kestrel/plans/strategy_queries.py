"""Backtest family on the supplier x month panel: contrarian weights, calendar
lag, portfolio return, lag/power families, costs, out-of-sample table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import panel as P
from kestrel.operators import quality as Q
from kestrel.plans.registry import query
from kestrel.plans.sqlbind import CAL, EX, MKT, PANEL_M, PANEL_R, PI1, PR, W1, with_  # noqa: F401
from kestrel.session import cut_lineage, ensure_checkpoint_dir, remove_folder
from kestrel.sources import bindings as B
from kestrel.sources import files as FS

PERIODS = 12  # monthly panel
# Sample windows of the monthly binding (in-sample, two out-of-sample).
WINDOWS = [("in_sample", "1995-01-01", "1998-12-31"),
           ("oos1", "1999-01-01", "2000-06-30"),
           ("oos2", "2000-07-01", "2001-12-31")]
# Strategy parameter grids (lags, half-spread cost levels in bps);
# the power grid is the rule 0.25 * i for i = 1..20.
LAGS = [1, 2, 3, 4, 5]
HALF_SPREAD_BPS = [0, 2, 5, 10, 25, 30, 40, 50, 75, 100]
POWERS = [round(0.25 * i, 2) for i in range(1, 21)]


def period_label(c: str = "d"):
    e = None
    for name, lo, hi in WINDOWS:
        cond = F.col(c).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return e


PERIOD_SQL = ("CASE " + " ".join(
    f"WHEN d BETWEEN DATE '{lo}' AND DATE '{hi}' THEN '{n}'" for n, lo, hi in WINDOWS) + " END")
IN_LO, IN_HI = WINDOWS[0][1], WINDOWS[0][2]


def base_panel(spark: SparkSession, sf: str):
    """(pr, cal): returns panel with calendar index, and the calendar.

    The panel is an aggregate of lineitem (ids x months, far smaller than the
    fact table) that every strategy query consumes several times, so it is
    materialised once in the shared checkpoint folder: the fact table is
    scanned once per query, not once per consumer."""
    r = cut_lineage(B.panel_returns(spark, sf))
    cal = cut_lineage(P.calendar(r))
    return cut_lineage(P.with_calendar(r, cal)), cal


def baseline_pi(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    pr, cal = base_panel(spark, sf)
    w = P.contrarian_weights(pr)
    pi = P.portfolio_return(w, pr, cal, k=1)
    return pi, pr, w


_BASE = with_(PANEL_M, PANEL_R, CAL, PR, MKT, EX, W1, PI1)


@query("strat_portfolio_return", rnd=["pi", "mkt"], bench=True, sql=_BASE + """
SELECT pi1.d, pi1.pi, mkt.mkt FROM pi1 LEFT JOIN mkt USING (d)""")
def strat_portfolio_return(spark, sf):
    """pi(t) = sum_i w_i(t-1) r_i(t) with the market return alongside."""
    pi, pr, _ = baseline_pi(spark, sf)
    return pi.join(P.market_return(pr), "d", "left").select("d", "pi", "mkt")


@query("strat_contrarian_weights", rnd=["w"], sql=_BASE + """
SELECT d, id, w FROM w1 WHERE w IS NOT NULL""")
def strat_contrarian_weights(spark, sf):
    _, _, w = baseline_pi(spark, sf)
    return w.where(F.col("w").isNotNull()).select("d", "id", "w")


@query("agg_market_return", rnd=["mkt"], sql=with_(PANEL_M, PANEL_R) + """
SELECT d, avg(ret) AS mkt, count(ret) AS n FROM panel_r GROUP BY d""")
def agg_market_return(spark, sf):
    r = B.panel_returns(spark, sf)
    return r.groupBy("d").agg(F.avg("ret").alias("mkt"), F.count("ret").alias("n"))


@query("agg_annualized", rnd=["ann_mean", "ann_vol", "sharpe"], bench=True, sql=_BASE + f"""
, s AS (SELECT 'strategy' AS series, pi AS r FROM pi1 WHERE d BETWEEN DATE '{IN_LO}' AND DATE '{IN_HI}'
        UNION ALL
        SELECT 'market', mkt FROM pi1 JOIN mkt USING (d) WHERE d BETWEEN DATE '{IN_LO}' AND DATE '{IN_HI}')
SELECT series, avg(r) * {PERIODS} AS ann_mean, stddev_samp(r) * sqrt({PERIODS}) AS ann_vol, count(r) AS n,
       CASE WHEN stddev_samp(r) * sqrt({PERIODS}) > 0 THEN avg(r) * {PERIODS} / (stddev_samp(r) * sqrt({PERIODS})) END AS sharpe
FROM s GROUP BY series""")
def agg_annualized(spark, sf):
    pi, pr, _ = baseline_pi(spark, sf)
    s = (pi.join(P.market_return(pr), "d", "left")
           .where(F.col("d").between(F.lit(IN_LO).cast("date"), F.lit(IN_HI).cast("date"))))
    long = s.select(F.lit("strategy").alias("series"), F.col("pi").alias("r")).unionByName(
        s.select(F.lit("market").alias("series"), F.col("mkt").alias("r")))
    return P.annualized(long, "r", PERIODS, by=["series"])


@query("win_calendar_lag", rnd=["w_lag"], sql=_BASE + """
SELECT c.d, w1.id, w1.w AS w_lag FROM w1 JOIN cal c ON c.date_idx = w1.date_idx + 2
WHERE w1.w IS NOT NULL""")
def win_calendar_lag(spark, sf):
    """Weights shifted by k=2 calendar rows (missing cells stay missing)."""
    pr, cal = base_panel(spark, sf)
    w = P.contrarian_weights(pr).where(F.col("w").isNotNull())
    sh = P.calendar_shift(w.select("id", "date_idx", F.col("w").alias("w_lag")), 2)
    return sh.join(cal, "date_idx").select("d", "id", "w_lag")


@query("join_self_lag", rnd=["w_prev", "ret", "contrib"], sql=_BASE + """
SELECT r.d, r.id, w1.w AS w_prev, r.ret, w1.w * r.ret AS contrib
FROM w1 JOIN pr r ON r.id = w1.id AND r.date_idx = w1.date_idx + 1
WHERE w1.w IS NOT NULL AND r.ret IS NOT NULL""")
def join_self_lag(spark, sf):
    """weights(t-1) x returns(t) on (id, calendar index)."""
    pr, cal = base_panel(spark, sf)
    w = P.contrarian_weights(pr).where(F.col("w").isNotNull())
    ws = P.calendar_shift(w.select("id", "date_idx", F.col("w").alias("w_prev")), 1)
    j = ws.join(pr.where(F.col("ret").isNotNull()).select("id", "date_idx", "d", "ret"), ["id", "date_idx"])
    return j.select("d", "id", "w_prev", "ret", (F.col("w_prev") * F.col("ret")).alias("contrib"))


# ----------------------------------------------------------- families -------
def _in_sample(df, c="d"):
    return df.where(F.col(c).between(F.lit(IN_LO).cast("date"), F.lit(IN_HI).cast("date")))


def _values(name, vals, cast="INTEGER"):
    return "(SELECT CAST(v AS " + cast + ") AS " + name + " FROM (VALUES " + \
        ", ".join(f"({v})" for v in vals) + ") AS _g(v))"


_STATS_SQL = (f"avg(pi) * {PERIODS} AS ann_mean, stddev_samp(pi) * sqrt({PERIODS}) AS ann_vol, "
              f"CASE WHEN stddev_samp(pi) > 0 THEN avg(pi) * {PERIODS} / (stddev_samp(pi) * sqrt({PERIODS})) END AS sharpe, "
              "count(pi) AS n")
_KG = _values("k", LAGS)
_PG = _values("p", POWERS, "DOUBLE")

_LAGFAM = _BASE + f""",
wk AS (SELECT w1.id, w1.date_idx, w1.w, g.k FROM w1 CROSS JOIN {_KG} AS g),
prodk AS (SELECT wk.k, r.date_idx, sum(wk.w * r.ret) AS pi
          FROM wk JOIN pr r ON r.id = wk.id AND r.date_idx = wk.date_idx + wk.k GROUP BY wk.k, r.date_idx),
pik AS (SELECT c.d, g.k, coalesce(p.pi, 0.0) AS pi FROM cal c CROSS JOIN {_KG} AS g
        LEFT JOIN prodk p ON p.k = g.k AND p.date_idx = c.date_idx)
"""

_POWFAM = _BASE + f""",
pw AS (SELECT g.p, ex.id, ex.d, ex.date_idx,
              -sign(coalesce(excess, 0.0)) * pow(abs(coalesce(excess, 0.0)), g.p) AS raw
       FROM ex CROSS JOIN {_PG} AS g),
psums AS (SELECT p, d, sum(CASE WHEN raw > 0 THEN raw END) AS lsum,
                 sum(CASE WHEN raw < 0 THEN -raw END) AS ssum FROM pw GROUP BY p, d),
pwn AS (SELECT p, id, date_idx, CASE WHEN raw > 0 THEN raw / lsum WHEN raw < 0 THEN raw / ssum ELSE raw END AS w
        FROM pw JOIN psums USING (p, d)),
pprod AS (SELECT pwn.p, r.date_idx, sum(pwn.w * r.ret) AS pi
          FROM pwn JOIN pr r ON r.id = pwn.id AND r.date_idx = pwn.date_idx + 1 GROUP BY pwn.p, r.date_idx),
ppi AS (SELECT c.d, g.p, coalesce(pp.pi, 0.0) AS pi FROM cal c CROSS JOIN {_PG} AS g
        LEFT JOIN pprod pp ON pp.p = g.p AND pp.date_idx = c.date_idx)
"""
_IN = f"d BETWEEN DATE '{IN_LO}' AND DATE '{IN_HI}'"


def lag_family_pi(spark, sf):
    pr, cal = base_panel(spark, sf)
    w = P.expand(P.contrarian_weights(pr), "k", LAGS)
    return P.portfolio_return(w, pr, cal, k="k", grid={"k": LAGS})


def power_family_pi(spark, sf, powers=None):
    powers = powers or POWERS
    pr, cal = base_panel(spark, sf)
    w = P.contrarian_weights(pr, powers=powers)
    return P.portfolio_return(w, pr, cal, k=1, grid={"p": [float(x) for x in powers]})


def _stats(df, by):
    return P.annualized(df.withColumnRenamed("pi", "r"), "r", PERIODS, by=by)


@query("strat_lag_family", rnd=["ann_mean", "ann_vol", "sharpe"], bench=True,
       sql=_LAGFAM + f"SELECT k, {_STATS_SQL} FROM pik WHERE {_IN} GROUP BY k")
def strat_lag_family(spark, sf):
    """k = 1..5: weights from lag-k excess, one plan for all k."""
    return _stats(_in_sample(lag_family_pi(spark, sf)), ["k"])


@query("strat_power_grid", rnd=["ann_mean", "ann_vol", "sharpe"],
       sql=_POWFAM + f"SELECT p, {_STATS_SQL} FROM ppi WHERE {_IN} GROUP BY p")
def strat_power_grid(spark, sf):
    """20-point power grid of -sign(x)|x|^p weights, in-sample stats."""
    return _stats(_in_sample(power_family_pi(spark, sf)), ["p"])


@query("strat_power_family", rnd=["ann_mean", "ann_vol", "sharpe"],
       sql=_POWFAM.replace(_PG, _values("p", [0.5], "DOUBLE")) +
       f"SELECT p, {_STATS_SQL} FROM ppi WHERE {_IN} GROUP BY p")
def strat_power_family(spark, sf):
    """Custom strategy at power 0.5."""
    return _stats(_in_sample(power_family_pi(spark, sf, [0.5])), ["p"])


@query("sort_argmax", rnd=["best_sharpe"], sql=_POWFAM + f"""
, st AS (SELECT p, {_STATS_SQL} FROM ppi WHERE {_IN} GROUP BY p)
SELECT arg_max(p, sharpe) AS best_power, max(sharpe) AS best_sharpe FROM st""")
def sort_argmax(spark, sf):
    """Best power by Sharpe (max_by)."""
    st = _stats(_in_sample(power_family_pi(spark, sf)), ["p"])
    return st.agg(F.max_by("p", "sharpe").alias("best_power"), F.max("sharpe").alias("best_sharpe"))


@query("strat_long_short_legs", rnd=["corr_ls", "long_mean", "short_mean"], sql=_BASE + f"""
, legs AS (SELECT r.date_idx, sum(greatest(w1.w, 0) * r.ret) AS lg, sum(least(w1.w, 0) * r.ret) AS sh
           FROM w1 JOIN pr r ON r.id = w1.id AND r.date_idx = w1.date_idx + 1 GROUP BY r.date_idx),
s AS (SELECT c.d, coalesce(lg, 0.0) AS lg, coalesce(sh, 0.0) AS sh FROM cal c LEFT JOIN legs USING (date_idx))
SELECT corr(lg, sh) AS corr_ls, avg(lg) * {PERIODS} AS long_mean, avg(sh) * {PERIODS} AS short_mean, count(*) AS n
FROM s WHERE {_IN}""")
def strat_long_short_legs(spark, sf):
    """Long leg sum max(w,0) r and short leg sum min(w,0) r; their correlation."""
    pr, cal = base_panel(spark, sf)
    w = P.contrarian_weights(pr)
    ws = w.select("id", (F.col("date_idx") + 1).alias("date_idx"), "w")
    legs = (ws.join(pr.select("id", "date_idx", "ret"), ["id", "date_idx"])
              .groupBy("date_idx").agg(F.sum(F.greatest("w", F.lit(0.0)) * F.col("ret")).alias("lg"),
                                       F.sum(F.least("w", F.lit(0.0)) * F.col("ret")).alias("sh")))
    s = _in_sample(cal.join(legs, "date_idx", "left").na.fill(0.0, ["lg", "sh"]))
    return s.agg(F.corr("lg", "sh").alias("corr_ls"), (F.avg("lg") * PERIODS).alias("long_mean"),
                 (F.avg("sh") * PERIODS).alias("short_mean"), F.count(F.lit(1)).alias("n"))


_TURN_IN = _BASE + f""",
wi AS (SELECT * FROM w1 WHERE {_IN} AND w IS NOT NULL),
dt AS (SELECT a.date_idx, sum(abs(a.w - b.w)) AS two_way
       FROM wi a JOIN wi b ON a.id = b.id AND a.date_idx = b.date_idx + 1 GROUP BY a.date_idx),
tt AS (SELECT c.d, c.date_idx, coalesce(dt.two_way, 0.0) AS two_way FROM cal c LEFT JOIN dt USING (date_idx) WHERE {_IN})
"""


def in_sample_two_way(spark, sf):
    """Per in-sample date sum |w(t) - w(t-1)| over names weighted on both
    dates (first sample date 0)."""
    pr, cal = base_panel(spark, sf)
    w = _in_sample(P.contrarian_weights(pr)).where(F.col("w").isNotNull())
    t = P.turnover(w, missing="skip")
    return _in_sample(cal).join(t.select("date_idx", "two_way"), "date_idx", "left").na.fill(0.0, ["two_way"])


@query("win_turnover", rnd=["mean_turnover", "median_turnover", "max_turnover", "annual_turnover"],
       sql=_TURN_IN + f"""
SELECT avg(two_way / 2) AS mean_turnover, quantile_cont(two_way / 2, 0.5) AS median_turnover,
       max(two_way / 2) AS max_turnover, avg(two_way / 2) * {PERIODS} AS annual_turnover FROM tt""")
def win_turnover(spark, sf):
    t = in_sample_two_way(spark, sf).withColumn("to", F.col("two_way") / 2)
    return t.agg(F.avg("to").alias("mean_turnover"), F.percentile("to", 0.5).alias("median_turnover"),
                 F.max("to").alias("max_turnover"), (F.avg("to") * PERIODS).alias("annual_turnover"))


@query("strat_net_of_costs", rnd=["ann_mean", "ann_vol", "sharpe", "avg_cost", "ann_cost_drag"],
       sql=_TURN_IN + f"""
, net AS (SELECT g.bps, tt.d, pi1.pi - g.bps / 10000.0 * tt.two_way AS pi, g.bps / 10000.0 * tt.two_way AS cost
          FROM tt JOIN pi1 USING (d) CROSS JOIN {_values('bps', HALF_SPREAD_BPS)} AS g)
SELECT bps, {_STATS_SQL}, avg(cost) AS avg_cost, avg(cost) * {PERIODS} AS ann_cost_drag FROM net GROUP BY bps""")
def strat_net_of_costs(spark, sf):
    """Half-spread cost grid on two-way traded fraction."""
    t = in_sample_two_way(spark, sf)
    pi, _, _ = baseline_pi(spark, sf)
    g = P.expand(t.join(pi.select("d", "pi"), "d"), "bps", HALF_SPREAD_BPS)
    c = F.col("bps") / 10000.0 * F.col("two_way")
    net = g.select("bps", "d", (F.col("pi") - c).alias("pi"), c.alias("cost"))
    st = _stats(net, ["bps"])
    cost = net.groupBy("bps").agg(F.avg("cost").alias("avg_cost"), (F.avg("cost") * PERIODS).alias("ann_cost_drag"))
    return st.join(cost, "bps")


@query("cross_param_grid", rnd=["net"], sql=_TURN_IN + f"""
SELECT g.bps, tt.d, pi1.pi - g.bps / 10000.0 * tt.two_way AS net
FROM tt JOIN pi1 USING (d) CROSS JOIN {_values('bps', HALF_SPREAD_BPS)} AS g""")
def cross_param_grid(spark, sf):
    """Every cost level x every date (grid expanded by explode, not a join)."""
    t = in_sample_two_way(spark, sf)
    pi, _, _ = baseline_pi(spark, sf)
    g = P.expand(t.join(pi.select("d", "pi"), "d"), "bps", HALF_SPREAD_BPS)
    return g.select("bps", "d", (F.col("pi") - F.col("bps") / 10000.0 * F.col("two_way")).alias("net"))


def _in_pi(spark, sf):
    pi, pr, _ = baseline_pi(spark, sf)
    return _in_sample(pi)


@query("win_cumulative", rnd=["cum"], dp=2, sql=_BASE + f"""
SELECT d, product(1 + pi) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
FROM pi1 WHERE {_IN}""")
def win_cumulative(spark, sf):
    return P.drawdown(_in_pi(spark, sf), "d", "pi").select("d", "cum")


@query("win_drawdown", rnd=["max_dd"], sql=_BASE + f"""
, c AS (SELECT d, product(1 + pi) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
        FROM pi1 WHERE {_IN}),
dd AS (SELECT d, (cum - max(cum) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
               / max(cum) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dd FROM c)
SELECT min(dd) AS max_dd, min(d) FILTER (WHERE dd = (SELECT min(dd) FROM dd)) AS trough_d FROM dd""")
def win_drawdown(spark, sf):
    dd = P.drawdown(_in_pi(spark, sf), "d", "pi")
    from pyspark.sql import Window
    dd = dd.withColumn("m", F.min("dd").over(Window.partitionBy()))  # one row per date
    return dd.agg(F.min("dd").alias("max_dd"), F.min(F.when(F.col("dd") == F.col("m"), F.col("d"))).alias("trough_d"))


@query("agg_half_split", rnd=["ann_mean", "ann_vol"], sql=_BASE + f"""
, s AS (SELECT pi, row_number() OVER (ORDER BY d) AS rn, count(*) OVER () AS n FROM pi1 WHERE {_IN})
SELECT CASE WHEN rn <= n // 2 THEN 'early' ELSE 'late' END AS half,
       avg(pi) * {PERIODS} AS ann_mean, stddev_samp(pi) * sqrt({PERIODS}) AS ann_vol FROM s GROUP BY 1""")
def agg_half_split(spark, sf):
    """Early / late halves by row position (floor(n/2) rows in the first)."""
    from pyspark.sql import Window
    s = _in_pi(spark, sf)
    # one row per date: the global window runs on a calendar-bounded series
    s = (s.withColumn("rn", F.row_number().over(Window.orderBy("d")))
          .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy())))
    s = s.withColumn("half", F.when(F.col("rn") <= F.floor(F.col("n") / 2), "early").otherwise("late"))
    return s.groupBy("half").agg((F.avg("pi") * PERIODS).alias("ann_mean"),
                                 (F.stddev_samp("pi") * PERIODS ** 0.5).alias("ann_vol"))


@query("win_zscore_outliers", rnd=["pi", "z"], sql=_BASE + f"""
, s AS (SELECT d, pi FROM pi1 WHERE {_IN}),
z AS (SELECT d, pi, abs(pi - avg(pi) OVER ()) / stddev_pop(pi) OVER () AS z FROM s)
SELECT d, pi, z FROM z WHERE z > 3""")
def win_zscore_outliers(spark, sf):
    """|z| > 3 days with population sd (ddof 0)."""
    s = _in_pi(spark, sf)
    from pyspark.sql import Window
    allw = Window.partitionBy()   # calendar-bounded series: one row per date
    z = s.withColumn("m", F.avg("pi").over(allw)).withColumn("sd", F.stddev_pop("pi").over(allw))
    return z.select("d", "pi", (F.abs(F.col("pi") - F.col("m")) / F.col("sd")).alias("z")).where("z > 3")


@query("agg_corr", rnd=["corr_pi_mkt"], sql=_BASE + f"""
SELECT corr(pi, mkt) AS corr_pi_mkt, count(*) AS n FROM pi1 JOIN mkt USING (d) WHERE {_IN}""")
def agg_corr(spark, sf):
    pi, pr, _ = baseline_pi(spark, sf)
    s = _in_sample(pi.join(P.market_return(pr), "d"))
    return s.agg(F.corr("pi", "mkt").alias("corr_pi_mkt"), F.count(F.lit(1)).alias("n"))


@query("win_rolling_stats", rnd=["roll_mean", "roll_vol", "roll_sharpe"], sql=_BASE + f"""
, s AS (SELECT d, pi,
          avg(pi) OVER (ORDER BY d ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) * {PERIODS} AS m,
          stddev_samp(pi) OVER (ORDER BY d ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) * sqrt({PERIODS}) AS v,
          count(pi) OVER (ORDER BY d ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS c
        FROM pi1 WHERE {_IN})
SELECT d, CASE WHEN c = 12 THEN m END AS roll_mean, CASE WHEN c = 12 THEN v END AS roll_vol,
       CASE WHEN c = 12 AND v > 0 THEN m / v END AS roll_sharpe FROM s""")
def win_rolling_stats(spark, sf):
    """12-period rolling annualized mean / vol / Sharpe, full-window guard."""
    from pyspark.sql import Window
    s = _in_pi(spark, sf)
    w = Window.orderBy("d").rowsBetween(-11, 0)
    full = F.count("pi").over(w) == 12
    m = F.avg("pi").over(w) * PERIODS
    v = F.stddev_samp("pi").over(w) * PERIODS ** 0.5
    return s.select("d", F.when(full, m).alias("roll_mean"), F.when(full, v).alias("roll_vol"),
                    F.when(full & (v > 0), m / v).alias("roll_sharpe"))


# ------------------------------------------------------------ OOS table -----
_OOS = _POWFAM.replace(_PG, _values("p", [0.5], "DOUBLE")) + f"""
, allpi AS (SELECT 'baseline_k1' AS strategy, d, pi FROM pi1
            UNION ALL SELECT 'custom_p0.5', d, pi FROM ppi
            UNION ALL SELECT 'market', d, mkt FROM mkt),
lab AS (SELECT strategy, {PERIOD_SQL} AS period, pi FROM allpi),
oos AS (SELECT strategy, period, {_STATS_SQL} FROM lab WHERE period IS NOT NULL GROUP BY strategy, period)
"""


def oos_table(spark, sf):
    pi, pr, _ = baseline_pi(spark, sf)
    cust = power_family_pi(spark, sf, [0.5]).select("d", "pi")
    allpi = (pi.select(F.lit("baseline_k1").alias("strategy"), "d", "pi")
             .unionByName(cust.select(F.lit("custom_p0.5").alias("strategy"), "d", "pi"))
             .unionByName(P.market_return(pr).select(F.lit("market").alias("strategy"), "d",
                                                     F.col("mkt").alias("pi"))))
    lab = allpi.withColumn("period", period_label()).where(F.col("period").isNotNull())
    return _stats(lab, ["strategy", "period"])


@query("strat_oos_table", rnd=["ann_mean", "ann_vol", "sharpe"], sql=_OOS + "SELECT * FROM oos")
def strat_oos_table(spark, sf):
    """strategy x period x (mean, vol, Sharpe)."""
    return oos_table(spark, sf)


@query("strat_allocation_rule", rnd=["mean_oos_sharpe"], sql=_OOS + """
, m AS (SELECT strategy, avg(sharpe) AS mean_oos_sharpe FROM oos
        WHERE period <> 'in_sample' AND strategy <> 'market' GROUP BY strategy)
SELECT arg_max(strategy, mean_oos_sharpe) AS strategy, max(mean_oos_sharpe) AS mean_oos_sharpe,
       CASE WHEN max(mean_oos_sharpe) > 0 THEN 0.5 ELSE 0.0 END AS risky_weight,
       CASE WHEN max(mean_oos_sharpe) > 0 THEN 0.5 ELSE 1.0 END AS cash_weight FROM m""")
def strat_allocation_rule(spark, sf):
    """Pick the strategy with best mean out-of-sample Sharpe; half in cash."""
    m = (oos_table(spark, sf).where((F.col("period") != "in_sample") & (F.col("strategy") != "market"))
         .groupBy("strategy").agg(F.avg("sharpe").alias("mean_oos_sharpe")))
    best = m.agg(F.max_by("strategy", "mean_oos_sharpe").alias("strategy"),
                 F.max("mean_oos_sharpe").alias("mean_oos_sharpe"))
    pos = F.col("mean_oos_sharpe") > 0
    return best.select("strategy", "mean_oos_sharpe",
                       F.when(pos, 0.5).otherwise(0.0).alias("risky_weight"),
                       F.when(pos, 0.5).otherwise(1.0).alias("cash_weight"))


# --------------------------------------------------------------- upload -----
_UPLOAD = _BASE + f""",
up AS (SELECT '0' AS pid, c.d, w1.id, g.k, w1.w, 0 AS vid
       FROM w1 CROSS JOIN {_KG} AS g JOIN cal c ON c.date_idx = w1.date_idx + g.k - 1
       WHERE w1.w IS NOT NULL AND w1.w <> 0 AND c.d BETWEEN DATE '{IN_LO}' AND DATE '{IN_HI}')
"""


def upload_rows(spark, sf):
    """(pid, d, id, k, w, vid): lag-k weights held at date t (formed at t-k+1),
    sample dates only, no zero / NULL weights."""
    pr, cal = base_panel(spark, sf)
    w = P.expand(P.contrarian_weights(pr).where(F.col("w").isNotNull() & (F.col("w") != 0)), "k", LAGS)
    sh = w.select("id", "k", "w", (F.col("date_idx") + F.col("k") - 1).alias("date_idx"))
    out = sh.join(cal, "date_idx").select(F.lit("0").alias("pid"), "d", "id", "k", "w", F.lit(0).alias("vid"))
    return _in_sample(out)


def _audit(rows):
    return Q.validate_upload(rows, ["pid", "d", "id", "k"], "w")


@query("sink_upload_long", rnd=["w"], sql=_UPLOAD + "SELECT * FROM up")
def sink_upload_long(spark, sf):
    """The upload, written, audited on disk and committed by a rename, as read from its place."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/upload-{uuid.uuid4().hex}"
    FS.commit_upload(upload_rows(spark, sf), path, _audit)
    return spark.read.parquet(path)


@query("sink_validate_upload", sql=_UPLOAD + """
SELECT count(*) AS n_rows, count(CASE WHEN w = 0 THEN 1 END) AS zeros, count(CASE WHEN isnan(w) OR w IS NULL THEN 1 END) AS nans,
       count(CASE WHEN isinf(w) THEN 1 END) AS infs, count(*) - count(DISTINCT (pid, d, id, k)) AS dups,
       CASE WHEN count(CASE WHEN w = 0 THEN 1 END) + count(CASE WHEN isnan(w) OR w IS NULL THEN 1 END) + count(CASE WHEN isinf(w) THEN 1 END)
                 + count(*) - count(DISTINCT (pid, d, id, k)) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM up""")
def sink_validate_upload(spark, sf):
    """Post-write audit of the staged upload: zeros, NaN, Inf, duplicate keys, from the files."""
    staged, written = FS.stage_upload(upload_rows(spark, sf), f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/upload")
    out = cut_lineage(_audit(written))
    remove_folder(spark, staged)
    return out


# ------------------------------------------------- series-level reports -----
_PIM = _BASE + """
, pm AS (SELECT pi1.d, pi1.pi, mkt.mkt FROM pi1 JOIN mkt USING (d))
"""


def _pi_mkt(spark, sf):
    pi, pr, _ = baseline_pi(spark, sf)
    return pi.join(P.market_return(pr), "d")


@query("sample_window", sql=_BASE + f"SELECT d, {PERIOD_SQL} AS period FROM cal")
def sample_window(spark, sf):
    """In-sample / OOS1 / OOS2 label per calendar date."""
    _, cal = base_panel(spark, sf)
    return cal.select("d", period_label().alias("period"))


@query("date_parts", sql=_BASE + "SELECT d, year(d) AS yr, strftime(d, '%Y-%m') AS ym, CAST(date_trunc('quarter', d) AS DATE) AS q FROM cal")
def date_parts(spark, sf):
    _, cal = base_panel(spark, sf)
    return cal.select("d", F.year("d").alias("yr"), F.date_format("d", "yyyy-MM").alias("ym"),
                      F.trunc("d", "quarter").alias("q"))


@query("agg_yearly", rnd=["ann_mean", "ann_vol", "sharpe"], sql=_PIM + f"""
SELECT year(d) AS yr, {_STATS_SQL} FROM pm GROUP BY year(d)""")
def agg_yearly(spark, sf):
    """Per calendar year annualised stats of the strategy."""
    s = _pi_mkt(spark, sf).withColumn("yr", F.year("d"))
    return _stats(s, ["yr"])


@query("agg_perf_rf", rnd=["ann_ret", "ann_vol", "ann_excess_vol", "ann_rf", "sharpe"], sql=_PIM + f"""
, rf AS (SELECT d, 0.002 AS rf FROM pm)
SELECT avg(pi) * {PERIODS} AS ann_ret, stddev_samp(pi) * sqrt({PERIODS}) AS ann_vol,
       stddev_samp(pi - rf) * sqrt({PERIODS}) AS ann_excess_vol, avg(rf) * {PERIODS} AS ann_rf,
       avg(pi - rf) * {PERIODS} / (stddev_samp(pi - rf) * sqrt({PERIODS})) AS sharpe
FROM pm JOIN rf USING (d) WHERE {_IN}""")
def agg_perf_rf(spark, sf):
    """Annual return, vol, excess-return vol, rf and Sharpe on excess returns
    (headline uses excess vol, S11); rf is a flat 0.2 % per month."""
    s = _in_sample(_pi_mkt(spark, sf)).withColumn("rf", F.lit(0.002))
    ex = F.col("pi") - F.col("rf")
    return s.agg((F.avg("pi") * PERIODS).alias("ann_ret"), (F.stddev_samp("pi") * PERIODS ** 0.5).alias("ann_vol"),
                 (F.stddev_samp(ex) * PERIODS ** 0.5).alias("ann_excess_vol"), (F.avg("rf") * PERIODS).alias("ann_rf"),
                 (F.avg(ex) * PERIODS / (F.stddev_samp(ex) * PERIODS ** 0.5)).alias("sharpe"))


@query("agg_winloss", rnd=["share_win", "share_loss", "share_zero", "median_win", "median_loss"], sql=_PIM + f"""
SELECT avg(CASE WHEN pi > 0 THEN 1.0 ELSE 0.0 END) AS share_win, avg(CASE WHEN pi < 0 THEN 1.0 ELSE 0.0 END) AS share_loss,
       avg(CASE WHEN pi = 0 THEN 1.0 ELSE 0.0 END) AS share_zero,
       quantile_cont(pi, 0.5) FILTER (WHERE pi > 0) AS median_win, quantile_cont(pi, 0.5) FILTER (WHERE pi < 0) AS median_loss
FROM pm""")
def agg_winloss(spark, sf):
    s = _pi_mkt(spark, sf)
    return s.agg(F.avg(F.when(F.col("pi") > 0, 1.0).otherwise(0.0)).alias("share_win"),
                 F.avg(F.when(F.col("pi") < 0, 1.0).otherwise(0.0)).alias("share_loss"),
                 F.avg(F.when(F.col("pi") == 0, 1.0).otherwise(0.0)).alias("share_zero"),
                 F.percentile(F.when(F.col("pi") > 0, F.col("pi")), 0.5).alias("median_win"),
                 F.percentile(F.when(F.col("pi") < 0, F.col("pi")), 0.5).alias("median_loss"))


@query("agg_ranked_returns", rnd=["pi"], sql=_PIM + "SELECT row_number() OVER (ORDER BY pi, d) AS rnk, d, pi FROM pm")
def agg_ranked_returns(spark, sf):
    """Ranked return curve (one row per date: calendar-bounded ordering)."""
    from pyspark.sql import Window
    s = _pi_mkt(spark, sf)
    return s.select(F.row_number().over(Window.orderBy("pi", "d")).alias("rnk"), "d", "pi")


@query("win_rank_in_group", rnd=["ret"], sql=with_(PANEL_M, PANEL_R) + """
SELECT id, d, ret FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ret DESC NULLS LAST, d) AS r FROM panel_r) AS _x WHERE r = 1""")
def win_rank_in_group(spark, sf):
    """First row per group under an explicit order (best month per supplier)."""
    from pyspark.sql import Window
    r = B.panel_returns(spark, sf)
    w = Window.partitionBy("id").orderBy(F.col("ret").desc_nulls_last(), "d")
    return r.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("id", "d", "ret")


@query("eval_forecast_err", rnd=["mse", "rmse", "mae", "baseline_rmse"], sql=_PIM + f"""
, f AS (SELECT d, pi, avg(pi) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fc FROM pm),
g AS (SELECT * FROM f WHERE fc IS NOT NULL)
SELECT avg((pi - fc) * (pi - fc)) AS mse, sqrt(avg((pi - fc) * (pi - fc))) AS rmse, avg(abs(pi - fc)) AS mae,
       sqrt(avg(pi * pi)) AS baseline_rmse FROM g""")
def eval_forecast_err(spark, sf):
    """Expanding-mean forecast of the strategy return: MSE / RMSE / MAE and a
    zero-forecast baseline RMSE."""
    from pyspark.sql import Window
    s = _pi_mkt(spark, sf)
    s = s.withColumn("fc", F.avg("pi").over(Window.orderBy("d").rowsBetween(Window.unboundedPreceding, -1))) \
        .where(F.col("fc").isNotNull())
    e = F.col("pi") - F.col("fc")
    return s.agg(F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                 F.sqrt(F.avg(F.col("pi") * F.col("pi"))).alias("baseline_rmse"))
