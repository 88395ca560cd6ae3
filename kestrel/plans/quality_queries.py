"""Data quality and missing-value queries (survey 2.3) plus the scalar
projection operators of 2.2 that act on the daily raw panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel import functions as K
from kestrel.operators import panel as P
from kestrel.operators import quality as Q
from kestrel.plans.registry import query
from kestrel.plans.sqlbind import PANEL_D, PANEL_M, PANEL_Q, PANEL_R, with_
from kestrel.sources import bindings as B
from kestrel.sources.tables import load

_D = with_(PANEL_D)
# The percentile set reported per date (quantile, column name).
PCT = ([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0], ["min", "p5", "p25", "median", "p75", "p95", "max"])
_QP = with_(PANEL_M, PANEL_Q)
_ORDER = ["okey", "lnum", "ret"]  # total tie order for keep-first


@query("dq_duplicate_keys", sql=_D + """
, g AS (SELECT d, id, count(*) AS c FROM panel_d GROUP BY d, id HAVING count(*) > 1)
SELECT count(*) AS n_dup_keys, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_surplus_rows FROM g""")
def dq_duplicate_keys(spark, sf):
    return Q.duplicate_keys(B.panel_daily_raw(spark, sf), ["d", "id"])


@query("dq_duplicate_lineitem_keys", sql="""
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT count(*) AS n_dup_keys, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_surplus_rows FROM g""")
def dq_duplicate_lineitem_keys(spark, sf):
    return Q.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_coverage", rnd=["mean_n"], sql=_D + """
, per AS (SELECT d, count(DISTINCT id) AS n FROM panel_d GROUP BY d),
j AS (SELECT n, abs(n - lag(n) OVER (ORDER BY d)) AS dn FROM per)
SELECT count(*) AS n_dates, min(n) AS min_n, max(n) AS max_n, avg(n) AS mean_n,
       count(CASE WHEN dn > 10 THEN 1 END) AS n_jump_days FROM j""")
def dq_coverage(spark, sf):
    return Q.coverage(B.panel_daily_raw(spark, sf), "d", "id", jump=10)


@query("dq_bounds", sql=_D + """
SELECT count(CASE WHEN ret < -1 THEN 1 END) AS n_impossible, count(CASE WHEN abs(ret) > 0.5 THEN 1 END) AS n_extreme,
       count(ret) AS n FROM panel_d""")
def dq_bounds(spark, sf):
    return Q.bounds(B.panel_daily_raw(spark, sf), "ret")


@query("dq_stale_zero", rnd=["zero_share"], sql=_D + """
SELECT id, avg(CASE WHEN ret = 0 THEN 1.0 ELSE 0.0 END) AS zero_share,
       avg(CASE WHEN ret = 0 THEN 1.0 ELSE 0.0 END) > 0.5 AS stale FROM panel_d GROUP BY id""")
def dq_stale_zero(spark, sf):
    return Q.stale_zero(B.panel_daily_raw(spark, sf), "id", "ret")


@query("dq_identical_day", rnd=["modal_share"], sql=_D + """
, pv AS (SELECT d, ret, count(*) AS c FROM panel_d WHERE ret IS NOT NULL GROUP BY d, ret),
per AS (SELECT d, max(c) AS modal, sum(c) AS n FROM pv GROUP BY d)
SELECT d, modal, CAST(n AS BIGINT) AS n, modal / n AS modal_share, (modal / n > 0.3 AND n > 10) AS flag FROM per""")
def dq_identical_day(spark, sf):
    return Q.identical_day(B.panel_daily_raw(spark, sf), "d", "ret")


@query("dq_null_summary", sql=_D + """
, per AS (SELECT d, count(CASE WHEN price IS NULL THEN 1 END) AS np FROM panel_d GROUP BY d)
SELECT (SELECT count(CASE WHEN price IS NULL THEN 1 END) FROM panel_d) AS null_price,
       (SELECT count(CASE WHEN ret IS NULL THEN 1 END) FROM panel_d) AS null_ret,
       (SELECT count(*) FROM panel_d) AS n_rows,
       max(np) AS max_null_price_per_date,
       (SELECT count(DISTINCT d) * count(DISTINCT id) - count(DISTINCT CASE WHEN ret IS NOT NULL THEN (d, id) END) FROM panel_d) AS empty_ret_cells,
       (SELECT (SELECT count(DISTINCT id) FROM panel_d) - min(c) FROM (SELECT d, count(DISTINCT CASE WHEN ret IS NOT NULL THEN id END) AS c
        FROM panel_d GROUP BY d) AS _h) AS max_empty_ret_per_date FROM per""")
def dq_null_summary(spark, sf):
    """Nulls by column, and cells of the calendar x id grid without a return (no row, or
    null returns only): in all and on the worst date."""
    p = B.panel_daily_raw(spark, sf)
    per = p.groupBy("d").agg(F.count(F.when(F.col("price").isNull(), 1)).alias("np"),
                             F.count(F.when(F.col("ret").isNull(), 1)).alias("nr"),
                             F.count(F.lit(1)).alias("c"))
    nulls = per.agg(F.sum("np").alias("null_price"), F.sum("nr").alias("null_ret"),
                    F.sum("c").alias("n_rows"), F.max("np").alias("max_null_price_per_date"))
    return K.attach_scalars(nulls, Q.empty_cells(p, "d", "id", "ret"))


@query("dq_volume_consistency", sql=_D + """
SELECT count(*) AS n_bad FROM panel_d WHERE (volume = 0 OR volume IS NULL) AND ret <> 0""")
def dq_volume_consistency(spark, sf):
    p = B.panel_daily_raw(spark, sf)
    return p.where(((F.col("volume") == 0) | F.col("volume").isNull()) & (F.col("ret") != 0)) \
        .agg(F.count(F.lit(1)).alias("n_bad"))


@query("dq_price_validity", sql=_D + """
SELECT count(*) AS n_bad, count(CASE WHEN price IS NULL THEN 1 END) AS n_null FROM panel_d
WHERE price <= 0 OR price IS NULL""")
def dq_price_validity(spark, sf):
    p = B.panel_daily_raw(spark, sf).where((F.col("price") <= 0) | F.col("price").isNull())
    return p.agg(F.count(F.lit(1)).alias("n_bad"), F.count(F.when(F.col("price").isNull(), 1)).alias("n_null"))


@query("dq_dispersion", rnd=["xs_sd", "thr"], sql=_D + """
, per AS (SELECT d, stddev_samp(ret) AS xs_sd FROM panel_d GROUP BY d),
t AS (SELECT d, xs_sd, quantile_cont(xs_sd, 0.99) OVER () AS thr FROM per)
SELECT d, xs_sd, thr FROM t WHERE xs_sd > thr""")
def dq_dispersion(spark, sf):
    return Q.dispersion(B.panel_daily_raw(spark, sf), "d", "ret", 0.99)


_PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
    CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
    quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM panel_d""" for c in ("ret", "price", "volume"))


@query("dq_profile", rnd=["mean", "std", "min", "p25", "p50", "p75", "max"], dp=5, sql=_D + _PROFILE_SQL)
def dq_profile(spark, sf):
    return Q.profile(B.panel_daily_raw(spark, sf), ["ret", "price", "volume"])


@query("dq_histogram", sql=_D + """
SELECT CASE WHEN ret < -1.53 THEN 0 WHEN ret >= 1.47 THEN 21
            ELSE CAST(floor((ret - -1.53) / (1.47 - -1.53) * 20) AS INTEGER) + 1 END AS bucket,
       count(*) AS n FROM panel_d WHERE ret IS NOT NULL GROUP BY 1""")
def dq_histogram(spark, sf):
    return Q.histogram(B.panel_daily_raw(spark, sf), "ret", -1.53, 1.47, 20)


_CLEAN = _D + """
, ranked AS (SELECT *, row_number() OVER (PARTITION BY d, id ORDER BY okey, lnum, ret) AS rn FROM panel_d),
clean AS (SELECT d, id, CASE WHEN ret >= -1 THEN greatest(least(ret, 0.5), -0.5) END AS ret,
                 price, volume FROM ranked WHERE rn = 1)
"""


def clean_daily(spark, sf):
    return P.clean_panel(B.panel_daily_raw(spark, sf), keys=("d", "id"), order=_ORDER)


@query("clean_panel", rnd=["ret"], sql=_CLEAN + "SELECT d, id, ret FROM clean")
def clean_panel(spark, sf):
    """Dedup keep-first (total order) -> ret < -1 to NULL -> clip +-0.5."""
    return clean_daily(spark, sf).select("d", "id", "ret")


@query("clip_winsorize", rnd=["ret_w"], sql=_D + """
SELECT d, id, okey, lnum, CASE WHEN ret IS NOT NULL THEN greatest(least(ret, 0.5), -0.5) END AS ret_w FROM panel_d""")
def clip_winsorize(spark, sf):
    p = B.panel_daily_raw(spark, sf)
    return p.select("d", "id", "okey", "lnum", K.clip("ret", -0.5, 0.5).alias("ret_w"))


@query("null_impossible", rnd=["ret_n"], sql=_D + """
SELECT d, id, okey, lnum, CASE WHEN ret >= -1 THEN ret END AS ret_n FROM panel_d""")
def null_impossible(spark, sf):
    p = B.panel_daily_raw(spark, sf)
    return p.select("d", "id", "okey", "lnum", K.null_below("ret", -1.0).alias("ret_n"))


@query("safe_ratio", rnd=["turn"], sql=_D + """
SELECT d, id, okey, lnum, price / nullif(volume, 0) AS turn FROM panel_d""")
def safe_ratio(spark, sf):
    p = B.panel_daily_raw(spark, sf)
    return p.select("d", "id", "okey", "lnum", K.safe_ratio("price", "volume").alias("turn"))


@query("signed_power", rnd=["sp"], sql=_D + """
SELECT d, id, okey, lnum, -sign(ret) * pow(abs(ret), 0.5) AS sp FROM panel_d""")
def signed_power(spark, sf):
    p = B.panel_daily_raw(spark, sf)
    return p.select("d", "id", "okey", "lnum", K.signed_power("ret", 0.5).alias("sp"))


# ------------------------------------------------- missing-value forensics ---
@query("na_gap_label", sql=_QP + """
, x AS (SELECT id, d, price, max(d) OVER (PARTITION BY id) AS last_d,
               count(price) OVER (PARTITION BY id ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
        FROM panel_q)
SELECT id, d, CASE WHEN d = last_d THEN 'TERMINAL' WHEN after > 0 THEN 'MID-SERIES GAP' ELSE 'TRAILING NA' END AS label
FROM x WHERE price IS NULL""")
def na_gap_label(spark, sf):
    return Q.na_gap_label(B.panel_quality(spark, sf), "id", "d", "price")


@query("na_reason_label", sql=_QP + """
, x AS (SELECT id, d, price, prc, min(d) OVER (PARTITION BY id) AS first_d, max(d) OVER (PARTITION BY id) AS last_d,
               lag(price) OVER (PARTITION BY id ORDER BY d) AS prev FROM panel_q)
SELECT id, d, CASE WHEN d = first_d THEN 'FIRST OBSERVATION'
                   WHEN price IS NULL AND prev IS NULL THEN 'BOTH PRICES MISSING'
                   WHEN price IS NULL THEN 'PRICE MISSING AT t'
                   WHEN prev IS NULL THEN 'PRICE MISSING AT t-1'
                   WHEN d = last_d THEN 'LAST OBSERVATION' ELSE 'UNKNOWN' END AS reason
FROM x WHERE prc IS NULL""")
def na_reason_label(spark, sf):
    return Q.na_reason_label(B.panel_quality(spark, sf), "id", "d", "price", "prc")


@query("return_mismatch_audit", sql=_QP + """
, pq AS (SELECT id, d, prc, price / lag(price) OVER (PARTITION BY id ORDER BY d) - 1 AS pret
         FROM (SELECT * FROM panel_q WHERE price IS NOT NULL) AS _p),
m AS (SELECT * FROM pq WHERE prc IS NOT NULL AND pret IS NOT NULL),
per AS (SELECT id, bool_and(abs(prc - pret) <= 1e-6 + 1e-5 * abs(pret)) AS all_eq,
               bool_and(prc >= pret - 1e-8) AS all_geq, count(CASE WHEN prc >= pret - 1e-8 THEN 1 END) AS n_geq,
               count(*) AS n FROM m GROUP BY id)
SELECT count(CASE WHEN all_eq THEN 1 END) AS n_ids_always_equal, count(*) AS n_ids,
       CAST(sum(n_geq) AS BIGINT) AS n_geq, CAST(sum(n) AS BIGINT) AS n_total,
       count(CASE WHEN all_geq THEN 1 END) AS n_ids_always_geq FROM per""")
def return_mismatch_audit(spark, sf):
    """Total return vs price return after dropping missing prices."""
    q = B.panel_quality(spark, sf).where(F.col("price").isNotNull())
    q = P.simple_returns(q, "id", "d", "price", out="pret")
    return Q.return_mismatch_audit(q, "id", "prc", "pret")


_QD = _QP + """
, qd AS (SELECT * FROM panel_q WHERE price IS NOT NULL)
"""


@query("membership_counts", sql=_QD + """
, per AS (SELECT d, count(*) AS n FROM qd GROUP BY d),
r AS (SELECT d, n, row_number() OVER (ORDER BY n, d) AS r_small, row_number() OVER (ORDER BY n DESC, d) AS r_large FROM per)
SELECT d, n, 'smallest' AS side, r_small AS rnk FROM r WHERE r_small <= 5
UNION ALL SELECT d, n, 'largest', r_large FROM r WHERE r_large <= 5""")
def membership_counts(spark, sf):
    """Entities per date; the 5 smallest and 5 largest dates (ties by date)."""
    per = B.panel_quality(spark, sf).where(F.col("price").isNotNull()).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    small = per.withColumn("rnk", F.row_number().over(Window.orderBy("n", "d"))).where("rnk <= 5")
    large = per.withColumn("rnk", F.row_number().over(Window.orderBy(F.col("n").desc(), "d"))).where("rnk <= 5")
    return (small.select("d", "n", F.lit("smallest").alias("side"), "rnk")
            .unionByName(large.select("d", "n", F.lit("largest").alias("side"), "rnk")))


@query("survivors", sql=_QD + """
SELECT id FROM qd GROUP BY id HAVING count(DISTINCT d) = (SELECT count(DISTINCT d) FROM qd)""")
def survivors(spark, sf):
    q = B.panel_quality(spark, sf).where(F.col("price").isNotNull())
    n = q.agg(F.countDistinct("d").alias("n_dates"))
    per = q.groupBy("id").agg(F.countDistinct("d").alias("c"))
    from kestrel.functions import scalar
    return per.where(F.col("c") == scalar(n)).select("id")


_EE = _QD + """
, qcal AS (SELECT d, row_number() OVER (ORDER BY d) AS di FROM (SELECT DISTINCT d FROM qd) AS _d),
qi AS (SELECT qd.*, qcal.di FROM qd JOIN qcal USING (d)),
mx AS (SELECT max(di) AS m FROM qcal),
ev AS (SELECT 'exit' AS event, a.mcap FROM qi a LEFT JOIN qi b ON b.id = a.id AND b.di = a.di + 1
       WHERE b.id IS NULL AND a.di < (SELECT m FROM mx)
       UNION ALL
       SELECT 'entry', a.mcap FROM qi a LEFT JOIN qi b ON b.id = a.id AND b.di = a.di - 1
       WHERE b.id IS NULL AND a.di > 1)
"""


@query("entry_exit_events", rnd=["mean", "std", "min", "p5", "p25", "median", "p75", "p95", "max"], sql=_EE + """
SELECT event, count(mcap) AS count, avg(mcap) AS mean, stddev_samp(mcap) AS std,
       quantile_cont(mcap, 0.0) AS min, quantile_cont(mcap, 0.05) AS p5, quantile_cont(mcap, 0.25) AS p25,
       quantile_cont(mcap, 0.5) AS median, quantile_cont(mcap, 0.75) AS p75, quantile_cont(mcap, 0.95) AS p95,
       quantile_cont(mcap, 1.0) AS max FROM ev GROUP BY event""")
def entry_exit_events(spark, sf):
    """Exits: present at t, absent at t+1 (value at t); entries: absent at t-1,
    present at t (value at t); panel ends excluded; anti-joins on the calendar."""
    q = B.panel_quality(spark, sf).where(F.col("price").isNotNull())
    cal = P.calendar(q).withColumnRenamed("date_idx", "di")
    cal = cal.withColumn("m", F.max("di").over(Window.partitionBy()))  # calendar-bounded
    qi = q.join(cal, "d")
    nxt = qi.select("id", (F.col("di") - 1).alias("di"))
    prv = qi.select("id", (F.col("di") + 1).alias("di"))
    exits = (qi.join(nxt, ["id", "di"], "left_anti").where(F.col("di") < F.col("m"))
               .select(F.lit("exit").alias("event"), "mcap"))
    entries = qi.join(prv, ["id", "di"], "left_anti").where(F.col("di") > 1).select(F.lit("entry").alias("event"), "mcap")
    ev = exits.unionByName(entries)
    mom = ev.groupBy("event").agg(F.count("mcap").alias("count"), F.avg("mcap").alias("mean"),
                                  F.stddev_samp("mcap").alias("std"))
    return mom.join(Q.exact_percentiles(ev, ["event"], "mcap", *PCT), "event")


@query("agg_pctile_set", rnd=["min", "p5", "p25", "median", "p75", "p95", "max"], sql=_QD + """
SELECT d, quantile_cont(mcap, 0.0) AS min, quantile_cont(mcap, 0.05) AS p5, quantile_cont(mcap, 0.25) AS p25,
       quantile_cont(mcap, 0.5) AS median, quantile_cont(mcap, 0.75) AS p75, quantile_cont(mcap, 0.95) AS p95,
       quantile_cont(mcap, 1.0) AS max FROM qd GROUP BY d""")
def agg_pctile_set(spark, sf):
    q = B.panel_quality(spark, sf).where(F.col("price").isNotNull())
    return Q.exact_percentiles(q, ["d"], "mcap", *PCT)


@query("corpus_validate", sql="""
SELECT 'labels_without_document' AS "check", count(*) AS n FROM labels l
  WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
UNION ALL SELECT 'documents_without_labels', count(*) FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL SELECT 'duplicate_document_ids', count(*) - count(DISTINCT doc_id) FROM documents
UNION ALL SELECT 'blank_texts', count(*) FROM documents WHERE text IS NULL OR trim(text) = ''""")
def corpus_validate_ids(spark, sf):
    """Input validation of a labelled corpus as one audit table (anti-joins)."""
    from kestrel.operators.corpus import validate_corpus
    return validate_corpus(load(spark, sf, "documents"), load(spark, sf, "labels"))


@query("id_coverage_diff", sql="""
SELECT count(*) AS n_missing FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def id_coverage_diff(spark, sf):
    d = load(spark, sf, "documents").select("doc_id")
    return d.join(load(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti").agg(
        F.count(F.lit(1)).alias("n_missing"))
