"""Data-quality audits and missing-value forensics on long panels.

Every audit is a single aggregation (partial aggregation on the map side) or a
per-entity window on the (id, d) grain; no audit collects rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions import scalar


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of keys seen more than once and surplus rows."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return g.agg(F.count(F.lit(1)).alias("n_dup_keys"),
                 F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint").alias("n_surplus_rows"))


def coverage(df: DataFrame, d: str, id_col: str, jump: int) -> DataFrame:
    """Entities per date: min/max/mean and number of days whose count jumps by
    more than ``jump`` versus the previous date.  The per-date series is one row
    per date, so its ordering window is calendar-bounded."""
    per = df.groupBy(d).agg(F.countDistinct(id_col).alias("n"))
    w = Window.orderBy(d)
    per = per.withColumn("dn", F.abs(F.col("n") - F.lag("n").over(w)))
    return per.agg(F.count(F.lit(1)).alias("n_dates"), F.min("n").alias("min_n"), F.max("n").alias("max_n"),
                   F.avg("n").alias("mean_n"), F.count(F.when(F.col("dn") > jump, 1)).alias("n_jump_days"))


def bounds(df: DataFrame, x: str, impossible: float = -1.0, extreme: float = 0.5) -> DataFrame:
    return df.agg(F.count(F.when(F.col(x) < impossible, 1)).alias("n_impossible"),
                  F.count(F.when(F.abs(F.col(x)) > extreme, 1)).alias("n_extreme"),
                  F.count(x).alias("n"))


def stale_zero(df: DataFrame, id_col: str, x: str, share: float = 0.5) -> DataFrame:
    g = df.groupBy(id_col).agg(F.avg(F.when(F.col(x) == 0, 1.0).otherwise(0.0)).alias("zero_share"))
    return g.withColumn("stale", F.col("zero_share") > share)


def identical_day(df: DataFrame, d: str, x: str, share: float = 0.3, min_names: int = 10) -> DataFrame:
    """Per date: share of names carrying the modal value (two-level groupBy)."""
    per_val = df.where(F.col(x).isNotNull()).groupBy(d, x).agg(F.count(F.lit(1)).alias("c"))
    per = per_val.groupBy(d).agg(F.max("c").alias("modal"), F.sum("c").alias("n"))
    per = per.withColumn("modal_share", F.col("modal") / F.col("n"))
    return per.withColumn("flag", (F.col("modal_share") > share) & (F.col("n") > min_names))


def null_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in cols],
                  F.count(F.lit(1)).alias("n_rows"))


def empty_cells(df: DataFrame, d: str, id_col: str, x: str) -> DataFrame:
    """One row: cells of the dates x ids grid of ``df`` without a known ``x`` (empty_<x>_cells) and
    the most on one date (max_empty_<x>_per_date).  Nothing of the grid is spelt out."""
    cells = df.groupBy(d, id_col).agg(F.count(x).alias("_k"))
    filled = cells.groupBy(d).agg(F.count(F.when(F.col("_k") > 0, 1)).alias("_f"))
    empty = filled.withColumn("_e", scalar(cells.agg(F.countDistinct(id_col).alias("n"))) - F.col("_f"))
    return empty.agg(F.sum("_e").alias(f"empty_{x}_cells"), F.max("_e").alias(f"max_empty_{x}_per_date"))


def dispersion(df: DataFrame, d: str, x: str, q: float = 0.99) -> DataFrame:
    """Cross-sectional sd per date and the dates above its q-quantile."""
    per = df.groupBy(d).agg(F.stddev_samp(x).alias("xs_sd"))
    # the per-date table has one row per date: a global window is calendar-bounded
    per = per.withColumn("thr", F.percentile("xs_sd", q).over(Window.partitionBy()))
    return per.where(F.col("xs_sd") > F.col("thr")).select(d, "xs_sd", "thr")


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """describe() with exact linear-interpolated percentiles, long form.  All
    columns are stacked once (unpivot) so moments are one grouped aggregation
    and the quartiles one distributed exact-percentile pass."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "v")
    mom = long.groupBy("column").agg(F.count("v").alias("count"), F.avg("v").alias("mean"),
                                     F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    pct = exact_percentiles(long, ["column"], "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return mom.join(pct, "column").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, x: str, lo: float, hi: float, n: int) -> DataFrame:
    b = F.when(F.col(x) < lo, 0).when(F.col(x) >= hi, n + 1) \
         .otherwise(F.floor((F.col(x) - lo) / (hi - lo) * n).cast("int") + 1)
    return df.where(F.col(x).isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def na_gap_label(df: DataFrame, id_col: str, d: str, price: str) -> DataFrame:
    """Label each missing price: TERMINAL (last row of the id), MID-SERIES GAP
    (a valid price follows), TRAILING NA (nothing valid after)."""
    wid = Window.partitionBy(id_col)
    after = Window.partitionBy(id_col).orderBy(d).rowsBetween(0, Window.unboundedFollowing)
    x = df.select(id_col, d, price, F.max(d).over(wid).alias("_last"), F.count(price).over(after).alias("_after"))
    lab = (F.when(F.col(d) == F.col("_last"), "TERMINAL")
            .when(F.col("_after") > 0, "MID-SERIES GAP").otherwise("TRAILING NA"))
    return x.where(F.col(price).isNull()).select(id_col, d, lab.alias("label"))


def na_reason_label(df: DataFrame, id_col: str, d: str, price: str, ret: str) -> DataFrame:
    """Reason for each missing return from the price at t and t-1."""
    wid = Window.partitionBy(id_col)
    wo = Window.partitionBy(id_col).orderBy(d)
    x = df.select(id_col, d, price, ret, F.min(d).over(wid).alias("_first"), F.max(d).over(wid).alias("_last"),
                  F.lag(price).over(wo).alias("_prev"))
    now, before = F.col(price).isNotNull(), F.col("_prev").isNotNull()
    lab = (F.when(F.col(d) == F.col("_first"), "FIRST OBSERVATION")
            .when(~now & ~before, "BOTH PRICES MISSING")
            .when(~now, "PRICE MISSING AT t")
            .when(~before, "PRICE MISSING AT t-1")
            .when(F.col(d) == F.col("_last"), "LAST OBSERVATION")
            .otherwise("UNKNOWN"))
    return x.where(F.col(ret).isNull()).select(id_col, d, lab.alias("reason"))


def isclose(a: Column, b: Column, atol: float, rtol: float = 1e-5) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def return_mismatch_audit(df: DataFrame, id_col: str, total: str, price_ret: str,
                          atol: float = 1e-6, tol_geq: float = 1e-8) -> DataFrame:
    m = df.where(F.col(total).isNotNull() & F.col(price_ret).isNotNull())
    eq = isclose(F.col(total), F.col(price_ret), atol)
    geq = F.col(total) >= F.col(price_ret) - tol_geq
    per = m.groupBy(id_col).agg(F.bool_and(eq).alias("all_eq"), F.bool_and(geq).alias("all_geq"),
                                F.count(F.when(geq, 1)).alias("n_geq"), F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.when(F.col("all_eq"), 1)).alias("n_ids_always_equal"), F.count(F.lit(1)).alias("n_ids"),
                   F.sum("n_geq").alias("n_geq"), F.sum("n").alias("n_total"),
                   F.count(F.when(F.col("all_geq"), 1)).alias("n_ids_always_geq"))


def validate_upload(df: DataFrame, keys: list[str], w: str) -> DataFrame:
    """zeros / NaN / Inf / duplicate keys -> PASS or FAIL, one aggregation."""
    isnan = F.isnan(F.col(w)) | F.col(w).isNull()
    isinf = F.col(w).isin(float("inf"), float("-inf"))
    out = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col(w) == 0, 1)).alias("zeros"),
                 F.count(F.when(isnan, 1)).alias("nans"), F.count(F.when(isinf, 1)).alias("infs"),
                 (F.count(F.lit(1)) - F.count_distinct(*keys)).alias("dups"))
    bad = F.col("zeros") + F.col("nans") + F.col("infs") + F.col("dups")
    return out.withColumn("status", F.when(bad == 0, "PASS").otherwise("FAIL"))


def percentile_set(x: str, qs=(0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0),
                   names=("min", "p5", "p25", "median", "p75", "p95", "max")) -> list[Column]:
    return [F.percentile(x, q).alias(n) for q, n in zip(qs, names)]


def exact_percentiles(df: DataFrame, by: list[str], x: str, qs, names) -> DataFrame:
    """Exact linear-interpolated percentiles (the ``percentile`` /
    ``quantile_cont`` definition, position (n-1) q) without buffering a group
    in one task.

    Values are range-partitioned on (by, x); each row's 1-based position in its
    group comes from local row numbers plus per-partition offsets (see
    ``running_totals``); only the rows at the two positions bracketing each
    requested quantile are kept and interpolated.  A group holding a third of
    the data is spread over many range partitions."""
    from kestrel.operators.evaluate import running_totals
    v = df.where(F.col(x).isNotNull()).select(*by, x).withColumn("_one", F.lit(1))
    pos = running_totals(v, by, x, ["_one"], descending=False).withColumnRenamed("cum__one", "_pos")
    n = v.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))      # one row per group
    want = n.select(*by, "_n", F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), F.lit(nm).alias("_qname"))
                                                   for q, nm in zip(qs, names)])).alias("_w"))
    h = (F.col("_n") - 1) * F.col("_w.q")
    want = want.select(*by, F.col("_w._qname").alias("_qname"), h.alias("_h"),
                       (F.floor(h) + 1).cast("long").alias("_lo"), (F.ceil(h) + 1).cast("long").alias("_hi"))
    need = want.select(*by, F.col("_lo").alias("_pos")).union(want.select(*by, F.col("_hi").alias("_pos"))).distinct()
    at = pos.join(need, [*by, "_pos"]).select(*by, "_pos", F.col(x).alias("_v"))
    lo = at.select(*by, F.col("_pos").alias("_lo"), F.col("_v").alias("_vlo"))
    hi = at.select(*by, F.col("_pos").alias("_hi"), F.col("_v").alias("_vhi"))
    j = want.join(lo, [*by, "_lo"]).join(hi, [*by, "_hi"])
    # same weighting as the SQL percentile: (hi_pos - h) * v_lo + (h - lo_pos) * v_hi
    lo_pos, hi_pos = (F.col("_lo") - 1).cast("double"), (F.col("_hi") - 1).cast("double")
    val = F.when(F.col("_lo") == F.col("_hi"), F.col("_vlo")).otherwise(
        (hi_pos - F.col("_h")) * F.col("_vlo") + (F.col("_h") - lo_pos) * F.col("_vhi"))
    out = j.select(*by, "_qname", val.alias("_val"))
    g = out.groupBy(*by) if by else out.groupBy()
    return g.pivot("_qname", list(names)).agg(F.first("_val"))
