"""Long-panel primitives: calendar, returns, lags, cross-sectional stats and
per-entity windows.

Layout rule: panels stay long ``(id, d, measures...)``; nothing is pivoted.
Cross-sectional (per-date) statistics are computed with ``groupBy(d)`` (partial
aggregation, skew-proof) and joined back -- never with a window partitioned by
date, which would put one whole cross-section in one task.  Per-entity windows
(partitioned by id) run on the (id, d) grain, so a partition holds at most one
row per calendar date however hot the entity is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions import clip, null_below, safe_ratio


# ---------------------------------------------------------------- calendar ---
def calendar(df: DataFrame, d: str = "d") -> DataFrame:
    """Dense calendar ``(d, date_idx)`` over the distinct dates of ``df``.

    The calendar has one row per distinct date, so the global ordering window
    runs on a table bounded by the date range, not by the data volume."""
    dates = df.select(d).where(F.col(d).isNotNull()).distinct()
    return dates.select(d, F.row_number().over(Window.orderBy(d)).alias("date_idx"))


def with_calendar(df: DataFrame, cal: DataFrame, d: str = "d") -> DataFrame:
    # The calendar side is tiny; AQE turns this into a broadcast join from
    # measured runtime size (no blind hint on a data-derived table).
    return df.join(cal, d)


def calendar_shift(df: DataFrame, k: int | str | Column, idx: str = "date_idx") -> DataFrame:
    """Move rows k calendar rows forward: value formed at idx is used at idx+k
    (S1: a missing cell stays missing, unlike a row lag)."""
    kk = F.lit(k) if isinstance(k, int) else (F.col(k) if isinstance(k, str) else k)
    return df.withColumn(idx, F.col(idx) + kk)


# ----------------------------------------------------------------- returns ---
def simple_returns(df: DataFrame, id_col: str = "id", d: str = "d", price: str = "price",
                   out: str = "ret", fill: str = "none") -> DataFrame:
    """price / previous observed price - 1 within each id (row lag).

    ``fill='ffill'`` carries the last non-null price forward first (old
    ``pct_change`` behaviour)."""
    w = Window.partitionBy(id_col).orderBy(d)
    p = F.col(price)
    if fill == "ffill":
        p = F.last(price, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        df = df.withColumn("_p", p)
        p = F.col("_p")
    r = safe_ratio(p, F.lag(p).over(w)) - F.lit(1.0)
    out_df = df.withColumn(out, r)
    return out_df.drop("_p") if fill == "ffill" else out_df


def log_returns(df: DataFrame, id_col: str = "id", d: str = "d", price: str = "price",
                out: str = "logret") -> DataFrame:
    w = Window.partitionBy(id_col).orderBy(d)
    return df.withColumn(out, F.log(F.col(price)) - F.log(F.lag(price).over(w)))


def diff(df: DataFrame, col: str, id_col: str, d: str, out: str, lag: int = 1) -> DataFrame:
    w = Window.partitionBy(id_col).orderBy(d)
    return df.withColumn(out, F.col(col) - F.lag(col, lag).over(w))


# ---------------------------------------------------------------- cleaning ---
def dedup_keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """drop_duplicates(keep='first') with an explicit total order (S14).

    Written as a ``min_by`` aggregate rather than a row_number window: the
    aggregate combines map-side, so a key duplicated across a third of the
    rows is reduced in every task before the shuffle instead of being sorted
    in one.  ``order`` columns are ascending names (a total order)."""
    if any(not isinstance(c, str) for c in order):
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    others = [c for c in df.columns if c not in keys]
    pick = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def clean_panel(df: DataFrame, keys=("d", "id"), order=None, ret: str = "ret",
                impossible: float = -1.0, bound: float = 0.5) -> DataFrame:
    """dedup keep-first -> ret < -1 to NULL -> winsorize to +-bound."""
    order = order or list(keys)
    out = dedup_keep_first(df, list(keys), order)
    return out.withColumn(ret, clip(null_below(ret, impossible), -bound, bound))


# ------------------------------------------------------- cross-sectional ---
def per_date(df: DataFrame, d: str, *aggs: Column) -> DataFrame:
    return df.groupBy(d).agg(*aggs)


def join_per_date(df: DataFrame, d: str, *aggs: Column) -> DataFrame:
    """Attach per-date aggregates to each row (groupBy + join, not a window)."""
    return df.join(per_date(df, d, *aggs), d)


def market_return(df: DataFrame, d: str = "d", ret: str = "ret", out: str = "mkt") -> DataFrame:
    """Equal-weight cross-sectional mean per date (NULLs skipped)."""
    return df.groupBy(d).agg(F.avg(ret).alias(out))


def long_short_normalize(df: DataFrame, d, raw: str, out: str = "w") -> DataFrame:
    """Scale so positive raws sum to 1 and negative raws sum to -1 per date
    (``d`` may be a list of keys, e.g. [power, d])."""
    keys = [d] if isinstance(d, str) else list(d)
    sums = df.groupBy(*keys).agg(
        F.sum(F.when(F.col(raw) > 0, F.col(raw))).alias("_lsum"),
        F.sum(F.when(F.col(raw) < 0, -F.col(raw))).alias("_ssum"))
    r = F.col(raw)
    w = (F.when(r > 0, r / F.col("_lsum"))
          .when(r < 0, r / F.col("_ssum"))
          .otherwise(r))
    return df.join(sums, keys).withColumn(out, w).drop("_lsum", "_ssum")


def excess_returns(df: DataFrame, d: str = "d", ret: str = "ret", out: str = "excess") -> DataFrame:
    mkt = market_return(df, d, ret)
    return df.join(mkt, d).withColumn(out, F.col(ret) - F.col("mkt"))


def contrarian_weights(df: DataFrame, d: str = "d", ret: str = "ret", power: float | None = None,
                       fill_zero: bool = False, out: str = "w", powers: list[float] | None = None) -> DataFrame:
    """w ~ -(r - mean r) (or -sign*|.|^power), longs sum to 1, |shorts| to 1.

    ``powers`` builds the whole power family at once (column ``p``)."""
    ex = excess_returns(df, d, ret)
    e = F.col("excess")
    if fill_zero or powers is not None:
        e = F.coalesce(e, F.lit(0.0))
    keys = [d]
    if powers is not None:
        ex = expand(ex, "p", [float(x) for x in powers])
        raw = -F.signum(e) * F.pow(F.abs(e), F.col("p"))
        keys = ["p", d]
    elif power is None:
        raw = -e
    else:
        raw = -F.signum(e) * F.pow(F.abs(e), F.lit(power))
    return long_short_normalize(ex.withColumn("_raw", raw), keys, "_raw", out).drop("_raw")


def expand(df: DataFrame, name: str, values: list) -> DataFrame:
    """Repeat every row once per parameter value (fixed literal list; no join)."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def portfolio_return(weights: DataFrame, rets: DataFrame, cal: DataFrame, k: int | str = 1,
                     id_col: str = "id", w: str = "w", ret: str = "ret",
                     grid: dict[str, list] | None = None) -> DataFrame:
    """pi(t) = sum_i w_i(t-k) r_i(t) on the calendar (S1); dates without any
    product give 0 (S3).  ``grid`` names parameter columns carried by
    ``weights`` (k, power, ...) so a whole strategy family is one plan;
    ``k`` may be such a column."""
    grid = grid or {}
    group = list(grid)
    kk = F.col(k) if isinstance(k, str) else F.lit(k)
    ws = weights.select(id_col, *group, (F.col("date_idx") + kk).alias("date_idx"), w)
    rs = rets.select(id_col, "date_idx", ret)
    prod = (ws.join(rs, [id_col, "date_idx"])
              .groupBy(*group, "date_idx").agg(F.sum(F.col(w) * F.col(ret)).alias("pi")))
    base = cal
    for name, values in grid.items():
        base = expand(base, name, values)
    return (base.join(prod, [*group, "date_idx"], "left")
                .withColumn("pi", F.coalesce("pi", F.lit(0.0))))


# ------------------------------------------------------------- statistics ---
def annualized(df: DataFrame, ret: str, periods: int = 252, by: list[str] | None = None) -> DataFrame:
    """mean*P, sd*sqrt(P) (ddof=1), Sharpe guarded against zero vol."""
    by = by or []
    mu = F.avg(ret) * F.lit(float(periods))
    vol = F.stddev_samp(ret) * F.lit(float(periods) ** 0.5)
    g = df.groupBy(*by) if by else df.groupBy()
    return (g.agg(mu.alias("ann_mean"), vol.alias("ann_vol"), F.count(ret).alias("n"))
             .withColumn("sharpe", F.when(F.col("ann_vol") > 0, F.col("ann_mean") / F.col("ann_vol"))))


# ------------------------------------------------------ per-entity windows ---
def _w(id_col: str, d: str) -> Window:
    return Window.partitionBy(id_col).orderBy(d)


def guarded(agg: Column, x: str, w: Window, n: int) -> Column:
    """min_periods = window length: NULL unless n non-null values (S6).
    ``agg`` is a bare aggregate; it is evaluated over ``w``."""
    return F.when(F.count(x).over(w) == n, agg.over(w))


def compound_over(x: str, w: Window, n: int) -> Column:
    """prod(1 + x) - 1 over the frame, guarded by a full count."""
    return guarded(F.product(F.lit(1.0) + F.col(x)), x, w, n) - F.lit(1.0)


def trailing_compound(id_col: str, d: str, x: str, n: int, skip: int = 0) -> Column:
    w = _w(id_col, d).rowsBetween(-(n - 1) - skip, -skip)
    return compound_over(x, w, n)


def forward_compound(id_col: str, d: str, x: str, h: int) -> Column:
    w = _w(id_col, d).rowsBetween(1, h)
    return compound_over(x, w, h)


def rolling_std(id_col: str, d: str, x: str, n: int, skip: int = 0) -> Column:
    w = _w(id_col, d).rowsBetween(-(n - 1) - skip, -skip)
    return guarded(F.stddev_samp(x), x, w, n)


def rolling_mean(id_col: str, d: str, x: str, n: int) -> Column:
    w = _w(id_col, d).rowsBetween(-(n - 1), 0)
    return guarded(F.avg(x), x, w, n)


def momentum_signals(df: DataFrame, id_col: str = "id", d: str = "d", ret: str = "ret") -> DataFrame:
    """Trailing / skip / lag / vol / Sharpe and forward signals per entity,
    all in one window stage (one shuffle by id)."""
    return df.select(
        "*",
        trailing_compound(id_col, d, ret, 12).alias("ret_t12"),
        trailing_compound(id_col, d, ret, 11, skip=1).alias("ret_t12m1"),
        F.lag(ret, 12).over(_w(id_col, d)).alias("ret_t12_1m"),
        rolling_std(id_col, d, ret, 11, skip=1).alias("vol_t12m1"),
        F.lead(ret, 1).over(_w(id_col, d)).alias("ret_f1m"),
        forward_compound(id_col, d, ret, 3).alias("ret_f3m"),
        forward_compound(id_col, d, ret, 6).alias("ret_f6m"),
    ).withColumn("sr_t12m1", safe_ratio("ret_t12m1", "vol_t12m1"))


def price_stream_signals(df: DataFrame, id_col: str = "id", d: str = "d", ret: str = "retx") -> DataFrame:
    """The trailing signals of the second return stream, beside those of ``momentum_signals``."""
    return df.select(
        "*",
        trailing_compound(id_col, d, ret, 12).alias("retx_t12"),
        trailing_compound(id_col, d, ret, 11, skip=1).alias("retx_t12m1"),
        F.lag(ret, 12).over(_w(id_col, d)).alias("retx_t12_1m"),
        rolling_std(id_col, d, ret, 11, skip=1).alias("volx_t12m1"),
    ).withColumn("srx_t12m1", safe_ratio("retx_t12m1", "volx_t12m1"))


def drawdown(df: DataFrame, order: str, r: str, by: list[str] | None = None) -> DataFrame:
    """Cumulative growth prod(1+r), running peak and drawdown (S10)."""
    by = by or []
    w = (Window.partitionBy(*by) if by else Window).orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("cum", F.product(F.lit(1.0) + F.col(r)).over(w))
              .withColumn("peak", F.max("cum").over(w))
              .withColumn("dd", (F.col("cum") - F.col("peak")) / F.col("peak")))


def turnover(weights: DataFrame, id_col: str = "id", w: str = "w", missing: str = "zero",
             group: list[str] | None = None) -> DataFrame:
    """Per date 0.5 * sum_i |w_i(t) - w_i(t-1)| over calendar rows.

    missing='zero': absent/NULL weight counts as 0 (entries/exits trade);
    missing='skip': only names with a weight on both dates."""
    group = group or []
    cur = weights.select(*group, id_col, "date_idx", F.col(w).alias("w_now"))
    prev = weights.select(*group, id_col, (F.col("date_idx") + 1).alias("date_idx"), F.col(w).alias("w_prev"))
    how = "full" if missing == "zero" else "inner"
    j = cur.join(prev, [*group, id_col, "date_idx"], how)
    if missing == "zero":
        dw = F.abs(F.coalesce("w_now", F.lit(0.0)) - F.coalesce("w_prev", F.lit(0.0)))
    else:
        dw = F.abs(F.col("w_now") - F.col("w_prev"))
    return j.groupBy(*group, "date_idx").agg((0.5 * F.sum(dw)).alias("turnover"),
                                             F.sum(dw).alias("two_way"))


def ffill_bfill(x: str, by: list[str], order: str) -> Column:
    """Forward fill, then backward fill what is still missing at the start."""
    fw = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    bw = Window.partitionBy(*by).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return F.coalesce(F.last(x, ignorenulls=True).over(fw), F.first(x, ignorenulls=True).over(bw))
