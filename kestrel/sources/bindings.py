"""Canonical research inputs derived (by Spark, lazily) from the driver's tables.

The reference reads security panels, factor files, instrument series, a wage
survey and a labelled news corpus.  None of those ship, so every canonical input
is a deterministic projection/aggregation of the TPC-H-style tables; the same
definitions are written in SQL in ``kestrel.plans.sqlbind`` for the DuckDB oracle.
All of them grow with the underlying tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.sources.tables import load


def month_of(c) -> F.Column:
    return F.trunc(F.to_date(c), "month")


def panel_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, d, price, vol): supplier x month panel; gaps are real (missing cells)."""
    li = load(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_suppkey").alias("id"), month_of("l_shipdate").alias("d"))
              .agg(F.avg("l_extendedprice").alias("price"), F.sum("l_quantity").alias("vol")))


def panel_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """panel_monthly + ``ret`` = price / previous observed price - 1 (row lag per id)."""
    from kestrel.operators.panel import simple_returns
    return simple_returns(panel_monthly(spark, sf_dir), "id", "d", "price", out="ret")


def panel_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, d, price, vol, price_net, ret, retx): the monthly panel with two return streams, of the
    price and of the price net of discounts."""
    from kestrel.operators.panel import simple_returns
    li = load(spark, sf_dir, "lineitem")
    m = (li.groupBy(F.col("l_suppkey").alias("id"), month_of("l_shipdate").alias("d"))
           .agg(F.avg("l_extendedprice").alias("price"), F.sum("l_quantity").alias("vol"),
                F.avg(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price_net")))
    return simple_returns(simple_returns(m, "id", "d", "price", out="ret"), "id", "d", "price_net", out="retx")


def panel_daily_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily rows with duplicate (d, id) keys, impossible and extreme returns,
    rule-derived missing prices and zero volumes."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.to_date("l_shipdate").alias("d"),
        F.col("l_suppkey").alias("id"),
        ((F.col("l_quantity") - 26.0) / 20.0).alias("ret"),
        F.when(F.col("l_partkey") % 17 != 0, F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.when(F.col("l_partkey") % 13 != 0, F.col("l_quantity")).otherwise(F.lit(0.0)).alias("volume"),
        F.col("l_orderkey").alias("okey"),
        F.col("l_linenumber").alias("lnum"),
    )


def leg_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(instrument, d, px): daily mean extended price per return flag (A, N, R)."""
    li = load(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_returnflag").alias("instrument"), F.to_date("l_shipdate").alias("d"))
              .agg(F.avg("l_extendedprice").alias("px")))


def leg_prices_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_returnflag").alias("instrument"), month_of("l_shipdate").alias("d"))
              .agg(F.avg("l_extendedprice").alias("px")))


def priority_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(d, prio, rev): monthly order revenue per priority class 1..5."""
    o = load(spark, sf_dir, "orders")
    return (o.groupBy(month_of("o_orderdate").alias("d"),
                      F.substring("o_orderpriority", 1, 1).cast("int").alias("prio"))
             .agg(F.sum("o_totalprice").alias("rev")))


def factors_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(d, mktrf, smb, hml, umd, rf): monthly log-growth factors built from
    order revenue; mkt = all priorities, the others are priority spreads."""
    pr = priority_revenue(spark, sf_dir)
    wide = (pr.groupBy("d").agg(
        F.sum("rev").alias("r_all"),
        *[F.sum(F.when(F.col("prio") == k, F.col("rev"))).alias(f"r{k}") for k in range(1, 6)]))
    w = Window.orderBy("d")  # one row per month: tiny, single partition is fine
    g = lambda c: F.log(F.col(c)) - F.lag(F.log(F.col(c))).over(w)
    return (wide.select(
        "d",
        g("r_all").alias("mktrf"),
        (g("r1") - g("r2")).alias("smb"),
        (g("r3") - g("r4")).alias("hml"),
        (g("r5") - g("r_all")).alias("umd"),
        F.lit(0.0).alias("rf"))
        .where(F.col("mktrf").isNotNull()))


def nation_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, t, y): monthly order revenue per customer nation."""
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return (j.groupBy(F.col("c_nationkey").cast("bigint").alias("series_id"), month_of("o_orderdate").alias("t"))
             .agg(F.sum("o_totalprice").alias("y")))


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, t, y): daily sum of event value per event type."""
    e = load(spark, sf_dir, "events")
    return (e.groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("t"))
             .agg(F.sum("value").alias("y")))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.col("text").alias("article"), "lang", "source")


def taxonomy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(parent, child): Root -> lang -> lang/source, from the distinct values."""
    d = load(spark, sf_dir, "documents")
    ls = d.select("lang", "source").distinct()
    lvl1 = ls.select(F.lit("Root").alias("parent"), F.col("lang").alias("child")).distinct()
    lvl2 = ls.select(F.col("lang").alias("parent"), F.concat_ws("/", "lang", "source").alias("child"))
    return lvl1.unionByName(lvl2)


def labels_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, cat): every document carries its lang node; documents whose id is
    not a multiple of 7 also carry their leaf lang/source node; ids that are
    multiples of 11 carry an extra code outside the taxonomy ('misc')."""
    d = load(spark, sf_dir, "documents")
    lvl1 = d.select(F.col("doc_id").alias("id"), F.col("lang").alias("cat"))
    leaf = d.where(F.col("doc_id") % 7 != 0).select(F.col("doc_id").alias("id"),
                                                     F.concat_ws("/", "lang", "source").alias("cat"))
    misc = d.where(F.col("doc_id") % 11 == 0).select(F.col("doc_id").alias("id"), F.lit("misc").alias("cat"))
    return lvl1.unionByName(leaf).unionByName(misc)


def panel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, d, price, prc, mcap): monthly index-member style panel with
    rule-derived missing prices (mid-series, trailing and terminal gaps), a
    total return ``prc`` that adds a small dividend for three ids in four, and
    a market cap."""
    m = panel_monthly(spark, sf_dir)
    mi = F.year("d") * 12 + F.month("d")
    m = m.withColumn("price", F.when((F.col("id") + mi) % 29 != 0, F.col("price")))
    w = Window.partitionBy("id").orderBy("d")
    div = F.when(F.col("id") % 4 == 0, F.lit(0.0)).otherwise(F.lit(0.001))
    prc = F.try_divide(F.col("price"), F.nullif(F.lag("price").over(w), F.lit(0.0))) - 1.0 + div
    return m.select("id", "d", "price", prc.alias("prc"), (F.col("price") * F.col("vol") / 1000.0).alias("mcap"))


def leg_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(instrument, d, px, ret): daily simple returns per leg."""
    from kestrel.operators.panel import simple_returns
    return simple_returns(leg_prices(spark, sf_dir), "instrument", "d", "px", out="ret")


# The three instrument pairs (leg a, leg b).
PAIRS = [("A", "N"), ("A", "R"), ("N", "R")]


def pair_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair, d, ret_a, ret_b): each pair's two legs inner-joined on date, NULLs
    dropped.  The pair list is a fixed literal, expanded with explode."""
    r = leg_returns(spark, sf_dir).where(F.col("ret").isNotNull())
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in PAIRS])
    a = r.select(F.col("instrument").alias("leg_a"), "d", F.col("ret").alias("ret_a"))
    b = r.select(F.col("instrument").alias("leg_b"), "d", F.col("ret").alias("ret_b"))
    keyed = a.select("*", F.explode(pairs).alias("p")).where(F.col("p.a") == F.col("leg_a"))
    keyed = keyed.select(F.col("p.b").alias("leg_b"), "leg_a", "d", "ret_a")
    j = keyed.join(b, ["leg_b", "d"])
    return j.select(F.concat_ws("-", "leg_a", "leg_b").alias("pair"), "d", "ret_a", "ret_b")


def did_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference-in-differences layout over customers: treated (nj) = nation in
    region 0; outcome = orders before / after 1998-07-01; chain = market
    segment; gap = exposure from account balance; closed = no orders after."""
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation")
    cut = F.lit("1998-07-01").cast("timestamp_ntz")
    per = o.groupBy("o_custkey").agg(F.count(F.when(F.col("o_orderdate") < cut, 1)).alias("fte"),
                                     F.count(F.when(F.col("o_orderdate") >= cut, 1)).alias("fte2"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(per, c.c_custkey == per.o_custkey, "left")
    nj = (F.col("n_regionkey") == 0).cast("int")
    gap = F.when(nj == 1, F.greatest(F.lit(0.0), (5000.0 - F.col("c_acctbal")) / 10000.0)).otherwise(F.lit(0.0))
    return j.select(F.col("c_custkey").alias("store"), nj.alias("nj"), F.col("c_mktsegment").alias("chain"),
                    (F.col("c_custkey") % 3 == 0).cast("int").alias("co_owned"),
                    F.coalesce("fte", F.lit(0)).cast("double").alias("fte"),
                    F.coalesce("fte2", F.lit(0)).cast("double").alias("fte2"),
                    gap.alias("gap"),
                    F.when(F.coalesce("fte2", F.lit(0)) == 0, 1).otherwise(0).alias("closed"))
