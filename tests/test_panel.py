"""Panel semantics: calendar lag vs row lag (S1), all-NaN sum = 0 (S3),
min_periods guard (S6), long/short normalisation."""

import datetime as dt

from pyspark.sql import functions as F

from kestrel.operators import panel as P


def _hole(spark):
    # 3 ids x 5 dates, id 2 missing on date 3
    rows = []
    for i in (1, 2, 3):
        for k in range(1, 6):
            if (i, k) == (2, 3):
                continue
            rows.append((i, dt.date(2020, 1, k), 0.01 * i * (1 if k % 2 else -1)))
    return spark.createDataFrame(rows, "id long, d date, ret double")


def test_calendar_lag_keeps_hole(spark):
    df = _hole(spark)
    cal = P.calendar(df)
    pr = P.with_calendar(df, cal)
    sh = P.calendar_shift(pr.select("id", "date_idx", "ret"), 1).join(cal, "date_idx")
    got = {(r.id, r.d) for r in sh.where("id = 2").collect()}
    # value of date 2 lands on date 3; nothing lands on date 4 from the missing date 3
    assert (2, dt.date(2020, 1, 3)) in got and (2, dt.date(2020, 1, 4)) not in got
    # row lag would have moved date 2 onto date 4
    from pyspark.sql import Window
    lagged = df.withColumn("prev", F.lag("ret").over(Window.partitionBy("id").orderBy("d")))
    assert lagged.where("id = 2 AND d = DATE'2020-01-04'").first().prev is not None


def test_weights_normalised_and_first_pi_zero(spark):
    df = _hole(spark)
    cal = P.calendar(df)
    pr = P.with_calendar(df, cal)
    w = P.contrarian_weights(pr)
    sums = w.groupBy("d").agg(F.sum(F.when(F.col("w") > 0, F.col("w"))).alias("l"),
                              F.sum(F.when(F.col("w") < 0, F.col("w"))).alias("s")).collect()
    for r in sums:
        assert abs(r.l - 1) < 1e-12 and abs(r.s + 1) < 1e-12
    pi = P.portfolio_return(w, pr, cal).orderBy("d").collect()
    assert len(pi) == 5 and pi[0].pi == 0.0


def test_min_periods_guard(spark):
    rows = [(1, dt.date(2020, k, 1), 0.1) for k in range(1, 13)] + [(2, dt.date(2020, k, 1), 0.1) for k in range(1, 12)]
    df = spark.createDataFrame(rows, "id long, d date, ret double")
    out = df.select("id", "d", P.trailing_compound("id", "d", "ret", 12).alias("c"))
    full = out.where("id = 1 AND c IS NOT NULL").collect()
    assert len(full) == 1 and abs(full[0].c - (1.1 ** 12 - 1)) < 1e-12
    assert out.where("id = 2 AND c IS NOT NULL").count() == 0


def test_clean_panel_keep_first(spark):
    rows = [(dt.date(2020, 1, 1), 1, -1.2, 1), (dt.date(2020, 1, 1), 1, 0.3, 2), (dt.date(2020, 1, 2), 1, 0.9, 1)]
    df = spark.createDataFrame(rows, "d date, id long, ret double, o int")
    out = {r.d: r.ret for r in P.clean_panel(df, order=["o"]).collect()}
    assert out[dt.date(2020, 1, 1)] is None and out[dt.date(2020, 1, 2)] == 0.5
