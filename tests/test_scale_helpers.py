"""Skew-proof helpers agree with the plain window formulation."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import corpus as C
from kestrel.operators import evaluate as E


def test_top_k_per_group_exact(spark):
    # one hot group holding most rows, plus small groups
    rows = [("hot", i) for i in range(400)] + [("a", i) for i in range(7)] + [("b", i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, id long").withColumn("k", F.lit(5)).withColumn("h", C.draw_key("id"))
    got = {(r.g, r.id) for r in C.top_k_per_group(df, "g", ["h", "id"], "k", salt_buckets=16, salt_of="id").collect()}
    w = Window.partitionBy("g").orderBy("h", "id")
    ref = {(r.g, r.id) for r in df.withColumn("r", F.row_number().over(w)).where("r <= k").collect()}
    assert got == ref and len(got) == 5 + 5 + 3


def test_running_totals_match_window(spark):
    rows = [("x", float(s % 37), s % 2) for s in range(300)] + [("y", float(s % 5), 1) for s in range(20)]
    df = spark.createDataFrame(rows, "g string, s double, v long").groupBy("g", "s").agg(F.sum("v").alias("v"))
    got = {(r.g, r.s): r.cum_v for r in E.running_totals(df, ["g"], "s", ["v"], descending=True, partitions=4).collect()}
    w = Window.partitionBy("g").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ref = {(r.g, r.s): r.c for r in df.withColumn("c", F.sum("v").over(w)).collect()}
    assert got == ref


def test_allocation_sums_to_total(spark):
    counts = spark.createDataFrame([(p, n) for p, n in enumerate([299, 49, 42, 9, 1])], "pattern int, n long")
    a = C.allocate(counts, "pattern", 100).collect()
    assert sum(r.k for r in a) == 100 and all(r.k <= r.n for r in a)


def test_allocation_gives_the_gap_to_the_largest_in_turn(spark):
    counts = [104, 104, 104, 104, 104, 4]                          # shares 1.98 and 0.08: 12 draws, 10 wanted
    want, total = [round(10 * n / sum(counts)) for n in counts], 10
    gap, order = total - sum(want), sorted(range(6), key=lambda i: (-want[i], i))
    for i in range(abs(gap)):
        want[order[i % 6]] += 1 if gap > 0 else -1
    got = C.allocate(spark.createDataFrame(list(enumerate(counts)), "pattern int, n long"), "pattern", total).collect()
    assert {r.pattern: r.k for r in got} == dict(enumerate(want))


def test_exact_percentiles_match_sql_percentile(spark):
    import random
    from kestrel.operators.quality import exact_percentiles
    rnd = random.Random(1)
    rows = [("hot", float(rnd.randint(0, 50))) for _ in range(2000)] + [("a", float(i)) for i in range(7)] + [("b", 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs, nm = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0], ["min", "p5", "p25", "median", "p75", "p95", "max"]
    got = {r.g: tuple(getattr(r, c) for c in nm) for r in exact_percentiles(df, ["g"], "x", qs, nm).collect()}
    ref = {r.g: tuple(getattr(r, c) for c in nm)
           for r in df.groupBy("g").agg(*[F.percentile("x", q).alias(n) for q, n in zip(qs, nm)]).collect()}
    assert got == ref
