"""Time-series operators vs NumPy, strategy family identities, streaming dedup."""

import datetime as dt
import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import panel as P
from kestrel.operators import timeseries as TS


def _one_series(spark, y):
    return spark.createDataFrame([(1, dt.date(2000 + i // 12, i % 12 + 1, 1), float(v)) for i, v in enumerate(y)],
                                 "series_id long, t date, y double")


def test_acf_matches_numpy(spark):
    rng = np.random.default_rng(0)
    y = np.cumsum(rng.normal(size=60))
    got = {r.lag: r.acf for r in TS.acf(TS.indexed(_one_series(spark, y)), 5).collect()}
    e = y - y.mean()
    for lag in range(6):
        ref = (e[:len(e) - lag] * e[lag:]).sum() / (e * e).sum()
        assert abs(got[lag] - ref) < 1e-12


def test_periodogram_peak_and_parseval(spark):
    n = 64
    y = np.cos(2 * np.pi * 5 * np.arange(n) / n)
    pg = TS.periodogram(TS.indexed(_one_series(spark, y)), scaling="raw").collect()
    best = max(pg, key=lambda r: r.power)
    assert best.k == 5
    # Parseval: sum_{k=0}^{n-1} |Y_k|^2 = n sum y^2 (demeaned); one-sided bins 1..n/2 double-count except n/2
    e = y - y.mean()
    two_sided = sum((2 if r.k < n // 2 else 1) * r.power * n for r in pg)
    assert abs(two_sided - n * (e * e).sum()) < 1e-6


def test_ar1_fit_recovers_coefficient(spark):
    y = [1.0]
    for _ in range(80):
        y.append(0.5 * y[-1] + 0.01)
    import pandas as pd
    pdf = pd.DataFrame({"series_id": 1, "t": range(len(y)), "y": y})
    out = TS.ar_order_search(pdf, 1)
    assert out["mse"].iloc[0] < 1e-20


def test_lag_family_k1_equals_baseline(spark):
    rows = [(i, dt.date(2020, m, 1), ((i * 7 + m * 3) % 11 - 5) / 100.0) for i in range(6) for m in range(1, 10)
            if (i, m) != (2, 4)]
    df = spark.createDataFrame(rows, "id long, d date, ret double")
    cal = P.calendar(df)
    pr = P.with_calendar(df, cal)
    w = P.contrarian_weights(pr)
    base = {r.d: r.pi for r in P.portfolio_return(w, pr, cal).collect()}
    fam = P.portfolio_return(P.expand(w, "k", [1, 2]), pr, cal, k="k", grid={"k": [1, 2]})
    k1 = {r.d: r.pi for r in fam.where("k = 1").collect()}
    assert all(abs(base[d] - k1[d]) < 1e-15 for d in base)
    # power 1 with NULL->0 excess equals the baseline too
    pw = P.portfolio_return(P.contrarian_weights(pr, powers=[1.0]), pr, cal, grid={"p": [1.0]})
    assert all(abs(base[r.d] - r.pi) < 1e-12 for r in pw.collect())


@pytest.mark.parametrize("files", [None, 1])
def test_streaming_ingest_drops_seen_ids(spark, files):
    from kestrel.streaming.jobs import ingest_dedup
    base = tempfile.mkdtemp(prefix="kestrel-stream-", dir="/tmp")
    src, out, ck = (os.path.join(base, x) for x in ("in", "out", "ck"))
    rows = [(i % 5, i, "r") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, turn long, role string")
    df.repartition(4, "turn").write.parquet(src)
    ingest_dedup(spark, src, df.schema, out, ck, "id", ["turn"], files)
    got = spark.read.parquet(out)
    assert got.count() == 5 and got.select("id").distinct().count() == 5
    if files is None:
        assert sorted(r.turn for r in got.collect()) == [0, 1, 2, 3, 4]
    # later files: only ids that were never stored, however old
    spark.createDataFrame([(3, 99, "r"), (70, 1, "b"), (70, 1, "a")], df.schema).write.mode("append").parquet(src)
    ingest_dedup(spark, src, df.schema, out, ck, "id", ["turn", "role"], files)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4, 70]


def test_stream_scores_each_document_once(spark):
    from kestrel.streaming.jobs import score_files
    base = tempfile.mkdtemp(prefix="kestrel-stream-", dir="/tmp")
    docs = spark.createDataFrame([(i, "good bad good" if i % 2 else None) for i in range(12)], "doc_id long, text string")
    docs.repartition(3).write.parquet(base + "/in")
    coef = spark.createDataFrame([("good", 1.0), ("bad", -0.5)], "term string, weight double")
    score_files(spark, base + "/in", docs.schema, coef, base + "/out", base + "/ck", files_per_trigger=1)
    got = {r.doc_id: r.score for r in spark.read.schema("doc_id long, score double").json(base + "/out").collect()}
    assert got == {i: 1.5 if i % 2 else 0.0 for i in range(12)}


def test_periodogram_fft_equals_dft(spark):
    rng = np.random.default_rng(4)
    s = TS.indexed(_one_series(spark, rng.normal(size=50)))
    a = {r.k: r.power for r in TS.periodogram(s, method="dft").collect()}
    b = {r.k: r.power for r in TS.periodogram(s, method="fft").collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


@pytest.mark.parametrize("y", [[5.0] * 40, [1.0, 2.0, 1.0, 3.0], [0.0], [1.0, float("nan")] * 20])
def test_bad_series_give_nulls(y):
    import pandas as pd
    pdf = pd.DataFrame({"series_id": 1, "t": range(len(y)), "y": y})
    ar, arma = TS.ar_order_search(pdf), TS.hannan_rissanen(pdf, 1, 1)
    assert len(ar) == 5 and ar["aic"].isna().all() and arma["aic"].isna().all()


def test_draw_keys_of_large_ids(spark):
    from kestrel.operators import corpus as C
    ids = [0, 7, 4_000_000_000, 2 ** 62 + 5]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: (r.k, r.split) for r in C.hash_split(df, "id").select("id", C.draw_key("id").alias("k"), "split").collect()}
    assert got == {i: (i * 2654435761 % 1000003, "train" if i * 7919 % 100 < 80 else "test") for i in ids}
