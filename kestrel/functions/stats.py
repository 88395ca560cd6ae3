"""Statistical helpers: average ranks (window) and distribution tail
probabilities for result rows (Arrow-batched pandas UDFs over a handful of
rows; the heavy lifting happens in the aggregations before them)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def avg_rank(df: DataFrame, x: str, by: list[str], out: str | None = None) -> DataFrame:
    """1-based rank with ties given their average rank."""
    out = out or f"{x}_rank"
    w = Window.partitionBy(*by).orderBy(x)
    ties = Window.partitionBy(*by, x)
    return df.withColumn(out, F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0)


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularized incomplete beta (Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of Student t."""
    if t is None or df is None or t != t or df <= 0:
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(F_: float, d1: float, d2: float) -> float:
    if F_ is None or F_ != F_ or d1 <= 0 or d2 <= 0:
        return float("nan")
    if F_ <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * F_))


def z_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _vec(fn):
    """Build the Arrow-batched UDF lazily (needs an active session)."""
    @F.pandas_udf("double")
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([fn(*vals) for vals in zip(*cols)], dtype="float64")
    return run


def t_two_sided(t: Column, df: Column) -> Column:
    return _vec(t_sf2)(t, df)


def f_sf_col(f: Column, d1: Column, d2: Column) -> Column:
    return _vec(f_sf)(f, d1, d2)


def z_pvalue(z: Column) -> Column:
    return _vec(lambda a: z_two_sided(a) if a == a else float("nan"))(z)
