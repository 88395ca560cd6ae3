"""Many time series in parallel, keyed by ``series_id``.

Set-based parts (resampling, detrending, ACF, CCF, periodogram, growth) are
joins and aggregations over ``(series_id, t)``.  Model fits that need a
sequential recursion (AR/ARX/MA order search, forecasts, ADF, PACF, Welch,
FFT filtering) run in ``groupBy(series_id).applyInPandas``: each group is one
series -- one row per calendar step, so its size is bounded by the calendar,
never by the raw data volume -- and the fit is a few NumPy least squares.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def indexed(df: DataFrame, sid: str = "series_id", t: str = "t") -> DataFrame:
    """Add a 1-based observation index per series."""
    return df.withColumn("idx", F.row_number().over(Window.partitionBy(sid).orderBy(t)))


def detrend_linear(df: DataFrame, y: str = "y", sid: str = "series_id") -> DataFrame:
    """Residual of y on the observation index per series (groupBy + join)."""
    fit = df.groupBy(sid).agg(F.regr_slope(y, "idx").alias("b"), F.regr_intercept(y, "idx").alias("a"))
    return df.join(fit, sid).withColumn("resid", F.col(y) - F.col("a") - F.col("b") * F.col("idx"))


def acf(df: DataFrame, max_lag: int, y: str = "y", sid: str = "series_id") -> DataFrame:
    """rho(l) = sum (y_t - m)(y_{t+l} - m) / sum (y_t - m)^2, l = 0..max_lag.
    Lag pairs come from an explode of l and an equi-join on (series, idx + l)."""
    m = df.groupBy(sid).agg(F.avg(y).alias("_m"), F.count(F.lit(1)).alias("n"))
    c = df.join(m, sid).select(sid, "idx", (F.col(y) - F.col("_m")).alias("e"), "n")
    a = c.select(sid, "idx", "e", F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"))
    b = c.select(F.col(sid).alias("_s"), F.col("idx").alias("_i"), F.col("e").alias("e2"))
    j = a.join(b, (F.col(sid) == F.col("_s")) & (F.col("idx") + F.col("lag") == F.col("_i")))
    num = j.groupBy(sid, "lag").agg(F.sum(F.col("e") * F.col("e2")).alias("num"))
    den = num.where("lag = 0").select(sid, F.col("num").alias("den"))
    return num.join(den, sid).join(m.select(sid, "n"), sid).select(sid, "lag", (F.col("num") / F.col("den")).alias("acf"), "n")


def ljung_box(acf_df: DataFrame, lags: int, sid: str = "series_id") -> DataFrame:
    a = acf_df.where((F.col("lag") >= 1) & (F.col("lag") <= lags))
    return a.groupBy(sid).agg((F.first("n") * (F.first("n") + 2) *
                               F.sum(F.col("acf") * F.col("acf") / (F.col("n") - F.col("lag")))).alias("q_stat"),
                              F.lit(lags).alias("lags"))


def periodogram(df: DataFrame, y: str = "y", sid: str = "series_id", scaling: str = "raw",
                method: str = "fft") -> DataFrame:
    """|sum_t (y_t - mean) e^{-2 pi i k t / n}|^2 / n for k = 1..floor(n/2).
    scaling='raw' divides by n; 'none' keeps the unnormalised power.

    method='fft' hands each series to a grouped NumPy FFT (O(n log n));
    method='dft' is the same sum as a set expression (frequencies x observations,
    n^2/2 rows per series), for cross-checks on short series."""
    if method == "fft":
        return _periodogram_fft(df, y, sid, scaling)
    m = df.groupBy(sid).agg(F.avg(y).alias("_m"), F.count(F.lit(1)).alias("n"))
    c = df.join(m, sid).select(sid, (F.col("idx") - 1).alias("t0"), (F.col(y) - F.col("_m")).alias("e"), "n")
    k = c.select("*", F.explode(F.sequence(F.lit(1), F.floor(F.col("n") / 2).cast("int"))).alias("k"))
    ang = 2 * math.pi * F.col("k") * F.col("t0") / F.col("n")
    s = k.groupBy(sid, "k").agg(F.sum(F.col("e") * F.cos(ang)).alias("re"), F.sum(F.col("e") * F.sin(ang)).alias("im"),
                                F.first("n").alias("n"))
    p = F.col("re") * F.col("re") + F.col("im") * F.col("im")
    return s.select(sid, "k", (F.col("k") / F.col("n")).alias("freq"),
                    (p / F.col("n") if scaling == "raw" else p).alias("power"))


def _periodogram_fft(df: DataFrame, y: str, sid: str, scaling: str) -> DataFrame:
    key_type = df.schema[sid].dataType.simpleString()

    def fft(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values("idx")[y].to_numpy(float)
        n = len(v)
        spec = np.fft.rfft(v - v.mean())
        k = np.arange(1, n // 2 + 1)
        p = np.abs(spec[k]) ** 2
        return pd.DataFrame({sid: pdf[sid].iloc[0], "k": k, "freq": k / n, "power": p / n if scaling == "raw" else p})
    return df.select(sid, "idx", y).groupBy(sid).applyInPandas(
        lambda p: fft(p), f"{sid} {key_type}, k long, freq double, power double")


# ------------------------------------------------- grouped NumPy fits --------
def _lagmat(y: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(y)
    X = np.column_stack([np.ones(n - p)] + [y[p - j - 1:n - j - 1] for j in range(p)])
    return X, y[p:]


def _ols(X, y):
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    r = y - X @ beta
    return beta, r


def _log_mse(mse: float, y: np.ndarray) -> float:
    """log(mse), NaN for a fit that is perfect up to rounding."""
    return math.log(mse) if mse > 1e-22 * float(y @ y) / len(y) else float("nan")


def ar_order_search(pdf: pd.DataFrame, max_p: int = 5) -> pd.DataFrame:
    """AR(p) by conditional least squares on a common sample, p = 1..max_p.  A
    series too short for p has NULL criteria, a perfectly fitted (e.g. constant) one NULL
    aic and bic; other series are not affected."""
    y = pdf.sort_values("t")["y"].to_numpy(float)
    rows = []
    for p in range(1, max_p + 1):
        n = max(len(y) - max_p, 0)
        if n <= p + 1 or not np.isfinite(y).all():
            rows.append({"p": p, "n": n, "mse": np.nan, "aic": np.nan, "bic": np.nan})
            continue
        X, yy = _lagmat(y, p)
        X, yy = X[max_p - p:], yy[max_p - p:]
        _, r = _ols(X, yy)
        n = len(yy)
        mse = float(r @ r / n)
        rows.append({"p": p, "n": n, "mse": mse, "aic": n * _log_mse(mse, yy) + 2 * (p + 1),
                     "bic": n * _log_mse(mse, yy) + math.log(n) * (p + 1)})
    out = pd.DataFrame(rows)
    out.insert(0, "series_id", pdf["series_id"].iloc[0])
    return out


def pacf_dl(pdf: pd.DataFrame, max_lag: int = 10) -> pd.DataFrame:
    """Partial autocorrelation by Durbin-Levinson on the ACF row of a series."""
    r = pdf.sort_values("lag")["acf"].to_numpy(float)
    L = min(max_lag, len(r) - 1)
    out, phi = [], np.zeros((L + 1, L + 1))
    for k in range(1, L + 1):
        num = r[k] - sum(phi[k - 1, j] * r[k - j] for j in range(1, k))
        den = 1 - sum(phi[k - 1, j] * r[j] for j in range(1, k))
        phi[k, k] = num / den if den else float("nan")
        for j in range(1, k):
            phi[k, j] = phi[k - 1, j] - phi[k, k] * phi[k - 1, k - j]
        out.append({"series_id": pdf["series_id"].iloc[0], "lag": k, "pacf": phi[k, k]})
    return pd.DataFrame(out)


def hannan_rissanen(pdf: pd.DataFrame, p: int, q: int, long_ar: int = 8) -> pd.DataFrame:
    """ARMA(p, q) by Hannan-Rissanen: long AR residuals, then OLS on lagged y
    and lagged residuals.  Too short a series has NULL mse and aic, a perfectly fitted one a
    NULL aic."""
    y = pdf.sort_values("t")["y"].to_numpy(float)
    if len(y) - max(p, q) - long_ar <= p + q + 1 or not np.isfinite(y).all():
        return pd.DataFrame([{"series_id": pdf["series_id"].iloc[0], "p": p, "q": q, "n": max(len(y) - max(p, q) - long_ar, 0),
                              "mse": np.nan, "aic": np.nan}])
    y = y - y.mean()
    X, yy = _lagmat(y, long_ar)
    _, e = _ols(X, yy)
    e = np.concatenate([np.zeros(long_ar), e])
    m = max(p, q) + long_ar
    cols = [np.ones(len(y) - m)] + [y[m - j:len(y) - j] for j in range(1, p + 1)] + \
        [e[m - j:len(y) - j] for j in range(1, q + 1)]
    Z = np.column_stack(cols)
    beta, r = _ols(Z, y[m:])
    n = len(r)
    mse = float(r @ r / n)
    return pd.DataFrame([{"series_id": pdf["series_id"].iloc[0], "p": p, "q": q, "n": n, "mse": mse,
                          "aic": n * _log_mse(mse, y) + 2 * (p + q + 1)}])


def welch(pdf: pd.DataFrame, nperseg: int = 16) -> pd.DataFrame:
    """Welch PSD: Hann window, 50 % overlap, mean-detrended segments."""
    y = pdf.sort_values("t")["y"].to_numpy(float)
    step = nperseg // 2
    win = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(nperseg) / nperseg)
    scale = 1.0 / (win * win).sum()
    acc, cnt = None, 0
    for s in range(0, len(y) - nperseg + 1, step):
        seg = y[s:s + nperseg]
        seg = (seg - seg.mean()) * win
        p = np.abs(np.fft.rfft(seg)) ** 2 * scale
        p[1:-1 if nperseg % 2 == 0 else None] *= 2
        acc = p if acc is None else acc + p
        cnt += 1
    if not cnt:
        return pd.DataFrame([])
    psd = acc / cnt
    return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "k": np.arange(len(psd)),
                         "freq": np.arange(len(psd)) / nperseg, "psd": psd})


def fft_filter(pdf: pd.DataFrame, lo: int, hi: int) -> pd.DataFrame:
    """Zero DFT bins lo..hi (and their mirror) and invert."""
    pdf = pdf.sort_values("t")
    y = pdf["y"].to_numpy(float)
    Y = np.fft.fft(y)
    n = len(y)
    for k in range(lo, min(hi, n - 1) + 1):
        Y[k] = 0
        Y[(n - k) % n] = 0
    return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "t": pdf["t"].to_numpy(), "y_filtered": np.fft.ifft(Y).real})


def find_peaks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Local maxima of the power spectrum with prominence >= its 75th
    percentile; flags the 4 lowest-frequency and the 4 tallest."""
    pdf = pdf.sort_values("k").reset_index(drop=True)
    p = pdf["power"].to_numpy(float)
    rows = []
    for i in range(1, len(p) - 1):
        if p[i] > p[i - 1] and p[i] >= p[i + 1]:
            left = p[:i + 1][::-1]
            right = p[i:]
            lmin = left[:np.argmax(left > p[i]) if (left > p[i]).any() else len(left)].min()
            rmin = right[:np.argmax(right > p[i]) if (right > p[i]).any() else len(right)].min()
            rows.append({"k": int(pdf["k"][i]), "power": p[i], "prominence": p[i] - max(lmin, rmin)})
    if not rows:
        return pd.DataFrame([])
    pk = pd.DataFrame(rows)
    pk = pk[pk["prominence"] >= pk["prominence"].quantile(0.75)].copy()
    pk["lowest4"] = pk["k"].rank(method="first") <= 4
    pk["tallest4"] = pk["power"].rank(method="first", ascending=False) <= 4
    pk.insert(0, "series_id", pdf["series_id"].iloc[0])
    return pk
