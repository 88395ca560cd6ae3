"""Column-level helpers (JVM-side expressions only; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo: float, hi: float) -> Column:
    """Winsorize to [lo, hi]; NULL stays NULL (greatest/least skip NULLs, so
    the NULL case is kept explicitly)."""
    x = col(c)
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(hi)), F.lit(lo)))


def null_below(c, lo: float) -> Column:
    """Values below ``lo`` become NULL (impossible values)."""
    return F.when(col(c) >= F.lit(lo), col(c))


def safe_ratio(a, b) -> Column:
    """a / b with zero or NULL denominators giving NULL (ANSI-safe)."""
    return F.try_divide(col(a), F.nullif(col(b), F.lit(0)))


def signed_power(c, p: float) -> Column:
    """-sign(x) * |x|^p: the contrarian power transform."""
    return -F.signum(col(c)) * F.pow(F.abs(col(c)), F.lit(p))


def log_growth(c, prev) -> Column:
    return 100.0 * (F.log(col(c)) - F.log(col(prev)))


def text_clean(c) -> Column:
    """NULL -> '', trim, collapse internal whitespace runs to one space."""
    return F.trim(F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"\s+", " "))


def bit_pattern(*flags) -> Column:
    """Pack booleans into an int: first flag is the most significant bit."""
    n = len(flags)
    out = F.lit(0)
    for i, f in enumerate(flags):
        out = out.bitwiseOR(F.shiftleft(col(f).cast("int"), n - 1 - i))
    return out


def rnd(c, dp: int = 6) -> Column:
    return F.round(col(c), dp)


def between_dates(c, lo: str, hi: str) -> Column:
    return col(c).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))


def third_friday(c) -> Column:
    """Quarterly expiry day: third Friday of Mar/Jun/Sep/Dec."""
    d = col(c)
    return ((F.dayofweek(d) == 6) & F.dayofmonth(d).between(15, 21) & F.month(d).isin(3, 6, 9, 12))


def attach_scalars(df, one_row):
    """Add the columns of a one-row aggregate to every row of ``df`` as a
    scalar subquery (evaluated once, no join of any kind)."""
    s = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.select("*", *[s.getField(c).alias(c) for c in one_row.columns])


def scalar(one_row, c: str | None = None) -> Column:
    """A single value of a one-row aggregate as a scalar subquery."""
    return one_row.select(c or one_row.columns[0]).scalar()
