"""Registry of named queries (one per operator ID of the survey) and their
DuckDB oracle SQL.  Rounding of floating outputs is declared once per query
and applied identically to the Spark result and to the oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
BENCH: list[str] = []


def _round_sql(sql: str, cols: dict[str, int]) -> str:
    if not cols:
        return sql
    repl = ", ".join(f"round({c} * 1e{dp}) / 1e{dp} + 0.0 AS {c}" for c, dp in cols.items())
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS _q"


def query(name: str, sql: str | None = None, rnd: list[str] | dict[str, int] | None = None,
          dp: int = 6, bench: bool = False):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``rnd`` lists float columns rounded to ``dp`` places on both sides."""
    cols = dict(rnd) if isinstance(rnd, dict) else {c: dp for c in (rnd or [])}

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from kestrel.session import ship_package
            ship_package(spark)          # workers import kestrel for grouped pandas functions
            out = fn(spark, sf_dir)
            if cols:
                # round(x * 10^p) / 10^p: both engines scale with the same IEEE
                # product and round half away from zero, so decimal ties agree;
                # "+ 0.0" folds -0.0 into 0.0.
                out = out.withColumns({c: F.round(F.col(c) * float(10 ** p), 0) / float(10 ** p) + F.lit(0.0)
                                       for c, p in cols.items()})
            return out
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = _round_sql(sql.strip(), cols)
        if bench:
            BENCH.append(name)
        return run
    return deco
