"""Named queries (survey operator IDs) with their DuckDB oracle SQL."""

import importlib

from kestrel.plans.registry import BENCH, ORACLE, QUERIES  # noqa: F401

_MODULES = [
    "misc_queries",
    "ml_queries",
    "text_queries",
    "ts_queries",
    "eval_queries",
    "tree_queries",
    "regression_queries",
    "signal_queries",
    "quality_queries",
    "strategy_queries",
]


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"kestrel.plans.{m}")
