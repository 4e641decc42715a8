"""Query catalog: every operator from the inventory as a runnable query over
the driver tables, paired (where SQL can express it) with oracle SQL.

Conventions for comparability with the oracle:
* every computed column is aliased identically on both sides;
* non-integral doubles are rounded once, at the end, to 6 dp (``R6``);
* integer sums are cast to BIGINT (DuckDB would return HUGEINT).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
R6 = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_cols(df: DataFrame, names, digits: int = R6) -> DataFrame:
    """Round the named double columns once at the end (comparison hygiene)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in names else F.col(c) for c in df.columns])


def sql_round(names, digits: int = R6) -> str:
    """``* replace (round(c, 6) as c, …)`` for the oracle's outer select."""
    if not names:
        return "*"
    return "* replace (" + ", ".join(f"round({c}, {digits}) as {c}" for c in names) + ")"


def load_all() -> None:
    """Import the modules that register queries."""
    from . import queries_features, queries_underwriting, queries_stats, queries_metrics  # noqa: F401
    from . import queries_portfolio, queries_scalar, queries_explain, queries_models  # noqa: F401
