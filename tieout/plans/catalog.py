"""Registry of runnable queries: name -> (Spark callable, oracle SQL or None).

Every Spark callable takes (spark, sf_dir), builds the ledger from the
driver's tables through `fixture_ledger` and returns a DataFrame produced by
the package's operators. Oracle SQL is plain DuckDB text over the same tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tieout.plans.session import apply_engine_conf

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_engine_conf(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tieout.plans import queries_core  # noqa: F401
    from tieout.plans import queries_quality  # noqa: F401
    from tieout.plans import queries_history  # noqa: F401
    from tieout.plans import queries_audit  # noqa: F401
    from tieout.plans import queries_reports  # noqa: F401
    from tieout.plans import queries_streaming  # noqa: F401
