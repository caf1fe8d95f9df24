"""Named queries over the driver tables, each with its DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``; its oracle is SQL over the
driver tables (the stand-in views are inlined as CTEs). Column names are
aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.session import prepare

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; ``oracle`` is its DuckDB SQL (None
    for operators with no SQL twin)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for m in MODULES:
        importlib.import_module(f"quayside.plans.{m}")


MODULES = ["q_select", "q_aggregate", "q_upsert", "q_flatten", "q_status", "q_report", "q_runs", "q_publish", "q_stream", "q_keys",
           "q_adhoc"]
