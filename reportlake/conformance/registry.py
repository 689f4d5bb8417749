"""Registry shared by the conformance modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reportlake.plans import gateway
from reportlake.sources.parquet import register_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def case(key: str, oracle: str | None = None):
    """Register a DataFrame-API query (and its DuckDB twin when SQL can express it)."""

    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate conformance key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return deco


def sql_case(key: str, spark_sql: str, duck_sql: str | None = None, mode: str = "default"):
    """Register a query the user would type into the gateway; ``duck_sql`` defaults to the same text."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_dir(spark, sf_dir)
        return gateway.sql(spark, spark_sql, mode)

    run.__name__ = f"sql_{key}"
    case(key, duck_sql if duck_sql is not None else spark_sql)(run)


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)
