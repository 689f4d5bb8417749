"""SQL-level names users of DuckDB-flavoured SQL expect, registered as SQL functions.

Each is a ``CREATE TEMPORARY FUNCTION ... RETURN <expression>``: Catalyst inlines the
body, so they run as built-in expressions (no Python). Aggregates cannot be SQL
functions; their Spark spellings are listed in ``AGGREGATE_SPELLINGS``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# DuckDB spelling → Spark SQL body.
SCALAR_FUNCTIONS = {
    "strpos": "(s STRING, sub STRING) RETURNS BIGINT RETURN CAST(instr(s, sub) AS BIGINT)",
    "regexp_matches": "(s STRING, p STRING) RETURNS BOOLEAN RETURN s RLIKE p",
    "string_split": "(s STRING, sep STRING) RETURNS ARRAY<STRING> RETURN split(s, concat('\\\\Q', sep, '\\\\E'), -1)",
    "list_contains": "(a ARRAY<STRING>, v STRING) RETURNS BOOLEAN RETURN array_contains(a, v)",
    "list_sort": "(a ARRAY<STRING>) RETURNS ARRAY<STRING> RETURN sort_array(a)",
    "list_distinct": "(a ARRAY<STRING>) RETURNS ARRAY<STRING> RETURN array_distinct(a)",
    "epoch": "(t TIMESTAMP_NTZ) RETURNS DOUBLE RETURN CAST(unix_micros(CAST(t AS TIMESTAMP)) AS DOUBLE) / 1000000",
    "isodow": "(t TIMESTAMP_NTZ) RETURNS INT RETURN CAST(dayofweek(t) + 5 AS INT) % 7 + 1",
}

AGGREGATE_SPELLINGS = {
    "arg_max": "max_by", "arg_min": "min_by", "quantile_cont": "percentile_cont ... WITHIN GROUP",
    "quantile_disc": "percentile_disc ... WITHIN GROUP", "string_agg": "listagg ... WITHIN GROUP",
    "list": "array_agg / collect_list", "approx_quantile": "approx_percentile",
}


def register_compat(spark: SparkSession) -> list[str]:
    """Register the compat functions in the session; returns their names."""
    for name, body in SCALAR_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(SCALAR_FUNCTIONS)
