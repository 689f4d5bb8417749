"""Catalog and profile results as DataFrames: columns, row counts, tree, preview, profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.plans.lake import PREVIEW_DEFAULT, PREVIEW_MAX, sql_type_name

# Fixed values that must equal the reference behaviour.
SMALL_PREVIEW_DEFAULT, SMALL_PREVIEW_MAX = 5, 10

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def column_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Columns of a table in ordinal order: ``(ordinal, name, type)`` (schema metadata)."""
    rows = [(i, f.name, sql_type_name(f.dataType)) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "ordinal int, name string, type string")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Exact counts of many tables in ONE job: a union of per-table count aggregates."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def catalog_rows(spark: SparkSession, tables: Mapping[str, DataFrame], source: str | None = None,
                 physical_prefix: str = "") -> DataFrame:
    """One row per table: source, table name, physical name, row count, column list."""
    meta = [(source, n, physical_prefix + n, len(df.columns),
             [(f.name, sql_type_name(f.dataType)) for f in df.schema.fields]) for n, df in tables.items()]
    m = spark.createDataFrame(meta, "source string, table_name string, physical_name string, n_columns int, "
                                    "columns array<struct<name:string,type:string>>")
    return m.join(row_counts(tables), "table_name").withColumn("n_columns", F.col("n_columns").cast("bigint"))


def preview(df: DataFrame, n: int = PREVIEW_DEFAULT, cap: int = PREVIEW_MAX,
            order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``min(max(n, 0), cap)`` rows in an explicit order (a bare limit has no defined order)."""
    k = min(max(int(n), 0), cap)
    ordered = df.orderBy(*order_by) if order_by else df
    return ordered.limit(k)


def preview_small(df: DataFrame, n: int = SMALL_PREVIEW_DEFAULT, order_by=None) -> DataFrame:
    return preview(df, n, SMALL_PREVIEW_MAX, order_by)


#: Rank error of the quartiles (a share of the rows is its inverse), frequent values kept per column and items tracked for them.
QUANTILE_ACCURACY, TOP_VALUES, TOP_TRACKED = 1000, 5, 1000


def profile(df: DataFrame, sketches: bool = True) -> DataFrame:
    """One pass over the table: per column non-null and null counts, share of nulls, min, max (as text),
    mean, standard deviation and quartiles for numbers (a mergeable quantile sketch), approximate distinct count (HyperLogLog) and the
    most frequent values with their counts (a mergeable frequent-items sketch, exact up to ``TOP_TRACKED`` distinct values).
    Without ``sketches`` the quartiles and frequent values, which cost more than all the rest, are NULL."""
    aggs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        numeric = isinstance(f.dataType, _NUMERIC)
        quartiles = F.percentile_approx(c.cast("double"), [0.25, 0.5, 0.75], QUANTILE_ACCURACY) if numeric and sketches else F.lit(None).cast("array<double>")
        comparable = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
        aggs.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(sql_type_name(f.dataType)).alias("column_type"),
            F.count(c).alias("non_null"), (F.count(F.lit(1)) - F.count(c)).alias("nulls"),
            F.when(F.count(F.lit(1)) > 0, F.round(100.0 * (F.count(F.lit(1)) - F.count(c)) / F.count(F.lit(1)), 2))
            .alias("null_pct"),
            (F.min(c).cast("string") if comparable else F.lit(None).cast("string")).alias("min_value"),
            (F.max(c).cast("string") if comparable else F.lit(None).cast("string")).alias("max_value"),
            (F.round(F.avg(c), 6) if numeric else F.lit(None).cast("double")).alias("mean"),
            (F.round(F.stddev_samp(c), 6) if numeric else F.lit(None).cast("double")).alias("std"),
            (F.approx_count_distinct(c) if comparable else F.lit(None).cast("bigint")).alias("approx_distinct"),
            *[F.get(quartiles, F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))],
            (_top(f.name) if comparable and sketches else F.lit(None).cast("array<struct<value:string,n:bigint>>")).alias("top_values"),
        ))
    return df.agg(F.array(*aggs).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def _top(name: str) -> Column:
    """The most frequent values of a column as text, most frequent first; NULLs don't count."""
    quoted = "`" + name.replace("`", "``") + "`"
    found = F.expr(f"approx_top_k(CAST({quoted} AS STRING), {TOP_VALUES}, {TOP_TRACKED}) FILTER (WHERE {quoted} IS NOT NULL)")
    return F.transform(found, lambda x: F.struct(x["item"].alias("value"), x["count"].cast("bigint").alias("n")))
