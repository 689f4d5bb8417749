"""CSV export (and parquet / JSON) of whole results, written by Spark tasks.

Line format (fixed by the reference): header = column labels unquoted; a value is quoted
only when it contains ``,``, ``"`` or a newline, with ``"`` doubled; NULL is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.session import checkpoint_root
from reportlake.sources.headers import dedupe_names

BOM = "﻿"


def csv_field(value: Column) -> Column:
    """One CSV field from any value (NULL stays NULL; callers map it to '')."""
    s = value.cast("string")
    return F.when(s.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))
                  ).otherwise(s)


def csv_line(*cols: Column) -> Column:
    return F.concat_ws(",", *[F.coalesce(csv_field(c), F.lit("")) for c in cols])


def unique_labels(df: DataFrame) -> DataFrame:
    """A result may show one label twice; exported columns get names of their own (``a, a`` → ``a, a_1``)."""
    names = dedupe_names(df.columns)
    return df if names == df.columns else df.toDF(*names)


def csv_lines(df: DataFrame, column: str = "line") -> DataFrame:
    """Data lines (no header) as a one-column DataFrame, computed in the tasks."""
    df = unique_labels(df)
    return df.select(csv_line(*[df[f"`{c}`"] for c in df.columns]).alias(column))


def header_line(df: DataFrame) -> str:
    return ",".join(df.columns)


def export_csv(df: DataFrame, path: str, single_file: bool = False, bom: bool = True) -> None:
    """Write the whole result as CSV under ``path``; the header is written even when empty.

    ``single_file=True`` (the reference's download): one part with the BOM-prefixed header first, then the rows
    in the input's order. The lines are finished in parallel and kept in the shared checkpoint folder; only
    putting them together is one task. Default, for results of
    any size: every task writes its own part with the header on top (what Spark CSV
    readers expect), values rendered as text exactly as in :func:`csv_lines` and quoted
    only when they hold ``,`` ``"`` or a newline; no BOM, no shuffle.
    """
    spark, df = df.sparkSession, unique_labels(df)
    if single_file:
        checkpoint_root(spark)
        head = spark.createDataFrame([((BOM if bom else "") + header_line(df),)], "line string") \
            .select(F.lit(0).alias("k"), F.lit(0).cast("bigint").alias("i"), "line")
        body = csv_lines(df).select(F.lit(1).alias("k"), F.monotonically_increasing_id().alias("i"), "line")
        # ids follow the input order (partition, then position); one partition, sorted by (k, i)
        (head.unionByName(body.checkpoint()).coalesce(1).sortWithinPartitions("k", "i").select("line")
         .write.mode("overwrite").text(path))
        return
    as_text = df.select(*[df[f"`{c}`"].cast("string").alias(c) for c in df.columns])
    (as_text.write.mode("overwrite").option("header", True).option("sep", ",").option("quote", '"')
     .option("escape", '"').option("escapeQuotes", True).option("quoteAll", False)
     .option("nullValue", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("lineSep", "\n").csv(path))
    if not as_text.take(1):  # Spark writes no header for an empty result: add one part that has it
        spark.createDataFrame([(header_line(df),)], "line string").write.mode("append").text(path)


def export(df: DataFrame, path: str, fmt: str = "csv", **kw) -> None:
    """Export in the requested format: ``csv`` (reference layout), ``parquet`` or ``json``."""
    fmt = fmt.lower()
    if fmt == "csv":
        export_csv(df, path, **kw)
    elif fmt == "parquet":
        unique_labels(df).write.mode("overwrite").parquet(path)
    elif fmt == "json":
        unique_labels(df).write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unsupported export format: {fmt}")
