"""Explicit file reads for user queries (instead of SQL on raw paths, which stays disabled)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READERS = ("parquet", "csv", "json", "orc")


def read_file(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read a file or folder by path in an allowed format; CSV goes through the sniffing reader."""
    fmt = fmt.lower()
    if fmt not in READERS:
        raise ValueError(f"unsupported format {fmt}; allowed: {', '.join(READERS)}")
    if fmt == "csv":
        from reportlake.sources.csv import read_csv

        return read_csv(spark, path)
    return spark.read.options(**options).format(fmt).load(path)
