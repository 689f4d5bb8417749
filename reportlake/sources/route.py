"""File-type routing and the per-file listing a bulk ingest starts from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Extension → reader.
CSV_EXTENSIONS = ("csv", "txt")
EXCEL_EXTENSIONS = ("xls", "xlsx")


def file_name(path: Column) -> Column:
    """Last path segment."""
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def extension(name: Column) -> Column:
    """Text after the last dot of the file name, lower-cased ('' when there is no dot)."""
    return F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))


def route(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Add ``file_name, extension, file_type ('csv'|'excel'|NULL), accepted, reason``."""
    name = file_name(F.col(path_col))
    ext = extension(name)
    ftype = (F.when(ext.isin(*CSV_EXTENSIONS), F.lit("csv"))
             .when(ext.isin(*EXCEL_EXTENSIONS), F.lit("excel")))
    return (df.withColumn("file_name", name).withColumn("extension", ext)
            .withColumn("file_type", ftype)
            .withColumn("accepted", ftype.isNotNull())
            .withColumn("reason", F.when(ftype.isNull(),
                                         F.concat(F.lit("unsupported file type: ."), ext))))


def route_name(name: str) -> tuple[str | None, str | None]:
    """Python twin of :func:`route` for one upload name: ``(file_type, reject_reason)``."""
    ext = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if ext in CSV_EXTENSIONS:
        return "csv", None
    if ext in EXCEL_EXTENSIONS:
        return "excel", None
    return None, f"unsupported file type: .{ext}"


def list_files(spark: SparkSession, paths: Sequence[str] | str, recursive: bool = True) -> DataFrame:
    """Path, size and modification time of every file under ``paths`` (content is never read:
    the binaryFile source prunes the unused ``content`` column), routed by extension."""
    if isinstance(paths, str):
        paths = [paths]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
             .load(list(paths)).select("path", F.col("length").alias("file_size"), "modificationTime"))
    return route(files)
