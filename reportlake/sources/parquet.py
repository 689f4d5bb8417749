"""Register a directory of ``<name>.parquet`` tables as temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reportlake.session import configure

# The star schema and side tables the test data ships with.
TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# (session, root, name) → DataFrame. Building a parquet DataFrame lists files and reads
# footers; the read-only inputs are resolved once per session instead of once per query.
_frames: dict[tuple[int, str, str], DataFrame] = {}
_views: dict[int, str] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy parquet scan of ``<root>/<name>.parquet``; filters and projections push into it."""
    key = (id(spark), root.rstrip("/"), name)
    df = _frames.get(key)
    if df is None or df.sparkSession is not spark:
        configure(spark)
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
        _frames[key] = df
    return df


def register_dir(spark: SparkSession, root: str, names=TEST_TABLES) -> SparkSession:
    """Create or replace one temp view per table (the scan itself stays lazy)."""
    configure(spark)
    root = root.rstrip("/")
    if _views.get(id(spark)) == root and all(spark.catalog.tableExists(n) for n in names[:1]):
        return spark
    for name in names:
        table(spark, root, name).createOrReplaceTempView(name)
    _views[id(spark)] = root
    return spark
