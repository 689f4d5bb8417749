"""Commit log of a database: which batches of rows belong to the tables of a source.

An append first writes the new rows of all its tables as partitions ``__batch=<id>`` of their row tables, where no reader looks. One
row added to this log then makes the batch part of all tables at once: readers see a table through a view that keeps
the batches of its source in the log (a semi join with the log, which prunes partitions). A batch that failed or whose writer died before the
log row stays invisible, and writing it again replaces its partitions, so a replay leaves one copy.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partition column of row tables, batch of a table's first load, name of the log.
BATCH, LOAD, LOG = "__batch", "load", "_commits"
COLUMNS = "source_id string, batch string, new_columns string, committed_at timestamp_ntz"


class CommitLog:
    """Append-only table, one row per committed batch; ``new_columns`` is a JSON object from table to added columns."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        self.name = f"`{database}`.`{LOG}`"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{LOG}")

    def create(self) -> None:
        if not self.exists():
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({COLUMNS}) USING parquet")

    def of(self, source_id: str) -> DataFrame:
        return self.spark.table(self.name).where(F.col("source_id") == source_id)

    def has(self, source_id: str, batch: str) -> bool:
        return self.exists() and not self.of(source_id).where(F.col("batch") == batch).isEmpty()

    def add(self, source_id: str, batch: str, new_columns: dict[str, list[str]] | None = None) -> None:
        """The commit: one file with one row appears in the log's folder."""
        row = (source_id, batch, json.dumps(new_columns or {}), _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
        self.spark.createDataFrame([row], COLUMNS).coalesce(1).write.insertInto(self.name)

    def added_columns(self) -> dict[str, list[str]]:
        """Table → columns that committed appends have added, in order of commit (one row per append that added any)."""
        out: dict[str, list[str]] = {}
        if self.exists():
            rows = self.spark.table(self.name).where("new_columns <> '{}'").orderBy("committed_at").select("new_columns")
            for r in rows.toLocalIterator():
                for table, columns in json.loads(r[0]).items():
                    held = out.setdefault(table, [])
                    held += [c for c in columns if c.lower() not in {h.lower() for h in held}]
        return out
