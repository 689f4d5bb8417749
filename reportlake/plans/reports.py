"""Saved reports: named SQL kept in an append-only registry table.

Every create, update and delete is one appended event row; the current registry is
the latest event per report id (a ``max_by`` aggregation), so the registry is never
rewritten in place. Each live report is also a temp view of its name, so reports can
be queried from other reports.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.plans import gateway

REGISTRY_COLUMNS = "id bigint, name string, sql string, description string, op string, ts timestamp_ntz"


def new_report_id() -> int:
    """A generated id: a report keeps it when it is renamed, and no other report gets it."""
    return uuid.uuid4().int >> 65


def blank_keeps(new: Column, old: Column) -> Column:
    """Partial-update rule: a NULL or blank new value keeps the old one."""
    return F.coalesce(F.nullif(F.trim(new), F.lit("")), old)


def merge_partial(current: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Apply partial updates: for each row of ``changes`` (same key), blank fields keep the old
    value; ``changed`` tells whether anything differs. Rows without a change pass through."""
    ch = changes.select(key, *[F.col(f).alias(f"__new_{f}") for f in fields])
    j = current.join(ch, key, "left")
    merged = [blank_keeps(F.col(f"__new_{f}"), F.col(f)).alias(f) for f in fields]
    changed = F.lit(False)
    for f in fields:
        changed = changed | ~blank_keeps(F.col(f"__new_{f}"), F.col(f)).eqNullSafe(F.col(f))
    rest = [c for c in current.columns if c != key and c not in fields]
    return j.select(key, *merged, *rest, changed.alias("changed"))


def batch_delete(current: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(remaining rows, one-row count of ids that existed and were deleted)``."""
    remaining = current.join(ids, key, "left_anti")
    deleted = current.join(ids, key, "left_semi").agg(F.count("*").alias("deleted"))
    return remaining, deleted


class Reports:
    """Registry of saved reports stored as a table in ``database``."""

    def __init__(self, spark: SparkSession, database: str = "reportlake", table: str = "_reports"):
        self.spark = spark
        self.name = f"`{database}`.`{table}`"
        if not spark.catalog.tableExists(f"{database}.{table}"):
            spark.createDataFrame([], REGISTRY_COLUMNS).write.format("parquet").saveAsTable(self.name)

    def _log(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, REGISTRY_COLUMNS).write.insertInto(self.name)

    def current(self) -> DataFrame:
        """Live reports: the latest event of each id, deletes removed."""
        ev = self.spark.table(self.name)
        last = ev.groupBy("id").agg(F.max_by(F.struct(*[c for c in ev.columns if c != "id"]), "ts").alias("e"),
                                    F.min("ts").alias("created_at"))
        return last.select("id", "e.*", "created_at").where(F.col("op") != "delete").drop("op").withColumnRenamed("ts", "updated_at")

    def save(self, name: str, sql: str, description: str = "") -> int:
        """Create, or replace the live report of that name; the SQL is screened and analysed first (even for
        agent callers), and the report is logged last."""
        if not name or not name.strip():
            raise ValueError("a report needs a name")
        same = self.current().where(F.col("name") == name).select("id").collect()
        rid = same[0]["id"] if same else new_report_id()
        self._view(name, sql)
        self._log([(rid, name, sql, description, "upsert", _dt.datetime.now())])
        return rid

    def _view(self, name: str, sql: str) -> None:
        gateway.sql(self.spark, sql).createOrReplaceTempView("`" + name.replace("`", "``") + "`")

    def open_views(self) -> list[str]:
        """Make the live reports queryable by name in this session (views last as long as a session)."""
        live = self.current().select("name", "sql").collect()
        for r in live:
            self._view(r["name"], r["sql"])
        return sorted(r["name"] for r in live)

    def get(self, rid: int):
        rows = self.current().where(F.col("id") == rid).collect()
        if not rows:
            raise KeyError(f"report {rid} does not exist")
        return rows[0]

    def update(self, rid: int, name: str | None = None, sql: str | None = None,
               description: str | None = None) -> bool:
        """Partial update: blank or None keeps the old value. Returns False when nothing changed."""
        old = self.get(rid)
        keep = lambda new, prev: prev if new is None or not str(new).strip() else new
        new = (keep(name, old["name"]), keep(sql, old["sql"]), keep(description, old["description"]))
        if new == (old["name"], old["sql"], old["description"]):
            return False
        if new[0] != old["name"] and not self.current().where(F.col("name") == new[0]).isEmpty():
            raise ValueError(f"there is a report named {new[0]}")
        self._view(new[0], new[1])
        self._log([(rid, *new, "upsert", _dt.datetime.now())])
        if new[0] != old["name"]:
            self.spark.catalog.dropTempView(old["name"])
        return True

    def delete(self, ids: list[int]) -> int:
        """Delete the ids that exist; returns how many were deleted."""
        live = self.current().where(F.col("id").isin(list(ids))).select("id", "name").collect()
        now = _dt.datetime.now()
        if live:
            self._log([(r["id"], None, None, None, "delete", now) for r in live])
        for r in live:
            self.spark.catalog.dropTempView(r["name"])
        return len(live)

    def list(self, page: int = 0, size: int = 50) -> DataFrame:
        return gateway.page_of(self.current().orderBy(F.desc("updated_at"), "id"), page, size)

    def run(self, rid: int, page: int = 0, size: int = gateway.DEFAULT_PAGE_SIZE) -> gateway.Page:
        return gateway.run_sql(self.spark, self.get(rid)["sql"], page, size)

    def export(self, rid: int, path: str, fmt: str = "csv", **kw) -> None:
        """Write the report's whole result (no row cap) as csv, parquet or json."""
        from reportlake.sinks.export import export

        export(gateway.sql(self.spark, self.get(rid)["sql"]), path, fmt, **kw)
