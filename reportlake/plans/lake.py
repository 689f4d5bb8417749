"""Managed report tables in the Spark catalog: ingest, append, truncate, drop, listing.

Every uploaded file is a *source*; a CSV gives one table, a workbook one table per
sheet. The rows of a table lie in a managed Parquet table partitioned by batch (``r_...``), and users read it through a view of
the table's name (``t_...``) that lists its columns and, once something was appended, keeps the batches in the commit
log (``plans/commits.py``); so all tables of an append change together or not at all. What the reference
keeps in a side database (display name, sheet, owning source, file name/type/size,
position inside the source) is kept as view properties, so the Spark catalog is the
only metadata store. Row data only ever moves through Spark jobs.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.operators.append import REPORT_SCHEMA, evolve
from reportlake.plans.commits import BATCH, LOAD, LOG, CommitLog
from reportlake.session import configure, scratch_dir
from reportlake.sources import csv as csv_src
from reportlake.sources.route import list_files, route_name

P = "reportlake."  # table-property prefix


class LakeError(ValueError):
    """A load or append could not be done; nothing visible was changed."""


# Fixed values that must equal the reference behaviour.
PREVIEW_DEFAULT, PREVIEW_MAX = 20, 200


@dataclass
class Preview:
    rows: DataFrame
    columns: list[tuple[str, str]]
    total: int


@dataclass
class TableInfo:
    physical_name: str
    display_name: str
    sheet: str | None
    source_id: str
    position: int


def _norm(path: str) -> str:
    p = path[5:] if path.startswith("file:") else path
    while p.startswith("//"):
        p = p[1:]
    return p.rstrip("/")


def _path_hash(path: str) -> str:
    return xxhash.xxh3_128_hexdigest(path.encode())


def physical_name(source_id: str, position: int) -> str:
    """Table name ``t_<source>_<sheet position>``: the tables of one upload share a name prefix, so they are
    found by one catalog lookup."""
    return f"t_{source_id[2:]}_{position}"


def source_id_of(path: str, upload: int = 1) -> str:
    """``s_<128-bit hash of the path>``; later uploads of the same path add ``u<number>``."""
    return "s_" + _path_hash(path) + (f"u{upload}" if upload > 1 else "")


def display_name_of(file_name: str) -> str:
    """CSV display name: file name without its last extension."""
    return file_name.rsplit(".", 1)[0] if "." in file_name else file_name


def _esc(v: str) -> str:
    return v.replace("\\", "\\\\").replace("'", "\\'")


class Lake:
    """A catalog database of report tables."""

    def __init__(self, spark: SparkSession, database: str = "reportlake", location: str | None = None):
        self.spark = configure(spark)
        self.db = database
        loc = location or scratch_dir(spark, f"lake-{database}")
        self._lock, self._given = threading.Lock(), {}  # uploads per path that this lake has named
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{_esc(loc)}'")
        self.log = CommitLog(spark, database)
        self.recover()

    # ---- names and lookups ---------------------------------------------------------------------
    def qualified(self, physical: str) -> str:
        return f"`{self.db}`.`{physical}`"

    def table(self, physical: str) -> DataFrame:
        """Scan of one table (Parquet: filters and projections push down)."""
        return self.spark.table(self.qualified(physical))

    def properties(self, physical: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(physical)}").collect()
        return {r["key"][len(P):]: r["value"] for r in rows if r["key"].startswith(P)}

    def storage(self, physical: str) -> str:
        """The table that holds the rows of a table, all batches of them."""
        return self.qualified("r_" + physical[2:])

    def table_names(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.db)
                      if not t.isTemporary and t.name != LOG and not t.name.startswith("r_"))

    def table_infos(self, source_id: str | None = None) -> list[TableInfo]:
        """Tables of one source (one catalog lookup by name prefix) or of all sources."""
        out = []
        if source_id is not None and source_id.startswith("s_"):
            names = sorted(t.name for t in self.spark.catalog.listTables(self.db, pattern=f"t_{source_id[2:]}_*")
                           if not t.isTemporary)
        else:
            names = self.table_names()
        for name in names:
            p = self.properties(name)
            if "source_id" not in p or (source_id is not None and p["source_id"] != source_id):
                continue
            out.append(TableInfo(name, p.get("display", name), p.get("sheet") or None, p["source_id"],
                                 int(p.get("position", "0"))))
        return sorted(out, key=lambda t: (t.source_id, t.position))

    def new_source_id(self, path: str) -> str:
        """Every upload is a source of its own, also when a path is loaded again."""
        stem = "t_" + _path_hash(path)
        with self._lock:
            taken = [self._given.get(path, 0)]
            for t in self.spark.catalog.listTables(self.db, pattern=f"{stem}*"):
                upload = t.name[len(stem):].split("_")[0]
                taken.append(int(upload[1:]) if upload else 1)
            self._given[path] = 1 + max(taken)
            return source_id_of(path, self._given[path])

    # ---- ingest ---------------------------------------------------------------------------------
    def _write_table(self, df: DataFrame, physical: str, props: dict[str, str],
                     partition_by: Sequence[str] | None = None) -> int:
        """Write a new table; returns its rows, counted while writing."""
        written = Observation()
        df = df.observe(written, F.count(F.lit(1)).alias("rows"))
        cols = [c for c in (partition_by or []) if c in df.columns]  # e.g. a date column: reports read only matching folders
        (df.withColumn(BATCH, F.lit(LOAD)).write.format("parquet").mode("errorifexists").partitionBy(BATCH, *cols)
         .saveAsTable(self.storage(physical)))
        shown = [c for c in df.columns if c not in cols] + cols
        kv = ", ".join(f"'{P}{k}'='{_esc(str(v))}'" for k, v in props.items())
        self.spark.sql(f"CREATE VIEW {self.qualified(physical)} TBLPROPERTIES ({kv}) AS {self._select(physical, shown)}")
        self.analyze(physical)
        return int(written.get["rows"])

    def _select(self, physical: str, columns: Sequence[str], source_id: str | None = None) -> str:
        """What a table shows: all rows of a table that was only loaded, the committed batches of its source otherwise."""
        names = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
        text = f"SELECT {names} FROM {self.storage(physical)}"
        if source_id is not None:
            text += f" WHERE `{BATCH}` IN (SELECT batch FROM {self.log.name} WHERE source_id = '{_esc(source_id)}')"
        return text

    def _show(self, physical: str, columns: Sequence[str], source_id: str) -> None:
        self.spark.sql(f"ALTER VIEW {self.qualified(physical)} AS {self._select(physical, columns, source_id)}")

    def analyze(self, physical: str) -> None:
        """Record the table's size in the catalog, where join planning (broadcast threshold) looks; NOSCAN lists
        files and reads none, so an append doesn't grow with the table."""
        self.spark.sql(f"ANALYZE TABLE {self.storage(physical)} COMPUTE STATISTICS NOSCAN")

    def _sheets(self, path: str, file_type: str, rejected: list[int]) -> list[tuple[str | None, DataFrame]]:
        if file_type == "csv":
            return [(None, csv_src.read_csv(self.spark, path, rejected=rejected))]
        from reportlake.sources.workbook import read_workbook

        return read_workbook(self.spark, path)

    def ingest_file(self, path: str, file_type: str, file_size: int = -1,
                    sheets: list[tuple[str | None, DataFrame]] | None = None,
                    partition_by: Sequence[str] | None = None, bad_cells: list[int] | None = None) -> list[dict]:
        """Load one file as a new source; all its tables appear, or none do (tables made so far are dropped).
        Sheets without cells make no table and say so in their row."""
        name = path.rstrip("/").rsplit("/", 1)[-1]
        sid = self.new_source_id(path)
        created, out = [], []
        rejected: list[int] = []
        try:
            if sheets is None:
                sheets = self._sheets(path, file_type, rejected)
            for pos, (sheet, df) in enumerate(sheets):
                row = {"source_id": sid, "file_name": name, "file_type": file_type, "file_size": file_size, "sheet": sheet}
                if not df.columns:
                    out.append({**row, "rejected_reason": "no cells"})
                    continue
                phys = physical_name(sid, pos)
                display = sheet if sheet is not None else display_name_of(name)
                created.append(phys)
                rows = self._write_table(df, phys, {
                    "source_id": sid, "source_file": name, "source_type": file_type,
                    "source_size": file_size, "display": display, "sheet": sheet or "",
                    "position": pos, "created_at": _dt.datetime.now(_dt.timezone.utc).isoformat(),
                }, partition_by)
                out.append({**row, "physical_name": phys, "display_name": display, "rows": rows,
                            "n_columns": len(df.columns), "bad_cells": bad_cells[pos] if bad_cells else None,
                            "rejected_rows": rejected[0] if rejected else None})
        except Exception as exc:
            for phys in created:
                self.drop_table(phys)
            raise LakeError(f"load of {name} failed, nothing kept: {exc}") from exc
        return out

    def ingest(self, paths: Sequence[str] | str, partition_by: Sequence[str] | None = None,
               parallel: int = 4) -> DataFrame:
        """Bulk load: each given path (a file, or a folder of parts such as Spark writes) is one
        upload, routed by the extension of its name. Returns the manifest: one row per table
        made, plus one row per rejected upload or empty sheet with its reason; an upload that fails leaves the
        others as they are.

        Up to ``parallel`` uploads are loaded at once from driver threads (Spark runs their jobs
        concurrently), so many small files do not queue behind each other's job overheads."""
        paths = [paths] if isinstance(paths, str) else list(paths)
        files = list_files(self.spark, paths).select("path", "file_size").collect()  # listing: metadata only
        sizes = dict.fromkeys((_norm(p) for p in paths), 0)
        for f in files:
            at = _norm(f["path"])
            while at and at not in sizes:  # the upload is the file or one of the folders above it
                at = at.rpartition("/")[0]
            if at:
                sizes[at] += f["file_size"]
        excel = [p for p in paths if route_name(_norm(p).rsplit("/", 1)[-1])[0] == "excel"]
        books, bad, failed = {}, {}, {}
        if excel:  # all workbooks parsed by one job, keyed by normalised path
            from reportlake.sources.workbook import read_workbooks

            found = read_workbooks(self.spark, excel)
            books, bad, failed = ({_norm(k): v for k, v in part.items()}
                                  for part in (found.sheets, found.bad_cells, found.failures))

        def load(p: str) -> list[dict]:
            root = _norm(p)
            name = root.rsplit("/", 1)[-1]
            ftype, reason = route_name(name)
            if ftype is not None and root not in failed:
                try:
                    return self.ingest_file(p, ftype, sizes[root], books.get(root) if ftype == "excel" else None,
                                            partition_by, bad.get(root))
                except LakeError as exc:
                    reason = str(exc)
            return [{"file_name": name, "file_type": ftype, "file_size": sizes[root],
                     "rejected_reason": failed.get(root, reason)}]

        if parallel > 1 and len(paths) > 1:
            from concurrent.futures import ThreadPoolExecutor

            with ThreadPoolExecutor(max_workers=parallel) as pool:
                results = list(pool.map(load, paths))  # input order kept
        else:
            results = [load(p) for p in paths]
        rows = [r for rs in results for r in rs]
        return self.spark.createDataFrame(rows, MANIFEST_SCHEMA)

    def ingest_folder(self, folder: str) -> DataFrame:
        """Every file under ``folder`` is its own upload."""
        files = list_files(self.spark, folder).orderBy("path").select("path").collect()
        return self.ingest([f["path"] for f in files])

    # ---- append ---------------------------------------------------------------------------------
    def append(self, source_id: str, path: str, file_type: str | None = None,
               sheets: list[tuple[str | None, DataFrame]] | None = None, batch: str | None = None) -> DataFrame:
        """Append a new file to the tables of a source, pairing sheets with tables by position.

        Two phases. First the new rows of every paired table, shaped to the evolved schema (target types, new
        columns as STRING), are written as partition ``batch`` of its row table, which readers don't see; whatever fails there
        (a bad value, surplus fields, a lost disk) leaves rows and columns of all tables as they were. Then one row in
        the commit log makes them part of all tables at once, and the views show the new columns.
        Old data is never rewritten: the cost is O(new rows). ``sheets`` gives the new rows directly. A ``batch``
        that is in the log already is not applied again, and one that was left before its commit is replaced.
        """
        targets = self.table_infos(source_id)
        if not targets:
            raise LakeError(f"source {source_id} has no tables to append to")
        if file_type is None and sheets is None:
            name = _norm(path).rsplit("/", 1)[-1]
            file_type, problem = route_name(name) if "." in name else ("csv", None)  # a folder of CSV parts
            if file_type not in ("csv", "excel"):
                raise LakeError(f"cannot append {path}: {problem or 'file type not supported'}")
        rejected: list[int] = []
        if sheets is None:
            sheets = self._sheets(path, file_type, rejected)
        if any(rejected):
            raise LakeError(f"append of {path} failed, nothing changed: {rejected[0]} rows have surplus fields")
        # by the sheet's place at load: an empty sheet made no table but keeps its place
        own_place = len({t.position for t in targets}) == len(targets)
        place = {t.physical_name: t.position if own_place else i for i, t in enumerate(targets)}
        batch = batch or uuid.uuid4().hex
        if self.log.has(source_id, batch):
            return self.spark.createDataFrame([self._skipped(t.physical_name, "already applied") for t in targets], REPORT_SCHEMA)
        paired = [t.physical_name for t in targets if place[t.physical_name] < len(sheets)]
        try:
            self._open(source_id, targets)
            staged = {p: self._stage(p, sheets[place[p]][1], batch) for p in paired}
        except Exception as exc:
            raise LakeError(f"append of {path} failed, nothing changed: {exc}") from exc
        before = {t.physical_name: self.table(t.physical_name).count() for t in targets}
        self._commit(source_id, batch, {p: diff.new for p, (_, diff) in staged.items() if diff.new})
        self.recover({p: diff.new for p, (_, diff) in staged.items()})
        reports = []
        for p in (t.physical_name for t in targets):
            if p in staged:
                rows, diff = staged[p]
                self.analyze(p)
                reports.append((p, before[p], rows, before[p] + rows, diff.new, diff.matched, diff.missing, False, None))
            else:
                reports.append(self._skipped(p, f"the new file has {len(sheets)} sheets, fewer than the {len(targets)} "
                                                "target tables; skipped", before[p]))
        return self.spark.createDataFrame(reports, REPORT_SCHEMA)

    def _skipped(self, physical: str, reason: str, before: int | None = None) -> tuple:
        before = self.table(physical).count() if before is None else before
        return (physical, before, 0, before, [], [], [], True, reason)

    def append_many(self, source_id: str, paths: Sequence[str]) -> DataFrame:
        """Append several files in the given order; one report row per (file, table)."""
        reps = [self.append(source_id, p).withColumn("file", F.lit(p)) for p in paths]
        return reduce(DataFrame.unionByName, reps)

    def _open(self, source_id: str, targets: list[TableInfo]) -> None:
        """Before a source's first append its load goes into the log and its views begin to follow the log."""
        if self.log.has(source_id, LOAD):
            return
        self.log.create()
        self.log.add(source_id, LOAD)
        for t in targets:
            self._show(t.physical_name, self.table(t.physical_name).columns, source_id)

    def _stage(self, physical: str, new_rows: DataFrame, batch: str):
        """Write the new rows as a partition of their own, replacing what an earlier try left there; readers don't see them."""
        shaped, diff = evolve(new_rows, self.table(physical).schema)
        held = {c.lower() for c in self.spark.table(self.storage(physical)).columns}
        fresh = [c for c in diff.new if c.lower() not in held]  # an append that failed may have left some
        if fresh:
            cols = ", ".join(f"`{c}` STRING" for c in fresh)
            self.spark.sql(f"ALTER TABLE {self.storage(physical)} ADD COLUMNS ({cols})")
        written = Observation()
        by_name = {c.lower(): c for c in shaped.columns}
        rows = shaped.observe(written, F.count(F.lit(1)).alias("rows")).select(*[
            F.col(f"`{by_name[f.name.lower()]}`").alias(f.name) if f.name.lower() in by_name else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.spark.table(self.storage(physical)).schema.fields if f.name != BATCH])
        self._overwrite(physical, batch, rows)
        return int(written.get["rows"]), diff  # counted while writing

    def _overwrite(self, physical: str, batch: str, rows: DataFrame) -> None:
        """One batch's partition of the row table gets these rows; the other partitions stay."""
        view = f"__batch_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        parts = [f"`{BATCH}`='{_esc(batch)}'"]  # the table's own partition columns stay dynamic and come last, as they lie
        parts += [f"`{c.name}`" for c in self.spark.catalog.listColumns(self.storage(physical)) if c.isPartition and c.name != BATCH]
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.storage(physical)} PARTITION ({', '.join(parts)}) SELECT * FROM `{view}`")
        finally:
            self.spark.catalog.dropTempView(view)

    def _commit(self, source_id: str, batch: str, new_columns: dict[str, list[str]]) -> None:
        self.log.add(source_id, batch, new_columns)

    def recover(self, new_columns: dict[str, list[str]] | None = None) -> None:
        """Let the views show the columns of committed appends (all of them when a database is opened: a writer may
        have died right after its commit)."""
        if new_columns is None:
            new_columns = self.log.added_columns()
        for physical, columns in new_columns.items():
            if columns and self.spark.catalog.tableExists(f"{self.db}.{physical}"):
                shown = self.table(physical).columns
                held = {c.lower() for c in shown}
                if any(c.lower() not in held for c in columns):
                    self._show(physical, [*shown, *(c for c in columns if c.lower() not in held)],
                               self.properties(physical)["source_id"])

    def clear_left_batches(self, source_id: str) -> int:
        """Remove partitions that no commit made part of the tables (their writer failed or died); not while appends run."""
        cleared = 0
        if not self.log.has(source_id, LOAD):
            return cleared
        for t in self.table_infos(source_id):
            name = self.storage(t.physical_name)
            left = (self.spark.table(name).select(BATCH).distinct()
                    .join(self.log.of(source_id), F.col(BATCH) == F.col("batch"), "left_anti").collect())  # one row per failure
            for r in left:
                self._overwrite(t.physical_name, r[0], self.spark.createDataFrame([], self.spark.table(name).drop(BATCH).schema))
                cleared += 1
        return cleared

    # ---- maintenance ----------------------------------------------------------------------------
    def truncate(self, source_id: str, physical: str) -> None:
        """Delete all rows, keep the schema; the table must belong to the source."""
        if self.properties(physical).get("source_id") != source_id:
            raise LakeError(f"table {physical} does not belong to source {source_id}")
        self.spark.sql(f"TRUNCATE TABLE {self.storage(physical)}")
        self.analyze(physical)

    def drop_table(self, physical: str) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.qualified(physical)}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.storage(physical)}")

    def drop_source(self, source_id: str) -> int:
        """Cascade delete: every table of the source; returns how many were dropped."""
        infos = self.table_infos(source_id)
        for t in infos:
            self.drop_table(t.physical_name)
        return len(infos)

    # ---- preview ---------------------------------------------------------------------------------
    def preview(self, source_id: str, physical: str, rows: int = PREVIEW_DEFAULT, order_by: Sequence[str] | None = None) -> Preview:
        """The first rows of a table (200 at most), its columns and its number of rows; the table must belong to the source."""
        if physical not in {t.physical_name for t in self.table_infos(source_id)}:
            raise LakeError(f"table {physical} does not belong to source {source_id}")
        table = self.table(physical)
        shown = table.orderBy(*order_by) if order_by else table
        return Preview(shown.limit(min(max(int(rows), 0), PREVIEW_MAX)), [(f.name, sql_type_name(f.dataType)) for f in table.schema.fields], table.count())

    # ---- listing --------------------------------------------------------------------------------
    def row_counts(self, physicals: Sequence[str] | None = None) -> DataFrame:
        """Exact row counts of many tables in one job (a union of per-table counts)."""
        names = list(physicals) if physicals is not None else self.table_names()
        parts = [self.table(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("physical_name"), "rows")
                 for n in names]
        if not parts:
            return self.spark.createDataFrame([], "physical_name string, rows bigint")
        return reduce(DataFrame.unionByName, parts)

    def listing(self, source_id: str | None = None) -> DataFrame:
        """display name, physical name, sheet, source and row count of every table."""
        infos = self.table_infos(source_id)
        meta = self.spark.createDataFrame(
            [(t.source_id, t.position, t.physical_name, t.display_name, t.sheet) for t in infos],
            "source_id string, position int, physical_name string, display_name string, sheet string")
        return meta.join(self.row_counts([t.physical_name for t in infos]), "physical_name", "left")

    def sources(self, page: int = 0, size: int = 20) -> DataFrame:
        """One row per source (newest first), paged."""
        rows = {}
        for name in self.table_names():
            p = self.properties(name)
            if "source_id" in p:
                rows.setdefault(p["source_id"], (p["source_id"], p.get("source_file"), p.get("source_type"),
                                                 int(p.get("source_size", "-1")), p.get("created_at")))
        df = self.spark.createDataFrame(list(rows.values()),
                                        "source_id string, file_name string, file_type string, "
                                        "file_size bigint, created_at string")
        from reportlake.plans.gateway import page_of

        return page_of(df.orderBy(F.desc("created_at"), "source_id"), page, size)

    def tree(self, source_id: str | None = None) -> DataFrame:
        """source → tables → (rows, columns) as one nested DataFrame."""
        infos = self.table_infos(source_id)
        cols = []
        for t in infos:
            for i, f in enumerate(self.table(t.physical_name).schema.fields):
                cols.append((t.physical_name, i, f.name, sql_type_name(f.dataType)))
        cdf = self.spark.createDataFrame(cols, "physical_name string, ordinal int, name string, type string")
        per_table = (cdf.groupBy("physical_name")
                     .agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "name", "type"))),
                                      lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type")))
                          .alias("columns")))
        tables = self.listing(source_id).join(per_table, "physical_name", "left")
        return (tables.groupBy("source_id")
                .agg(F.array_sort(F.collect_list(F.struct("position", "physical_name", "display_name", "sheet",
                                                          "rows", "columns"))).alias("tables")))


MANIFEST_SCHEMA = T.StructType([
    T.StructField("source_id", T.StringType()), T.StructField("file_name", T.StringType()),
    T.StructField("file_type", T.StringType()), T.StructField("file_size", T.LongType()),
    T.StructField("physical_name", T.StringType()), T.StructField("display_name", T.StringType()),
    T.StructField("sheet", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("n_columns", T.LongType()), T.StructField("rejected_reason", T.StringType()),
    T.StructField("rejected_rows", T.LongType()), T.StructField("bad_cells", T.LongType()),
])


def sql_type_name(dt: T.DataType) -> str:
    """SQL type names shown to users (BIGINT, VARCHAR, TIMESTAMP, ...)."""
    simple = {
        T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT", T.ByteType: "TINYINT",
        T.DoubleType: "DOUBLE", T.FloatType: "FLOAT", T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN",
        T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        T.BinaryType: "BLOB",
    }
    for k, v in simple.items():
        if isinstance(dt, k):
            return v
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return sql_type_name(dt.elementType) + "[]"
    if isinstance(dt, T.StructType):
        return "STRUCT(" + ", ".join(f"{f.name} {sql_type_name(f.dataType)}" for f in dt.fields) + ")"
    if isinstance(dt, T.MapType):
        return f"MAP({sql_type_name(dt.keyType)}, {sql_type_name(dt.valueType)})"
    return dt.simpleString().upper()
