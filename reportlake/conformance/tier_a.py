"""Tier A: the logic the reference writes itself — ingest, append, maintenance, catalog,
gateway paging, saved reports, export and chat-log shaping — checked on the given tables.

Cases that load files first write the given tables to the shared scratch folder with
Spark, then run the library on those files.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.conformance import fixtures
from reportlake.conformance.registry import case, t
from reportlake.operators import append as ap
from reportlake.operators import chatlog, relational as rel
from reportlake.plans import gateway, lake as lk, reports as rp
from reportlake.plans.catalog import catalog_rows, column_table, preview, profile, row_counts
from reportlake.session import scratch_dir
from reportlake.sinks import export as ex
from reportlake.sources import csv as csv_src
from reportlake.sources import workbook as wb
from reportlake.sources.files import read_file
from reportlake.sources.headers import dedupe_names, sanitize_header
from reportlake.sources.parquet import TEST_TABLES, register_dir
from reportlake.sources.route import route

CONF_DB = "reportlake_conformance"


def _lake(spark) -> lk.Lake:
    return lk.Lake(spark, CONF_DB)


def _write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def _ingest_one(spark, df: DataFrame, name: str, sep: str = ",") -> tuple[lk.Lake, dict]:
    lake = _lake(spark)
    path = _write_csv(df, f"{scratch_dir(spark, 'upload')}/{name}.csv", sep)
    return lake, lake.ingest_file(path, "csv")[0]


# ---- A: sources / ingest --------------------------------------------------------------------------
@case("csv_ingest", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
                    "c_mktsegment FROM customer")
def csv_ingest(spark, d):
    lake, info = _ingest_one(spark, t(spark, d, "customer"), "customer")
    return lake.table(info["physical_name"])


@case("csv_sniff", "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def csv_sniff(spark, d):
    path = _write_csv(t(spark, d, "supplier"), f"{scratch_dir(spark, 'upload')}/supplier.csv", sep=";")
    return csv_src.read_csv(spark, path)


@case("ctas_count", "SELECT * FROM orders")
def ctas_count(spark, d):
    lake, info = _ingest_one(spark, t(spark, d, "orders"), "orders")
    return lake.table(info["physical_name"])


@case("lenient_cast", """
SELECT 'source_no' AS column_name, 'bigint' AS target_type, count(source) AS n_cells,
       count(*) FILTER (WHERE try_cast(replace(source, 'src', '') AS BIGINT) IS NULL) AS n_bad FROM documents
UNION ALL
SELECT 'lang', 'bigint', count(lang), count(*) FILTER (WHERE try_cast(lang AS BIGINT) IS NULL) FROM documents
UNION ALL
SELECT 'n_chars', 'date', count(n_chars), count(*) FROM documents""")
def lenient_cast(spark, d):
    docs = t(spark, d, "documents").select(F.regexp_replace("source", "src", "").alias("source_no"), "lang",
                                           F.col("n_chars").cast("string").alias("n_chars"))
    return csv_src.bad_cell_counts(docs, {"source_no": "bigint", "lang": "bigint", "n_chars": "date"})


_ROUTE_PATH = """concat('/uploads/', regexp_extract(url, '^https?://([^/]+)/', 1), '/',
       regexp_extract(url, '/([^/?#]*)([?#].*)?$', 1),
       CASE WHEN regexp_extract(url, '/([^/?#]*)([?#].*)?$', 1) LIKE '%.%' THEN ''
            WHEN url LIKE '%/en/%' THEN '.csv' WHEN url LIKE '%/fr/%' THEN '.XLSX'
            WHEN url LIKE '%/de/%' THEN '.Txt' WHEN url LIKE '%/es/%' THEN '.xls' ELSE '' END)"""


@case("route_files", f"""
WITH p AS (SELECT page_id, {_ROUTE_PATH} AS path FROM pages),
     n AS (SELECT page_id, path, regexp_extract(path, '([^/\\\\]*)$', 1) AS file_name FROM p),
     e AS (SELECT *, lower(regexp_extract(file_name, '\\.([^.]*)$', 1)) AS extension FROM n)
SELECT page_id, path, file_name, extension,
       CASE WHEN extension IN ('csv', 'txt') THEN 'csv' WHEN extension IN ('xls', 'xlsx') THEN 'excel' END AS file_type,
       extension IN ('csv', 'txt', 'xls', 'xlsx') AS accepted,
       CASE WHEN extension NOT IN ('csv', 'txt', 'xls', 'xlsx') THEN 'unsupported file type: .' || extension END
         AS reason
FROM e""")
def route_files(spark, d):
    pages = t(spark, d, "pages").select("page_id", F.expr(_ROUTE_PATH).alias("path"))
    return route(pages)


_CSV_CASES = "SELECT c_custkey, c_name, c_acctbal FROM customer"


@case("csv_surplus", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 1 THEN NULL ELSE c_acctbal END AS c_acctbal,
       (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0) AS rejected
FROM customer WHERE c_custkey % 5 <> 0""")
def csv_surplus(spark, d):
    c = t(spark, d, "customer")
    line = F.concat_ws(",", "c_custkey", "c_name", F.when(F.col("c_custkey") % 5 != 1, F.col("c_acctbal")),
                       F.when(F.col("c_custkey") % 5 == 0, F.lit("surplus")))
    path = f"{scratch_dir(spark, 'upload')}/surplus.csv"
    head = spark.createDataFrame([("c_custkey,c_name,c_acctbal",)], "value string")
    head.unionByName(c.select(line.alias("value"))).coalesce(1).write.text(path)  # one file: header, then the rows
    return csv_src.read_csv(spark, path).withColumn("rejected", F.lit(csv_src.csv_rejects(spark, path).count()).cast("long"))


@case("csv_multiline", """
SELECT c_custkey, c_name || chr(10) || '5" "pipe",' || c_mktsegment AS note, c_acctbal FROM customer""")
def csv_multiline(spark, d):
    note = F.concat("c_name", F.lit('\n5" "pipe",'), "c_mktsegment")
    path = f"{scratch_dir(spark, 'upload')}/notes.csv"
    (t(spark, d, "customer").select("c_custkey", note.alias("note"), "c_acctbal")
     .write.option("header", True).option("escape", '"').csv(path))
    return csv_src.read_csv(spark, path)


@case("csv_mixed_parts", _CSV_CASES)
def csv_mixed_parts(spark, d):
    c = t(spark, d, "customer")
    path = f"{scratch_dir(spark, 'upload')}/parts.csv"
    c.where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(path)
    (c.where("c_custkey % 2 = 1").select("c_acctbal", F.col("c_name").alias("C_NAME"), "c_custkey")
     .write.mode("append").option("header", True).csv(path))
    got = csv_src.read_csv(spark, path)
    return got.select("c_custkey", F.col("c_name").alias("c_name"), "c_acctbal")


@case("csv_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dmy, CAST(o_orderdate AS DATE) AS ymd FROM orders")
def csv_dates(spark, d):
    path = f"{scratch_dir(spark, 'upload')}/dates.csv"
    (t(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("dmy"),
                                  F.date_format("o_orderdate", "yyyy/MM/dd").alias("ymd"))
     .write.option("header", True).csv(path))
    return csv_src.read_csv(spark, path)


@case("reingest", """
SELECT 1 AS upload, s_suppkey, s_name FROM supplier UNION ALL SELECT 2, s_suppkey, s_name FROM supplier""")
def reingest(spark, d):
    lake = _lake(spark)
    path = _write_csv(t(spark, d, "supplier"), f"{scratch_dir(spark, 'upload')}/supplier.csv")
    made = [lake.ingest_file(path, "csv")[0]["physical_name"] for _ in range(2)]
    return reduce(DataFrame.unionByName, [lake.table(n).select(F.lit(i).alias("upload"), "s_suppkey", "s_name")
                                          for i, n in enumerate(made, 1)])


_SANITIZE_SQL = """CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'COL'
  ELSE coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(trim({c}), '[^\\p{{L}}\\p{{N}}_]', '_', 'g'),
                                                     '_+', '_', 'g'), '^_|_$', '', 'g'), ''), 'COL') END"""


@case("sanitize_header", f"SELECT page_id, {_SANITIZE_SQL.format(c='url')} AS name FROM pages")
def sanitize_header_q(spark, d):
    return t(spark, d, "pages").select("page_id", sanitize_header("url").alias("name"))


@case("dedupe_header", """
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations WHERE text IS NOT NULL),
     u AS (SELECT conv_id, turn, unnest(w) AS name, unnest(range(len(w))) AS i FROM w),
     r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, lower(name) ORDER BY i) AS n FROM u)
SELECT conv_id, turn, string_agg(CASE WHEN n = 1 THEN name ELSE name || '_' || (n - 1) END, ' ' ORDER BY i) AS header
FROM r GROUP BY conv_id, turn""")
def dedupe_header_q(spark, d):
    """Every message's words as a header list, through the function that file headers go through."""
    @F.pandas_udf("string")
    def unique(text: pd.Series) -> pd.Series:
        return text.map(lambda v: " ".join(dedupe_names(v.split(" "))))

    turns = t(spark, d, "conversations").where("text IS NOT NULL")
    return turns.select("conv_id", "turn", unique("text").alias("header"))


@case("scan_table", "SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 1")
def scan_table(spark, d):
    register_dir(spark, d)
    return spark.table("supplier").where(F.col("s_nationkey") == 1).select("s_suppkey", "s_name")


@case("read_parquet_file", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 9000")
def read_parquet_file(spark, d):
    return (read_file(spark, f"{d}/customer.parquet", "parquet")
            .where(F.col("c_acctbal") > 9000).select("c_custkey", "c_name", "c_acctbal"))


@case("ingest_manifest", """
SELECT 'customer.csv' AS file_name, 'csv' AS file_type, 'customer' AS display_name, count(*) AS rows,
       CAST(5 AS BIGINT) AS n_columns FROM customer
UNION ALL SELECT 'nation.csv', 'csv', 'nation', count(*), 3 FROM nation
UNION ALL SELECT 'region.csv', 'csv', 'region', count(*), 2 FROM region
UNION ALL SELECT 'notes.md', NULL, NULL, NULL, NULL""")
def ingest_manifest(spark, d):
    up = scratch_dir(spark, "upload")
    paths = [_write_csv(t(spark, d, n), f"{up}/{n}.csv") for n in ("customer", "nation", "region")]
    notes = f"{up}/notes.md"
    t(spark, d, "region").select(F.concat_ws(" ", "r_name").alias("value")).write.text(notes)
    man = _lake(spark).ingest(paths + [notes])
    return man.select("file_name", "file_type", "display_name", "rows", "n_columns")


# ---- A03/A04/B04: workbooks ------------------------------------------------------------------------
def _customer_workbooks(spark, d) -> str:
    out = scratch_dir(spark, "workbooks")
    fixtures.write_customer_workbooks(t(spark, d, "customer"), out)
    return out


@case("workbook_ingest", """
SELECT 'customers' AS sheet, c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
       CAST(NULL AS BIGINT) AS n_customers FROM customer
UNION ALL
SELECT 'nations', NULL, NULL, c_nationkey, NULL, NULL, count(*) FROM customer
GROUP BY c_mktsegment, c_custkey // 50000, c_nationkey""")
def workbook_ingest(spark, d):
    folder = _customer_workbooks(spark, d)
    lake = _lake(spark)
    man = lake.ingest_folder(folder).select("sheet", "physical_name").collect()
    parts = [lake.table(r["physical_name"]).withColumn("sheet", F.lit(r["sheet"])) for r in man]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@case("workbook_bad_cell", """
WITH c AS (SELECT *, c_custkey % 7 = 0 AND c_custkey <> min(c_custkey) OVER (PARTITION BY c_mktsegment, c_custkey // 50000)
                     AS bad FROM customer)
SELECT c_custkey, CASE WHEN NOT bad THEN c_acctbal END AS c_acctbal,
       CAST((SELECT count(*) FROM c WHERE bad) AS BIGINT) AS bad_cells FROM c""")
def workbook_bad_cell(spark, d):
    folder = scratch_dir(spark, "workbooks")
    fixtures.write_customer_workbooks(t(spark, d, "customer"), folder, text_every=7)
    lake = _lake(spark)
    man = lake.ingest_folder(folder).where(F.col("sheet") == "customers").collect()
    got = reduce(DataFrame.unionByName, [lake.table(r["physical_name"]) for r in man])
    return got.select("c_custkey", "c_acctbal", F.lit(sum(r["bad_cells"] for r in man)).cast("long").alias("bad_cells"))


@case("workbook_sheets", """
SELECT DISTINCT c_mktsegment || '-' || CAST(c_custkey // 50000 AS VARCHAR) || '.xlsx' AS file_name,
       0 AS sheet_idx, 'customers' AS sheet FROM customer
UNION ALL
SELECT DISTINCT c_mktsegment || '-' || CAST(c_custkey // 50000 AS VARCHAR) || '.xlsx', 1, 'nations' FROM customer""")
def workbook_sheets(spark, d):
    folder = _customer_workbooks(spark, d)
    s = wb.workbook_sheets(spark, folder)
    return s.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"), "sheet_idx", "sheet")


@case("workbook_to_csv", """
SELECT 'customers' AS sheet, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS line
FROM (SELECT DISTINCT c_mktsegment, c_custkey // 50000 FROM customer)
UNION ALL
SELECT 'customers', CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || CAST(c_nationkey AS VARCHAR) || ','
       || CAST(c_acctbal AS VARCHAR) || ',' || c_mktsegment FROM customer
UNION ALL
SELECT 'nations', 'c_nationkey,n_customers' FROM (SELECT DISTINCT c_mktsegment, c_custkey // 50000 FROM customer)
UNION ALL
SELECT 'nations', CAST(c_nationkey AS VARCHAR) || ',' || CAST(count(*) AS VARCHAR)
FROM customer GROUP BY c_mktsegment, c_custkey // 50000, c_nationkey""")
def workbook_to_csv(spark, d):
    folder = _customer_workbooks(spark, d)
    out = scratch_dir(spark, "sheets-csv")
    wb.workbook_to_csv(spark, folder, out)
    return spark.read.text(out).select("sheet", F.col("value").alias("line"))


# ---- B: export -------------------------------------------------------------------------------------
def _csv_field_sql(v: str) -> str:
    return (f"coalesce(CASE WHEN regexp_matches(CAST({v} AS VARCHAR), '[,\"\\n]') "
            f"THEN '\"' || replace(CAST({v} AS VARCHAR), '\"', '\"\"') || '\"' ELSE CAST({v} AS VARCHAR) END, '')")


_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props", "tag"]


@case("csv_export_lines", "WITH e AS (SELECT *, event_type || ',' || CAST(user_id AS VARCHAR) AS tag FROM events) "
                          "SELECT " + " || ',' || ".join(_csv_field_sql(c) for c in _EV_COLS) + " AS line FROM e")
def csv_export_lines(spark, d):
    ev = t(spark, d, "events").withColumn("tag", F.concat_ws(",", "event_type", F.col("user_id").cast("string")))
    return ex.csv_lines(ev.select(*_EV_COLS))


@case("csv_export_page", "SELECT " + " || ',' || ".join(_csv_field_sql(c) for c in
                                                         ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
      + " AS line FROM (SELECT * FROM supplier ORDER BY s_suppkey LIMIT 20 OFFSET 20)")
def csv_export_page(spark, d):
    page = gateway.Page(t(spark, d, "supplier").orderBy("s_suppkey"), page=1, size=20)
    return ex.csv_lines(page.frame)


@case("export_formats", """
SELECT 'csv' AS fmt, s_suppkey, s_name FROM supplier
UNION ALL SELECT 'json', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'parquet', s_suppkey, s_name FROM supplier""")
def export_formats(spark, d):
    region = t(spark, d, "supplier").select("s_suppkey", "s_name")
    base = scratch_dir(spark, "export")
    parts = []
    for fmt in ("csv", "json", "parquet"):
        ex.export(region, f"{base}/{fmt}", fmt)
        back = read_file(spark, f"{base}/{fmt}", fmt)
        if fmt == "csv":  # the BOM belongs to the first header name only
            back = back.toDF(*[c.lstrip(ex.BOM) for c in back.columns])
        parts.append(back.select(F.lit(fmt).alias("fmt"), F.col("s_suppkey").cast("bigint").alias("s_suppkey"),
                                 "s_name"))
    return reduce(DataFrame.unionByName, parts)


# ---- C: append -------------------------------------------------------------------------------------
@case("append_diff", """
WITH s AS (SELECT upper(replace(column_name, 's_', 'c_')) AS name, ordinal_position AS o
           FROM information_schema.columns WHERE table_name = 'supplier'),
     t AS (SELECT column_name AS name, ordinal_position AS o FROM information_schema.columns
           WHERE table_name = 'customer')
SELECT (SELECT string_agg(name, ',' ORDER BY o) FROM s WHERE lower(name) NOT IN (SELECT lower(name) FROM t))
         AS new_columns,
       (SELECT string_agg(name, ',' ORDER BY o) FROM s WHERE lower(name) IN (SELECT lower(name) FROM t))
         AS matched_columns,
       (SELECT string_agg(name, ',' ORDER BY o) FROM t WHERE lower(name) NOT IN (SELECT lower(name) FROM s))
         AS missing_columns, (SELECT count(*) FROM supplier) AS rows_appended""")
def append_diff(spark, d):
    lake, info = _ingest_one(spark, t(spark, d, "customer"), "customer")
    sup = t(spark, d, "supplier")
    path = _write_csv(sup.toDF(*[c.replace("s_", "c_").upper() for c in sup.columns]), f"{scratch_dir(spark, 'upload')}/s.csv")
    rep = lake.append(info["source_id"], path)
    return rep.select(F.array_join("newColumns", ",").alias("new_columns"),
                      F.array_join("matchedColumns", ",").alias("matched_columns"),
                      F.array_join("missingColumns", ",").alias("missing_columns"), F.col("rowsAppended").alias("rows_appended"))


def _supplier_as_customer(spark, d) -> DataFrame:
    return t(spark, d, "supplier").select(
        F.col("s_suppkey").alias("C_CUSTKEY"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.concat(F.lit("supplier of nation "), F.col("s_nationkey").cast("string")).alias("origin"))


@case("append_new_cols", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
       CAST(NULL AS VARCHAR) AS origin FROM customer
UNION ALL
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT), s_acctbal, NULL, 'supplier of nation ' || s_nationkey
FROM supplier""")
def append_new_cols(spark, d):
    lake, info = _ingest_one(spark, t(spark, d, "customer"), "customer")
    path = _write_csv(_supplier_as_customer(spark, d), f"{scratch_dir(spark, 'upload')}/more.csv")
    lake.append(info["source_id"], path).collect()
    return lake.table(info["physical_name"])


@case("append_by_name", "SELECT * FROM orders")
def append_by_name(spark, d):
    o = t(spark, d, "orders")
    lake, info = _ingest_one(spark, o.where(F.col("o_orderstatus") == "F"), "orders")
    rest = o.where(F.col("o_orderstatus") != "F")
    reordered = rest.select(*[F.col(c).alias(c.upper()) for c in reversed(rest.columns)])
    path = _write_csv(reordered, f"{scratch_dir(spark, 'upload')}/orders_rest.csv")
    lake.append(info["source_id"], path).collect()
    return lake.table(info["physical_name"])


@case("append_pairing", """
SELECT 0 AS position, 2 * count(*) AS rows_after, count(*) AS rows_appended, false AS skipped,
       CAST(NULL AS VARCHAR) AS skip_reason FROM customer
UNION ALL SELECT 1, 2 * count(*), count(*), false, NULL FROM supplier
UNION ALL SELECT 2, count(*), 0, true, 'the new file has 2 sheets, fewer than the 3 target tables; skipped' FROM part""")
def append_pairing(spark, d):
    lake = _lake(spark)
    sheets = [(n, t(spark, d, n)) for n in ("customer", "supplier", "part")]
    info = lake.ingest_file(f"{scratch_dir(spark, 'upload')}/book.xlsx", "excel", sheets=sheets)
    rep = lake.append(info[0]["source_id"], "more.xlsx", sheets=sheets[:2])
    return rep.select(F.regexp_extract("tableName", "_([0-9]+)$", 1).cast("int").alias("position"),
                      F.col("rowsAfter").alias("rows_after"), F.col("rowsAppended").alias("rows_appended"),
                      "skipped", F.col("skipReason").alias("skip_reason"))


@case("append_atomic", """
SELECT 1 AS step, 'customer' AS display_name, count(*) AS rows, 5 AS n_columns FROM customer
UNION ALL SELECT 1, 'supplier', count(*), 4 FROM supplier
UNION ALL SELECT 2, 'customer', 2 * count(*), 6 FROM customer
UNION ALL SELECT 2, 'supplier', 2 * count(*), 5 FROM supplier""")
def append_atomic(spark, d):
    """Step 1: the second sheet of an append fails while it is written; step 2: the same append with a whole second sheet."""
    lake = _lake(spark)
    sheets = [(n, t(spark, d, n)) for n in ("customer", "supplier")]
    info = lake.ingest_file(f"{scratch_dir(spark, 'upload')}/pair.xlsx", "excel", sheets=sheets)
    more = [(n, df.withColumn("origin", F.lit("second upload"))) for n, df in sheets]
    last = more[1][1].agg(F.max("s_suppkey")).first()[0]
    broken = more[1][1].withColumn("s_name", F.when(F.col("s_suppkey") < last, F.col("s_name")).otherwise(F.raise_error(F.lit("lost"))))
    steps = []
    for step, second in ((1, broken), (2, more[1][1])):
        try:
            lake.append(info[0]["source_id"], "pair2.xlsx", sheets=[more[0], ("supplier", second)])
        except lk.LakeError:
            if step == 2:
                raise
        for row in info:
            now = lake.table(row["physical_name"])
            steps.append((step, row["display_name"], now.count(), len(now.columns)))
    return spark.createDataFrame(steps, "step int, display_name string, rows long, n_columns int")


@case("append_replay", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN o_orderstatus <> 'F' THEN 'later' END AS note FROM orders""")
def append_replay(spark, d):
    """A writer dies after its rows are written and before they are committed; the batch is replayed twice."""
    class Dies(lk.Lake):
        def _commit(self, source_id, batch, new_columns):
            raise SystemError("killed before the commit")

    o = t(spark, d, "orders")
    lake, info = _ingest_one(spark, o.where(F.col("o_orderstatus") == "F"), "orders_replay")
    rest = [(None, o.where(F.col("o_orderstatus") != "F").withColumn("note", F.lit("later")))]
    try:
        Dies(spark, lake.db).append(info["source_id"], "rest.csv", sheets=rest, batch="stream-0-0")
    except SystemError:
        pass
    for _ in range(2):
        lake.append(info["source_id"], "rest.csv", sheets=rest, batch="stream-0-0")
    return lake.table(info["physical_name"])


@case("append_report", """
WITH c AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)
SELECT 1 AS step, (SELECT n FROM c WHERE s = 'F') AS rows_before, (SELECT n FROM c WHERE s = 'O') AS rows_appended,
       (SELECT sum(n) FROM c WHERE s IN ('F', 'O'))::BIGINT AS rows_after, '' AS new_columns,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS matched_columns,
       '' AS missing_columns, false AS skipped
UNION ALL
SELECT 2, (SELECT sum(n) FROM c WHERE s IN ('F', 'O'))::BIGINT, (SELECT n FROM c WHERE s = 'P'),
       (SELECT sum(n) FROM c)::BIGINT, 'note', 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate',
       'o_orderpriority', false""")
def append_report(spark, d):
    o = t(spark, d, "orders")
    lake, info = _ingest_one(spark, o.where(F.col("o_orderstatus") == "F"), "orders_by_status")
    up = scratch_dir(spark, "upload")
    p1 = _write_csv(o.where(F.col("o_orderstatus") == "O"), f"{up}/o.csv")
    p2 = _write_csv(o.where(F.col("o_orderstatus") == "P").drop("o_orderpriority")
                    .withColumn("note", F.lit("late batch")), f"{up}/p.csv")
    reps = []
    for step, p in enumerate((p1, p2), start=1):
        reps.append(lake.append(info["source_id"], p).withColumn("step", F.lit(step)))
    rep = reduce(DataFrame.unionByName, reps)
    return rep.select("step", F.col("rowsBefore").alias("rows_before"), F.col("rowsAppended").alias("rows_appended"),
                      F.col("rowsAfter").alias("rows_after"), F.array_join("newColumns", ",").alias("new_columns"),
                      F.array_join("matchedColumns", ",").alias("matched_columns"),
                      F.array_join("missingColumns", ",").alias("missing_columns"), "skipped")


# ---- D: maintenance ------------------------------------------------------------------------------
@case("truncate_keep_schema", """
SELECT (SELECT count(*) FROM part) AS rows_before, CAST(0 AS BIGINT) AS rows_after,
       (SELECT string_agg(column_name, ',' ORDER BY ordinal_position) FROM information_schema.columns
        WHERE table_name = 'part') AS columns""")
def truncate_keep_schema(spark, d):
    lake, info = _ingest_one(spark, t(spark, d, "part"), "part_trunc")
    before = lake.table(info["physical_name"]).count()
    lake.truncate(info["source_id"], info["physical_name"])
    left = lake.table(info["physical_name"])
    return left.agg(F.lit(before).cast("long").alias("rows_before"), F.count("*").alias("rows_after"),
                    F.lit(",".join(left.columns)).alias("columns"))


@case("drop_source", " UNION ALL ".join(
    f"SELECT '{n}' AS display_name, count(*) AS rows FROM {n}" for n in ("orders", "part")))
def drop_source(spark, d):
    """Two sources; after one is dropped with all its tables only the other's are listed."""
    lake = lk.Lake(spark, f"{CONF_DB}_{uuid.uuid4().hex[:8]}")
    gone = lake.ingest_file("/reports/old.xlsx", "excel", sheets=[(n, t(spark, d, n)) for n in ("customer", "supplier")])
    lake.ingest_file("/reports/new.xlsx", "excel", sheets=[(n, t(spark, d, n)) for n in ("orders", "part")])
    lake.drop_source(gone[0]["source_id"])
    return lake.listing().select("display_name", "rows")


# ---- E: catalog / profile ------------------------------------------------------------------------
_IN_TABLES = ", ".join(f"'{n}'" for n in TEST_TABLES)


@case("list_tables", f"""
WITH c AS (SELECT t.table_name, count(*) AS n_columns FROM information_schema.tables t
           JOIN information_schema.columns c ON c.table_name = t.table_name
           WHERE t.table_name IN ({_IN_TABLES}) GROUP BY t.table_name),
     r AS ({" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in TEST_TABLES)})
SELECT c.table_name, c.n_columns, r.row_count FROM c JOIN r USING (table_name) ORDER BY c.table_name""")
def list_tables(spark, d):
    register_dir(spark, d)
    names = sorted(tb.name for tb in spark.catalog.listTables() if tb.isTemporary and tb.name in TEST_TABLES)
    return (catalog_rows(spark, {n: spark.table(n) for n in names})
            .select("table_name", "n_columns", "row_count").orderBy("table_name"))


@case("table_columns", """
SELECT CAST(ordinal_position AS INT) AS ordinal, column_name AS name, data_type AS type
FROM information_schema.columns WHERE table_name = 'lineitem'""")
def table_columns(spark, d):
    c = column_table(spark, t(spark, d, "lineitem"))
    return c.select((F.col("ordinal") + 1).cast("int").alias("ordinal"), "name", "type")


@case("row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
                                       for n in TEST_TABLES))
def row_counts_q(spark, d):
    return row_counts({n: t(spark, d, n) for n in TEST_TABLES})


_STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
_STAR_SOURCE = lk.source_id_of("/reports/tpch.xlsx")


def _star_lake(spark, d) -> lk.Lake:
    """A database of its own with one upload of seven tables."""
    lake = lk.Lake(spark, f"{CONF_DB}_{uuid.uuid4().hex[:8]}")
    lake.ingest_file("/reports/tpch.xlsx", "excel", sheets=[(n, t(spark, d, n)) for n in _STAR])
    return lake


@case("catalog_tree", " UNION ALL ".join(
    f"""SELECT '{_STAR_SOURCE}' AS source_id, '{n}' AS table_name, (SELECT count(*) FROM {n}) AS row_count,
       (SELECT string_agg(column_name || ' ' || data_type, ', ' ORDER BY ordinal_position)
        FROM information_schema.columns WHERE table_name = '{n}') AS columns""" for n in _STAR))
def catalog_tree(spark, d):
    flat = _star_lake(spark, d).tree().select("source_id", F.explode("tables").alias("x"))
    return flat.select("source_id", F.col("x.display_name").alias("table_name"), F.col("x.rows").alias("row_count"),
                       F.array_join(F.transform("x.columns", lambda c: F.concat_ws(" ", c["name"], c["type"])),
                                    ", ").alias("columns"))


@case("preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 20")
def preview_q(spark, d):
    return preview(t(spark, d, "customer"), order_by=["c_custkey"])


@case("preview_small", "SELECT * FROM part ORDER BY p_partkey LIMIT 10")
def preview_small(spark, d):
    return preview(t(spark, d, "part"), n=15, cap=10, order_by=["p_partkey"])


@case("table_listing", " UNION ALL ".join(
    f"SELECT '{n}' AS display_name, '{lk.physical_name(_STAR_SOURCE, i)}' AS physical_name, "
    f"(SELECT count(*) FROM {n}) AS row_count" for i, n in enumerate(_STAR)))
def table_listing(spark, d):
    return _star_lake(spark, d).listing().select("display_name", "physical_name", F.col("rows").alias("row_count"))


@case("catalog_page", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 75")
def catalog_page(spark, d):
    return gateway.page_of(t(spark, d, "orders").orderBy("o_orderkey"), page=3, size=25)


_PROFILE_COLS = {"l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "INTEGER",
                 "l_quantity": "DOUBLE", "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE", "l_tax": "DOUBLE",
                 "l_returnflag": "VARCHAR", "l_linestatus": "VARCHAR", "l_shipdate": "TIMESTAMP"}
_NUMBERS = ("BIGINT", "INTEGER", "DOUBLE")


@case("profile_table", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{typ}' AS column_type, count({c}) AS non_null, count(*) - count({c}) AS nulls,
       round(100.0 * (count(*) - count({c})) / count(*), 2)::DOUBLE AS null_pct,
       CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
       {f"round(avg({c}), 2)" if typ in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS mean,
       {f"round(stddev_samp({c}), 2)" if typ in _NUMBERS else "CAST(NULL AS DOUBLE)"} AS std, true AS distinct_ok
       FROM lineitem""" for c, typ in _PROFILE_COLS.items()))
def profile_table(spark, d):
    lines = t(spark, d, "lineitem")
    p = profile(lines, sketches=False)  # key profile_quartiles checks them
    # means depend on the order of summation in their last bits; the sketch is held against exact counts
    exact = lines.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.countDistinct(c).alias("n"))
                                for c in lines.columns]).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return p.join(exact, "column_name").select(
        "column_name", "column_type", "non_null", "nulls", F.col("null_pct").cast("double").alias("null_pct"),
        "min_value", "max_value", F.round("mean", 2).alias("mean"), F.round("std", 2).alias("std"),
        (F.abs(F.col("approx_distinct") - F.col("n")) <= 0.2 * F.col("n")).alias("distinct_ok"))


# ---- F: gateway screening ------------------------------------------------------------------------
_SQL_TEXT = """concat(CASE lang WHEN 'en' THEN 'SELECT' WHEN 'fr' THEN '  with' WHEN 'de' THEN 'DELETE FROM'
                              ELSE 'pragma' END,
                     ' ', chr(39), replace(text, chr(39), concat(chr(39), chr(39))), chr(39), ' AS t -- ', source,
                     chr(10), '/* ', lang, ' */;')"""


@case("screen_sql", f"""
WITH q AS (SELECT doc_id, {_SQL_TEXT} AS sql FROM documents)
SELECT doc_id,
       CASE WHEN sql IS NULL OR trim(sql) = '' THEN 'blank'
            WHEN NOT regexp_matches(trim(sql), '^\\s*(SELECT|WITH|EXPLAIN|DESCRIBE|SHOW|PRAGMA)([^\\p{{L}}\\p{{N}}_].*)?$', 'is')
              THEN 'prefix'
            WHEN regexp_matches(trim(sql),
                 '(^|[^\\p{{L}}\\p{{N}}_])(INSERT|UPDATE|DELETE|DROP|TRUNCATE|ALTER|CREATE|MERGE|REPLACE|GRANT|REVOKE)([^\\p{{L}}\\p{{N}}_]|$)',
                 'i') THEN 'keyword' END AS reason
FROM q""")
def screen_sql(spark, d):
    q = t(spark, d, "documents").select("doc_id", F.expr(_SQL_TEXT).alias("sql"))
    return q.select("doc_id", gateway.screen_sql_col("sql")["reason"].alias("reason"))


@case("strip_sql", f"""
WITH q AS (SELECT doc_id, {_SQL_TEXT} AS sql FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(
         regexp_replace(sql, '(''[^''\\\\]*(?:(?:''''|\\\\.)[^''\\\\]*)*''|"[^"\\\\]*(?:(?:""|\\\\.)[^"\\\\]*)*"|`[^`]*`|/\\*\\+)|--[^\\n]*|/\\*[^*]*\\*+(?:[^/*][^*]*\\*+)*/',
                        '\\1', 'gs'),
         '\\s+$', ''), ';$', ''), '\\s+$', '') AS stripped
FROM q""")
def strip_sql(spark, d):
    q = t(spark, d, "documents").select("doc_id", F.expr(_SQL_TEXT).alias("sql"))
    return q.select("doc_id", gateway.strip_sql_col("sql").alias("stripped"))


# ---- G: paging and saved reports -----------------------------------------------------------------
@case("capped_count", "SELECT least(count(*), 1000) AS total_rows FROM lineitem")
def capped_count(spark, d):
    total = gateway.capped_count(t(spark, d, "lineitem"), 1000)  # the cap is what is asked for
    return spark.createDataFrame([(total,)], "total_rows long")


@case("page_ordered", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def page_ordered(spark, d):
    register_dir(spark, d)
    return gateway.run_sql(spark, "SELECT * FROM orders ORDER BY o_orderkey", page=2, size=50).frame


@case("page_inner_order", """
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
               ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) LIMIT 30 OFFSET 60""")
def page_inner_order(spark, d):
    register_dir(spark, d)
    return gateway.run_sql(spark, """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey""", page=2, size=30).frame


@case("label_alias", 'SELECT c_name AS "客户", c_nationkey AS "国家", c_acctbal AS "余额" FROM customer')
def label_alias(spark, d):
    register_dir(spark, d)
    return gateway.sql(spark, 'SELECT c_name AS "客户", c_nationkey AS "国家", c_acctbal AS "余额" FROM customer')


@case("digest_top20", """
SELECT c_custkey, c_acctbal, (SELECT count(*) FROM customer) AS total_rows
FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20""")
def digest_top20(spark, d):
    register_dir(spark, d)
    page = gateway.run_sql(spark, "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey",
                           0, 20)
    return page.frame.withColumn("total_rows", F.lit(page.total_rows()).cast("bigint"))


@case("page_count", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, CAST(ceil(count(*) / 50) AS BIGINT) AS pages FROM {n}"
    for n in TEST_TABLES))
def page_count(spark, d):
    parts = [t(spark, d, n).agg(F.count("*").alias("c"))
             .select(F.lit(n).alias("table_name"), gateway.page_count_col(F.col("c"), 50).alias("pages"))
             for n in TEST_TABLES]
    return reduce(DataFrame.unionByName, parts)


_REPORT_SQL = """SELECT c.c_mktsegment, count(*) AS n_orders,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment"""


@case("saved_report", _REPORT_SQL)
def saved_report(spark, d):
    register_dir(spark, d)
    reports = rp.Reports(_lake(spark).spark, CONF_DB)
    rid = reports.save("segment_revenue", _REPORT_SQL, "orders by market segment")
    return gateway.sql(spark, reports.get(rid)["sql"])


@case("run_report_page", _REPORT_SQL + " ORDER BY total DESC LIMIT 2 OFFSET 2")
def run_report_page(spark, d):
    register_dir(spark, d)
    reports = rp.Reports(_lake(spark).spark, CONF_DB)
    rid = reports.save("segment_revenue_sorted", _REPORT_SQL + " ORDER BY total DESC")
    return reports.run(rid, page=1, size=2).frame


_CHANGES = """SELECT c_custkey,
       CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 10 THEN '   ' ELSE upper(c_name) END AS c_name,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE lower(c_mktsegment) END AS c_mktsegment
FROM customer WHERE c_nationkey < 20"""


@case("merge_partial", f"""
WITH ch AS ({_CHANGES})
SELECT c.c_custkey, coalesce(nullif(trim(ch.c_name), ''), c.c_name) AS c_name,
       coalesce(nullif(trim(ch.c_mktsegment), ''), c.c_mktsegment) AS c_mktsegment, c.c_nationkey, c.c_acctbal,
       (coalesce(nullif(trim(ch.c_name), ''), c.c_name) IS DISTINCT FROM c.c_name)
         OR (coalesce(nullif(trim(ch.c_mktsegment), ''), c.c_mktsegment) IS DISTINCT FROM c.c_mktsegment) AS changed
FROM customer c LEFT JOIN ch ON ch.c_custkey = c.c_custkey""")
def merge_partial(spark, d):
    register_dir(spark, d)
    changes = spark.sql(_CHANGES)
    return rp.merge_partial(t(spark, d, "customer"), changes, "c_custkey", ["c_name", "c_mktsegment"])


@case("batch_delete", """
SELECT o.*, (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW') AS deleted
FROM orders o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW')""")
def batch_delete(spark, d):
    o = t(spark, d, "orders")
    ids = o.where(F.col("o_orderpriority") == "5-LOW").select("o_orderkey")
    remaining, deleted = rp.batch_delete(o, ids, "o_orderkey")
    return remaining.withColumn("deleted", F.lit(deleted.first()["deleted"]).cast("bigint"))


# ---- K: chat logs ------------------------------------------------------------------------------------
@case("session_title", """
SELECT conv_id, left(arg_min(text, turn), 50) AS title FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def session_title(spark, d):
    return chatlog.session_titles(t(spark, d, "conversations"))


@case("session_index", """
WITH s AS (SELECT conv_id, count(*) AS n_messages, max(turn) AS last_turn FROM conversations GROUP BY conv_id),
     u AS (SELECT conv_id, left(arg_min(text, turn), 50) AS title FROM conversations WHERE role = 'user'
           GROUP BY conv_id)
SELECT s.conv_id, s.n_messages, s.last_turn, u.title FROM s LEFT JOIN u ON s.conv_id = u.conv_id
ORDER BY s.conv_id DESC""")
def session_index(spark, d):
    return chatlog.session_index(t(spark, d, "conversations"))


@case("transcript_flatten", """
SELECT conv_id, turn, role, text FROM conversations
WHERE role = 'user' OR (role = 'assistant' AND coalesce(text <> '', false))""")
def transcript_flatten(spark, d):
    return chatlog.transcript_rows(t(spark, d, "conversations"))
