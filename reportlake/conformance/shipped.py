"""Keys that drive the functions users call (lake, reports, gateway, export), and operators the SQL surface was short of."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reportlake.conformance.registry import case, sql_case, t
from reportlake.functions.columns import money
from reportlake.operators.relational import limit_percent, order_nulls_last, select_matching
from reportlake.plans import gateway
from reportlake.plans import lake as lk
from reportlake.plans import reports as rp
from reportlake.plans.pages import PageIndex
from reportlake.session import scratch_dir
from reportlake.sinks.export import export_csv
from reportlake.sources.parquet import register_dir


def _new_lake(spark) -> lk.Lake:
    return lk.Lake(spark, f"reportlake_shipped_{uuid.uuid4().hex[:8]}")


@case("page_deep", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey
OFFSET (SELECT (count(*) - 1) // 50 * 50 FROM lineitem)""")
def page_deep(spark, d):
    """The last page of all order lines."""
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    index = PageIndex(li, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return index.page(index.last_page(50), 50)


@case("preview_source", """
SELECT *, (SELECT count(*) FROM customer) AS total, 5 AS n_columns FROM customer ORDER BY c_custkey LIMIT 200""")
def preview_source(spark, d):
    """A preview through the lake: the table must belong to the source, more than 200 rows are not given."""
    lake = _new_lake(spark)
    a, b = (lake.ingest_file(f"/reports/{n}.xlsx", "excel", sheets=[(n, t(spark, d, n))])[0] for n in ("customer", "part"))
    try:
        lake.preview(b["source_id"], a["physical_name"])
    except lk.LakeError:
        shown = lake.preview(a["source_id"], a["physical_name"], 1000, ["c_custkey"])
        return shown.rows.withColumn("total", F.lit(shown.total).cast("long")).withColumn("n_columns", F.lit(len(shown.columns)))
    raise AssertionError("a table of another source was shown")


@case("drop_one_table", "SELECT 'supplier' AS display_name, count(*) AS rows FROM supplier")
def drop_one_table(spark, d):
    """One of two tables of a source goes, dropping it again is no error."""
    lake = _new_lake(spark)
    info = lake.ingest_file("/reports/two.xlsx", "excel", sheets=[(n, t(spark, d, n)) for n in ("customer", "supplier")])
    for _ in range(2):
        lake.drop_table(info[0]["physical_name"])
    return lake.listing().select("display_name", "rows")


@case("load_all_or_nothing", "SELECT 'customer' AS display_name, count(*) AS rows FROM customer")
def load_all_or_nothing(spark, d):
    """The second sheet of a load fails while it is written; only the tables of another load are listed."""
    lake = _new_lake(spark)
    lake.ingest_file("/reports/whole.xlsx", "excel", sheets=[("customer", t(spark, d, "customer"))])
    broken = t(spark, d, "supplier").withColumn("s_name", F.when(F.col("s_suppkey") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("s_name")))
    try:
        lake.ingest_file("/reports/broken.xlsx", "excel", sheets=[("part", t(spark, d, "part")), ("supplier", broken)])
    except lk.LakeError:
        return lake.listing().select("display_name", "rows")
    raise AssertionError("a failing load was kept")


@case("append_refused", "SELECT count(*) AS rows, 'no' AS appended FROM region")
def append_refused(spark, d):
    """A file that is neither CSV nor a workbook is not appended."""
    lake = _new_lake(spark)
    info = lake.ingest_file("/reports/region.xlsx", "excel", sheets=[("region", t(spark, d, "region"))])[0]
    path = f"{scratch_dir(spark, 'upload')}/more.json"
    t(spark, d, "region").write.json(path)
    try:
        lake.append(info["source_id"], path)
        said = "yes"
    except lk.LakeError:
        said = "no"
    return lake.table(info["physical_name"]).agg(F.count("*").alias("rows"), F.lit(said).alias("appended"))


@case("export_bom_header", """
SELECT 'S_SUPPKEY' AS first_header, true AS has_bom, count(*) AS rows FROM supplier""")
def export_bom_header(spark, d):
    """One file with a byte order mark and the header, then the rows."""
    path = f"{scratch_dir(spark, 'export')}/supplier.csv"
    export_csv(t(spark, d, "supplier"), path, single_file=True)
    raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("v"))
    back = spark.read.option("header", True).csv(path)
    return raw.select(F.upper(F.regexp_extract("v", "^﻿?([A-Za-z_]+)", 1)).alias("first_header"), F.col("v").startswith("﻿").alias("has_bom"),
                      F.lit(back.count()).cast("long").alias("rows"))


@case("syntax_check", """
SELECT r_regionkey, CASE r_regionkey % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'unknown column' ELSE 'no statement' END AS verdict FROM region""")
def syntax_check(spark, d):
    """what parses and resolves is told without running anything; trailing signs and comments don't matter."""
    register_dir(spark, d)
    said = {}
    for shape, text in enumerate(("SELECT count(*) FROM lineitem WHERE l_quantity > 1 -- the end\n;", "SELECT nope FROM region", "SELECT (1")):
        try:
            gateway.validate_syntax(spark, text)
            said[shape] = "ok"
        except gateway.QuerySyntaxError as exc:
            said[shape] = "unknown column" if "UNRESOLVED_COLUMN" in str(exc) else "no statement"
    verdict = F.element_at(F.array(*[F.lit(said[i]) for i in range(3)]), (F.col("r_regionkey") % 3 + 1).cast("int"))
    return t(spark, d, "region").select("r_regionkey", verdict.alias("verdict"))


@case("reports_registry", """
SELECT 'big orders' AS name, (SELECT count(*) FROM orders WHERE o_totalprice > 1000) AS rows, false AS blank_changed, true AS sql_changed,
       1 AS deleted, 'rejected' AS bad_save""")
def reports_registry(spark, d):
    """G08, G10, G11, G12 through the registry: save, blank and real updates, delete of ids of which one exists, list, get, run."""
    register_dir(spark, d)
    reports = rp.Reports(spark, _new_lake(spark).db)
    kept = reports.save("all orders", "SELECT * FROM orders")
    gone = reports.save("all parts", "SELECT * FROM part")
    try:
        reports.save("bad", "DROP TABLE part")
        bad = "saved"
    except gateway.QueryRejected:
        bad = "rejected"
    blank = reports.update(kept, name=" ", sql="", description=None)
    real = reports.update(kept, name="big orders", sql="SELECT * FROM orders WHERE o_totalprice > 1000")
    deleted = reports.delete([gone, gone + 1])
    rows = reports.run(reports.get(kept)["id"]).total_rows()
    return reports.list().select("name", F.lit(rows).cast("long").alias("rows"), F.lit(blank).alias("blank_changed"), F.lit(real).alias("sql_changed"),
                                 F.lit(deleted).alias("deleted"), F.lit(bad).alias("bad_save"))


@case("sort_nulls_whole", """
SELECT row_number() OVER (ORDER BY nullif(c_mktsegment, 'BUILDING') NULLS LAST, c_custkey DESC) - 1 AS place, c_custkey,
       nullif(c_mktsegment, 'BUILDING') AS seg FROM customer""")
def sort_nulls_whole(spark, d):
    """Every row with its place in an order with NULLs last."""
    c = t(spark, d, "customer").select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("seg"))
    index = PageIndex(order_nulls_last(c, "seg", "c_custkey", ascending=[True, False]), [F.col("seg").asc_nulls_last(), F.col("c_custkey").desc()])
    return index.numbered("place").select("place", "c_custkey", "seg")


@case("limit_percent", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 7%""")
def limit_percent_q(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return limit_percent(o, 7, [F.desc("o_totalprice"), "o_orderkey"])


@case("columns_regex", "SELECT COLUMNS('^c_.*(key|acct)') FROM customer")
def columns_regex(spark, d):
    return select_matching(t(spark, d, "customer"), "^c_.*(key|acct)")


sql_case("join_natural", """
SELECT c_custkey, c_name, o_orderkey
FROM customer NATURAL JOIN (SELECT o_custkey AS c_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F')""")

sql_case("agg_first_last", """
SELECT o_custkey, min_by(o_orderstatus, struct(o_orderdate, o_orderkey)) AS first_status, max_by(o_orderstatus, struct(o_orderdate, o_orderkey)) AS last_status,
       any_value(o_custkey) AS any_cust
FROM orders GROUP BY o_custkey""", """
SELECT o_custkey, first(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS first_status, last(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS last_status,
       any_value(o_custkey) AS any_cust
FROM orders GROUP BY o_custkey""")


@case("agg_histogram", """
SELECT l_returnflag, key AS quantity, value::BIGINT AS n FROM (
    SELECT l_returnflag, unnest(map_entries(histogram(l_quantity::BIGINT)), recursive := true) FROM lineitem GROUP BY l_returnflag)""")
def agg_histogram(spark, d):
    """``histogram`` as a map per group: counted per value first, so that a group's rows never meet in one task."""
    n = t(spark, d, "lineitem").groupBy("l_returnflag", F.col("l_quantity").cast("long").alias("quantity")).agg(F.count("*").alias("n"))
    maps = n.groupBy("l_returnflag").agg(F.map_from_entries(F.collect_list(F.struct("quantity", "n"))).alias("h"))
    return maps.select("l_returnflag", F.explode("h").alias("quantity", "n"))


sql_case("math_width_bucket", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, width_bucket(l_quantity, 0, 50, 10) AS bucket FROM lineitem""", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN l_quantity < 0 THEN 0 WHEN l_quantity >= 50 THEN 11 ELSE floor(l_quantity / 5) + 1 END AS BIGINT) AS bucket FROM lineitem""")

sql_case("arr_flatten", """
SELECT o_custkey, array_join(array_sort(array_distinct(flatten(collect_list(array(o_orderstatus, o_orderpriority))))), '|') AS seen
FROM orders GROUP BY o_custkey""", """
SELECT o_custkey, array_to_string(list_sort(list_distinct(flatten(list([o_orderstatus, o_orderpriority])))), '|') AS seen
FROM orders GROUP BY o_custkey""")


@case("join_two_uploads", """
SELECT l_orderkey, l_suppkey, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS qty,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) END) AS DOUBLE) AS price
FROM lineitem GROUP BY l_orderkey, l_suppkey HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 0""")
def join_two_uploads(spark, d):
    """H02 over one table: both sides of the two-key join come from one scan and one conditional aggregate."""
    li = t(spark, d, "lineitem")
    back = F.col("l_returnflag") == "R"
    return (li.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum(money("l_quantity")).cast("double").alias("qty"), F.sum(F.when(back, money("l_extendedprice"))).cast("double").alias("price"),
        F.count_if(back).alias("n")).where("n > 0").drop("n"))


@case("cast_on_write", """
SELECT c_custkey, c_acctbal, CAST(NULL AS VARCHAR) AS extra FROM customer UNION ALL
SELECT s_suppkey, CAST(s_nationkey AS DOUBLE), CAST(s_suppkey AS VARCHAR) FROM supplier""")
def cast_on_write(spark, d):
    """Appended values take the table's types, new columns are text."""
    lake = _new_lake(spark)
    info = lake.ingest_file("/reports/c.xlsx", "excel", sheets=[("c", t(spark, d, "customer").select("c_custkey", "c_acctbal"))])[0]
    more = t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("C_CUSTKEY"), F.col("s_nationkey").alias("c_acctbal"),
                                          F.col("s_suppkey").alias("extra"))
    lake.append(info["source_id"], "more.xlsx", sheets=[("c", more)])
    return lake.table(info["physical_name"])
