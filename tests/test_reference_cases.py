"""Golden cases T1–T8 of the reference's manual test plan, on uploads of the same shape."""

import pytest
from pyspark.sql import functions as F

from reportlake.plans import gateway
from reportlake.plans.catalog import preview
from reportlake.plans.reports import Reports
from reportlake.sinks.export import BOM, export_csv
from samples import SALARY, SALES, write

JOIN_SQL = """SELECT s."店员", s."片区", s."成交额", s."成交日", y."月薪"
FROM sales s JOIN salary y ON s."店员" = y."店员名" AND s."片区" = y."片区" ORDER BY s."店员" """


@pytest.fixture()
def loaded(spark, lake, workdir):
    man = lake.ingest([write(workdir, "test_sales.csv", SALES), write(workdir, "test_salary.csv", SALARY)])
    rows = {r["display_name"]: r for r in man.collect()}
    lake.table(rows["test_sales"]["physical_name"]).createOrReplaceTempView("sales")
    lake.table(rows["test_salary"]["physical_name"]).createOrReplaceTempView("salary")
    return lake, rows


def test_t1_t2_load(loaded):
    lake, rows = loaded
    sales = lake.table(rows["test_sales"]["physical_name"])
    assert rows["test_sales"]["rows"] == 8 and rows["test_salary"]["rows"] == 8
    assert [t for _, t in sales.dtypes] == ["string", "string", "bigint", "date"]
    assert rows["test_salary"]["n_columns"] == 3


def test_t3_preview(loaded):
    lake, rows = loaded
    df = lake.table(rows["test_sales"]["physical_name"])
    assert preview(df, 3, order_by=["成交日"]).count() == 3
    assert gateway.capped_count(df) == 8
    assert preview(df, -4).count() == 0 and preview(df, 500).count() == 8


def test_t4_page(spark, loaded):
    page = gateway.run_sql(spark, 'SELECT * FROM sales ORDER BY "成交额" DESC', page=0, size=5)
    assert len(page.rows()) == 5 and page.total_rows() == 8 and page.total_pages() == 2


def test_t5_join_report_and_t6_export(spark, loaded, workdir):
    reports = Reports(spark, loaded[0].db)
    rid = reports.save("sales_with_salary", JOIN_SQL, "two-key join")
    page = reports.run(rid, 0, 50)
    assert page.columns == ["店员", "片区", "成交额", "成交日", "月薪"]
    assert page.total_rows() == 8
    out = f"{workdir}/export"
    export_csv(spark.table("sales_with_salary"), out, single_file=True)
    from test_csv import _raw_lines

    lines = _raw_lines(out)
    assert len(lines) == 9 and lines[0] == BOM + "店员,片区,成交额,成交日,月薪"


def test_sum_by_department(spark, loaded):
    df = gateway.sql(spark, 'SELECT "片区", sum("成交额") AS total FROM sales GROUP BY "片区" ORDER BY total DESC')
    assert [tuple(r) for r in df.collect()] == [("西区", 14600), ("南区", 13800), ("东区", 12700)]


@pytest.mark.parametrize("text", ["DROP TABLE sales", "INSERT INTO sales VALUES (1)", "delete from sales",
                                  "   update sales set x = 1", ""])
def test_t7_rejects(text):
    with pytest.raises(gateway.QueryRejected):
        gateway.check_sql(text)


def test_t8_cascade_delete(loaded):
    lake, rows = loaded
    sid = rows["test_sales"]["source_id"]
    assert lake.drop_source(sid) == 1
    assert rows["test_sales"]["physical_name"] not in lake.table_names()
    assert rows["test_salary"]["physical_name"] in lake.table_names()


def test_truncate_keeps_schema(loaded):
    lake, rows = loaded
    info = rows["test_salary"]
    lake.truncate(info["source_id"], info["physical_name"])
    t = lake.table(info["physical_name"])
    assert t.count() == 0 and t.columns == ["店员名", "片区", "月薪"]
    with pytest.raises(Exception):
        lake.truncate("s_other", info["physical_name"])


def test_catalog_tree_and_listing(loaded):
    lake, rows = loaded
    tree = lake.tree().collect()
    assert len(tree) == 2
    tables = [t for r in tree for t in r["tables"]]
    assert sorted(t["rows"] for t in tables) == [8, 8]
    assert all(c["type"] in ("VARCHAR", "BIGINT", "DATE") for t in tables for c in t["columns"])
    assert lake.sources().count() == 2
    assert lake.listing().where(F.col("rows") == 8).count() == 2
