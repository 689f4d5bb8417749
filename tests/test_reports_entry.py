import os
import sys

import pytest

from reportlake.plans import reports as rp
from reportlake.sources.parquet import register_dir
from conftest import SF


def test_registry_lifecycle(spark, lake):
    register_dir(spark, SF)
    reg = rp.Reports(spark, lake.db)
    a = reg.save("a_report", "SELECT r_name FROM region")
    b = reg.save("b_report", "SELECT n_name FROM nation", "nations")
    assert reg.list().count() == 2
    assert reg.update(b, name="", sql="  ", description=None) is False  # blank keeps old values
    assert reg.update(b, description="all nations") is True
    assert reg.get(b)["description"] == "all nations" and reg.get(b)["sql"] == "SELECT n_name FROM nation"
    assert reg.run(a, 0, 2).total_rows() == 5
    with pytest.raises(Exception):
        reg.save("bad", "DROP TABLE region")
    assert reg.delete([a, 12345]) == 1
    assert [r["id"] for r in reg.current().collect()] == [b]


def test_entry_and_contract(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns
    q, o = E.queries(), E.oracle_sql()
    from reportlake import conformance

    assert set(o) <= set(q) and set(conformance.oracle_sql()) == set(conformance.queries()) <= set(q)


def test_export_saved_report(spark, lake, workdir):
    register_dir(spark, SF)
    reg = rp.Reports(spark, lake.db)
    rid = reg.save("nations_by_region", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey")
    reg.export(rid, f"{workdir}/r.parquet", "parquet")
    assert spark.read.parquet(f"{workdir}/r.parquet").count() == 5
    reg.export(rid, f"{workdir}/r.csv", "csv", single_file=True)
    assert spark.read.option("header", True).csv(f"{workdir}/r.csv").count() == 5


def test_reports_keep_their_ids_over_renames(spark, lake):
    register_dir(spark, SF)
    reg = rp.Reports(spark, lake.db)
    a = reg.save("report a", "SELECT 1 AS x")
    assert reg.update(a, name="report b") and not spark.catalog.tableExists("`report a`")
    again = reg.save("report a", "SELECT 2 AS x")
    assert again != a and reg.get(a)["name"] == "report b" and reg.get(a)["created_at"] <= reg.get(a)["updated_at"]
    assert reg.save("report a", "SELECT 3 AS x") == again
    with pytest.raises(Exception):
        reg.save("broken", "SELECT FROM WHERE")
    assert reg.current().count() == 2
    assert reg.delete([a, a + 1]) == 1 and reg.open_views() == ["report a"]
    assert spark.table("`report a`").first()[0] == 3
    with pytest.raises(Exception):
        spark.table("`report b`").collect()
