import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from reportlake.operators.relational import limit_percent, select_matching
from reportlake.plans.lake import LakeError
from reportlake.plans.pages import PageIndex


def test_pages_cover_all_rows_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id"), F.lit("x").alias("__v")).repartition(6)
    index = PageIndex(df, ["id"], parts=5)
    assert index.total == 1000 and index.last_page(30) == 33
    seen = [r["id"] for p in range(index.last_page(30) + 1) for r in index.page(p, 30).collect()]
    assert seen == list(range(1000))
    assert index.page(40, 30).count() == 0 and [r["id"] for r in index.page(-1, 3).collect()] == [0, 1, 2]
    assert index.numbered("n").where("n <> id").count() == 0
    lo, hi = index.parts_of(33, 30)
    assert lo == hi  # the last page lies in one part, and only its folder is read
    assert "PartitionFilters: [isnotnull(__page_part" in plan_text(index.page(33, 30))
    assert PageIndex(df.limit(0), ["id"]).page(0, 10).count() == 0 and PageIndex(df.limit(0), ["id"]).last_page() == 0


def test_limit_percent_and_matching_columns(spark):
    df = spark.range(200).select("id", (F.col("id") % 7).alias("id_mod"), F.lit(1).alias("other"))
    assert [r["id"] for r in limit_percent(df, 2.5, [F.desc("id")]).orderBy(F.desc("id")).collect()] == [199, 198, 197, 196, 195]
    assert limit_percent(df, 0, ["id"]).count() == 0 and limit_percent(df, 100, ["id"]).count() == 200
    assert select_matching(df, "^id").columns == ["id", "id_mod"]
    with pytest.raises(ValueError):
        select_matching(df, "nothing")


def test_preview_asks_for_the_owner(spark, lake):
    a, b = (lake.ingest_file(f"/in/{n}.xlsx", "excel", sheets=[(n, spark.range(300))])[0] for n in ("a", "b"))
    with pytest.raises(LakeError):
        lake.preview(b["source_id"], a["physical_name"])
    shown = lake.preview(a["source_id"], a["physical_name"], 500, ["id"])
    assert shown.total == 300 and shown.rows.count() == 200 and shown.columns == [("id", "BIGINT")]
    assert lake.preview(a["source_id"], a["physical_name"]).rows.count() == 20 and lake.preview(a["source_id"], a["physical_name"], -5).rows.count() == 0
