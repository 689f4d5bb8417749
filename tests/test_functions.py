import pytest
from pyspark.sql import functions as F

from reportlake.functions.columns import cents, mask_secret, month_diff, net_price_units
from reportlake.functions.compat import register_compat
from reportlake.sources.files import read_file
from reportlake.sources.route import route, route_name


def test_mask_secret(spark):
    vals = [None, "", "short", "12345678", "sk-abcdefghijkl"]
    df = spark.createDataFrame([(v,) for v in vals], "k string")
    assert [r[0] for r in df.select(mask_secret("k")).collect()] == ["", "", "****", "****", "sk-a****ijkl"]


def test_month_diff_and_units(spark):
    df = spark.createDataFrame([("2024-01-31", "2024-02-01", 68423.46, 0.05)], "a string, b string, p double, d double")
    r = df.select(month_diff(F.to_date("a"), F.to_date("b")), cents("p"), net_price_units("p", "d")).first()
    assert tuple(r) == (1, 6842346, 6842346 * 95)


def test_compat_functions(spark):
    register_compat(spark)
    r = spark.sql("SELECT strpos('hello', 'l'), regexp_matches('abc', 'b+'), "
                  "list_contains(string_split('a|b', '|'), 'b'), list_sort(list_distinct(array('b', 'a', 'b')))").first()
    assert tuple(r) == (3, True, True, ["a", "b"])


def test_route_rules(spark):
    names = ["a.CSV", "b.txt", "c.xlsx", "d.Xls", "e.parquet", "noext", "dir/f.tar.csv"]
    df = route(spark.createDataFrame([(n,) for n in names], "path string")).collect()
    assert [r["file_type"] for r in df] == ["csv", "csv", "excel", "excel", None, None, "csv"]
    assert df[4]["reason"] == "unsupported file type: .parquet" and df[5]["reason"] == "unsupported file type: ."
    assert [route_name(n)[0] for n in names] == ["csv", "csv", "excel", "excel", None, None, "csv"]


def test_read_file_formats(spark):
    with pytest.raises(ValueError):
        read_file(spark, "/tmp/x", "avro")
    assert read_file(spark, "/root/testdata/sf0.001/region.parquet").count() == 5
