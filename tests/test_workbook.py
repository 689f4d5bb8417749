import datetime as dt
import zipfile

from reportlake.conformance.fixtures import xlsx_bytes
from reportlake.sources import workbook as W


def _write(path, data):
    with open(path, "wb") as fh:
        fh.write(data)
    return path


def test_sheets_cells_types(spark, workdir):
    book = xlsx_bytes([
        ("People", ["name", "age", "joined", "active", "score"],
         [["ann", 31, dt.date(2024, 1, 15), True, 1.5], ["bob", None, dt.date(2024, 2, 1), False, 2.0],
          ["cy", 40, dt.date(2023, 12, 31), True, None]]),
        ("Notes", ["k", "text"], [[1, "x"], [2, "y"]]),
    ], shared_strings=False)
    path = _write(f"{workdir}/b.xlsx", book)
    sheets = [(r["sheet_idx"], r["sheet"]) for r in W.workbook_sheets(spark, path).orderBy("sheet_idx").collect()]
    assert sheets == [(0, "People"), (1, "Notes")]
    got = dict(W.read_workbook(spark, path))
    people = got["People"]
    assert people.dtypes == [("name", "string"), ("age", "bigint"), ("joined", "date"),
                             ("active", "boolean"), ("score", "double")]
    rows = {r["name"]: r for r in people.collect()}
    assert rows["bob"]["age"] is None and rows["ann"]["joined"] == dt.date(2024, 1, 15)
    assert rows["cy"]["score"] is None and rows["ann"]["active"] is True
    assert got["Notes"].count() == 2


def test_missing_workbook_xml_falls_back(spark, workdir):
    book = xlsx_bytes([("Data", ["a"], [[1]])], with_workbook_xml=False)
    path = _write(f"{workdir}/nowb.xlsx", book)
    assert [r["sheet"] for r in W.workbook_sheets(spark, path).collect()] == ["Sheet1"]
    assert W.sheet_names(zipfile.ZipFile(path)) == [("Sheet1", None)]


def test_workbook_to_csv(spark, workdir):
    path = _write(f"{workdir}/c.xlsx", xlsx_bytes([("S", ["a", "b"], [[1, "x,y"], [2, None]])]))
    out = f"{workdir}/csv"
    W.workbook_to_csv(spark, path, out)
    lines = [r["value"] for r in spark.read.text(out).orderBy("value").collect()]
    assert lines == ['1,"x,y"', "2,", "a,b"]


def test_bulk_ingest_many_workbooks(spark, lake, workdir):
    for i in range(3):
        _write(f"{workdir}/w{i}.xlsx", xlsx_bytes([("s", ["k", "v"], [[i, f"v{i}"], [i + 10, "z"]])]))
    man = lake.ingest_folder(workdir).collect()
    assert len(man) == 3 and all(r["rows"] == 2 for r in man)


def test_unreadable_and_partly_empty_workbooks_dont_stop_the_others(lake, workdir):
    _write(f"{workdir}/bad.xlsx", b"no archive")
    _write(f"{workdir}/half.xlsx", xlsx_bytes([("s", ["k"], [[1], [2]]), ("none", [], [])]))
    with open(f"{workdir}/c.csv", "w") as fh:
        fh.write("a\n1\n")
    man = {(r["file_name"], r["sheet"]): (r["rows"], r["rejected_reason"]) for r in lake.ingest_folder(workdir).collect()}
    assert man.pop(("bad.xlsx", None))[1].startswith("BadZipFile")
    assert man == {("c.csv", None): (1, None), ("half.xlsx", "s"): (2, None), ("half.xlsx", "none"): (None, "no cells")}


def test_bad_cells_become_null_and_are_counted(lake, workdir):
    path = _write(f"{workdir}/n.xlsx", xlsx_bytes([("s", ["v", "w"], [[1, "x"], ["n/a", 2], [3, "y"]])]))
    row = lake.ingest([path]).first()
    t = lake.table(row["physical_name"])
    assert row["bad_cells"] == 1 and t.dtypes == [("v", "bigint"), ("w", "string")]
    assert sorted((r["v"] or 0, r["w"]) for r in t.collect()) == [(0, "2"), (1, "x"), (3, "y")]


def test_first_row_of_numbers_is_data(spark, workdir):
    path = _write(f"{workdir}/h.xlsx", xlsx_bytes([("s", [1, 2], [[3, 4], [5, 6]])]))
    (_, df), = W.read_workbook(spark, path)
    assert df.columns == ["A1", "B1"] and sorted(map(tuple, df.collect())) == [(1, 2), (3, 4), (5, 6)]


def test_same_sheet_name_in_two_workbooks(spark, workdir):
    for n in ("a", "b"):
        _write(f"{workdir}/{n}.xlsx", xlsx_bytes([("S", ["k"], [[n]])]))
    W.workbook_to_csv(spark, [f"{workdir}/a.xlsx", f"{workdir}/b.xlsx"], f"{workdir}/csv")
    got = spark.read.text(f"{workdir}/csv").groupBy("workbook", "sheet").count().collect()
    assert sorted((r["workbook"][:2], r["sheet"], r["count"]) for r in got) == [("a-", "S", 2), ("b-", "S", 2)]
