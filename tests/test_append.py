import pytest
from pyspark.sql import functions as F

from reportlake.operators.append import column_diff
from reportlake.plans.lake import LakeError
from samples import write

BASE = "id,name,amount\n1,a,10\n2,b,20\n"


def _load(lake, workdir, text=BASE, name="base.csv"):
    return lake.ingest_file(write(workdir, name, text), "csv")[0]


def test_column_diff_order_rules():
    d = column_diff(["Name", "extra", "ID", "more"], ["id", "name", "amount"])
    assert d.matched == ["Name", "ID"] and d.new == ["extra", "more"] and d.missing == ["amount"]


def test_same_columns_other_case(lake, workdir):
    info = _load(lake, workdir)
    rep = lake.append(info["source_id"], write(workdir, "more.csv", "ID,NAME,AMOUNT\n3,c,30\n")).first()
    assert (rep["rowsBefore"], rep["rowsAppended"], rep["rowsAfter"]) == (2, 1, 3)
    assert rep["newColumns"] == [] and rep["missingColumns"] == []
    assert rep["matchedColumns"] == ["ID", "NAME", "AMOUNT"]


def test_extra_and_missing_columns(lake, workdir):
    info = _load(lake, workdir)
    rep = lake.append(info["source_id"], write(workdir, "more.csv", "name,id,note\nc,3,hello\n")).first()
    assert rep["newColumns"] == ["note"] and rep["missingColumns"] == ["amount"]
    t = lake.table(info["physical_name"])
    assert dict(t.dtypes)["note"] == "string" and dict(t.dtypes)["amount"] == "bigint"
    rows = {r["id"]: r for r in t.collect()}
    assert rows[1]["note"] is None and rows[3]["amount"] is None and rows[3]["note"] == "hello"


def test_bad_value_fails_whole_append_and_changes_nothing(lake, workdir):
    info = _load(lake, workdir)
    with pytest.raises(LakeError):
        lake.append(info["source_id"], write(workdir, "bad.csv", "id,amount,newcol\n3,30,x\nfour,40,y\n"))
    t = lake.table(info["physical_name"])
    assert t.count() == 2 and t.columns == ["id", "name", "amount"]


def test_fewer_sheets_than_tables_skips(spark, lake, workdir):
    from reportlake.conformance.fixtures import xlsx_bytes

    path = f"{workdir}/book.xlsx"
    with open(path, "wb") as fh:
        fh.write(xlsx_bytes([("s1", ["k", "v"], [[1, "a"]]), ("s2", ["k", "w"], [[2, "b"]])]))
    infos = lake.ingest([path]).collect()
    sid = infos[0]["source_id"]
    one = f"{workdir}/one.xlsx"
    with open(one, "wb") as fh:
        fh.write(xlsx_bytes([("only", ["k", "v"], [[3, "c"]])]))
    reps = lake.append(sid, one).collect()
    assert [r["skipped"] for r in reps] == [False, True]
    assert "fewer" in reps[1]["skipReason"] and reps[1]["rowsAfter"] == reps[1]["rowsBefore"] == 1
    three = f"{workdir}/three.xlsx"
    with open(three, "wb") as fh:
        fh.write(xlsx_bytes([("a", ["k"], [[4]]), ("b", ["k"], [[5]]), ("c", ["k"], [[6]])]))
    reps = lake.append(sid, three).collect()  # the surplus sheet is ignored
    assert len(reps) == 2 and not any(r["skipped"] for r in reps)


def test_append_property_counts_add_up(lake, workdir):
    info = _load(lake, workdir)
    total = 2
    for i, text in enumerate(["id\n5\n6\n", "amount,id\n1,7\n", "id,name\n8,z\n9,y\n10,x\n"]):
        rep = lake.append(info["source_id"], write(workdir, f"a{i}.csv", text)).first()
        assert rep["rowsAfter"] == rep["rowsBefore"] + rep["rowsAppended"] == total + rep["rowsAppended"]
        total = rep["rowsAfter"]
    t = lake.table(info["physical_name"])
    assert t.count() == total == 8
    assert t.where(F.col("id") <= 2).select("name").orderBy("id").collect()[0][0] == "a"  # old rows unchanged


def test_load_is_all_or_nothing(spark, lake, workdir, monkeypatch):
    from reportlake.conformance.fixtures import xlsx_bytes

    path = f"{workdir}/two.xlsx"
    with open(path, "wb") as fh:
        fh.write(xlsx_bytes([("ok", ["k"], [[1]]), ("breaks", ["k"], [[2]])]))
    real = type(lake)._write_table
    calls = []

    def flaky(self, df, physical, props, partition_by):
        calls.append(physical)
        if len(calls) == 2:
            raise RuntimeError("disk full")
        return real(self, df, physical, props, partition_by)

    before = set(lake.table_names())
    monkeypatch.setattr(type(lake), "_write_table", flaky)
    (row,) = lake.ingest([path]).collect()
    assert len(calls) == 2 and "disk full" in row["rejected_reason"] and row["rows"] is None
    assert set(lake.table_names()) == before  # the first sheet's table was dropped again


def test_partitioned_table_prunes_and_appends(spark, lake, workdir):
    from conftest import plan_text

    text = "id,day,amount\n1,2024-01-01,10\n2,2024-01-02,20\n3,2024-01-02,30\n"
    info = lake.ingest([write(workdir, "p.csv", text)], partition_by=["day"]).first()
    t = lake.table(info["physical_name"])
    q = t.where(F.col("day") == F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(day" in plan_text(q) and q.count() == 2
    rep = lake.append(info["source_id"], write(workdir, "p2.csv", "day,id,note\n2024-01-03,4,x\n")).first()
    assert rep["rowsAfter"] == 4 and rep["newColumns"] == ["note"]
    got = lake.table(info["physical_name"]).where("id = 4").first()
    assert str(got["day"]) == "2024-01-03" and got["note"] == "x" and got["amount"] is None


def test_append_many_in_order(lake, workdir):
    info = _load(lake, workdir)
    paths = [write(workdir, f"m{i}.csv", f"id,name\n{10 + i},n{i}\n") for i in range(3)]
    rep = lake.append_many(info["source_id"], paths).collect()
    assert [r["rowsAfter"] for r in rep] == [3, 4, 5] and [r["file"] for r in rep] == paths


def test_append_rejects_other_file_types(lake, workdir):
    info = lake.ingest_file(write(workdir, "base.csv", "id\n1\n"), "csv")[0]
    with pytest.raises(LakeError):
        lake.append(info["source_id"], write(workdir, "more.json", '{"id": 2}\n'))
    assert lake.table(info["physical_name"]).count() == 1


def test_append_changes_no_table_when_a_later_sheet_is_bad(lake, workdir, spark, monkeypatch):
    infos = lake.ingest_file(write(workdir, "two.csv", "id\n1\n"), "csv")
    other = lake.ingest_file(write(workdir, "other.csv", "id\n5\n"), "csv")
    source = infos[0]["source_id"]
    targets = lake.table_infos(source) + lake.table_infos(other[0]["source_id"])
    monkeypatch.setattr(type(lake), "table_infos", lambda self, sid: targets)
    good, bad = spark.createDataFrame([("2",)], "id string"), spark.createDataFrame([("x",)], "id string")
    monkeypatch.setattr(type(lake), "_sheets", lambda self, path, kind, rejected: [("a", good), ("b", bad)])
    with pytest.raises(LakeError):
        lake.append(source, "any.xlsx")
    assert lake.table(infos[0]["physical_name"]).count() == 1
    monkeypatch.setattr(type(lake), "_sheets", lambda self, path, kind, rejected: [("a", good), ("b", good)])
    report = lake.append(source, "any.xlsx").collect()
    assert [(r["rowsBefore"], r["rowsAppended"], r["rowsAfter"]) if "rowsBefore" in r else tuple(r)[1:4] for r in report] == [(1, 1, 2)] * 2


def test_same_path_again_is_a_new_source(lake, workdir):
    first, again = _load(lake, workdir), _load(lake, workdir, BASE + "3,c,30\n")
    assert first["source_id"] != again["source_id"] and (first["rows"], again["rows"]) == (2, 3)
    assert [t.physical_name for t in lake.table_infos(first["source_id"])] == [first["physical_name"]]
    assert [t.physical_name for t in lake.table_infos(again["source_id"])] == [again["physical_name"]]
    lake.append(again["source_id"], write(workdir, "m.csv", "id\n9\n")).collect()
    assert lake.table(first["physical_name"]).count() == 2 and lake.table(again["physical_name"]).count() == 4


def test_surplus_fields_are_counted_on_load_and_stop_an_append(lake, workdir):
    info = _load(lake, workdir, BASE + "3,c,30,more\n")
    assert (info["rows"], info["rejected_rows"]) == (2, 1)
    with pytest.raises(LakeError):
        lake.append(info["source_id"], write(workdir, "x.csv", "id,name\n1,a,b\n"))
    assert lake.table(info["physical_name"]).count() == 2


def test_empty_loads_and_appends(lake, workdir):
    empty = lake.ingest_file(write(workdir, "none.csv", "id,name\n"), "csv")[0]
    assert (empty["rows"], empty["rejected_rows"]) == (0, 0)
    info = _load(lake, workdir)
    rep = lake.append(info["source_id"], write(workdir, "head.csv", "id,name,amount\n")).first()
    assert (rep["rowsBefore"], rep["rowsAppended"], rep["rowsAfter"]) == (2, 0, 2)


def test_nothing_of_an_append_is_seen_before_all_of_it(spark, lake, workdir, monkeypatch):
    """Sheet 2 fails while it is written: rows and columns of both tables stay, and the next append is whole."""
    rows = [(None, spark.createDataFrame([(1, "a")], "k long, v string")), (None, spark.createDataFrame([(5, "b")], "k long, w string"))]
    info = lake.ingest_file("/in/two.xlsx", "excel", sheets=rows)
    sid, names = info[0]["source_id"], [i["physical_name"] for i in info]
    more = spark.createDataFrame([(2, "c", "n")], "k long, v string, note string")
    fails = more.select("k", F.when(F.raise_error(F.lit("disk full")).isNull(), "v").alias("w"), "note")

    def state():
        return [(lake.table(n).columns, sorted(map(tuple, lake.table(n).collect()))) for n in names]

    before = state()
    with pytest.raises(LakeError, match="disk full"):
        lake.append(sid, "more.xlsx", sheets=[(None, more), (None, fails)])
    assert state() == before and lake.clear_left_batches(sid) == 1 and state() == before
    commit = type(lake)._commit
    monkeypatch.setattr(type(lake), "_commit", lambda *a: (_ for _ in ()).throw(SystemError("killed")))
    with pytest.raises(SystemError):
        lake.append(sid, "more.xlsx", sheets=[(None, more), (None, more)], batch="b")
    assert state() == before  # both sheets are written, neither is committed
    monkeypatch.setattr(type(lake), "_commit", commit)
    rep = lake.append(sid, "more.xlsx", sheets=[(None, more), (None, more)], batch="b").collect()
    assert [(r["rowsBefore"], r["rowsAfter"], r["newColumns"]) for r in rep] == [(1, 2, ["note"]), (1, 2, ["v", "note"])]
    assert state() == [(["k", "v", "note"], [(1, "a", None), (2, "c", "n")]),
                       (["k", "w", "v", "note"], [(2, None, "c", "n"), (5, "b", None, None)])]
    assert [r["skipReason"] for r in lake.append(sid, "more.xlsx", sheets=[(None, more), (None, more)], batch="b").collect()] == [
        "already applied"] * 2
    assert lake.table(names[0]).count() == 2 and lake.clear_left_batches(sid) == 0


def test_a_writer_that_dies_after_its_commit_is_finished_by_the_next_opening(spark, lake, workdir, monkeypatch):
    from reportlake.plans.lake import Lake

    info = _load(lake, workdir)
    recover = Lake.recover
    monkeypatch.setattr(Lake, "recover", lambda self, new_columns=None: None)
    lake.append(info["source_id"], write(workdir, "more.csv", "id,note\n3,hello\n"))
    assert lake.table(info["physical_name"]).count() == 3 and "note" not in lake.table(info["physical_name"]).columns
    monkeypatch.setattr(Lake, "recover", recover)
    t = Lake(spark, lake.db).table(info["physical_name"])
    assert t.columns == ["id", "name", "amount", "note"] and t.where("note = 'hello'").count() == 1
