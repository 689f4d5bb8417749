import pytest
from pyspark.sql import functions as F

from reportlake.sinks.export import csv_lines, export_csv
from reportlake.sources import csv as C
from reportlake.sources.headers import dedupe_names, sanitize_header
from samples import write


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_sniff_delimiters(spark, workdir, sep):
    text = sep.join(["k", "name", "v"]) + "\n" + "\n".join(sep.join([str(i), f"n{i}", f"{i}.5"]) for i in range(30))
    path = write(workdir, "d.csv", text + "\n")
    d = C.sniff_csv(spark, path)
    assert d.delimiter == sep
    df = C.read_csv(spark, path)
    assert df.dtypes == [("k", "bigint"), ("name", "string"), ("v", "double")] and df.count() == 30


def test_quoted_delimiters_and_newlines(spark, workdir):
    path = write(workdir, "q.csv", 'id,text\n1,"a, b"\n2,"line1\nline2"\n3,"say ""hi"""\n')
    df = C.read_csv(spark, path)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "a, b"), (2, "line1\nline2"), (3, 'say "hi"')]


def test_header_dedupe_and_blank():
    assert dedupe_names(["a", "a", "A"]) == ["a", "a_1", "A_2"]


def test_header_file(spark, workdir):
    path = write(workdir, "h.csv", "a,a,A,,x y\n1,2,3,4,5\n")
    assert C.read_csv(spark, path).columns == ["a", "a_1", "A_2", "column3", "x y"]


def test_sanitize_header(spark):
    vals = ["  销售 额(元) ", "___", None, "", "a--b", "Ünïcode-Név", "x"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(sanitize_header("v")).collect()] == [
        "销售_额_元", "COL", "COL", "COL", "a_b", "Ünïcode_Név", "x"]


def test_mixed_types_and_lenient_cells(spark, workdir):
    text = ("n,txt,empty,d,ts,t,b,f\n"
            "1,x,,2024-01-02,2024-01-02 03:04:05,10:11:12,true,1.5\n"
            "2,y,,2024-02-03,2024-02-03T04:05:06.5,11:12:13,false,2\n"
            "oops,z,,2024-03-04,2024-03-04 05:06:07,12:13:14,TRUE,-3e2\n")
    df = C.read_csv(spark, write(workdir, "m.csv", text))
    assert dict(df.dtypes) == {"n": "string", "txt": "string", "empty": "string", "d": "date",
                               "ts": "timestamp_ntz", "t": "string", "b": "boolean", "f": "double"}
    raw = C.read_text_columns(spark, write(workdir, "m2.csv", text), ["n", "txt", "empty", "d", "ts", "t", "b", "f"],
                              C.Dialect())
    typed = C.lenient_cast(raw, {"n": "bigint"})
    assert [r[0] for r in typed.select("n").collect()] == [1, 2, None]
    bad = C.bad_cell_counts(raw, {"n": "bigint", "d": "date"}).collect()
    assert {r["column_name"]: r["n_bad"] for r in bad} == {"n": 1, "d": 0}


def test_csv_lines_round_trip(spark, workdir):
    rows = [(1, 'plain', None), (2, 'a,b', 1.5), (3, 'say "x"', -2.0), (4, "two\nlines", 0.0)]
    df = spark.createDataFrame(rows, "id bigint, s string, v double")
    assert csv_lines(df).orderBy("line").first()[0] == "1,plain,"
    out = f"{workdir}/rt"
    export_csv(df, out, bom=False)
    back = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .schema("id bigint, s string, v double").csv(out))
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == rows


def test_export_empty_has_header(spark, workdir):
    df = spark.createDataFrame([], "a bigint, b string")
    out = f"{workdir}/empty"
    export_csv(df, out, single_file=True)
    assert _raw_lines(out) == ["\ufeffa,b"]


def _raw_lines(folder):
    import glob

    out = []
    for f in sorted(glob.glob(f"{folder}/part-*")):
        with open(f, encoding="utf-8") as fh:
            out += fh.read().splitlines()
    return out


def test_quoted_newline_beyond_the_sample(spark, workdir):
    body = "".join(f"{i},plain{i}\n" for i in range(1500))
    path = write(workdir, "late.csv", "id,text\n" + body + '1500,"two\nlines"\n')
    assert C.sniff_csv(spark, path).multiline
    df = C.read_csv(spark, path)
    assert df.count() == 1501 and df.where("id = 1500").first()["text"] == "two\nlines"


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_quote_inside_a_field_keeps_the_file_split(spark, workdir):
    path = write(workdir, "pipe.csv", 'id,t\n1,5" pipe\n2,x\n')
    assert not C.sniff_csv(spark, path).multiline
    assert _rows(C.read_csv(spark, path)) == [(1, '5" pipe'), (2, "x")]


def test_surplus_fields_are_kept_apart_and_counted(spark, workdir):
    path = write(workdir, "s.csv", "id,t\n1,a\n2,y,EXTRA\n3\n")
    seen = []
    df = C.read_csv(spark, path, rejected=seen)
    assert _rows(df) == [(1, "a"), (3, None)] and seen == [1]
    assert df.count() == 2 and [r[0] for r in C.csv_rejects(spark, path).collect()] == ["2,y,EXTRA"]


def test_single_quotes_header_over_lines_and_never_closed(spark, workdir):
    assert _rows(C.read_csv(spark, write(workdir, "q1.csv", "id,t\n'x,y',1\n'z',2\n"))) == [("x,y", 1), ("z", 2)]
    assert C.read_csv(spark, write(workdir, "q2.csv", 'id,"a\nb"\n1,2\n')).columns == ["id", "a\nb"]
    with pytest.raises(ValueError):
        C.read_csv(spark, write(workdir, "q3.csv", 'id,t\n1,"abc\n2,x\n'))


def test_other_date_forms(spark, workdir):
    text = "a,b,c\n01/02/2020,2020/1/2,12/31/2020\n13.02.2020,2020.05.06,01/02/2020\n"
    df = C.read_csv(spark, write(workdir, "dates.csv", text))
    assert [[str(v) for v in r] for r in df.orderBy("b").collect()] == [
        ["2020-02-01", "2020-01-02", "2020-12-31"], ["2020-02-13", "2020-05-06", "2020-01-02"]]


def test_parts_are_matched_by_header_name(spark, workdir):
    import os

    os.makedirs(f"{workdir}/parts")
    write(f"{workdir}/parts", "a.csv", "id,name\n1,x\n")
    write(f"{workdir}/parts", "b.csv", "NAME,id,note\ny,2,n\n")
    df = C.read_csv(spark, f"{workdir}/parts")
    assert df.columns == ["id", "name", "note"] and _rows(df.fillna("")) == [(1, "x", ""), (2, "y", "n")]


def test_records_over_many_splits(spark, workdir):
    import csv
    import io
    import random

    rnd = random.Random(1)
    pieces = ["p", 'two\nli,"nes\n', '"', "\n\n,x", '5" pipe', ""]
    rows = [(i, rnd.choice(pieces) + "z") for i in range(2000)]
    buf = io.StringIO()
    out = csv.writer(buf, lineterminator="\n")
    out.writerow(["id", "t"])
    out.writerows(rows)
    path = write(workdir, "many.csv", buf.getvalue())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert _rows(C.read_csv(spark, path)) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_export_of_repeated_labels(spark, workdir):
    df = spark.createDataFrame([(1, 2), (3, 4)], "a bigint, b bigint").toDF("a", "a")
    assert sorted(r[0] for r in csv_lines(df).collect()) == ["1,2", "3,4"]
    export_csv(df, f"{workdir}/dup", single_file=True)
    assert _raw_lines(f"{workdir}/dup") == ["\ufeffa,a_1", "1,2", "3,4"]
