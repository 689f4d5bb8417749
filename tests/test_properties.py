"""Property tests: append column-diff invariants and CSV quoting round trips."""

import csv
import io

from hypothesis import given, settings
from hypothesis import strategies as st

from reportlake.operators.append import column_diff

names = st.lists(st.text(alphabet="abcAB_12", min_size=1, max_size=4), max_size=8, unique_by=str.lower)


@given(names, names)
def test_column_diff_partitions_both_sides(source, target):
    d = column_diff(source, target)
    # every source column is either matched or new, in source order
    assert sorted(d.matched + d.new, key=source.index) == source
    assert [c for c in source if c in d.matched] == d.matched and [c for c in source if c in d.new] == d.new
    # missing = target columns absent from the source, in target order
    assert d.missing == [c for c in target if c.lower() not in {s.lower() for s in source}]
    # the evolved table has the union of the column sets
    assert {c.lower() for c in target} | {c.lower() for c in d.new} == {c.lower() for c in target + source}


cells = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\r\x00"),
                                     max_size=12))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(cells, cells), min_size=1, max_size=6))
def test_csv_line_round_trip(spark, rows):
    from reportlake.sinks.export import csv_lines

    df = spark.createDataFrame(rows, "a string, b string")
    lines = [r[0] for r in csv_lines(df).collect()]
    parsed = [next(csv.reader(io.StringIO(line + "\n"))) if line else ["", ""] for line in lines]
    parsed = [p if len(p) == 2 else p + [""] * (2 - len(p)) for p in parsed]
    want = [["" if v is None else v for v in r] for r in rows]
    assert parsed == want
