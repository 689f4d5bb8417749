import pandas as pd
from pyspark.sql import functions as F

from reportlake.operators import joins, relational as rel
from reportlake.sources.parquet import table
from conftest import SF, plan_text


def test_asof_matches_brute_force(spark):
    ev = table(spark, SF, "events")
    clicks = ev.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    errors = ev.where(F.col("event_type") == "error").select("user_id", "ts", "event_id")
    got = joins.asof_join(clicks, errors, "user_id", "ts", "ts", ["event_id"], bucket_seconds=3600.0,
                          prefix="e_").toPandas()
    c = clicks.toPandas().sort_values("ts")
    e = errors.toPandas().rename(columns={"ts": "e_ts", "event_id": "e_event_id"}).sort_values("e_ts")
    want = pd.merge_asof(c, e, left_on="ts", right_on="e_ts", by="user_id", direction="backward")
    a = got.sort_values("event_id").reset_index(drop=True)
    b = want.sort_values("event_id").reset_index(drop=True)
    assert len(a) == len(b) == len(c)
    assert (a["e_event_id"].fillna(-1).astype("int64") == b["e_event_id"].fillna(-1).astype("int64")).all()


def test_asof_plan_has_no_nested_loop(spark):
    ev = table(spark, SF, "events")
    out = joins.asof_join(ev.select("event_id", "user_id", "ts"), ev.select("user_id", "ts", "value"),
                          "user_id", "ts", "ts", ["value"])
    plan = plan_text(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_brute_force(spark):
    left = spark.createDataFrame([(1, 0.0, 10.0), (2, 5.0, 5.5), (3, 9.0, 30.0), (4, 100.0, 101.0)],
                                 "id int, s double, e double")
    right = spark.createDataFrame([(i, float(i)) for i in range(0, 40, 3)], "rid int, p double")
    got = sorted(map(tuple, joins.range_join(left, right, "s", "e", "p", bucket_width=4.0)
                     .select("id", "rid").collect()))
    want = sorted((i, r) for i, s, e in left.collect() for r, p in right.collect() if s <= p < e)
    assert got == want


def test_positional_join(spark):
    a = spark.createDataFrame([(k,) for k in [5, 3, 9, 1]], "a int")
    b = spark.createDataFrame([(k,) for k in ["z", "y"]], "b string")
    got = [tuple(r) for r in joins.positional_join(a, b, ["a"], ["b"]).collect()]
    assert got == [(1, "y"), (3, "z"), (5, None), (9, None)]


def test_distinct_on_qualify_sampling(spark):
    o = table(spark, SF, "orders")
    d = rel.distinct_on(o, ["o_custkey"], [("o_totalprice", False), ("o_orderkey", True)])
    q = rel.qualify(o, "row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
    assert sorted(map(tuple, d.collect())) == sorted(map(tuple, q.select(*o.columns).collect()))
    s1 = rel.sample_rows(o, 10, ["o_orderkey"], seed=7).collect()
    s2 = rel.sample_rows(o, 10, ["o_orderkey"], seed=7).collect()
    assert s1 == s2 and len(s1) == 10
    frac = rel.sample_fraction(o, 10.0, ["o_orderkey"]).count()
    assert 0.05 * o.count() < frac < 0.15 * o.count()


def test_ordinal_within_matches_row_number(spark):
    from pyspark.sql import Window

    p = table(spark, SF, "part").select("p_partkey", "p_name")
    got = rel.ordinal_within(p, ["p_name"], "p_partkey", "rn", bucket_width=16)
    want = p.withColumn("rn", F.row_number().over(Window.partitionBy("p_name").orderBy("p_partkey")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_groups_frame(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 4), (1, "c", 8)], "k int, g string, v int")
    got = [r["s"] for r in rel.with_groups_frame(df, ["k"], "g", "v", 1, 0, "s").orderBy("v").collect()]
    assert got == [3, 3, 7, 12]


def test_distinct_on_directions(spark):
    from pyspark.sql import Window

    o = table(spark, SF, "orders")
    for order in ([("o_orderpriority", False), ("o_orderkey", True)],
                  [("o_orderstatus", True), ("o_totalprice", False), ("o_orderkey", False)],
                  [("o_orderstatus", True), ("o_orderpriority", False), ("o_orderkey", True)]):
        got = rel.distinct_on(o, ["o_custkey"], order)
        w = Window.partitionBy("o_custkey").orderBy(*[F.col(n).asc() if a else F.col(n).desc() for n, a in order])
        want = o.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_range_join_totals_equal_the_pairs(spark):
    import random
    from decimal import Decimal

    import pytest

    rnd = random.Random(5)
    spans = [(rnd.choice([1, 2, None]), rnd.choice(["a", "b", None]), s, rnd.choice([None, s - 2, s, s + 1, s + rnd.randrange(30)]))
             for s in (rnd.randrange(40) for _ in range(60))]
    spans += spans[:9] + [(1, "a", None, 3)]
    points = [(rnd.choice(["a", "b", None]), rnd.choice([None, *range(45)]), rnd.choice([None, Decimal("1.25"), Decimal("-3.10")])) for _ in range(90)]
    left = spark.createDataFrame(spans, "id int, k string, s long, e long").repartition(3)
    right = spark.createDataFrame(points, "k string, p long, v decimal(12,2)").repartition(3)
    for closed in ("left", "both"):
        for on in (None, "k"):
            got = joins.range_join(left, right, "s", "e", "p", 4.0, on, closed, totals={"n": None, "t": "v"})
            want = []
            for i, k, s, e in spans:
                hit = [v for q, p, v in points if None not in (s, e, p) and s <= p and (p < e if closed == "left" else p <= e)
                       and (on is None or (k is not None and k == q))]
                if hit:
                    held = [v for v in hit if v is not None]
                    want.append((i, k, s, e, len(hit), sum(held) if held else None))
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        joins.range_join(left, right.withColumn("f", F.col("v").cast("double")), "s", "e", "p", 4.0, totals={"t": "f"})


def test_range_join_query_makes_no_pairs(spark):
    from reportlake.conformance.relational import range_join

    plan = plan_text(range_join(spark, SF))
    assert "NestedLoop" not in plan and "sequence(" not in plan  # no bucket per hour, in which all rows would meet
