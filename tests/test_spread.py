"""Windows and quantiles over blocks against DuckDB, with blocks so small that every key lies in many."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from reportlake.operators.spread import Frame, Rank, Running, exact_quantiles, excluded, lag, lead, spread_windows

BLOCK = 8


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, *range(6)]), rnd.choice([None, *range(-5, 9)])) for i in range(160)]
    rows += [(1000, "alone", 1, None)]
    df = spark.createDataFrame(rows, "id long, k string, o long, v long").repartition(5)
    con = duckdb.connect()
    con.register("t", pd.DataFrame(rows, columns=["id", "k", "o", "v"]).astype({"o": "Int64", "v": "Int64"}))
    return df, con


def same(got, con, sql):
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    want = [tuple(None if v is None or v != v else round(float(v), 9) if isinstance(v, float) else v for v in r) for r in res.fetchall()]
    have = [tuple(round(r[n], 9) if isinstance(r[n], float) else r[n] for n in names) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_ranks(table):
    df, con = table
    w = "(PARTITION BY k ORDER BY o NULLS FIRST)"
    got = spread_windows(df, ["k"], [("o", True)], {n: Rank(n) for n in ("rank", "dense_rank", "percent_rank", "cume_dist")}, BLOCK)
    same(got, con, f"SELECT id, rank() OVER {w} AS rank, dense_rank() OVER {w} AS dense_rank, percent_rank() OVER {w} AS percent_rank, "
                   f"cume_dist() OVER {w} AS cume_dist FROM t")
    got = spread_windows(df, [], [("o", False), ("id", True)], {"rn": Rank("row_number"), "tile": Rank("ntile", 9), "more": Rank("ntile", 500)}, BLOCK)
    w = "(ORDER BY o DESC NULLS LAST, id)"
    same(got, con, f"SELECT id, row_number() OVER {w} AS rn, ntile(9) OVER {w} AS tile, ntile(500) OVER {w} AS more FROM t")


def test_frames_and_running_values(table):
    df, con = table
    cols = {"back": lag("v", 3), "ahead": lead("v"), "slide": Frame(lambda b: F.sum("v").over(b.rows(-8, 8)), 8, 8),
            "total": Running("sum", "v", total=True)} | {f: Running(f, "v") for f in ("sum", "count", "min", "max", "first", "last")}
    got = spread_windows(df, ["k"], [("o", True), ("id", True)], cols, BLOCK)
    w = "PARTITION BY k ORDER BY o NULLS FIRST, id"
    up = f"({w} ROWS UNBOUNDED PRECEDING)"
    same(got, con, f"""SELECT id, lag(v, 3) OVER ({w}) AS back, lead(v) OVER ({w}) AS ahead, sum(v)::BIGINT OVER ({w} ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS slide,
        sum(v) OVER (PARTITION BY k) AS total, sum(v) OVER {up} AS sum, count(v) OVER {up} AS count, min(v) OVER {up} AS min, max(v) OVER {up} AS max,
        first_value(v IGNORE NULLS) OVER {up} AS first, last_value(v IGNORE NULLS) OVER {up} AS last FROM t""".replace("::BIGINT OVER", " OVER"))


@pytest.mark.parametrize("back,ahead", [(3, 2), (0, 4), (5, 0), (0, 0)])
def test_exclude(table, back, ahead):
    df, con = table
    # one value for all peers: their order then doesn't matter
    d = df.select("k", "o", F.when(F.col("o") != 2, F.col("o") * 3 - 5).alias("v"))
    kinds = [(fn, x) for fn in ("sum", "count", "min", "max") for x in ("current row", "group", "ties")]
    got = spread_windows(d, ["k"], [("o", True)], {f"{fn}_{x[:2]}": excluded(fn, "v", back, ahead, x) for fn, x in kinds}, BLOCK).drop("v")
    calls = ", ".join(f"{fn}(v) OVER (PARTITION BY k ORDER BY o NULLS FIRST ROWS BETWEEN {back} PRECEDING AND {ahead} FOLLOWING EXCLUDE {x}) AS {fn}_{x[:2]}"
                      for fn, x in kinds)
    same(got, con, f"SELECT k, o, {calls} FROM (SELECT k, o, CASE WHEN o <> 2 THEN o * 3 - 5 END AS v FROM t)")


def test_quantiles(table, spark):
    df, con = table
    wanted = {"med": ("cont", "v", 0.5), "q1": ("cont", "v", 0.1), "top": ("disc", "v", 1.0), "low": ("disc", "v", 0.0), "d3": ("disc", "o", 0.3)}
    calls = ", ".join(f"quantile_{kind}({c}, {q}) AS {n}" for n, (kind, c, q) in wanted.items())
    same(exact_quantiles(df, ["k"], wanted, 3), con, f"SELECT k, {calls} FROM t GROUP BY k")
    same(exact_quantiles(df, [], wanted, 3), con, f"SELECT {calls} FROM t")
    assert exact_quantiles(df.limit(0), ["k"], wanted).count() == 0
    assert tuple(exact_quantiles(df.limit(0), [], wanted).first()) == (None,) * 5


def test_limits_and_plan(table):
    df, _ = table
    with pytest.raises(ValueError):
        spread_windows(df, ["k"], [("id", True)], {"x": lag("v", BLOCK + 1)}, BLOCK)
    assert spread_windows(df.limit(0), ["k"], [("id", True)], {"x": Rank("rank"), "y": Running("sum", "v")}, BLOCK).count() == 0
    got = spread_windows(df, ["k"], [("id", True)], {"x": Rank("rank"), "y": lag("v"), "z": Running("sum", "v")}, BLOCK)
    plan = plan_text(got)
    # rows go by (block, key); only tables of one row per key and block are windowed by key alone
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert got.count() == 161


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_asof_against_plain_search(spark, direction, keys):
    from reportlake.operators.asof import asof

    rnd = random.Random(9)
    left = [(i, rnd.choice("ab") if rnd.random() < 0.9 else None, rnd.choice([None, *range(40)])) for i in range(60)]
    right = [(rnd.choice("abc") if rnd.random() < 0.9 else None, rnd.choice([None, *range(40)]), i) for i in range(25)]
    ldf = spark.createDataFrame(left, "id long, k string, t long").repartition(3)
    rdf = spark.createDataFrame(right, "k string, t long, r long")
    got = {r["id"]: (r["x_t"], r["x_r"]) for r in asof(ldf, rdf, keys or None, "t", "t", direction, ["r"], "x_", 5).collect()}
    want = {}
    for i, k, t in left:
        able = [(x, r) for q, x, r in right if x is not None and t is not None and (not keys or (k is not None and q == k))]
        before = max(((x, r) for x, r in able if x <= t), default=(None, None))
        after = max(((-x, r) for x, r in able if x >= t), default=None)
        after = (-after[0], after[1]) if after else (None, None)
        near = after if before[0] is None or (after[0] is not None and after[0] - t < t - before[0]) else before
        want[i] = {"backward": before, "forward": after, "nearest": near}[direction]
    assert got == want
    plan = plan_text(asof(ldf, rdf, keys or None, "t", "t", direction, ["r"], "x_", 5))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("closed", ["left", "both"])
def test_intervals_of_all_lengths(spark, closed):
    from reportlake.operators.intervals import dyadic_cells, interval_join

    rnd = random.Random(4)
    spans = [(i, rnd.choice(["a", "b", None]), s, rnd.choice([None, s - 1, s, s + 1, s + rnd.randrange(60), s + 10**rnd.randrange(12)]))
             for i, s in enumerate(rnd.randrange(-500, 500) for _ in range(60))]
    points = [(j, rnd.choice(["a", "b", None]), rnd.choice([None, *range(-510, 700)])) for j in range(120)]
    left = spark.createDataFrame(spans, "id long, k string, s long, e long")
    right = spark.createDataFrame(points, "id long, k string, p long")
    for unit in (1.0, 7.0):
        got = sorted((r["id"], r["id_right"]) for r in interval_join(left, right, "s", "e", "p", "k", unit, closed).collect())
        assert got == sorted((i, j) for i, k, s, e in spans for j, q, p in points if k is not None and k == q and None not in (e, p)
                             and s <= p and (p < e if closed == "left" else p <= e))
    wide = spark.range(1).select(dyadic_cells(F.lit(-10**15 + 7), F.lit(10**17 + 5)).alias("c")).first()["c"]
    assert len(wide) <= 2 * 63
    assert sum(2**c["level"] for c in wide) == 10**17 + 5 + 10**15 - 7
    assert interval_join(left.limit(0), right, "s", "e", "p", "k").count() == 0


def test_no_frame_is_gone_through_again_for_each_row(spark, table):
    """Spark goes through a frame that ends with the last row anew for each row: in blocks of thousands that is most of the time."""
    df, con = table
    kinds = ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist")
    got = spread_windows(df, ["k"], [("o", True)], {n: Rank(n) for n in kinds}, BLOCK)
    assert "unboundedfollowing" not in plan_text(got).replace("unboundedpreceding$(), unboundedfollowing$()", "")
    big = spark.range(60000).selectExpr("id % 2 AS k", "id DIV 100 AS o", "id")
    out = spread_windows(big, ["k"], [("o", True)], {"c": Rank("cume_dist"), "r": Rank("rank")}, 6000)
    assert out.filter("abs(c - (o + 1) / 600) > 1e-9 OR r <> 50 * o + 1").count() == 0


def test_excluded_frames_share_one_array_and_sort_none(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id DIV 5 AS o", "id AS v")
    kinds = [(fn, x) for fn in ("sum", "count", "min", "max") for x in ("current row", "group", "ties")]
    plan = plan_text(spread_windows(df, ["k"], [("o", True)], {f"{fn}_{x[:2]}": excluded(fn, "v", 7, 4, x) for fn, x in kinds}, BLOCK))
    lines = plan.splitlines()
    made = [i for i, x in enumerate(lines) if "Window [" in x and "collect_list" in x]
    assert len(made) == 1 and plan.count("collect_list(") == 1
    assert not any(" Sort [" in x for x in lines[:made[0]])


def test_points_are_copied_once_for_each_of_few_levels(spark):
    from reportlake.operators.intervals import interval_join, wide_cells

    cells = spark.range(1).select(wide_cells(F.lit(-10**15 + 7), F.lit(10**17 + 5)).alias("c")).first()["c"]
    assert sum(2**c["level"] for c in cells) == 10**17 + 5 + 10**15 - 7
    assert all(c["level"] % 3 == 0 for c in cells)
    rnd = random.Random(8)
    ends = [(lo, lo + rnd.randrange(3000)) for lo in (rnd.randrange(-2000, 2000) for _ in range(80))] + [(5, 5), (-8, 8), (-64, 0), (7, 8)]
    got = spark.createDataFrame(ends, "lo long, hi long").select("lo", "hi", wide_cells(F.col("lo"), F.col("hi")).alias("c")).collect()
    for lo, hi, c in got:
        assert sorted(x for q in c for x in range(q["cell"] << q["level"], (q["cell"] + 1) << q["level"])) == list(range(lo, hi))
    long = spark.createDataFrame([(1, 0, 10**8)], "id long, s long, e long")
    point = spark.createDataFrame([(2, 77), (3, 10**8)], "id long, p long")
    found = interval_join(long, point, "s", "e", "p")
    assert [r["id_right"] for r in found.collect()] == [2]
    most = max(len(c.split(",")) for c in __import__("re").findall(r"explode\(\[([0-9,]*)\]\)", plan_text(found)))
    assert most <= 10
