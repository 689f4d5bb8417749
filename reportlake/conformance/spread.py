"""Windows and quantiles over keys as large as the table (``operators/spread.py``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reportlake.conformance.registry import case, t
from reportlake.functions.columns import money
from reportlake.operators import chatlog
from reportlake.operators.asof import asof
from reportlake.operators.intervals import interval_join
from reportlake.plans.catalog import profile
from reportlake.operators.spread import Frame, Rank, Running, exact_quantiles, excluded, lag, lead, spread_windows

#: Rows of a block in these queries: a tenth of the library's, so that small tables have many blocks too.
BLOCK = 6000


@case("quantiles_spread", """
SELECT l_returnflag, median(l_quantity) AS med, quantile_cont(l_extendedprice, 0.25) AS p25, quantile_disc(l_quantity, 0.9) AS p90,
       quantile_cont(l_extendedprice, 0.999) AS p999
FROM lineitem GROUP BY l_returnflag""")
def quantiles_spread(spark, d):
    return exact_quantiles(t(spark, d, "lineitem"), ["l_returnflag"], {
        "med": ("cont", "l_quantity", 0.5), "p25": ("cont", "l_extendedprice", 0.25), "p90": ("disc", "l_quantity", 0.9),
        "p999": ("cont", "l_extendedprice", 0.999)}, BLOCK)


@case("quantiles_one_group", """
SELECT median(o_totalprice) AS med, quantile_disc(o_orderdate, 0.1) AS early FROM orders""")
def quantiles_one_group(spark, d):
    return exact_quantiles(t(spark, d, "orders"), [], {"med": ("cont", "o_totalprice", 0.5), "early": ("disc", "o_orderdate", 0.1)}, BLOCK)


@case("win_hot_rank", """
SELECT l_orderkey, l_linenumber, row_number() OVER (w, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn, rank() OVER w AS rnk, dense_rank() OVER w AS drnk,
       percent_rank() OVER w AS prank, cume_dist() OVER w AS cdist,
       ntile(7) OVER (w, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tile
FROM lineitem""".replace("(w, l", "(PARTITION BY l_linestatus ORDER BY l_shipdate, l").replace(
    "OVER w ", "OVER (PARTITION BY l_linestatus ORDER BY l_shipdate) "))
def win_hot_rank(spark, d):
    """Two keys hold all rows; ranks are shared by days, numbers and tiles go on by line."""
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_shipdate")
    shared = spread_windows(li, ["l_linestatus"], [("l_shipdate", True)], {
        "rnk": Rank("rank"), "drnk": Rank("dense_rank"), "prank": Rank("percent_rank"), "cdist": Rank("cume_dist")}, BLOCK)
    own = spread_windows(shared, ["l_linestatus"], [(c, True) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                         {"rn": Rank("row_number"), "tile": Rank("ntile", 7)}, BLOCK)
    return own.select("l_orderkey", "l_linenumber", "rn", "rnk", "drnk", "prank", "cdist", "tile")


_W = "OVER (ORDER BY o_orderdate, o_orderkey"
_ROWS = f"{_W} ROWS BETWEEN"


@case("win_hot_frames", f"""
SELECT o_orderkey, lag(o_totalprice) {_W}) AS prev_price, lead(o_orderkey, 2) {_W}) AS next2,
       first_value(o_orderkey) {_W}) AS first_key, last_value(o_orderkey) {_ROWS} UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_key,
       lag(nullif(o_orderstatus, 'F') IGNORE NULLS) {_W}) AS prev_open_status,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) {_ROWS} 20 PRECEDING AND 5 FOLLOWING) AS DOUBLE) AS slide,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) {_ROWS} UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS upto,
       max(o_totalprice) {_ROWS} UNBOUNDED PRECEDING AND CURRENT ROW) AS high
FROM orders""")
def win_hot_frames(spark, d):
    """All orders are one key."""
    o = (t(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", money("o_totalprice").alias("price"),
                                      F.expr("nullif(o_orderstatus, 'F')").alias("open")))
    o = spread_windows(o, [], [("o_orderdate", True), ("o_orderkey", True)], {
        "prev_price": lag("o_totalprice"), "next2": lead("o_orderkey", 2), "first_key": Running("first", "o_orderkey", total=True),
        "last_key": Running("last", "o_orderkey", total=True), "before": lag("open"), "upto": Running("sum", "price"), "high": Running("max", "o_totalprice"),
        "slide": Frame(lambda b: F.sum("price").over(b.rows(-20, 5)), 20, 5)}, BLOCK)
    o = spread_windows(o, [], [("o_orderdate", True), ("o_orderkey", True)], {"prev_open_status": Running("last", "before")}, BLOCK)
    return o.select("o_orderkey", "prev_price", "next2", "first_key", "last_key", "prev_open_status",
                    F.col("slide").cast("double").alias("slide"), F.col("upto").cast("double").alias("upto"), "high")


_CALLS = [(fn, x) for x in ("CURRENT ROW", "GROUP", "TIES") for fn in ("sum", "count", "min", "max")]


def _named(fn: str, exclude: str) -> str:
    return f"{fn}_{exclude.split()[0].lower()}"


@case("win_exclude", """
SELECT o_orderstatus, lot, """ + ", ".join(
    f"CAST({fn}(v) OVER (PARTITION BY o_orderstatus ORDER BY lot ROWS BETWEEN 7 PRECEDING AND 4 FOLLOWING EXCLUDE {x}) AS BIGINT) AS {_named(fn, x)}"
    for fn, x in _CALLS) + """
FROM (SELECT o_orderstatus, o_orderkey // 5 AS lot, nullif(o_orderkey // 5 % 97, 3) AS v FROM orders)""")
def win_exclude(spark, d):
    """Up to five orders are peers and have one value, so it doesn't matter in which order a frame meets them."""
    o = t(spark, d, "orders").select("o_orderstatus", F.expr("o_orderkey DIV 5").alias("lot"), F.expr("nullif(o_orderkey DIV 5 % 97, 3)").alias("v"))
    return spread_windows(o, ["o_orderstatus"], [("lot", True)], {
        _named(fn, x): excluded(fn, "v", 7, 4, x.lower()) for fn, x in _CALLS}, BLOCK).drop("v")


_SIDES = """(SELECT event_id, user_id, ts FROM events WHERE event_type = 'click') c ASOF LEFT JOIN
     (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'error' GROUP BY ALL) e"""


def _clicks_and_errors(spark, d):
    ev = t(spark, d, "events")
    return (ev.where("event_type = 'click'").select("event_id", "user_id", "ts"),
            ev.where("event_type = 'error'").select("user_id", "ts", "event_id"))


@case("asof_forward", f"""
SELECT c.event_id, c.user_id, c.ts, e.ts AS err_ts, e.event_id AS err_event_id
FROM {_SIDES} ON c.user_id = e.user_id AND c.ts <= e.ts""")
def asof_forward(spark, d):
    clicks, errors = _clicks_and_errors(spark, d)
    return asof(clicks, errors, "user_id", "ts", "ts", "forward", ["event_id"], "err_", BLOCK)


_TIMES = """(SELECT event_id, ts FROM events WHERE event_type = 'click') c ASOF LEFT JOIN
     (SELECT ts, max(event_id) AS event_id FROM events WHERE event_type = 'error' GROUP BY ts) e"""


@case("asof_nearest", f"""
WITH b AS (SELECT c.event_id, c.ts, e.ts AS t, e.event_id AS i FROM {_TIMES} ON c.ts >= e.ts),
     f AS (SELECT c.event_id, c.ts, e.ts AS t, e.event_id AS i FROM {_TIMES} ON c.ts <= e.ts)
SELECT b.event_id, b.ts, CASE WHEN b.t IS NULL OR f.t - f.ts < b.ts - b.t THEN f.t ELSE b.t END AS err_ts,
       CASE WHEN b.t IS NULL OR f.t - f.ts < b.ts - b.t THEN f.i ELSE b.i END AS err_event_id
FROM b JOIN f ON b.event_id = f.event_id""")
def asof_nearest(spark, d):
    """The closest error of any user: a join without keys."""
    clicks, errors = _clicks_and_errors(spark, d)
    return asof(clicks.select("event_id", "ts"), errors.select("ts", "event_id"), None, "ts", "ts", "nearest", prefix="err_", block=BLOCK)


@case("transcript_pairing", """
WITH e AS (SELECT conv_id // 25 AS session, conv_id * 1000 + turn AS place, length(text) % 5 < 3 AS is_call,
                  CASE WHEN length(text) % 7 > 0 THEN conv_id || ':' || turn ELSE '' END AS content FROM conversations),
     s AS (SELECT *, sum(CASE WHEN is_call THEN 1 ELSE -1 END) OVER (PARTITION BY session ORDER BY place) + CASE WHEN is_call THEN 0 ELSE 1 END AS level
           FROM e WHERE is_call OR content <> ''),
     p AS (SELECT *, lead(is_call) OVER w AS next_call, lead(content) OVER w AS got FROM s WINDOW w AS (PARTITION BY session, level ORDER BY place))
SELECT session, place, CASE WHEN NOT next_call THEN got END AS content FROM p WHERE is_call""")
def transcript_pairing(spark, d):
    """Turns of 25 conversations are a session of tool calls and results (told by the lengths of their texts)."""
    e = t(spark, d, "conversations").selectExpr(
        "conv_id DIV 25 AS session", "conv_id * 1000 + turn AS place", "length(text) % 5 < 3 AS is_call",
        "CASE WHEN length(text) % 7 > 0 THEN conv_id || ':' || turn ELSE '' END AS content")
    return chatlog.pair_latest(e, "session", ["place"], "is_call", BLOCK).select("session", "place", "content")


@case("range_mixed", """
SELECT s.event_id, s.user_id, p.event_id AS event_id_right, p.ts AS ts_right
FROM (SELECT event_id, user_id, ts AS s, CASE event_id % 3 WHEN 0 THEN ts + INTERVAL 1 SECOND WHEN 1 THEN ts + INTERVAL 36 HOUR
             ELSE ts + INTERVAL 3 YEAR END AS e FROM events WHERE event_type = 'error' AND event_id % 5 = 0) s
JOIN events p ON p.user_id = s.user_id AND p.ts >= s.s AND p.ts < s.e""")
def range_mixed(spark, d):
    """Spans of a second, of a day and a half and of three years in one join."""
    ev = t(spark, d, "events")
    spans = ev.where("event_type = 'error' AND event_id % 5 = 0").selectExpr("event_id", "user_id", "ts AS s", """CASE event_id % 3
        WHEN 0 THEN ts + INTERVAL 1 SECOND WHEN 1 THEN ts + INTERVAL 36 HOUR ELSE ts + INTERVAL 3 YEAR END AS e""")
    return interval_join(spans, ev.select("event_id", "user_id", "ts"), "s", "e", "ts", "user_id").select(
        "event_id", "user_id", "event_id_right", F.col("ts").alias("ts_right"))


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@case("profile_quartiles", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, 'q{q}' AS what, true AS ok FROM lineitem LIMIT 1".join(("(", ")")) for c in _MEASURES for q in (25, 50, 75)) +
    " UNION ALL " + " UNION ALL ".join(
    f"(SELECT '{c}', {c} || ' ' || count(*), true FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in ("l_returnflag", "l_linestatus")))
def profile_quartiles(spark, d):
    """The sketch's quartiles are held against the table by rank (a hundredth of the rows); frequent values of columns with few are exact."""
    li = t(spark, d, "lineitem")
    p = profile(li).where(F.col("column_name").isin(*_MEASURES, "l_returnflag", "l_linestatus"))
    marks = {r["column_name"]: (r["q25"], r["q50"], r["q75"]) for r in p.where("q50 IS NOT NULL").collect()}  # one row per column
    ranks = li.agg(F.count("*").alias("n"), *[F.struct(F.count_if(F.col(c) < v).alias("below"), F.count_if(F.col(c) <= v).alias("upto")).alias(f"{c} {q}")
                                               for c, m in marks.items() for q, v in zip((25, 50, 75), m)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(f"q{q}").alias("what"),
                     ((F.col(f"`{c} {q}`.below") <= (q / 100 + 0.01) * F.col("n")) & (F.col(f"`{c} {q}`.upto") >= (q / 100 - 0.01) * F.col("n"))).alias("ok"))
            for c in marks for q in (25, 50, 75)]
    top = p.where("column_name IN ('l_returnflag', 'l_linestatus')").select(
        "column_name", F.concat_ws(" ", F.col("top_values")[0]["value"], F.col("top_values")[0]["n"].cast("string")).alias("what"), F.lit(True).alias("ok"))
    return ranks.select(F.explode(F.array(*rows)).alias("x")).select("x.*").unionByName(top)
