"""Edge cases of the custom joins on the given tables: NULLs made with ``nullif``, large numbers, clashing names."""

from pyspark.sql import functions as F

from reportlake.conformance.registry import case, t
from reportlake.operators import joins
from reportlake.operators import relational as rel


@case("asof_nulls", """
WITH e AS (SELECT event_id, event_type, nullif(user_id % 50, 7) AS u, CASE WHEN event_id % 11 <> 0 THEN ts END AS ts FROM events)
SELECT c.event_id, c.u, c.ts, e.ts AS err_ts, e.event_id AS err_event_id
FROM (SELECT * FROM e WHERE event_type = 'click') c
LEFT JOIN LATERAL (SELECT x.ts, x.event_id FROM e x WHERE x.event_type = 'error' AND x.u = c.u AND x.ts <= c.ts
                   ORDER BY x.ts DESC, x.event_id DESC LIMIT 1) e ON true""")
def asof_nulls(spark, d):
    ev = t(spark, d, "events").select("event_id", "event_type", F.expr("nullif(user_id % 50, 7)").alias("u"),
                                      F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("ts"))
    clicks = ev.where(F.col("event_type") == "click").select("event_id", "u", "ts")
    errors = ev.where(F.col("event_type") == "error").select("u", "ts", "event_id")
    return joins.asof_join(clicks, errors, "u", "ts", "ts", ["event_id"], prefix="err_")


@case("asof_bigint", """
WITH e AS (SELECT event_id, event_type, user_id, 9007199254740993 + event_id AS k FROM events)
SELECT c.event_id, c.user_id, c.k, e.k AS err_k
FROM (SELECT * FROM e WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'error') e ON c.user_id = e.user_id AND c.k >= e.k""")
def asof_bigint(spark, d):
    ev = t(spark, d, "events").select("event_id", "event_type", "user_id",
                                      (F.lit(9007199254740993) + F.col("event_id")).alias("k"))
    clicks = ev.where(F.col("event_type") == "click").select("event_id", "user_id", "k")
    errors = ev.where(F.col("event_type") == "error").select("user_id", "k")
    return joins.asof_join(clicks, errors, "user_id", "k", "k", [], bucket_seconds=1000.0, prefix="err_")


@case("distinct_on_nulls", """
SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, nullif(o_orderpriority, '1-URGENT') AS p,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price
FROM orders ORDER BY o_custkey, price DESC NULLS LAST, p NULLS LAST, o_orderkey""")
def distinct_on_nulls(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", F.expr("nullif(o_orderpriority, '1-URGENT')").alias("p"),
                                     F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"))
    return rel.distinct_on(o, ["o_custkey"], [("price", False), ("p", True), ("o_orderkey", True)])


@case("range_join_names", """
SELECT s.event_id, s.user_id, e.event_id AS event_id_right, e.k
FROM (SELECT event_id, user_id, 9007199254740993 + event_id AS lo, 9007199254740993 + event_id + 50 AS hi
      FROM events WHERE event_type = 'signup') s
JOIN (SELECT event_id, user_id, 9007199254740993 + event_id AS k FROM events) e
  ON e.user_id = s.user_id AND e.k >= s.lo AND e.k < s.hi""")
def range_join_names(spark, d):
    ev = t(spark, d, "events")
    k = F.lit(9007199254740993) + F.col("event_id")
    left = ev.where(F.col("event_type") == "signup").select("event_id", "user_id", k.alias("lo"), (k + 50).alias("hi"))
    right = ev.select("event_id", "user_id", k.alias("k"))
    return (joins.range_join(left, right, "lo", "hi", "k", bucket_width=64.0, on="user_id").drop("lo", "hi"))


@case("positional_nullable", """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 9007199254740993 + c_custkey END AS v,
                  row_number() OVER (ORDER BY c_custkey) AS rn FROM customer),
     s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey DESC) AS rn FROM supplier)
SELECT c_custkey, v, s_suppkey FROM c FULL OUTER JOIN s ON c.rn = s.rn""")
def positional_nullable(spark, d):
    v = F.when(F.col("c_custkey") % 2 == 0, F.lit(9007199254740993) + F.col("c_custkey"))
    c = t(spark, d, "customer").select("c_custkey", v.alias("v"))
    s = t(spark, d, "supplier").select("s_suppkey")
    return joins.positional_join(c, s, ["c_custkey"], [F.desc("s_suppkey")])
