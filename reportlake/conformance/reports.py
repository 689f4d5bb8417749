"""The report shapes the reference names, written with the DataFrame API."""

from __future__ import annotations

from pyspark.sql import functions as F

from reportlake.conformance.registry import case, t
from reportlake.functions.columns import money, net_price_units, ntz_month, units_total


@case("sum_by_group", """
SELECT l_returnflag, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
       COUNT(*) AS n_lines
FROM lineitem GROUP BY l_returnflag ORDER BY sum_qty DESC""")
def sum_by_group(spark, d):
    return (t(spark, d, "lineitem").groupBy("l_returnflag")
            .agg(F.sum(money("l_quantity")).cast("double").alias("sum_qty"), F.count("*").alias("n_lines"))
            .orderBy(F.desc("sum_qty")))


@case("join_two_keys", """
WITH q AS (SELECT l_orderkey, l_suppkey, CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS qty
           FROM lineitem GROUP BY l_orderkey, l_suppkey),
     r AS (SELECT l_orderkey, l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS price
           FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_suppkey)
SELECT q.l_orderkey, q.l_suppkey, q.qty, r.price
FROM q JOIN r ON q.l_orderkey = r.l_orderkey AND q.l_suppkey = r.l_suppkey""")
def join_two_keys(spark, d):
    li = t(spark, d, "lineitem")
    keys = ["l_orderkey", "l_suppkey"]
    q = li.groupBy(*keys).agg(F.sum(money("l_quantity")).cast("double").alias("qty"))
    r = (li.where(F.col("l_returnflag") == "R").groupBy(*keys)
         .agg(F.sum(money("l_extendedprice")).cast("double").alias("price")))
    # both sides are hash-partitioned on the same keys by their aggregations: the join adds no shuffle
    return q.join(r, keys).select(*keys, "qty", "price")


@case("join_one_key", """
SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderpriority = '1-URGENT'""")
def join_one_key(spark, d):
    o = t(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    c = t(spark, d, "customer")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select("o_orderkey", "o_orderdate", "o_totalprice", "c_name", "c_mktsegment"))


@case("recent_orders", """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20""")
def recent_orders(spark, d):
    return (t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
            .orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(20))


@case("monthly_summary", """
SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1 ORDER BY 1""")
def monthly_summary(spark, d):
    return (t(spark, d, "orders").groupBy(ntz_month("o_orderdate").alias("month"))
            .agg(F.count("*").alias("n_orders"), F.sum(money("o_totalprice")).cast("double").alias("total"))
            .orderBy("month"))


REGION_REVENUE_SQL = """
SELECT r.r_name, CAST(year(o.o_orderdate) AS INTEGER) AS o_year,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(12,2)))) AS DOUBLE)
         AS revenue,
       COUNT(*) AS n_lines
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE l.l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'
GROUP BY r.r_name, year(o.o_orderdate)
ORDER BY revenue DESC, r_name, o_year"""


def region_revenue_df(spark, d):
    """Flagship: 5-way star join, filtered, aggregated, sorted.

    Per-order revenue is summed as exact bigint units of 1e-4 (one order has few lines, so
    no overflow); the cross-order total is decimal(38,0). Same value as decimal arithmetic.

    lineitem is first reduced to one row per order (partial aggregation before
    the shuffle on ``l_orderkey``); the join with orders then reuses that
    partitioning. nation and region are tiny dimension files that Spark's size
    check broadcasts; customer is left to AQE, which broadcasts it only while it
    is under the threshold and falls back to a shuffle join beyond it.
    """
    per_order = (t(spark, d, "lineitem")
                 .where(F.col("l_shipdate") >= F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"))
                 .groupBy("l_orderkey")
                 .agg(F.sum(net_price_units()).alias("rev"), F.count("*").alias("n")))
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("o_year"))
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = t(spark, d, "nation").select("n_nationkey", "n_regionkey")
    r = t(spark, d, "region").select("r_regionkey", "r_name")
    joined = (per_order.join(o, per_order.l_orderkey == o.o_orderkey)
              .join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .join(r, n.n_regionkey == r.r_regionkey))
    return (joined.groupBy("r_name", "o_year")
            .agg(units_total(F.col("rev")).alias("revenue"), F.sum("n").alias("n_lines"))
            .orderBy(F.desc("revenue"), "r_name", "o_year"))


case("region_revenue", REGION_REVENUE_SQL)(region_revenue_df)
