"""Scalar function families, with the DuckDB spelling where it differs."""

from __future__ import annotations


from reportlake.conformance.registry import case, sql_case, t
from reportlake.functions.columns import mask_secret

sql_case("str_basic", """
SELECT p_partkey, lower(p_name) AS lo, upper(p_brand) AS up, trim(concat('  ', p_name, '  ')) AS tr,
       substr(p_name, 2, 3) AS sub, replace(p_name, ' ', '_') AS rep, split_part(p_brand, '#', 2) AS num,
       lpad(CAST(p_size AS STRING), 4, '0') AS padded, concat_ws('-', p_brand, p_type) AS cw,
       CAST(length(p_name) AS BIGINT) AS len, reverse(p_name) AS rev, CAST(instr(p_name, 'e') AS BIGINT) AS pos,
       p_brand || '/' || p_type AS piped
FROM part""", """
SELECT p_partkey, lower(p_name) AS lo, upper(p_brand) AS up, trim(concat('  ', p_name, '  ')) AS tr,
       substr(p_name, 2, 3) AS sub, replace(p_name, ' ', '_') AS rep, split_part(p_brand, '#', 2) AS num,
       lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, concat_ws('-', p_brand, p_type) AS cw,
       CAST(length(p_name) AS BIGINT) AS len, reverse(p_name) AS rev, CAST(strpos(p_name, 'e') AS BIGINT) AS pos,
       p_brand || '/' || p_type AS piped
FROM part""")

sql_case("str_regex", """
SELECT p_partkey, regexp_extract(p_name, '^([a-z]+) ([a-z]+)$', 2) AS noun,
       regexp_replace(p_name, '[aeiou]', '*') AS starred,
       p_name RLIKE 'o{2}' AS double_o,
       CAST(levenshtein(p_name, 'red widget') AS BIGINT) AS lev
FROM part""", """
SELECT p_partkey, regexp_extract(p_name, '^([a-z]+) ([a-z]+)$', 2) AS noun,
       regexp_replace(p_name, '[aeiou]', '*', 'g') AS starred,
       regexp_matches(p_name, 'o{2}') AS double_o,
       CAST(levenshtein(p_name, 'red widget') AS BIGINT) AS lev
FROM part""")

sql_case("str_hash", "SELECT c_custkey, md5(c_name) AS md5_name, sha2(c_name, 256) AS sha_name FROM customer",
         "SELECT c_custkey, md5(c_name) AS md5_name, sha256(c_name) AS sha_name FROM customer")

sql_case("dt_trunc", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP_NTZ) AS m,
       CAST(date_trunc('week', o_orderdate) AS TIMESTAMP_NTZ) AS w,
       CAST(date_trunc('year', o_orderdate) AS TIMESTAMP_NTZ) AS y,
       CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP_NTZ) AS q
FROM orders""", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS m,
       CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS w,
       CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS y,
       CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS q
FROM orders""")

sql_case("dt_extract", """
SELECT event_id, CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS mo, CAST(day(ts) AS INT) AS d,
       CAST(quarter(ts) AS INT) AS q, CAST(dayofweek(ts) - 1 AS INT) AS dow, CAST(hour(ts) AS INT) AS h,
       CAST(minute(ts) AS INT) AS mi, CAST(dayofyear(ts) AS INT) AS doy, CAST(weekofyear(ts) AS INT) AS wk,
       CAST(extract(SECOND FROM ts) AS DOUBLE) AS sec
FROM events""", """
SELECT event_id, CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS mo, CAST(day(ts) AS INT) AS d,
       CAST(quarter(ts) AS INT) AS q, CAST(dayofweek(ts) AS INT) AS dow, CAST(hour(ts) AS INT) AS h,
       CAST(minute(ts) AS INT) AS mi, CAST(dayofyear(ts) AS INT) AS doy, CAST(weekofyear(ts) AS INT) AS wk,
       CAST(date_part('microseconds', ts) AS DOUBLE) / 1000000 AS sec
FROM events""")

sql_case("dt_arith", """
SELECT o_orderkey, o_orderdate + INTERVAL 30 DAYS AS due,
       CAST(datediff(DATE '2002-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days_left,
       CAST((2002 * 12 + 1) - (year(o_orderdate) * 12 + month(o_orderdate)) AS BIGINT) AS months_left,
       add_months(CAST(o_orderdate AS DATE), 1) AS next_month,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       make_date(year(o_orderdate), 12, 31) AS year_end
FROM orders""", """
SELECT o_orderkey, o_orderdate + INTERVAL 30 DAYS AS due,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS BIGINT) AS days_left,
       CAST(date_diff('month', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS BIGINT) AS months_left,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month,
       last_day(CAST(o_orderdate AS DATE)) AS month_end,
       make_date(CAST(year(o_orderdate) AS INT), 12, 31) AS year_end
FROM orders""")

sql_case("dt_format", """
SELECT event_id, date_format(ts, 'yyyy-MM-dd HH:mm') AS minute_text,
       to_timestamp_ntz(date_format(ts, 'yyyy/MM/dd'), 'yyyy/MM/dd') AS parsed_day
FROM events""", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute_text,
       strptime(strftime(ts, '%Y/%m/%d'), '%Y/%m/%d') AS parsed_day
FROM events""")

sql_case("math_basic", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_quantity + 1 AS q1, l_quantity % 7 AS qmod, l_orderkey DIV 7 AS kdiv,
       floor(l_extendedprice / 100) AS fl, ceil(l_extendedprice / 100) AS ce, abs(l_tax - 0.05) AS ab,
       sqrt(l_quantity) AS sq, round(ln(l_extendedprice), 9) AS lnp, power(l_discount, 2) AS pw,
       greatest(l_tax, l_discount) AS gt, least(l_tax, l_discount) AS lt, sign(l_tax - 0.04) AS sg,
       try_divide(l_quantity, l_tax) AS per_tax
FROM lineitem""", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_quantity + 1 AS q1, l_quantity % 7 AS qmod, l_orderkey // 7 AS kdiv,
       CAST(floor(l_extendedprice / 100) AS BIGINT) AS fl, CAST(ceil(l_extendedprice / 100) AS BIGINT) AS ce,
       abs(l_tax - 0.05) AS ab,
       sqrt(l_quantity) AS sq, round(ln(l_extendedprice), 9) AS lnp, power(l_discount, 2) AS pw,
       greatest(l_tax, l_discount) AS gt, least(l_tax, l_discount) AS lt, CAST(sign(l_tax - 0.04) AS DOUBLE) AS sg,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity / l_tax END AS per_tax
FROM lineitem""")

sql_case("cond", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'OTHER') AS seg,
       CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
       if(c_nationkey < 12, 'west', 'east') AS side,
       try_cast(substr(c_name, 10) AS INT) AS name_no, try_cast(c_mktsegment AS INT) AS bad_int,
       c_nationkey::STRING AS nation_text
FROM customer""", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'OTHER') AS seg,
       CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
       if(c_nationkey < 12, 'west', 'east') AS side,
       try_cast(substr(c_name, 10) AS INT) AS name_no, try_cast(c_mktsegment AS INT) AS bad_int,
       c_nationkey::VARCHAR AS nation_text
FROM customer""")

sql_case("arr", """
SELECT vec_id, CAST(size(embedding) AS BIGINT) AS dim,
       round(sqrt(aggregate(embedding, CAST(0 AS DOUBLE), (acc, x) -> acc + CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6)
         AS norm,
       CAST(element_at(embedding, 1) AS DOUBLE) AS first_x,
       CAST(size(filter(embedding, x -> x > 0)) AS BIGINT) AS n_pos,
       CAST(sort_array(embedding)[0] AS DOUBLE) AS min_x,
       array_contains(transform(embedding, x -> x > 0.5), true) AS any_big
FROM embeddings""", """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dim,
       round(sqrt(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)),
                              lambda a, b: a + b)), 6) AS norm,
       CAST(embedding[1] AS DOUBLE) AS first_x,
       CAST(len(list_filter(embedding, lambda x: x > 0)) AS BIGINT) AS n_pos,
       CAST(list_sort(embedding)[1] AS DOUBLE) AS min_x,
       list_contains(list_transform(embedding, lambda x: x > 0.5), true) AS any_big
FROM embeddings""")

sql_case("map_struct", """
SELECT c_custkey, named_struct('k', c_custkey, 'n', c_name).n AS s_name,
       map('seg', c_mktsegment, 'name', c_name)['seg'] AS m_seg,
       CAST(cardinality(map('seg', c_mktsegment, 'name', c_name)) AS BIGINT) AS m_size
FROM customer""", """
SELECT c_custkey, struct_pack(k := c_custkey, n := c_name).n AS s_name,
       map(['seg', 'name'], [c_mktsegment, c_name])['seg'] AS m_seg,
       CAST(cardinality(map(['seg', 'name'], [c_mktsegment, c_name])) AS BIGINT) AS m_size
FROM customer""")

sql_case("json_props", """
SELECT event_id, get_json_object(props, '$.k') AS k_text,
       from_json(props, 'k INT').k AS k_int,
       CAST(get_json_object(props, '$.missing') AS STRING) AS absent
FROM events""", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(props ->> 'k' AS INTEGER) AS k_int,
       json_extract_string(props, '$.missing') AS absent
FROM events""")


@case("mask_secret", """
SELECT c_custkey,
       CASE WHEN c_name IS NULL OR length(c_name) = 0 THEN ''
            WHEN length(c_name) <= 8 THEN '****'
            ELSE left(c_name, 4) || '****' || right(c_name, 4) END AS masked,
       CASE WHEN length(c_mktsegment) <= 8 THEN '****'
            ELSE left(c_mktsegment, 4) || '****' || right(c_mktsegment, 4) END AS masked_seg
FROM customer""")
def mask_secret_q(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", mask_secret("c_name").alias("masked"), mask_secret("c_mktsegment").alias("masked_seg"))


@case("compat_functions", """
SELECT p_partkey, strpos(p_name, 'e') AS pos, regexp_matches(p_name, 'o{2}') AS oo,
       list_contains(string_split(p_name, ' '), 'red') AS has_red,
       array_to_string(list_sort(list_distinct(string_split(p_name || ' ' || p_type, ' '))), '|') AS words
FROM part""")
def compat_functions(spark, d):
    from reportlake.functions.compat import register_compat
    from reportlake.plans import gateway
    from reportlake.sources.parquet import register_dir

    register_dir(spark, d)
    register_compat(spark)
    return gateway.sql(spark, """
SELECT p_partkey, strpos(p_name, 'e') AS pos, regexp_matches(p_name, 'o{2}') AS oo,
       list_contains(string_split(p_name, ' '), 'red') AS has_red,
       array_join(list_sort(list_distinct(string_split(p_name || ' ' || p_type, ' '))), '|') AS words
FROM part""")
