import pytest

from reportlake.plans import gateway as g
from reportlake.sources.parquet import register_dir
from conftest import SF, plan_text


@pytest.mark.parametrize("word", g.FORBIDDEN_WORDS)
def test_each_forbidden_word_blocked(word):
    with pytest.raises(g.QueryRejected):
        g.check_sql(f"SELECT 1 FROM t WHERE x = 1 {word} y", mode="compat")
    with pytest.raises(g.QueryRejected):
        g.check_sql(f"SELECT 1; {word} TABLE t")


@pytest.mark.parametrize("prefix", ["SELECT 1", "with a as (select 1) select * from a", "EXPLAIN SELECT 1",
                                    "describe t", "SHOW TABLES", "  \n select 2"])
def test_allowed_prefixes(prefix):
    assert g.check_sql(prefix, mode="compat")


def test_literal_and_replace_modes():
    q = "SELECT replace(name, 'a', 'b') FROM t WHERE note = 'please delete me'"
    with pytest.raises(g.QueryRejected):
        g.check_sql(q, mode="compat")
    assert g.check_sql(q) == q


def test_unicode_word_boundary():
    # a keyword glued to a letter is not a word of its own
    assert g.check_sql("SELECT éDROP FROM t", mode="compat")
    with pytest.raises(g.QueryRejected):
        g.check_sql("SELECT 1 FROM t WHERE a=1 -- drop", mode="compat")


def test_blank_and_prefix_rejected():
    for q in ["", "   ", None, "VACUUM", "CALL x()"]:
        with pytest.raises(g.QueryRejected):
            g.check_sql(q)


def test_strip_sql_keeps_literals():
    q = "SELECT '--not a comment' AS a, \"x--y\" /* c */ -- tail\n;  "
    assert g.strip_sql(q) == "SELECT '--not a comment' AS a, \"x--y\""
    assert g.strip_sql("select 1;") == "select 1"


def test_strip_sql_column_matches_python(spark):
    texts = ["SELECT 'a--b' -- c\n;", "/* x */ SELECT 1 /* y */;", "SELECT 'it''s' -- q"]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    got = [r[0] for r in df.select(g.strip_sql_col("q")).collect()]
    assert got == [g.strip_sql(t) for t in texts]


def test_long_text_regex_does_not_overflow(spark):
    big = "SELECT '" + ("x" * 200_000) + "' -- end"
    df = spark.createDataFrame([(big,)], "q string")
    assert df.select(g.strip_sql_col("q")).first()[0] == big[: -len(" -- end")]


def test_syntax_error(spark):
    register_dir(spark, SF)
    with pytest.raises(g.QuerySyntaxError):
        g.validate_syntax(spark, "SELECT nope FROM region")
    with pytest.raises(g.QuerySyntaxError):
        g.validate_syntax(spark, "SELECT FROM WHERE")


def test_page_clamps_and_plan(spark):
    register_dir(spark, SF)
    p = g.run_sql(spark, "SELECT * FROM orders ORDER BY o_orderkey", page=-3, size=0)
    assert (p.page, p.size) == (0, 1)
    big = g.Page(spark.table("orders"), 0, 10**9)
    assert big.size == 10**9 and g.Page(spark.table("orders"), 0, 10**9, cap=100).size == 100
    page = g.run_sql(spark, "SELECT * FROM orders ORDER BY o_orderkey", page=2, size=7)
    plan = plan_text(page.frame)
    assert "TakeOrderedAndProject" in plan
    keys = [r[0] for r in page.rows()]
    all_keys = [r[0] for r in spark.table("orders").orderBy("o_orderkey").select("o_orderkey").collect()]
    assert keys == all_keys[14:21]


def test_capped_count(spark):
    register_dir(spark, SF)
    assert g.capped_count(spark.table("lineitem"), 1000) == 1000
    assert g.capped_count(spark.table("region"), 1000) == 5


def test_digest_text(spark):
    register_dir(spark, SF)
    text = g.run_sql(spark, "SELECT n_name FROM nation ORDER BY n_name").digest()
    assert text.startswith("total rows: 25") and text.endswith("... (of 25 rows)")


def test_timeout_cancels_running_job(spark):
    import time

    from pyspark.sql import functions as F

    slow = spark.range(0, 10**12, 1, 8).select(F.sum(F.sqrt("id")))
    t0 = time.time()
    with pytest.raises(Exception):
        g.run_with_timeout(spark, lambda: slow.collect(), 2.0)
    assert time.time() - t0 < 60


def test_page_timeout(spark):
    import time

    page = g.Page(spark.range(0, 10**12, 1, 8).selectExpr("sum(sqrt(id)) AS s"), timeout_s=2.0)
    t0 = time.time()
    with pytest.raises(Exception):
        page.rows()
    assert time.time() - t0 < 60


def test_page_pool_is_restored(spark):
    register_dir(spark, SF)
    page = g.run_sql(spark, "SELECT r_name FROM region ORDER BY r_name", 0, 2, pool="reports")
    names = sorted(r["r_name"] for r in spark.table("region").collect())
    assert [r[0] for r in page.rows()] == names[:2]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") in (None, "default")


def test_sql_on_raw_files_is_off(spark):
    with pytest.raises(g.QuerySyntaxError):
        g.sql(spark, f"SELECT * FROM parquet.`{SF}/region.parquet`")
    assert spark.sql(f"SELECT count(*) FROM parquet.`{SF}/region.parquet`").first()[0] == 5  # outside the gateway


def test_total_is_exact_unless_a_cap_is_asked_for(spark):
    df = spark.range(250_000)
    assert g.Page(df).total_rows() == 250_000 and not g.Page(df).total_is_capped()
    assert g.Page(df, cap=100).total_rows() == 100 and g.Page(df, cap=100).total_is_capped()
    assert not g.Page(df, cap=250_000).total_is_capped()


@pytest.mark.parametrize("text", ["SELECT java_method('java.lang.System', 'getProperty', 'x')", "SELECT `reflect`('a', 'b')",
                                  "SELECT try_reflect ('a', 'b')"])
def test_no_jvm_calls(text):
    with pytest.raises(g.QueryRejected):
        g.check_sql(text)


@pytest.mark.parametrize("text", [
    r"SELECT '\'', reflect('java.lang.System', 'getProperty', 'java.version'), ''", "SELECT reflect/* x */('a', 'b')",
    "SELECT \"java_method\"('a', 'b')", "SELECT system.builtin.reflect('a', 'b')", "SELECT IDENTIFIER('ref' || 'lect')('a', 'b')",
    r"SELECT r'\', reflect('a', 'b'), ''", "SELECT 1 /* a /* b */ c */, reflect('a', 'b')", "SELECT $$'$$, reflect('a', 'b'), ''",
    "SELECT TRANSFORM(a) USING 'cat' AS b FROM t", "FROM t MAP a USING 'cat' AS b", "SELECT 1; SELECT 2",
    "WITH a AS (SELECT 1 AS x) INSERT INTO t SELECT * FROM a", "WITH a(x) AS (SELECT (1)), b AS (SELECT 2) DELETE FROM t",
    "FROM t INSERT OVERWRITE TABLE u SELECT *", "EXPLAIN EXTENDED DROP TABLE t", "EXPLAIN CREATE TABLE x (a INT)", "WITH"])
def test_default_guard_rejects(text):
    with pytest.raises(g.QueryRejected):
        g.check_sql(text)


def test_default_guard_lets_reads_through(spark):
    spark.sql("SELECT 1 AS update, 'x' AS `drop`, 3 AS map").createOrReplaceTempView("odd_names")
    for text, want in [("SELECT update, `drop`, map FROM odd_names", (1, "x", 3)), (r"SELECT 'it\'s -- here' AS a", ("it's -- here",)),
                       ("SELECT replace('abc', 'b', 'x') AS r", ("axc",)), ("SELECT transform(array(1), x -> x + 1)[0] AS t", (2,)),
                       ("WITH a(x) AS (SELECT (1)), b AS (SELECT x + 1 AS y FROM a) SELECT y FROM b", (2,)),
                       ("SELECT /*+ broadcast(b) */ a.map FROM odd_names a JOIN odd_names b USING (update)", (3,)),
                       ("SELECT/**/4 -- five", (4,)), ("SELECT 'reflect(1); DROP TABLE x' AS s;", ("reflect(1); DROP TABLE x",)),
                       ("SELECT IDENTIFIER('update') FROM odd_names", (1,))]:
        assert tuple(g.sql(spark, text).first()) == want, text
    assert g.sql(spark, "EXPLAIN SELECT 1").count() == 1 and g.sql(spark, "SHOW TABLES").columns
    assert g.strip_sql(r"SELECT 'it\'s -- here' AS a") == r"SELECT 'it\'s -- here' AS a"


def test_spark_is_asked_about_doubtful_statements(spark):
    """What the words alone don't tell is decided by the parsed plan, and nothing runs."""
    for text in ("INSERT INTO t SELECT 1", "CREATE VIEW v AS SELECT 1", "SELECT TRANSFORM(1) USING 'cat'", "DROP TABLE IF EXISTS t"):
        with pytest.raises(g.QueryRejected):
            g._check_plan(spark, text)
    g._check_plan(spark, "SELECT 1 AS update")


def test_tokens_make_up_the_text():
    from reportlake.plans import lexer

    text = ("SELECT 'a''b\\'c', \"x\"\"y\", `k``l`, r'\\', 1.5e-3, $t$ ' $t$ /*+ hint */ -- end \\\nstill the comment\n"
            "/* a /* b */ c */ FROM t /* open")
    held = list(lexer.tokens(text))
    assert "".join(t.text for t in held) == text
    assert [t.text for t in held if t.kind == "string"] == ["'a''b\\'c'", "r'\\'", "$t$ ' $t$"]
    assert [t.kind for t in held if t.kind in ("line", "comment")] == ["line", "comment", "comment"]
