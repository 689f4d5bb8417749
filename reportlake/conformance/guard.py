"""The gateway's default guard and comment strip over a table of query texts made from the words of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from reportlake.conformance.registry import case, t
from reportlake.plans import gateway

_JVM, _READ = "calls into the JVM are not allowed", "only read-only statements are allowed"
#: Query text, the text without comments, the guard's answer; ~ stands for a quote, ^ for a backslash, @ for the words.
SHAPES = [
    ("SELECT ~it^~s -- @~ AS a /* @ */ FROM t -- @", "SELECT ~it^~s -- @~ AS a  FROM t", None),
    ("SELECT ~^~~, reflect(~java.lang.System~, ~getProperty~, ~@~), ~~", "SELECT ~^~~, reflect(~java.lang.System~, ~getProperty~, ~@~), ~~", _JVM),
    ("SELECT update, `drop` /* delete */ FROM t WHERE note = ~@ DROP TABLE x~;",
     "SELECT update, `drop`  FROM t WHERE note = ~@ DROP TABLE x~", None),
    ("SELECT ~@~; DROP TABLE x", "SELECT ~@~; DROP TABLE x", "only one statement is allowed"),
    ("WITH a AS (SELECT ~@~ AS x) INSERT INTO t SELECT * FROM a", "WITH a AS (SELECT ~@~ AS x) INSERT INTO t SELECT * FROM a", _READ),
    ("SELECT TRANSFORM(a) USING ~@~ FROM t", "SELECT TRANSFORM(a) USING ~@~ FROM t", "programs can~t be started"),
    ("SELECT `try_reflect` /* @ */ (~a~, ~b~)", "SELECT `try_reflect`  (~a~, ~b~)", _JVM),
]
_WORDS = "coalesce(regexp_replace(text, '[^a-z]+', ' '%s), '')"


def _part(part: int) -> str:
    """SQL for both engines: a part of the shape that a document's id selects."""
    texts = " ".join(f"WHEN {i} THEN " + ("NULL" if s[part] is None else f"'{s[part]}'") for i, s in enumerate(SHAPES))
    return f"replace(replace(replace(CASE doc_id % {len(SHAPES)} {texts} END, '~', chr(39)), '^', chr(92)), '@', w)"


@case("screen_default", f"""
SELECT doc_id, {_part(1)} AS stripped, {_part(2)} AS reason
FROM (SELECT doc_id, {_WORDS % ", 'g'"} AS w FROM documents)""")
def screen_default(spark, d):
    words = t(spark, d, "documents").select("doc_id", F.expr(_WORDS % "").alias("w"))
    texts = words.select("doc_id", F.expr(_part(0)).alias("sql"))
    return texts.select("doc_id", gateway.strip_sql_col("sql").alias("stripped"), gateway.screen_default_col("sql").alias("reason"))
