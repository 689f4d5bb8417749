"""Read-only SQL gateway: guard, comment strip, syntax check, capped count and paging.

A user query is text. It is screened, handed to ``spark.sql`` (which parses and
analyses eagerly but runs nothing), and wrapped in a lazy :class:`Page`. Only the
requested page is ever collected; the total is ``limit(cap).count()`` so counting
stops once the cap is reached.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.plans import lexer
from reportlake.session import configure, scoped_conf

# Fixed values that must equal the reference behaviour.
DEFAULT_PAGE_SIZE = 50
ALLOWED_PREFIXES = ("SELECT", "WITH", "EXPLAIN", "DESCRIBE", "SHOW", "PRAGMA")
FORBIDDEN_WORDS = (
    "INSERT", "UPDATE", "DELETE", "DROP", "TRUNCATE", "ALTER",
    "CREATE", "MERGE", "REPLACE", "GRANT", "REVOKE",
)
# Read-only statement starts Spark adds on top (pipe syntax, VALUES, TABLE).
SPARK_READ_PREFIXES = ("FROM", "VALUES", "TABLE")

# A word boundary over Unicode letters and digits, written out so Java regex
# (Spark ``rlike``) and RE2 agree on it.
_WORD = r"[\p{L}\p{N}_]"
# prefix test only: the reference's trailing ".*" (whole-text match) adds nothing but a scan
ALLOWED_RE = r"(?is)^\s*(" + "|".join(ALLOWED_PREFIXES) + r")(?!" + _WORD + r")"
FORBIDDEN_RE = r"(?i)(^|[^\p{L}\p{N}_])(" + "|".join(FORBIDDEN_WORDS) + r")([^\p{L}\p{N}_]|$)"

# One alternation: literals and quoted identifiers are captured and put back,
# comments match without a capture and vanish.
# Written as "unrolled loops" (a character class repeated, then rare escapes) so Java's regex
# engine matches long texts iteratively instead of recursing once per character.
_LITERAL_OR_COMMENT = (r"""(?s)('[^'\\]*(?:(?:''|\\.)[^'\\]*)*'|"[^"\\]*(?:(?:""|\\.)[^"\\]*)*"|`[^`]*`|/\*\+)"""
                       r"""|--[^\n]*|/\*[^*]*\*+(?:[^/*][^*]*\*+)*/""")

#: Functions that call into the JVM, whatever way they are named.
JVM_CALLS = ("java_method", "reflect", "try_reflect")
#: Nodes of a parsed plan that change something or start a program.
_CHANGES = re.compile(r"^[\s:|+-]*'?(?:\w*(?:Insert|Create|Drop|Truncate|Alter|Rename|Merge|Update|Delete|Replace(?!Null)|Append|Overwrite|"
                      r"Load|Cache|Refresh|Analyze|Repair|Set(?:Catalog|Namespace|Variable|Command|Table)|AddJar|AddFile|Call)\w*"
                      r"|ScriptTransformation|\w+Command)\b", re.M)
#: Words that make it worth asking Spark's parser what a statement is.
_DOUBTFUL = {*FORBIDDEN_WORDS, "TRANSFORM", "MAP", "REDUCE", "USING", "IDENTIFIER", "LOAD", "SET", "CALL", "EXECUTE"}


class QueryRejected(ValueError):
    """The text is not a read-only statement the gateway accepts."""


class QuerySyntaxError(ValueError):
    """Spark could not parse or analyse the statement."""


def _py(pattern: str) -> re.Pattern:
    # Python ``re`` has no \p{..}; \w with re.UNICODE is letters, digits and underscore.
    return re.compile(pattern.replace(r"[\p{L}\p{N}_]", r"\w").replace(r"[^\p{L}\p{N}_]", r"\W")
                      .replace("(?is)", "").replace("(?i)", ""), re.IGNORECASE | re.DOTALL)


_ALLOWED_PY = _py(ALLOWED_RE)
_FORBIDDEN_PY = _py(FORBIDDEN_RE)


def strip_sql(sql: str) -> str:
    """Remove ``--`` and ``/* */`` comments (not inside literals, quoted names or hints) and one trailing ``;``."""
    out = lexer.without_comments(sql).rstrip()
    return out[:-1].rstrip() if out.endswith(";") else out


def strip_sql_col(col: Column | str) -> Column:
    """Column form of :func:`strip_sql` for screening a table of query texts. Comments inside comments, raw strings and
    comments that alone part two words need the lexer."""
    c = F.col(col) if isinstance(col, str) else col
    no_comments = F.regexp_replace(c, _LITERAL_OR_COMMENT, "$1")
    trimmed = F.regexp_replace(no_comments, r"\s+$", "")
    return F.regexp_replace(F.regexp_replace(trimmed, r";$", ""), r"\s+$", "")


def check_sql(sql: str | None, mode: str = "default") -> str:
    """Return the cleaned statement or raise :class:`QueryRejected`.

    ``compat`` reproduces the reference guard exactly: a prefix whitelist and a
    keyword blacklist anywhere in the text (so ``'delete'`` in a literal or a call
    to ``replace()`` is rejected too). ``default`` reads the text as Spark's lexer does: one statement that begins like a
    read (behind its common table expressions too), calls no function of the JVM and starts no program. Words inside literals,
    quoted names and columns named like a command don't matter.
    """
    if sql is None or not sql.strip():
        raise QueryRejected("SQL must not be blank")
    if mode == "compat":
        text = sql.strip()
        if not _ALLOWED_PY.match(text):
            raise QueryRejected("only SELECT / WITH / EXPLAIN / DESCRIBE / SHOW / PRAGMA statements are allowed")
        if _FORBIDDEN_PY.search(text):
            raise QueryRejected("statement contains a forbidden keyword")
        return text
    text = strip_sql(sql).strip()
    if not text:
        raise QueryRejected("SQL must not be blank")
    code = lexer.code(text)
    if any(t.text == ";" and t.kind == "sign" for t in code):
        raise QueryRejected("only one statement is allowed")
    _check_start(code)
    for i, t in enumerate(code[:-1]):
        after = code[i + 1]
        if after.text == "(" and t.called in JVM_CALLS:
            raise QueryRejected("calls into the JVM are not allowed")
        if after.text == "(" and t.upper == "IDENTIFIER":
            end = _closing(code, i + 1)
            if end + 1 < len(code) and code[end + 1].text == "(":
                raise QueryRejected("functions must be called by their name")
        if t.upper == "USING" and after.kind == "string":
            raise QueryRejected("programs can't be started")
    return text


def _closing(code: list[lexer.Token], at: int) -> int:
    """Place of the parenthesis that closes the one at ``at`` (or the end)."""
    depth = 0
    for i in range(at, len(code)):
        depth += {"(": 1, ")": -1}.get(code[i].text, 0) if code[i].kind == "sign" else 0
        if depth == 0:
            return i
    return len(code)


def _check_start(code: list[lexer.Token], query_only: bool = False) -> None:
    """The statement is a read: its first word, that of an explained statement, and that behind ``WITH`` ..."""
    first = code[0].upper if code else ""
    if first == "PRAGMA":
        raise QueryRejected("PRAGMA is not a Spark statement")
    if query_only and code and code[0].text == "(":
        return
    allowed = {"SELECT", "WITH", *SPARK_READ_PREFIXES} | (set() if query_only else set(ALLOWED_PREFIXES))
    if first not in allowed:
        raise QueryRejected("only read-only statements are allowed")
    if first == "EXPLAIN":
        rest = code[1:]
        while rest and rest[0].upper in ("EXTENDED", "CODEGEN", "COST", "FORMATTED", "LOGICAL"):
            rest = rest[1:]
        _check_start(rest, True)
    elif first == "WITH":
        at = 1
        while at < len(code):  # name, column list, AS, query in parentheses; then a comma or the statement
            while at < len(code) and code[at].upper != "AS":
                at = _closing(code, at) + 1 if code[at].text == "(" else at + 1
            at = _closing(code, at + 1) + 1
            if at < len(code) and code[at].text == ",":
                at += 1
                continue
            break
        _check_start(code[at:], True)
    elif first == "FROM" and any(t.upper == "INSERT" and code[i + 1].upper in ("INTO", "OVERWRITE") for i, t in enumerate(code[:-1])):
        raise QueryRejected("only read-only statements are allowed")


def _check_plan(spark: SparkSession, text: str) -> None:
    """Second look, where words of the text leave a doubt: Spark's own parse of the statement, which runs nothing."""
    words = {t.upper for t in lexer.code(text)}
    if not words & _DOUBTFUL or lexer.code(text)[0].upper in ("EXPLAIN", "DESCRIBE", "SHOW"):
        return
    plan = spark.sql("EXPLAIN EXTENDED " + text).first()[0]
    parsed = plan.partition("== Analyzed Logical Plan ==")[0].partition("== Parsed Logical Plan ==")[2]
    if _CHANGES.search(parsed):
        raise QueryRejected("the statement is not a read")


def screen_sql_col(col: Column | str) -> Column:
    """Compat guard as a Column: struct(ok boolean, reason string) per query text."""
    c = F.col(col) if isinstance(col, str) else col
    t = F.trim(c)
    reason = (
        F.when(c.isNull() | (t == ""), F.lit("blank"))
        .when(~t.rlike(ALLOWED_RE), F.lit("prefix"))
        .when(t.rlike(FORBIDDEN_RE), F.lit("keyword"))
    )
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


def reason_of(text: str | None) -> str | None:
    """Why the default mode rejects a text (without Spark's second look), or None."""
    try:
        check_sql(text)
    except QueryRejected as exc:
        return str(exc)
    return None


def screen_default_col(col: Column | str) -> Column:
    """Default guard as a Column: the reason a query text is rejected for, null if it isn't (Arrow batches through the lexer)."""
    @F.pandas_udf("string")
    def reasons(texts: pd.Series) -> pd.Series:
        return pd.Series([reason_of(x if isinstance(x, str) else None) for x in texts], dtype=object)

    return reasons(F.col(col) if isinstance(col, str) else col)


def sql(spark: SparkSession, text: str, mode: str = "default") -> DataFrame:
    """Screen, parse and analyse a read-only statement; the result is lazy."""
    configure(spark)
    clean = check_sql(text, mode)
    try:
        # double quotes name columns (as users of the reference expect); SQL on raw file
        # paths stays off, files come in through ``sources.files.read_file``
        with scoped_conf(spark, **{"spark.sql.ansi.doubleQuotedIdentifiers": "true",
                                   "spark.sql.runSQLOnFiles": "false"}):
            if mode != "compat":
                _check_plan(spark, clean)
            return spark.sql(clean)
    except Exception as exc:  # ParseException / AnalysisException
        if exc.__class__.__name__ in ("ParseException", "AnalysisException"):
            raise QuerySyntaxError(str(exc).splitlines()[0]) from exc
        raise


def validate_syntax(spark: SparkSession, text: str, mode: str = "default") -> None:
    """Parse and analyse without running anything (Spark analysis is eager, execution lazy)."""
    sql(spark, text, mode)


def capped_count(df: DataFrame, cap: int | None = None) -> int:
    """The exact row count; with a ``cap``, ``min(count, cap)``, for which Spark stops scanning early."""
    return df.count() if cap is None else df.limit(cap).count()


def clamp(page: int, size: int, cap: int | None = None) -> tuple[int, int]:
    size = max(int(size), 1)
    return max(int(page), 0), size if cap is None else min(size, cap)


def page_of(df: DataFrame, page: int = 0, size: int = DEFAULT_PAGE_SIZE, cap: int | None = None) -> DataFrame:
    """Rows ``[page*size, page*size+size)``; with an ORDER BY Spark plans TakeOrderedAndProject."""
    p, s = clamp(page, size, cap)
    off = p * s
    return (df.offset(off) if off else df).limit(s)


@dataclass
class Page:
    """One page of a lazy result: ``rows`` is the only thing collected."""

    df: DataFrame
    page: int = 0
    size: int = DEFAULT_PAGE_SIZE
    cap: int | None = None  # on counted rows and the page size, where the caller wants one
    timeout_s: float | None = None
    pool: str | None = None  # FAIR scheduler pool for this page's jobs (concurrent users)

    def __post_init__(self):
        self.page, self.size = clamp(self.page, self.size, self.cap)

    def _run(self, action):
        sc = self.df.sparkSession.sparkContext
        old = sc.getLocalProperty("spark.scheduler.pool")
        if self.pool is not None:
            sc.setLocalProperty("spark.scheduler.pool", self.pool)
        try:
            if self.timeout_s is None:
                return action()
            return run_with_timeout(self.df.sparkSession, action, self.timeout_s)
        finally:
            if self.pool is not None:
                sc.setLocalProperty("spark.scheduler.pool", old)

    @property
    def columns(self) -> list[str]:
        return list(self.df.columns)

    @property
    def frame(self) -> DataFrame:
        return page_of(self.df, self.page, self.size, self.cap)

    def total_rows(self) -> int:
        return self._run(lambda: capped_count(self.df, self.cap))

    def total_is_capped(self) -> bool:
        """Whether the total stopped at the cap the caller set."""
        return self.cap is not None and not self._run(lambda: self.df.offset(self.cap).limit(1).isEmpty())

    def total_pages(self) -> int:
        t = self.total_rows()
        return -(-t // self.size)

    def rows(self) -> list[tuple]:
        return [tuple(r) for r in self._run(self.frame.collect)]

    def digest(self, top: int = 20) -> str:
        """Short text digest: total, columns, the first ``top`` rows and "... of N"."""
        total = self.total_rows()
        rows = [tuple(r) for r in self._run(page_of(self.df, 0, top, self.cap).collect)]
        lines = [f"total rows: {total}", "columns: " + ", ".join(self.columns), f"first {len(rows)} rows:"]
        lines += [f"  {list(r)}" for r in rows]
        if total > top:
            lines.append(f"  ... (of {total} rows)")
        return "\n".join(lines)


def run_sql(spark: SparkSession, text: str, page: int = 0, size: int = DEFAULT_PAGE_SIZE,
            mode: str = "default", cap: int | None = None, timeout_s: float | None = None,
            pool: str | None = None) -> Page:
    """Guarded query → lazy page (the reference's execute endpoint). Collecting the page or the
    total is cancelled after ``timeout_s`` seconds (default: no limit), counts stop at ``cap`` (default: exact); with ``pool`` its jobs run
    in that FAIR scheduler pool, so one user's large query does not starve the others."""
    return Page(sql(spark, text, mode), page, size, cap, timeout_s, pool)


def page_count_col(total: Column, size: int) -> Column:
    """``ceil(total / size)`` as a Column."""
    return F.ceil(total / F.lit(size)).cast("bigint")


def run_with_timeout(spark: SparkSession, action, seconds: float, tag: str = "reportlake-query"):
    """Run ``action()`` and cancel its Spark jobs once ``seconds`` have passed (the timeout the
    reference reads but never applies). Jobs started by this thread carry ``tag``; after the
    deadline a watcher keeps cancelling jobs with that tag until the action gives up, so a job
    submitted late (after planning) is cancelled too."""
    import threading
    import uuid

    sc = spark.sparkContext
    tag = f"{tag}-{uuid.uuid4().hex[:8]}"
    done = threading.Event()

    def watch():
        if done.wait(seconds):
            return
        while not done.is_set():
            sc.cancelJobsWithTag(tag)
            done.wait(0.5)

    sc.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        return action()
    finally:
        done.set()
        sc.removeJobTag(tag)
