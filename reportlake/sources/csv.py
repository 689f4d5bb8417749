"""CSV/TXT ingest: dialect vote, whole records, header handling and exact type detection.

Spark's CSV reader has no sniffer (``a;b`` reads as one column) and its schema
inference picks ``int`` where a report engine wants BIGINT. Here:

1. ``sniff_csv`` votes for quote and delimiter over all lines (one aggregation; only counts reach the driver).
2. A quote opens a field only at its start. If some field really goes on over the end of a line, records are put
   together from lines (``records``): states are carried from block to block, so a large file stays split.
   A quote that never closes fails the load.
3. The header record of every part is read; parts with other column orders are matched by name. Names are
   deduplicated case-insensitively.
4. Rows with more fields than the header are kept apart (``csv_rejects``) and counted; short rows end in NULLs.
5. Every column is read as text, then one aggregation finds the types all its cells parse as; the narrowest
   wins, else STRING. Values are converted with ``try_cast``, so an unparseable cell becomes NULL (A05).
"""

from __future__ import annotations

import csv as _csv
import io
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.sources.headers import blank_to_positional, dedupe_names

# Candidate delimiters and quotes, and the type ladder, narrowest first.
DELIMITERS = (",", ";", "\t", "|")
QUOTES = ('"', "'")
TYPE_LADDER = ("boolean", "bigint", "double", "date", "timestamp_ntz", "date_ymd", "date_dmy", "date_mdy")

# Shape checks run before every cast: a failed string→number cast costs a JVM exception,
# a regex mismatch does not.
_INT_RE = r"^[+-]?\d{1,19}$"
_NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DATE_RE = r"^\d{4}-\d{2}-\d{2}$"
_TS_RE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"
_YMD_RE = r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})$"
_DMY_RE = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$"
#: other date forms: shape, and its parts written as an ISO date; day first where both readings fit every cell
_DATE_FORMS = {"date_ymd": (_YMD_RE, "$1-$2-$3"), "date_dmy": (_DMY_RE, "$3-$2-$1"), "date_mdy": (_DMY_RE, "$3-$1-$2")}
_BAD = "__bad_record"


@dataclass
class Dialect:
    delimiter: str = ","
    quote: str = '"'
    multiline: bool = False  # some quoted field goes on over the end of a line


def sniff_csv(spark: SparkSession, path) -> Dialect:
    """Quote, delimiter and whether records span lines, voted over all lines.

    The quote is the candidate that encloses a whole field on more lines. The delimiter is the one whose count
    outside quoted parts is the same on the most lines (then the larger count). One aggregation by
    (candidate, count) answers both.
    """
    lines = spark.read.text(path).select(F.col("value").alias("v")).where(F.trim("v") != "")
    votes = []
    for qi, q in enumerate(QUOTES):
        has = F.col("v").contains(q)
        bare = F.when(has, F.regexp_replace("v", f"{q}[^{q}]*{q}", "")).otherwise(F.col("v"))
        votes += [F.struct(F.lit(qi).alias("q"), F.lit(di).alias("d"),
                           (F.length(bare) - F.length(F.replace(bare, F.lit(d)))).alias("n"))
                  for di, d in enumerate(DELIMITERS)]
        whole = has & F.col("v").rlike(f"(^|[,;\t|]){q}[^{q}]*{q}([,;\t|]|$)")
        votes.append(F.struct(F.lit(qi).alias("q"), F.lit(-1).alias("d"), whole.cast("int").alias("n")))
        votes.append(F.struct(F.lit(qi).alias("q"), F.lit(-2).alias("d"), has.cast("int").alias("n")))
    stats = (lines.select(F.explode(F.array(*votes)).alias("v"))
             .groupBy("v.q", "v.d", "v.n").agg(F.count("*").alias("lines")).collect())
    wrapped = [sum(r["lines"] for r in stats if r["q"] == qi and r["d"] == -1 and r["n"]) for qi in range(len(QUOTES))]
    qi = max(range(len(QUOTES)), key=lambda i: (wrapped[i], -i))
    cands = sorted((r for r in stats if r["q"] == qi and r["d"] >= 0 and r["n"] > 0),
                   key=lambda r: (-r["lines"], -r["n"], r["d"]))
    found = Dialect(DELIMITERS[cands[0]["d"]] if cands else ",", QUOTES[qi])
    if any(r["q"] == qi and r["d"] == -2 and r["n"] for r in stats):  # from a closed state only an open line changes it
        open_line = F.col("v").contains(found.quote) & _left_open(F.col("v"), found)
        found.multiline = not lines.where(open_line).limit(1).isEmpty()
    return found


def _left_open(line: Column, d: Dialect) -> Column:
    """Whether a line that starts outside of quotes ends inside a quoted field."""
    q, sep = d.quote, _regex_quote(d.delimiter)
    quoted = f"{q}(?:[^{q}]++|{q}{q})*+"
    return line.rlike(f"^(?:(?:{quoted}{q}[^{sep}]*+|(?!{q})[^{sep}]*+){sep})*+{quoted}$")


def _regex_quote(d: str) -> str:
    return "\\" + d if d in "|.^$*+?()[]{}\\" else d


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines with their place: file, start of the split, order inside it."""
    return spark.read.text(path).select(
        F.col("value").alias("v"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def records(spark: SparkSession, path, d: Dialect) -> DataFrame:
    """``(file, head, record)``: one row per CSV record of files whose records span lines.

    A line maps the state before it (inside quotes or not) to the state after it; two of the four maps forget the
    state before, the others keep or swap it. Inside a split a window composes them; one row per split then
    carries the state on through its file. Lines of one record are gathered, all others are records as they are.
    """
    plain = _left_open(F.col("v"), d)
    within = _left_open(F.concat(F.lit(d.quote), F.col("v")), d)
    quoted = F.col("v").contains(d.quote)
    own = Window.partitionBy("file", "block").orderBy("at")
    before, upto = own.rowsBetween(Window.unboundedPreceding, -1), own.rowsBetween(Window.unboundedPreceding, 0)
    maps = (_lines(spark, path).withColumn("t0", quoted & plain).withColumn("t1", ~quoted | within)
            .withColumn("swap", (F.col("t0") & ~F.col("t1")).cast("long"))
            .withColumn("swaps", F.sum("swap").over(upto))
            .withColumn("mark", F.when(F.col("t0") == F.col("t1"), F.struct(F.col("t0").cast("long").alias("s"),
                                                                            F.col("swaps").alias("n")))))
    last = F.last("mark", ignorenulls=True)
    maps = (maps.withColumn("m", last.over(before)).withColumn("after", last.over(upto))
            .withColumn("k", F.col("swaps") - F.col("swap")))

    def state(mark: str, swaps: Column, start: Column) -> Column:
        return (F.coalesce(F.col(f"{mark}.s"), start) + swaps - F.coalesce(F.col(f"{mark}.n"), F.lit(0))) % 2

    def first_outside(start: int) -> Column:
        return F.max(F.when(state("m", F.col("k"), F.lit(start)) == 0, F.col("at")))

    blocks = maps.groupBy("file", "block").agg(
        F.max_by(state("after", F.col("swaps"), F.lit(0)), "at").alias("e0"),
        F.max_by(state("after", F.col("swaps"), F.lit(1)), "at").alias("e1"),
        first_outside(0).alias("b0"), first_outside(1).alias("b1"),
        F.min(F.when(F.trim("v") != "", F.col("at"))).alias("top"))
    order = Window.partitionBy("file").orderBy("block")  # one row per split of a file
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    both = F.when(F.col("e0") == F.col("e1"), F.struct(F.col("e0").alias("s"), F.col("turns").alias("n")))
    blocks = (blocks.withColumn("turn", ((F.col("e0") == 1) & (F.col("e1") == 0)).cast("long"))
              .withColumn("turns", F.sum("turn").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("both", both).withColumn("p", F.last("both", ignorenulls=True).over(past)))
    blocks = blocks.withColumn("start", state("p", F.col("turns") - F.col("turn"), F.lit(0)))
    begin = F.when(F.col("start") == 0, F.col("b0")).otherwise(F.col("b1"))
    blocks = (blocks.withColumn("end", F.when(F.col("start") == 0, F.col("e0")).otherwise(F.col("e1")))
              .withColumn("begin", F.when(begin.isNotNull(), F.struct("block", begin.alias("at"))))
              .withColumn("carry", F.last("begin", ignorenulls=True).over(past)))
    unclosed = blocks.groupBy("file").agg(F.max_by("end", "block").alias("end")).where("end = 1").limit(1).collect()
    if unclosed:
        raise ValueError(f"a quoted field of {unclosed[0]['file']} is never closed")
    lines = (maps.join(blocks.select("file", "block", "start", "carry", "top"), ["file", "block"])
             .withColumn("before", state("m", F.col("k"), F.col("start")))
             .withColumn("open", F.when(F.col("before") == 0, F.col("t0")).otherwise(F.col("t1")))
             .withColumn("here", F.last(F.when(F.col("before") == 0, F.struct("block", "at")), ignorenulls=True).over(upto))
             .withColumn("first", F.coalesce("here", "carry"))
             .withColumn("head", (F.col("block") == 0) & (F.col("at") == F.col("top"))))
    single = lines.where((F.col("before") == 0) & ~F.col("open") & (F.trim("v") != "")).select(
        "file", "head", F.col("v").alias("record"))
    spanning = (lines.where((F.col("before") == 1) | F.col("open")).groupBy("file", "first")
                .agg(F.max("head").alias("head"), F.sort_array(F.collect_list(F.struct("block", "at", "v"))).alias("l"))
                .select("file", "head", F.concat_ws("\n", F.col("l.v")).alias("record")))
    return single.unionByName(spanning)


def _headers(spark: SparkSession, path, d: Dialect) -> list[tuple[str, list[str]]]:
    """Distinct header records with the files they head; the files are listed only if headers differ."""
    if d.multiline:
        heads = records(spark, path, d).where("head").select("file", F.col("record").alias("h"))
    else:
        heads = (_lines(spark, path).where((F.col("block") == 0) & (F.trim("v") != ""))
                 .groupBy("file").agg(F.min_by("v", "at").alias("h")))
    kinds = heads.groupBy("h").agg(F.min("file").alias("file")).orderBy("file").collect()
    if len(kinds) < 2:
        return [(r["h"], []) for r in kinds]
    files: dict[str, list[str]] = {r["h"]: [] for r in kinds}
    for r in heads.orderBy("file").collect():
        files[r["h"]].append(r["file"])
    return list(files.items())


def _names(header: str, d: Dialect) -> list[str]:
    row = next(_csv.reader(io.StringIO(header.lstrip("\ufeff"), newline=""), delimiter=d.delimiter, quotechar=d.quote), [])
    return dedupe_names(blank_to_positional(row))


def read_header(spark: SparkSession, path, dialect: Dialect) -> list[str]:
    """Column names of the first file in path order."""
    found = _headers(spark, path, dialect)
    return _names(found[0][0], dialect) if found else []


def _options(d: Dialect) -> dict[str, str]:
    # field counts are only checked on whole rows: a pruned read would not see surplus fields
    return {"sep": d.delimiter, "quote": d.quote, "escape": d.quote, "mode": "PERMISSIVE", "columnPruning": "false",
            "columnNameOfCorruptRecord": _BAD}


def _text_rows(spark: SparkSession, path, names: list[str], d: Dialect) -> DataFrame:
    """All columns as strings (empty field → NULL) and ``__bad_record``, the text of a row with surplus fields."""
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    schema = T.StructType([*fields, T.StructField(_BAD, T.StringType(), True)])
    if d.multiline:
        rows = records(spark, path, d).where("NOT head").select(
            F.from_csv("record", F.lit(_ddl(schema)), _options(d)).alias("r")).select("r.*")
    else:
        rows = (spark.read.schema(schema).options(**_options(d)).option("header", True)
                .option("enforceSchema", True).option("encoding", "UTF-8").csv(path))
    if not names:
        return rows
    # short rows are marked bad too: a surplus field is what a schema with one more column finds. The empty piece
    # of the first column keeps the reader from being asked for the bad text alone, which it refuses.
    more = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
    text = F.concat(F.col(_BAD), F.coalesce(F.substring(F.col(f"`{names[0]}`"), 1, 0), F.lit("")))
    extra = F.from_csv(text, F.lit(_ddl(more)), {k: v for k, v in _options(d).items() if k != "columnNameOfCorruptRecord"})
    surplus = F.when(F.col(_BAD).isNotNull() & extra[f"c{len(names)}"].isNotNull(), F.col(_BAD))
    return rows.select(*[F.col(f"`{n}`") for n in names], surplus.alias(_BAD))


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + "` STRING" for f in schema.fields)


def read_text_columns(spark: SparkSession, path, names: list[str], dialect: Dialect) -> DataFrame:
    """All columns as strings under an explicit schema; rows with surplus fields are left to ``csv_rejects``."""
    rows = _text_rows(spark, path, names, dialect)
    return rows.where(F.col(_BAD).isNull()).drop(_BAD)


def fit_mask(c: Column) -> Column:
    """Bit i set when the cell parses as ``TYPE_LADDER[i]``; NULL for an empty cell.

    Cheap shape tests gate the expensive ones (CASE branches are evaluated lazily): only
    number-shaped text is cast to numbers, only text with dashes at positions 5 and 8 is
    tried as a date or timestamp, only short text as a boolean.
    """
    s = F.trim(c)
    n = F.length(s)
    low = F.lower(s)
    boolean = F.when((n <= 5) & low.isin("true", "false"), F.lit(1)).otherwise(F.lit(0))
    number = F.when(
        s.rlike(_NUM_RE),
        F.when(s.rlike(_INT_RE) & s.try_cast("bigint").isNotNull(), F.lit(2)).otherwise(F.lit(0))
        + F.when(s.try_cast("double").isNotNull(), F.lit(4)).otherwise(F.lit(0)),
    ).otherwise(F.lit(0))
    dated = (n >= 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
    temporal = F.when(
        dated,
        F.when((n == 10) & s.rlike(_DATE_RE) & s.try_cast("date").isNotNull(), F.lit(8 + 16)).otherwise(
            F.when(s.rlike(_TS_RE) & s.try_cast("timestamp_ntz").isNotNull(), F.lit(16)).otherwise(F.lit(0))),
    ).otherwise(F.lit(0))
    iso = {k: F.regexp_replace(s, shape, parts).try_cast("date").isNotNull() for k, (shape, parts) in _DATE_FORMS.items()}
    other = F.when(
        (n >= 8) & (n <= 10),
        F.when(s.rlike(_YMD_RE), F.when(iso["date_ymd"], F.lit(32)).otherwise(F.lit(0)))
        .when(s.rlike(_DMY_RE), F.when(iso["date_dmy"], F.lit(64)).otherwise(F.lit(0))
              + F.when(iso["date_mdy"], F.lit(128)).otherwise(F.lit(0)))
        .otherwise(F.lit(0))).otherwise(F.lit(0))
    return F.when(c.isNotNull(), boolean + number + temporal + other)


def detect_types(df: DataFrame, rejected: list[int] | None = None) -> dict[str, str]:
    """One pass over all rows → the narrowest type per text column.

    Rows are unpivoted to ``(column index, text)`` so ONE mask expression (the bitmask of
    ladder types a cell parses as) serves every column; ``bit_and`` per column index then
    keeps the types every non-empty cell fits, and the first one still set wins. Partial
    aggregation leaves one row per column per task before the shuffle, and the generated
    code stays the same size however wide the file is. Rows with a ``__bad_record`` have no say; their number is
    added to ``rejected``.
    """
    names = [n for n in df.columns if n != _BAD]
    if not names:
        return {}
    bad = F.col(_BAD) if _BAD in df.columns else F.lit(None).cast("string")
    cells = df.select(F.posexplode(F.array(*[F.when(bad.isNull(), F.col(f"`{n}`")) for n in names], bad)).alias("i", "v"))
    stats = cells.groupBy("i").agg(F.count("v").alias("n"), F.bit_and(fit_mask(F.col("v"))).alias("m")).collect()
    by_i = {r["i"]: r for r in stats}
    if rejected is not None:
        rejected.append(by_i[len(names)]["n"] if len(names) in by_i else 0)
    out = {}
    for i, name in enumerate(names):
        chosen = "string"
        r = by_i.get(i)
        if r is not None and r["n"]:
            for j, typ in enumerate(TYPE_LADDER):
                if r["m"] & (1 << j):
                    chosen = typ
                    break
        out[name] = chosen
    return out


def lenient_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``try_cast`` each named column (unparseable → NULL); others pass through."""
    return df.select(*[_cast_expr(F.col(f"`{n}`"), types.get(n, "string")).alias(n) for n in df.columns])


def bad_cell_counts(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column: non-null input cells and how many of them became NULL under ``types``
    (one aggregation pass; the result has one row per column)."""
    aggs = []
    for n, typ in types.items():
        src = F.col(f"`{n}`")
        tgt = _cast_expr(src, typ)
        aggs.append(F.struct(F.lit(n).alias("column_name"), F.lit(typ).alias("target_type"),
                             F.count(src).alias("n_cells"),
                             F.sum(F.when(src.isNotNull() & tgt.isNull(), 1).otherwise(0)).cast("bigint")
                             .alias("n_bad")))
    return raw.agg(F.array(*aggs).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def _cast_expr(c: Column, typ: str) -> Column:
    if typ == "string":
        return c
    s = F.trim(c)
    if typ == "boolean":
        low = F.lower(s)
        return F.when(low.isin("true", "false"), low == F.lit("true"))
    if typ in ("bigint", "int", "smallint", "tinyint"):
        return F.when(s.rlike(_INT_RE), s.try_cast(typ))
    if typ in ("double", "float") or typ.startswith("decimal"):
        return F.when(s.rlike(_NUM_RE), s.try_cast(typ))
    if typ == "date":  # ISO dates only: a bare '2024' is not a date
        return F.when(s.rlike(_DATE_RE), s.try_cast("date"))
    if typ in _DATE_FORMS:
        shape, parts = _DATE_FORMS[typ]
        return F.when(s.rlike(shape), F.regexp_replace(s, shape, parts).try_cast("date"))
    if typ.startswith("timestamp"):
        return F.when(s.rlike(_TS_RE) | s.rlike(_DATE_RE), s.try_cast(typ))
    return s.try_cast(typ)


def _all_text(spark: SparkSession, path, dialect: Dialect | None) -> DataFrame:
    d = dialect or sniff_csv(spark, path)
    heads = _headers(spark, path, d)
    if not heads:  # an empty upload
        return spark.createDataFrame([], f"{_BAD} string").select(_BAD)
    if len(heads) == 1:
        return _text_rows(spark, path, _names(heads[0][0], d), d)
    parts, spelling = [], {}
    for header, files in heads:  # one branch per distinct header
        rows = _text_rows(spark, files, _names(header, d), d)
        for c in rows.columns:
            spelling.setdefault(c.lower(), c)
        parts.append(rows.toDF(*[spelling[c.lower()] for c in rows.columns]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv(spark: SparkSession, path, dialect: Dialect | None = None, types: dict[str, str] | None = None,
             rejected: list[int] | None = None) -> DataFrame:
    """CSV/TXT file (or a directory of parts, matched by header names) → typed DataFrame.

    Rows with surplus fields are left out: their number, counted in the pass that finds the types, is added to
    ``rejected``, and ``csv_rejects`` gives their texts.
    """
    rows = _all_text(spark, path, dialect)
    found = types or detect_types(rows, rejected)
    if types and rejected is not None:
        rejected.append(csv_rejects(spark, path, dialect).count())
    return lenient_cast(rows.where(F.col(_BAD).isNull()).drop(_BAD), found)


def csv_rejects(spark: SparkSession, path, dialect: Dialect | None = None) -> DataFrame:
    """Texts of the rows with more fields than their header: ``record``."""
    rows = _all_text(spark, path, dialect)
    keep = [F.col(f"`{c}`") for c in rows.columns if c != _BAD][:1]
    return rows.where(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("record"), *keep).select("record")
