"""Excel workbooks (.xlsx): sheet listing, cells, typed sheets, per-sheet CSV.

Workbooks are read by a Spark job: the ``binaryFile`` source gives one row per file,
``mapInPandas`` opens each one (stdlib ``zipfile`` + ``xml.etree``) and emits long
cells ``(path, sheet_idx, sheet, row, col, value, cell_type)``. Everything after
that — header pick, per-column type vote, reshaping into columns — is grouping on
the cell table. One task per workbook, so throughput comes from many files; a workbook that can't be read
fails alone. The first row is a header if all its cells are text. A column has the type of its first cell if
most of its cells agree, else STRING; cells that can't be cast to it become NULL and are counted.
"""

from __future__ import annotations

import io
import re
import zipfile
from dataclasses import dataclass, field
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.sources.headers import blank_to_positional, dedupe_names

# The fallback sheet name and the built-in date number formats.
FALLBACK_SHEET = "Sheet1"
BUILTIN_DATE_FORMATS = frozenset(range(14, 23)) | frozenset(range(45, 48))

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

CELL_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("sheet_idx", T.IntegerType()),
    T.StructField("sheet", T.StringType()), T.StructField("row", T.LongType()),
    T.StructField("col", T.IntegerType()), T.StructField("value", T.StringType()),
    T.StructField("cell_type", T.StringType()),
])
SHEET_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("sheet_idx", T.IntegerType()),
    T.StructField("sheet", T.StringType()),
])


def sheet_names(zf: zipfile.ZipFile | None) -> list[tuple[str, str | None]]:
    """(name, part path) per sheet in workbook order; ``[('Sheet1', None)]`` when the list is
    missing, unreadable or empty."""
    try:
        wb = ET.fromstring(zf.read("xl/workbook.xml"))
        rels = {}
        try:
            for r in ET.fromstring(zf.read("xl/_rels/workbook.xml.rels")).findall("pr:Relationship", _NS):
                tgt = r.get("Target", "")
                rels[r.get("Id")] = tgt.lstrip("/") if tgt.startswith("/") else "xl/" + tgt
        except KeyError:
            pass
        out = []
        for i, s in enumerate(wb.findall("m:sheets/m:sheet", _NS)):
            name = s.get("name")
            if name:
                out.append((name, rels.get(s.get(_REL_ID), f"xl/worksheets/sheet{i + 1}.xml")))
        return out or [(FALLBACK_SHEET, None)]
    except Exception:
        return [(FALLBACK_SHEET, None)]


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    try:
        root = ET.fromstring(zf.read("xl/sharedStrings.xml"))
    except KeyError:
        return []
    return ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in root.findall("m:si", _NS)]


def _date_styles(zf: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format is a date/time format."""
    try:
        root = ET.fromstring(zf.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    for nf in root.findall("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", nf.get("formatCode", ""))
        custom[int(nf.get("numFmtId"))] = bool(re.search(r"[ymdhs]", code, re.I))
    out = set()
    for i, xf in enumerate(root.findall("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in BUILTIN_DATE_FORMATS or custom.get(fid, False):
            out.add(i)
    return out


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n


def parse_cells(path: str, content: bytes):
    """Yield (sheet_idx, sheet, row, col, value, cell_type) for every non-empty cell."""
    zf = zipfile.ZipFile(io.BytesIO(content))
    shared = _shared_strings(zf)
    dates = _date_styles(zf)
    m = _NS["m"]
    for si, (sheet, part) in enumerate(sheet_names(zf)):
        if part is None:
            continue
        if part not in zf.namelist():
            continue
        for r_i, row in enumerate(_rows(zf, part)):
            rnum = int(row.get("r", r_i + 1))
            for c_i, c in enumerate(row.findall("m:c", _NS)):
                ref = c.get("r")
                col = _col_index(ref) if ref else c_i + 1
                t = c.get("t", "n")
                v = c.find("m:v", _NS)
                if t == "inlineStr":
                    is_ = c.find("m:is", _NS)
                    val = "".join(x.text or "" for x in is_.iter(f"{{{m}}}t")) if is_ is not None else None
                    kind = "s"
                elif v is None or v.text is None:
                    continue
                elif t == "s":
                    val, kind = shared[int(v.text)], "s"
                elif t == "str":
                    val, kind = v.text, "s"
                elif t == "b":
                    val, kind = ("true" if v.text.strip() == "1" else "false"), "b"
                elif t == "e":
                    val, kind = v.text, "e"
                else:
                    val = v.text
                    kind = "d" if int(c.get("s", "0")) in dates else "n"
                if val is None or val == "":
                    continue
                yield si, sheet, rnum, col, val, kind


def _rows(zf: zipfile.ZipFile, part: str):
    """Row elements of a sheet, read one by one: the sheet's tree is never held whole."""
    with zf.open(part) as fh:
        root = None
        for event, el in ET.iterparse(fh, events=("start", "end")):
            if event == "start":
                if root is None or el.tag == f"{{{_NS['m']}}}sheetData":
                    root = el
            elif el.tag == f"{{{_NS['m']}}}row":
                yield el
                root.clear()


CELL_CHUNK = 100_000  # cells per emitted pandas frame
UNREADABLE = -1  # sheet index of the one row that tells why a workbook can't be read


def _cells_batches(batches):
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows = []
            try:
                for si, sheet, r, c, v, k in parse_cells(path, bytes(content)):
                    rows.append((path, si, sheet, r, c, v, k))
                    if len(rows) >= CELL_CHUNK:
                        yield pd.DataFrame(rows, columns=CELL_SCHEMA.names)
                        rows = []
            except (zipfile.BadZipFile, ET.ParseError, KeyError, IndexError, ValueError, NotImplementedError, OSError) as exc:
                rows = [(path, UNREADABLE, "", 0, 0, f"{type(exc).__name__}: {exc}", "x")]
            if rows:
                yield pd.DataFrame(rows, columns=CELL_SCHEMA.names)


def _sheet_batches(batches):
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                zf = zipfile.ZipFile(io.BytesIO(bytes(content)))
            except Exception:
                zf = None
            names = sheet_names(zf) if zf is not None else [(FALLBACK_SHEET, None)]
            rows += [(path, i, n) for i, (n, _) in enumerate(names)]
        yield pd.DataFrame(rows, columns=SHEET_SCHEMA.names)


def _files(spark: SparkSession, paths) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def workbook_sheets(spark: SparkSession, paths) -> DataFrame:
    """One row per sheet of every workbook, in workbook order."""
    return _files(spark, paths).mapInPandas(_sheet_batches, SHEET_SCHEMA)


def workbook_cells(spark: SparkSession, paths) -> DataFrame:
    """Every non-empty cell of every sheet as a long table (one task per workbook)."""
    return _files(spark, paths).mapInPandas(_cells_batches, CELL_SCHEMA)


def typed_sheet(cells: DataFrame, header_names: list[str], col_ids: list[int], types: dict[int, str],
                header_row: int) -> DataFrame:
    """Long cells of ONE sheet → one column per header cell, typed by the vote; other cells become NULL."""
    body = cells.where(F.col("row") > header_row)
    aggs = []
    for name, cid in zip(header_names, col_ids):
        typ = types[cid]
        v = F.col("value")
        if typ == "bigint":
            expr = v.try_cast("double").try_cast("bigint")
        elif typ == "double":
            expr = v.try_cast("double")
        elif typ == "boolean":
            expr = v.try_cast("boolean")
        elif typ in ("date", "timestamp_ntz"):
            serial = v.try_cast("double")
            micros = ((serial - F.lit(25569.0)) * F.lit(86400.0 * 1_000_000)).cast("bigint")
            ts = F.coalesce(F.timestamp_micros(micros).cast("timestamp_ntz"), v.try_cast("timestamp_ntz"))
            expr = ts.cast("date") if typ == "date" else ts
        else:
            expr = F.when(F.col("cell_type") != "e", v)
        aggs.append(F.max(F.when(F.col("col") == cid, expr)).alias(name))
    return body.groupBy("row").agg(*aggs).orderBy("row").drop("row")


def _vote(r) -> tuple[str, int]:
    """Type of a column and how many of its cells can't be cast to it."""
    agree = {"n": r["num"], "d": r["dt"], "b": r["b"]}.get(r["first"], 0)
    if 2 * agree <= r["n"]:
        return "string", r["err"]
    if r["first"] == "n":
        return ("double" if r["frac"] else "bigint"), r["no_num"]
    if r["first"] == "d":
        return ("timestamp_ntz" if r["frac"] else "date"), r["no_time"]
    return "boolean", r["no_bool"]


def _letters(i: int) -> str:
    """Column 1 → A, 27 → AA."""
    out = ""
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


@dataclass
class Workbooks:
    """Sheets by workbook path; cells that became NULL, per sheet in the same order; why a workbook can't be read."""

    sheets: dict[str, list[tuple[str, DataFrame]]] = field(default_factory=dict)
    bad_cells: dict[str, list[int]] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def read_workbooks(spark: SparkSession, paths) -> Workbooks:
    """Every sheet of every workbook as a typed DataFrame.

    A fixed number of jobs however many workbooks: one parse job writes the cell table to
    the shared scratch folder (so workbooks are parsed once), then one aggregation finds
    each sheet's first row and width, one collects the cells of first rows and one votes the
    type of every column of every sheet. Only that metadata reaches the driver. Sheets
    without cells have no columns.
    """
    from reportlake.session import scratch_dir

    paths = [paths] if isinstance(paths, str) else list(paths)
    loc = scratch_dir(spark, "cells")
    # one directory per (workbook, sheet): each sheet's reshape below reads only its own files
    (workbook_cells(spark, paths).withColumn("book", F.xxhash64("path"))
     .write.mode("overwrite").partitionBy("book", "sheet_idx").parquet(loc))
    schema = "path string, sheet string, row long, col int, value string, cell_type string, book long, sheet_idx int"
    cells = spark.read.schema(schema).parquet(loc)
    sheets = workbook_sheets(spark, paths).collect()  # one row per sheet
    out = Workbooks()
    out.failures = {r["path"]: r["value"] for r in cells.where(F.col("sheet_idx") == UNREADABLE).collect()}
    cells = cells.where(F.col("sheet_idx") != UNREADABLE)
    keys = ["path", "sheet_idx"]
    bounds = cells.groupBy(*keys).agg(F.min("row").alias("top"), F.max("col").alias("width"))
    meta = {(r["path"], r["sheet_idx"]): (r["top"], r["width"]) for r in bounds.collect()}
    placed = cells.join(bounds, keys)
    heads: dict[tuple, dict[int, str]] = {}
    no_header = set()
    for r in placed.where(F.col("row") == F.col("top")).select(*keys, "col", "value", "cell_type").collect():
        heads.setdefault((r["path"], r["sheet_idx"]), {})[r["col"]] = r["value"]
        if r["cell_type"] != "s":
            no_header.add((r["path"], r["sheet_idx"]))
    kind, value = F.col("cell_type"), F.col("value")
    number = value.try_cast("double")
    serial = kind.isin("n", "d")
    first_rows = (placed.where(F.col("row") == F.col("top")).groupBy(*keys)
                  .agg(F.min(kind == "s").alias("headed")))
    body = placed.join(first_rows, keys).where((F.col("row") > F.col("top")) | ~F.col("headed"))

    def cases(cond):
        return F.count(F.when(cond, 1))

    stats = body.groupBy(*keys, "col").agg(
        cases(kind != "e").alias("n"), F.min_by(F.when(kind != "e", kind), F.when(kind != "e", F.col("row"))).alias("first"),
        cases(kind == "n").alias("num"), cases(kind == "d").alias("dt"), cases(kind == "b").alias("b"),
        cases(kind == "e").alias("err"), cases(serial & (number != F.floor(number))).alias("frac"),
        cases(number.isNull()).alias("no_num"), cases(value.try_cast("boolean").isNull()).alias("no_bool"),
        cases(number.isNull() & value.try_cast("timestamp_ntz").isNull()).alias("no_time"))
    votes: dict[tuple, dict[int, tuple[str, int]]] = {}
    for r in stats.collect():
        votes.setdefault((r["path"], r["sheet_idx"]), {})[r["col"]] = _vote(r)
    for s in sorted(sheets, key=lambda x: (x["path"], x["sheet_idx"])):
        k = (s["path"], s["sheet_idx"])
        if s["path"] in out.failures:
            continue
        own, bad = out.sheets.setdefault(s["path"], []), out.bad_cells.setdefault(s["path"], [])
        if k not in meta:
            own.append((s["sheet"], spark.createDataFrame([], T.StructType([]))))
            bad.append(0)
            continue
        top, width = meta[k]
        col_ids = list(range(1, width + 1))
        if k in no_header:  # named after the cells of the first row, which is data
            names, top = [f"{_letters(c)}{top}" for c in col_ids], top - 1
        else:
            names = dedupe_names(blank_to_positional([heads[k].get(c) for c in col_ids]))
        types = {c: votes.get(k, {}).get(c, ("string", 0)) for c in col_ids}
        sc = cells.where((F.col("book") == F.xxhash64(F.lit(s["path"]))) & (F.col("sheet_idx") == s["sheet_idx"])
                         & (F.col("path") == s["path"]))
        own.append((s["sheet"], typed_sheet(sc, names, col_ids, {c: t for c, (t, _) in types.items()}, top)))
        bad.append(sum(n for _, n in types.values()))
    return out


def read_workbook(spark: SparkSession, path: str) -> list[tuple[str, DataFrame]]:
    """Every sheet of one workbook (see :func:`read_workbooks`); an unreadable one raises."""
    got = read_workbooks(spark, [path])
    if got.failures:
        raise ValueError(f"cannot read {path}: {next(iter(got.failures.values()))}")
    return next(iter(got.sheets.values()), [(FALLBACK_SHEET, spark.createDataFrame([], T.StructType([])))])


def workbook_to_csv(spark: SparkSession, paths, out_dir: str) -> None:
    """Every sheet → CSV text, every cell as text: one folder per workbook (``workbook=<name>-<hash of its path>``)
    and sheet (``sheet=<name>``)."""
    from reportlake.sinks.export import csv_field

    cells = workbook_cells(spark, paths).where(F.col("sheet_idx") != UNREADABLE)
    lines = (cells.groupBy("path", "sheet", "row")
             .agg(F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("m"),
                  F.max("col").alias("w")))
    width = cells.groupBy("path", "sheet").agg(F.max("col").alias("width"))
    rows = lines.join(width, ["path", "sheet"]).select(
        "path", "sheet", "row",
        F.array_join(F.transform(F.sequence(F.lit(1), F.col("width")),
                                 lambda i: F.coalesce(csv_field(F.col("m")[i]), F.lit(""))), ",", "").alias("line"))
    # range partitioning keeps a big sheet spread over several tasks, in row order
    (rows.repartitionByRange("path", "sheet", "row").sortWithinPartitions("path", "sheet", "row")
     .select(F.concat_ws("-", F.regexp_extract("path", r"([^/]*?)(\.[^/.]*)?$", 1),
                         F.lower(F.hex(F.xxhash64("path")))).alias("workbook"), "sheet", "line")
     .write.mode("overwrite").partitionBy("workbook", "sheet").text(out_dir))
