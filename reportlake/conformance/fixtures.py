"""Test support: writes .xlsx workbooks from a DataFrame so the workbook reader can be
checked against the given tables (the library itself only reads workbooks)."""

from __future__ import annotations

import io
import math
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/xl/workbook.xml" '
       'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/></Types>')
_RELS = ('<?xml version="1.0" encoding="UTF-8"?><Relationships '
         'xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
         'officeDocument" Target="xl/workbook.xml"/></Relationships>')
_STYLES = ('<?xml version="1.0" encoding="UTF-8"?><styleSheet '
           'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
           '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')


def _col(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def xlsx_bytes(sheets: list[tuple[str, list[str], list[list]]], shared_strings: bool = True,
               with_workbook_xml: bool = True) -> bytes:
    """A minimal workbook: strings shared (or inline), numbers, booleans, dates (style 1)."""
    import datetime as dt

    shared: dict[str, int] = {}
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CT)
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/styles.xml", _STYLES)
        wb = ['<?xml version="1.0" encoding="UTF-8"?><workbook '
              'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
              'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>']
        rels = ['<?xml version="1.0" encoding="UTF-8"?><Relationships '
                'xmlns="http://schemas.openxmlformats.org/package/2006/relationships">']
        for si, (name, header, rows) in enumerate(sheets, start=1):
            wb.append(f'<sheet name="{escape(name)}" sheetId="{si}" r:id="rId{si}"/>')
            rels.append(f'<Relationship Id="rId{si}" Type="http://schemas.openxmlformats.org/officeDocument/'
                        f'2006/relationships/worksheet" Target="worksheets/sheet{si}.xml"/>')
            out = ['<?xml version="1.0" encoding="UTF-8"?><worksheet '
                   'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
            for r, values in enumerate([header] + rows, start=1):
                cells = []
                for c, v in enumerate(values):
                    ref = f"{_col(c)}{r}"
                    if v is None or (isinstance(v, float) and math.isnan(v)):
                        continue
                    if isinstance(v, bool):
                        cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                    elif isinstance(v, (int, float)):
                        cells.append(f'<c r="{ref}"><v>{repr(v) if isinstance(v, float) else v}</v></c>')
                    elif isinstance(v, (dt.date, dt.datetime, pd.Timestamp)):
                        base = dt.datetime(1899, 12, 30)
                        d = v if isinstance(v, dt.datetime) else dt.datetime(v.year, v.month, v.day)
                        serial = (d - base).total_seconds() / 86400
                        cells.append(f'<c r="{ref}" s="1"><v>{serial!r}</v></c>')
                    elif shared_strings:
                        idx = shared.setdefault(str(v), len(shared))
                        cells.append(f'<c r="{ref}" t="s"><v>{idx}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
                out.append(f'<row r="{r}">' + "".join(cells) + "</row>")
            out.append("</sheetData></worksheet>")
            z.writestr(f"xl/worksheets/sheet{si}.xml", "".join(out))
        wb.append("</sheets></workbook>")
        rels.append("</Relationships>")
        if with_workbook_xml:
            z.writestr("xl/workbook.xml", "".join(wb))
        z.writestr("xl/_rels/workbook.xml.rels", "".join(rels))
        if shared:
            items = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
            z.writestr("xl/sharedStrings.xml",
                       '<?xml version="1.0" encoding="UTF-8"?><sst '
                       f'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{items}</sst>')
    return buf.getvalue()


KEYS_PER_WORKBOOK = 50_000  # bounded workbook size (Excel itself stops at 1 048 576 rows)


def write_customer_workbooks(customer: DataFrame, out_dir: str, text_every: int = 0) -> None:
    """One workbook per market segment and block of 50 000 customer keys: sheet ``customers``
    (the rows) and sheet ``nations`` (customers per nation). Each pandas group is bounded
    by the key block, whatever the skew of segments. ``text_every``: the balances of keys divisible by it are
    texts, but for a workbook's first."""
    from pyspark.sql import functions as F

    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    root = out_dir.replace("file:", "")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        import os

        seg, block = str(pdf["c_mktsegment"].iloc[0]), int(pdf["block"].iloc[0])
        pdf = pdf.sort_values("c_custkey")
        rows = [[int(r.c_custkey), r.c_name, int(r.c_nationkey), float(r.c_acctbal), r.c_mktsegment]
                for r in pdf.itertuples()]
        for r in rows[1:] if text_every else ():
            if r[0] % text_every == 0:
                r[3] = "n/a"
        nat = pdf.groupby("c_nationkey").size().reset_index(name="n").sort_values("c_nationkey")
        data = xlsx_bytes([("customers", cols, rows),
                           ("nations", ["c_nationkey", "n_customers"],
                            [[int(a), int(b)] for a, b in zip(nat["c_nationkey"], nat["n"])])])
        os.makedirs(root, exist_ok=True)
        name = f"{seg}-{block}.xlsx"
        with open(f"{root}/{name}", "wb") as fh:
            fh.write(data)
        return pd.DataFrame({"file": [name], "rows": [len(rows)]})

    blocks = customer.select(*cols).withColumn("block", F.floor(F.col("c_custkey") / KEYS_PER_WORKBOOK).cast("long"))
    blocks.groupBy("c_mktsegment", "block").applyInPandas(one, "file string, rows long").collect()
