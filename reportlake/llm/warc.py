"""WARC archives with revisit records.

The headers of all pages (id, payload digest, length) are shuffled by digest; of several records with one
payload of at least ``MIN_PAYLOAD`` bytes the one with the largest id is the original. Headers and originals
are joined to the pages, and every page becomes one record with fresh headers: a response with its payload or
a revisit that refers to the original and carries none. Spark's text writer puts the records into files of
bounded size, the blank lines that end a record being the line separator, so each file is a WARC file.
``read`` takes the files apart again by the records' Content-Length.

Nulls and ties: a null payload is empty; a null url has no WARC-Target-URI; a null id is written empty and
read back as null (such a record revisits an original with an id, never the reverse); rows that share the
largest id of a payload are all responses; line breaks in a url become %0D and %0A; an empty table gives no
records; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import ready, stored

MIN_PAYLOAD, FILE_RECORDS, FILE_BYTES = 1000, 2000, 1 << 29
_END = "\r\n\r\n"
#: Profile of revisit records, as the WARC 1.1 standard names it.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id, digest):
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                                                     F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", min_payload: int = MIN_PAYLOAD,
          id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write one record per row of ``pages`` to WARC files in the folder ``path``."""
    ready(pages.sparkSession)
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    p = p.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("strong", F.sha2("payload", 256))
    headers = stored(p.select("page_id", "strong", "bytes"), "headers")
    originals = stored(headers.filter(F.col("bytes") >= min_payload).groupBy("strong", "bytes")
                       .agg(F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1")
                       .select("strong", "bytes", "original"), "originals")
    largest = headers.agg(F.max("bytes").alias("b")).first()["b"] or 0
    per_file = int(max(1, min(FILE_RECORDS, FILE_BYTES // (largest + 2048))))
    d = p.join(originals, ["strong", "bytes"], "left")
    revisit = F.coalesce(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.lit(False))
    d = d.withColumn("digest", F.sha1("payload")).withColumn("again", revisit)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(_END))
    block = F.concat(http, F.when(F.col("again"), F.lit("")).otherwise(F.col("payload")))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("strong"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("again"), F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("original"), F.col("strong")))),
        F.when(F.col("again"), F.lit(f"WARC-Profile: {_PROFILE}")),
        F.when(F.col("again"), F.concat(F.lit("Refers-To-Page: "), F.col("original").cast("string"))),
        F.concat(F.lit("Page: "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    (d.select(F.concat(head, F.lit(_END), block).alias("value")).write
     .option("lineSep", _END).option("maxRecordsPerFile", per_file).text(path))


def _records(data: bytes):
    """(headers, block) of every record in a WARC file."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(fields["Content-Length"])
        yield fields, data[stop + 4: stop + 4 + size]
        at = stop + 4 + size + 4


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to, url`` and, if
    asked for, ``payload`` (null for revisits). A response's digest is computed from the payload read, and a
    record whose payload does not fit its header stops the read."""
    ready(spark)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    if with_payload:
        names, types = [*names, "payload"], [*types, pa.binary()]

    def run(batches):
        for b in batches:
            for data in b.column(0):
                rows = []
                for fields, block in _records(data.as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.rsplit(b": ", 1)[1])
                    digest = fields["WARC-Payload-Digest"].split(":", 1)[1]
                    kind = fields["WARC-Type"]
                    if kind == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
                    to = fields.get("Refers-To-Page")
                    rows.append((int(fields["Page"]) if fields["Page"] else None, size, digest, kind,
                                 int(to) if to else None, fields.get("WARC-Target-URI"),
                                 *([payload if kind == "response" else None] if with_payload else [])))
                cols = list(zip(*rows)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)

    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, ddl + (", payload binary" if with_payload else ""))
