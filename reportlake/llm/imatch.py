"""Document fingerprints by I-Match over several randomised lexicons, in DataFrame functions only.

The lexicon is all terms whose inverse document frequency lies in a band: in at least ``LEAST`` and at most ``MOST`` of
the documents. Each of the randomised sub-lexicons keeps a hashed share of it (1/16 to 1/1024: small documents show in the large ones,
large documents in the small ones). A document's distinct terms inside a sub-lexicon are sorted and hashed; the
fingerprint is these hashes side by side. The likeness of two fingerprints is the share of equal hashes among the sub-lexicons of
which either document has a term, for the size of sub-lexicon where it is largest.

A term of the lexicon is in at least ``1/TERMS`` of all (document, term) rows, so the lexicon never has more than
``TERMS`` terms and goes to every task as a broadcast. Documents meet the one that follows them by one shuffle of the texts: ids
are cut into ranges of ``WIDTH``, so a range holds few documents however ids are spread, and the first document of a range is copied
behind the last of the range before it. Everything after that (edited texts, terms, sorting, hashing, the next
fingerprint) stays inside the ranges and is not shuffled again.

Nulls and ties: a null text is empty; a text without terms in the band has a hash of the whole text for its
fingerprint; rows with a null id follow nobody: their edited text is their text and ``near_next`` is null; rows that
share an id follow each other by a hash of their text, in one task; a single document follows itself; texts of any
length are whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm.common import documents, ready, stored
from reportlake.operators.joins import row_index

#: Share of documents a term of the lexicon is in, and most terms of the lexicon.
LEAST, MOST, TERMS = 0.001, 0.4, 500_000
#: Sub-lexicons keep 1/16 ... 1/1024 of the lexicon's terms, ``SUBSETS`` of them each; hashes of a level that count at least.
LEVELS, SUBSETS, LEAST_HASHES = (16, 64, 256, 1024), 16, 4
#: Ids of a range; most ranges whose first ids are sent to every task (24 bytes each), more are joined by a shuffle.
WIDTH, BROADCAST_ROWS = 256, 500_000

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_INFO = 0  # stands for a document itself among the hashes of its terms


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text: runs of letters, digits and characters outside ASCII."""
    words = F.array_distinct(F.split(F.lower(text), _GAP))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST, most_terms: int = TERMS) -> DataFrame:
    """``h``: hashes of the terms in the band, over all documents."""
    sets = docs.select(terms(F.coalesce("text", F.lit(""))).alias("t"))
    df = stored(sets.select(F.explode("t").alias("h")).groupBy("h").agg(F.count("*").alias("n")), "terms")
    n_docs = docs.count()
    rows = df.agg(F.sum("n")).first()[0] or 0
    return df.filter((F.col("n") >= least * n_docs) & (F.col("n") <= most * n_docs) & (F.col("n") * most_terms >= rows)).select("h")


def in_sequence(docs: DataFrame) -> DataFrame:
    """Rows with a place (``range``, ``pos``) and the text that follows (``after``); the last row of a range is a
    copy (``copied``) of the first row of the next range, and after the last range comes the first."""
    base = docs.filter("doc_id IS NOT NULL").withColumn("h", F.xxhash64("text")).withColumn("range", F.expr(f"doc_id DIV {WIDTH}"))
    first = base.groupBy("range").agg(F.min(F.struct("doc_id", "h")).alias("f")).select("range", "f.*")
    first = stored(row_index(first, ["doc_id"], "place"), "firsts")
    n = first.count()
    before = first.select(F.expr(f"pmod(place + 1, {max(n, 1)})").alias("place"), F.col("range").alias("before"))
    leading = first.drop("range").join(before, "place").drop("place")
    if n <= BROADCAST_ROWS:  # else Spark plans the join
        leading = F.broadcast(leading)
    copies = base.drop("range").join(leading, ["doc_id", "h"])
    rows = (base.select("range", F.lit(False).alias("copied"), "doc_id", "h", "text")
            .unionByName(copies.select(F.col("before").alias("range"), F.lit(True).alias("copied"), "doc_id", "h", "text")))
    w = Window.partitionBy("range").orderBy("copied", "doc_id", "h")
    return rows.select("range", "copied", "doc_id", "text", F.row_number().over(w).alias("pos"), F.lead("text").over(w).alias("after"))


def _slots(h: Column) -> Column:
    """The sub-lexicons a term is in, at most one of each level, by different bits of its hash."""
    found = [F.pmod(F.shiftright(h, 12 * i), F.lit(m)) for i, m in enumerate(LEVELS)]
    return F.array_compact(F.array(*[F.when(f < SUBSETS, f + SUBSETS * i) for i, f in enumerate(found)]))


def _written(hashes: Column, kind: int, whole: Column) -> Column:
    places = F.sequence(F.lit(0), F.lit(SUBSETS * len(LEVELS) - 1))
    sides = F.transform(places, lambda i: F.coalesce(F.element_at(hashes, F.lit(kind * 1000) + i), F.lit("")))
    text = F.array_join(sides, ".")
    return F.when(text.rlike("[^.]"), text).otherwise(F.concat(F.lit("text:"), whole))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; equal fingerprints have 1."""
    def level(i):
        def part(c):
            return F.slice(F.split(c, r"\."), 1 + SUBSETS * i, SUBSETS)
        both = F.zip_with(part(a), part(b), lambda x, y: F.when((x != "") | (y != ""), F.when(x == y, 1.0).otherwise(0.0)))
        shown = F.filter(both, lambda x: x.isNotNull())
        return F.aggregate(shown, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size(shown), F.lit(LEAST_HASHES))
    plain = a.startswith("text:") | b.startswith("text:")
    return F.when(a == b, 1.0).when(plain, 0.0).otherwise(F.greatest(*[level(i) for i in range(len(LEVELS))]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row."""
    spark = ready(docs.sparkSession)
    docs = documents(docs, id_col, text_col)
    kept = lexicon(docs).unionByName(spark.range(1).select(F.lit(_INFO).cast("long").alias("h")))
    # rows with a null id are ranges of their own, dealt by their text
    loose = docs.filter("doc_id IS NULL").select(
        F.xxhash64("text").alias("range"), F.lit(False).alias("copied"), "doc_id", "text", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("after"))
    rows = in_sequence(docs)
    return _compared(rows, kept).unionByName(_alone(loose, kept))


def _signed(rows: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, the row's facts and its fingerprints, grouped by ``keys``."""
    n = F.char_length("text")
    cut = F.expr("char_length(text) DIV 4")
    edited = F.when(F.col("after").isNull(), F.col("text")).otherwise(
        F.concat(F.col("text").substr(F.lit(1), n - cut), F.col("after").substr(F.lit(1), cut)))
    rows = rows.select(*keys, F.struct("copied", "doc_id", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
                                       F.substring(F.sha2("text", 256), 1, 32).alias("whole")).alias("info"),
                       terms(F.col("text")).alias("t"), terms(edited).alias("e"))
    none = F.lit(None).cast(rows.schema["info"].dataType)

    def entries(kind, hashes):
        return F.transform(hashes, lambda h: F.struct(F.lit(kind).alias("kind"), h.alias("h"), none.alias("info")))

    entry = F.concat(F.array(F.struct(F.lit(0).alias("kind"), F.lit(_INFO).cast("long").alias("h"), F.col("info").alias("info"))),
                     entries(1, F.col("t")), entries(2, F.col("e")))
    found = rows.select(*keys, F.explode(entry).alias("x")).select(*keys, "x.*").join(F.broadcast(kept), "h")
    slots = found.select(*keys, "kind", "h", "info", F.explode(
        F.when(F.col("kind") > 0, _slots(F.col("h"))).otherwise(F.array(F.lit(0).cast("long")))).alias("slot"))
    hashed = (slots.groupBy(*keys, "kind", "slot").agg(F.sort_array(F.collect_set("h")).alias("set"), F.max("info").alias("info"))
              .select(*keys, "info", (F.col("kind") * 1000 + F.col("slot")).cast("int").alias("at"),
                      F.lower(F.lpad(F.hex(F.xxhash64("set")), 16, "0")).substr(1, 8).alias("hash")))
    both = hashed.groupBy(*keys).agg(F.max("info").alias("info"), F.map_from_entries(F.collect_list(F.struct("at", "hash"))).alias("m"))
    return both.select(*keys, "info.*", _written(F.col("m"), 1, F.col("info.whole")).alias("fingerprint"),
                       _written(F.col("m"), 2, F.substring("info.edited_sha256", 1, 32)).alias("edited_fingerprint"))


_OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(rows: DataFrame, kept: DataFrame) -> DataFrame:
    w = Window.partitionBy("range").orderBy("pos")
    out = _signed(rows, kept, ["range", "pos"]).withColumn("next", F.lead("fingerprint").over(w))
    return (out.filter("NOT copied").withColumn("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint")))
            .withColumn("near_next", likeness(F.col("fingerprint"), F.col("next"))).select(*_OUT))


def _alone(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows without an id: nothing follows them. ``row`` tells repeated ones apart."""
    out = _signed(rows.withColumn("row", F.monotonically_increasing_id()), kept, ["row"])
    return out.withColumn("near_edited", F.lit(1.0)).withColumn("near_next", F.lit(None).cast("double")).select(*_OUT)
