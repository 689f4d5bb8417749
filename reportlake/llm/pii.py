"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seed entities are what four written rules find (e-mail, IP address, payment card, phone). The tokens around
identifier-like tokens are lexical patterns ("the word before is ...", "the word after is ..."). Spark scores
the graph of patterns and instances: a pattern is as good as the share of its instances that are known, an
instance as good as its patterns together; after a few rounds, tokens of a kind's shape in patterns of
high confidence are new entities of that kind. Seeds always stay.

Positions come from splitting a text at the rule: the pieces between matches and the matches themselves, added
up in code points. The rules are written so that Java's matcher never backtracks over a long run. Whatever runs
along a text's matches does so in blocks of ``_BLOCK``, and a masked text is put together from pieces of
``_PIECE`` characters: time grows with the text and its matches, not with their product.

Nulls and ties: a null text counts as empty; repeated rows each get their own result; overlapping spans of
several kinds are all kept, ordered by start, then kind; extra columns of any name are ignored by ``find`` and
kept by ``redact``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm.common import ready, stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS, SMOOTHING, CONFIDENCE, MIN_SEEDS = 3, 2.0, 0.9, 3
#: Matches that one inner loop runs along, characters of a piece of a text that is masked.
_BLOCK, _PIECE = 256, 1024

_RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: What a whole token must look like to become an entity of a kind.
_SHAPE = {"email": r"^\S+@\S+$", "ip": r"^[0-9]+(?:[.:][0-9]+){2,}$", "card": r"^[0-9](?:-?[0-9]){11,18}$",
          "phone": r"^[+(]*[0-9](?:[().\-]*[0-9]){5,12}[).,;]*$"}


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled and reduced, divisible by 10."""
    each = F.transform(F.split(F.reverse(digits), "(?<=[0-9])(?=[0-9])"), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        # leading zeros don't count; at most three digits are left to compare
        return F.forall(F.split(F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", ""), r"\."), lambda p: F.when(
            F.length(p) <= 3, p.cast("int") <= 255).otherwise(F.lit(False)))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


_SPAN = "array<struct<start: bigint, stop: bigint, value: string, before: string, after: string>>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often loops inside ``use`` read it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` (whole numbers from 0 on) what ``combine`` makes of those before it. Blocks of
    _BLOCK values are combined first, so that no growing array is longer than a block or their number."""
    zero = F.lit(0).cast("long")

    def scan(part, first):
        start = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(part, start, lambda acc, x: F.struct(
            combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    blocks = _once(values, lambda every: F.transform(
        F.sequence(F.lit(0), F.floor(F.size(every) / _BLOCK).cast("int")),
        lambda i: F.slice(every, i * _BLOCK + 1, F.lit(_BLOCK))))
    return _once(blocks, lambda parts: F.flatten(F.zip_with(
        parts, scan(F.transform(parts, lambda part: F.aggregate(part, zero, combine)), zero), scan)))


def _context(side: Column, last: bool) -> Column:
    """The word next to a token, lower-cased with digits as 9; a mark where there is none."""
    word = F.regexp_extract(side, r"(?<!\S)(\S++)\s*+$" if last else r"^\s*+(\S++)", 1)
    return F.when(word == "", F.lit("^" if last else "$")).otherwise(F.regexp_replace(F.lower(word), "[0-9]", "9"))


def _spans(text: Column, rule: str, keep, contexts: bool = False) -> Column:
    """Kept matches of ``rule`` as (start, stop, value, before, after); the last two are context words."""
    found = F.regexp_extract_all(text, F.lit(rule), F.lit(0))
    pieces = F.split(text, rule, -1)  # one more than there are matches
    pairs = F.zip_with(found, pieces, lambda m, gap: F.struct(
        m.alias("m"), F.length(gap).cast("long").alias("skip"), F.length(m).cast("long").alias("size"),
        (_context(gap, True) if contexts else F.lit("")).alias("before")))
    if contexts:
        pairs = F.zip_with(pairs, F.slice(pieces, F.lit(2), F.length(text) + 1), lambda p, gap: F.struct(
            p["m"].alias("m"), p["skip"].alias("skip"), p["size"].alias("size"), p["before"].alias("before"),
            _context(gap, False).alias("after")))

    def placed(x, at):
        start = at + x["skip"]
        return F.struct(start.alias("start"), (start + x["size"]).alias("stop"), x["m"].alias("value"),
                        x["before"].alias("before"), (x["after"] if contexts else F.lit("")).alias("after"))

    spans = _once(F.filter(pairs, lambda x: x["m"].isNotNull()), lambda every: F.zip_with(
        every, _running(F.transform(every, lambda x: x["skip"] + x["size"]), lambda a, b: a + b), placed))
    return F.filter(spans, lambda s: keep(s["value"]))


def base_spans(text: Column) -> Column:
    """Seeds in a text: array of (start, kind_no, stop, kind), ordered by start, then kind."""
    none = F.array().cast(_SPAN)
    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")),
             "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20\-]?[0-9]")}
    def named(number, kind):
        spans = F.when(needs[kind], _spans(text, _RULES[kind], lambda m: _valid(kind, m))).otherwise(none)
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind_no"), s["stop"].alias("stop"), F.lit(kind).alias("kind")))

    parts = [named(i, k) for i, k in enumerate(KINDS)]
    return F.array_sort(F.concat(*parts))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    tokens = F.when(F.col("text").rlike("[0-9@]"), _spans(F.col("text"), _TOKEN, lambda m: F.lit(True), True)).otherwise(
        F.array().cast(_SPAN))
    d = d.select("doc_id", F.xxhash64("text").alias("text_hash"), base_spans(F.col("text")).alias("base"),
                 tokens.alias("tokens"))
    return d.withColumn("row_id", F.monotonically_increasing_id())


def _known(rows: DataFrame) -> DataFrame:
    """The tokens with their patterns and the kind of the first base span that overlaps each, if any.

    Tokens and base spans of a row are put in one order. Spans of a kind don't overlap, so of those that start
    before a token only the last of each kind can reach into it; no token starts inside another one, so a span
    that starts inside a token comes right after it.
    """
    about = ["row_id", "doc_id", "text_hash"]
    t = rows.select(*about, F.explode("tokens").alias("t")).select(
        *about, F.col("t.start").alias("start"), F.lit(len(KINDS)).alias("kind_no"), F.col("t.stop").alias("stop"),
        F.lower("t.value").alias("value"),
        F.array(F.concat(F.lit("L "), F.col("t.before")), F.concat(F.lit("R "), F.col("t.after"))).alias("patterns"))
    b = rows.filter(F.size("tokens") > 0).select(*about, F.explode("base").alias("b")).select(
        *about, "b.start", "b.kind_no", "b.stop")
    order = Window.partitionBy("row_id").orderBy("start", "kind_no")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    span = F.struct("start", "kind_no", "stop")
    both = t.unionByName(b, allowMissingColumns=True).select("*", *[
        F.last(F.when(F.col("kind_no") == i, span), ignorenulls=True).over(running).alias(f"last_{k}")
        for i, k in enumerate(KINDS)], F.lead(span).over(order).alias("next"))
    reaching = [F.when(F.col(f"last_{k}")["stop"] > F.col("start"), F.col(f"last_{k}")) for k in KINDS]
    inside = F.when((F.col("next")["start"] < F.col("stop")) & (F.col("next")["kind_no"] < len(KINDS)), F.col("next"))
    first = F.coalesce(F.least(*reaching), inside)["kind_no"]
    return both.filter(F.col("kind_no") == len(KINDS)).select(
        *about, "start", "stop", "value", F.get(F.array(*[F.lit(k) for k in KINDS]), first).alias("seed"), "patterns")


def _discovered(rows: DataFrame, confidence: float, rounds: int) -> DataFrame:
    """``(row_id, doc_id, text_hash, start, stop, kind, kind_no)`` of tokens that patterns reveal."""
    t = stored(_known(rows), "tokens")
    seeds = t.filter("seed IS NOT NULL").groupBy("value").agg(F.min("seed").alias("seed"))
    edges = (t.select(F.explode("patterns").alias("pattern"), "value").groupBy("pattern", "value")
             .agg(F.count("*").alias("n")))
    edges = stored(edges.join(seeds, "value", "left"), "graph")
    total = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    scores = seeds.select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score"))
    patterns = None
    for _ in range(rounds):
        patterns = (edges.join(scores, "value").groupBy("pattern", "kind")
                    .agg(F.sum(F.col("n") * F.col("score")).alias("mass"),
                         F.count_if(F.col("seed") == F.col("kind")).alias("seeds"))
                    .filter(F.col("seeds") >= MIN_SEEDS).join(total, "pattern")
                    .select("pattern", "kind", (F.col("mass") / (F.col("total") + SMOOTHING)).alias("trust")))
        patterns = stored(patterns, "patterns")
        fresh = (edges.filter("seed IS NULL").join(patterns, "pattern").groupBy("value", "kind")
                 .agg((1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("score")))
        scores = stored(seeds.select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).union(fresh), "scores")
    shape = F.lit(False)
    for k in KINDS:
        shape = shape | ((F.col("kind") == k) & F.col("value").rlike(_SHAPE[k]))
    hits = (t.filter("seed IS NULL").select("row_id", "doc_id", "text_hash", "start", "stop", "value",
                                            F.explode("patterns").alias("pattern"))
            .join(patterns.filter(F.col("trust") >= confidence), "pattern").filter(shape))
    kind_no = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    return hits.select("row_id", "doc_id", "text_hash", "start", kind_no.alias("kind_no"), "stop", "kind").distinct()


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, text_hash, base, spans``; spans are (start, kind_no, stop, kind)."""
    ready(docs.sparkSession)
    rows = stored(_rows(docs, id_col, text_col), "pii")
    more = (_discovered(rows, confidence, rounds).groupBy("row_id")
            .agg(F.collect_set(F.struct("start", "kind_no", "stop", "kind")).alias("more")))
    out = rows.select("row_id", "doc_id", "text_hash", "base").join(more, "row_id", "left")
    spans = F.array_sort(F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more")))
    return out.select("doc_id", "text_hash", "base", spans.alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _between(pieces: Column, start: Column, stop: Column) -> Column:
    """Characters ``start`` to ``stop`` of a text cut into pieces of _PIECE characters."""
    i, j = F.floor(start / _PIECE).cast("int"), F.floor(stop / _PIECE).cast("int")
    head, tail = (start - i * _PIECE).cast("int"), (stop - j * _PIECE).cast("int")
    return F.when(i == j, F.substring(F.get(pieces, i), head + 1, tail - head)).otherwise(F.concat(
        F.substring(F.get(pieces, i), head + 1, F.lit(_PIECE)), F.array_join(F.slice(pieces, i + 2, j - i - 1), ""),
        F.substring(F.coalesce(F.get(pieces, j), F.lit("")), F.lit(1), tail)))


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with ``spans``, ordered by start, replaced by their kinds."""
    end = F.struct(F.length(text).cast("long").alias("start"), F.lit(len(KINDS)).alias("kind_no"),
                   F.length(text).cast("long").alias("stop"), F.lit(None).cast("string").alias("kind"))
    marks = _once(F.concat(spans, F.array(end)), lambda every: F.zip_with(
        every, _running(F.transform(every, lambda s: s["stop"]), lambda a, b: F.greatest(a, b)), lambda s, at: F.struct(
            at.alias("gap"), s["start"].alias("start"), s["kind"].alias("kind"))))
    # a span that starts inside the one before it adds no mark
    marks = F.filter(marks, lambda m: m["start"] >= m["gap"])
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    return _once(pieces, lambda p: F.array_join(F.transform(marks, lambda m: F.concat(
        F.when(m["start"] > m["gap"], _between(p, m["gap"], m["start"])).otherwise(F.lit("")),
        F.when(m["kind"].isNull(), F.lit("")).otherwise(F.concat(F.lit("["), F.upper(m["kind"]), F.lit("]"))))), ""))


def redact(docs: DataFrame, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans become one.

    All columns of ``docs`` stay; ``n_chars``, where there is one, is set to the new length.
    """
    ready(docs.sparkSession)
    rows = stored(_rows(docs, "doc_id", "text"), "pii")
    more = (_discovered(rows, confidence, rounds).groupBy("doc_id", "text_hash")
            .agg(F.collect_set(F.struct("start", "kind_no", "stop", "kind")).alias("more")))
    # the document's own columns travel as one, so that no name of theirs can meet one of ours
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    text = F.coalesce(F.col("d.text").cast("string"), F.lit(""))
    d = d.select("d", F.col("d.doc_id").cast("long").alias("id"), F.xxhash64(text).alias("hash"), base_spans(text).alias("base"))
    d = d.join(more, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")
    d = d.select("d", F.array_sort(F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))).alias("spans"))
    d = d.select("d", F.when(F.size("spans") > 0, _masked(F.col("d.text"), F.col("spans"))).otherwise(F.col("d.text")).alias("new"))
    kept = {c: F.col("d").getField(c) for c in docs.columns} | {"text": F.col("new")}
    if "n_chars" in docs.columns:
        kept["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    return d.select(*[kept[c].alias(c) for c in docs.columns])
