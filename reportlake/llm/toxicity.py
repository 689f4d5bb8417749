"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps homoglyphs of other scripts, digits and signs written for letters, and drops
invisible characters; what is not a letter becomes a space. A lexicon entry is a whole word or the first
letters of a word, with the log-odds of its documents as weight. Exception phrases (one or more words)
silence the entries inside them. A document scores x / (x + tau), x being the weight of its hits over the
logarithm of its length.

Entries, exceptions and tau are learned from a bounded sample of labelled rows (``SAMPLE_DOCS``) by
sequential covering: an entry stays only if it explains toxic documents that no stronger entry explains.
Texts that fold alike are one document of the fit, however many copies there are, and every term that is
precise enough is weighed.

Nulls and ties: null and empty texts score 0; null labels teach nothing; several labels of one document
count as toxic if one says so; without labels every score is 0; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import documents, ready, stored

#: Bounds of the fit: labelled documents looked at, distinct toxic texts an entry must add (one is enough for an
#: entry found in the common share).
SAMPLE_DOCS, MIN_ADDED, COMMON_SHARE = 20_000, 3, 0.1
#: Letters of a word-start entry; least share of toxic documents among those with an entry, were both labels
#: equally frequent.
STEM_LETTERS, MIN_PRECISION = (4, 5, 6, 7, 8), 0.98

# Letters of other scripts, digits and signs that stand for Latin letters.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d",
    "һ": "h", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u",
    "ı": "i", "ł": "l", "ø": "o",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
_FOLD = str.maketrans(
    _LOOKALIKES | {chr(0xFF41 + i): chr(0x61 + i) for i in range(26)}
    | {c: None for c in "­​‌‍⁠﻿"})
_LETTERS = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Folded words between single spaces, with one at both ends."""
    return " " + " ".join(_LETTERS.findall(text.lower().translate(_FOLD))) + " "


@dataclass
class Lexicon:
    """``entries``: " word " or " stem" → weight; ``exceptions``: " some words " that silence entries."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    tau: float = 1.0

    def matcher(self) -> "Matcher":
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.tau = lexicon.tau
        self.machine = ahocorasick.Automaton()
        for term, weight in lexicon.entries.items():
            self.machine.add_word(term, (weight, len(term)))
        for term in lexicon.exceptions:
            self.machine.add_word(term, (None, len(term)))
        self.any = bool(lexicon.entries)
        if len(self.machine):
            self.machine.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Entries found, the longest for each start, without those inside an exception phrase."""
        found, quiet = {}, []
        if not self.any:
            return []
        for end, (weight, size) in self.machine.iter(folded):
            if weight is None:
                quiet.append((end - size + 1, end))
            else:
                found[end - size + 1] = (end, weight)  # ends rise, so the longest stays
        out, k, reach = [], 0, -1
        quiet.sort()
        for start in sorted(found):
            end, weight = found[start]
            while k < len(quiet) and quiet[k][0] <= start:
                reach = max(reach, quiet[k][1])
                k += 1
            # a stem counts to the end of its word; the space that follows belongs to the phrase
            if reach < end:
                out.append((start, end, weight))
        return out

    def strength(self, text: str) -> float:
        folded = fold(text)
        total = sum(w for _, _, w in self.hits(folded))
        return total / math.log2(2 + folded.count(" ")) if total else 0.0

    def score(self, text: str) -> float:
        x = self.strength(text)
        return x / (x + self.tau) if x > 0 else 0.0


def held_out(id_col: str = "doc_id"):
    """The documents that teach nothing: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _fold_keys(batches):
    for b in batches:
        keys = [xxhash.xxh3_128_digest(fold(x).encode("utf-8", "surrogatepass")) for x in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary())],
                                         names=["text", "toxic", "key"])


def _count_words(batches):
    """Documents of either label that hold a folded word, added up within the task."""
    toxic, clean = Counter(), Counter()

    def out():
        words = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()),
             pa.array([clean[w] for w in words], pa.int64())], names=["word", "toxic", "clean"])

    for b in batches:
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            (toxic if y else clean).update(set(fold(text).split()))
        if len(toxic) + len(clean) > 500_000:
            yield out()
            toxic.clear()
            clean.clear()
    yield out()


def _terms(stem_if):
    """" word " and the stems " wor" of a word; those of k letters are null unless ``stem_if(k)``."""
    return F.array(F.concat(F.lit(" "), "word", F.lit(" ")),
                   *[F.when(stem_if(k), F.concat(F.lit(" "), F.substring("word", 1, k))) for k in STEM_LETTERS])


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
          exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Lexicon from the labelled documents that are not held out (``labels``: doc_id, toxic).

    ``exceptions`` adds phrases to those learned: words that begin like an entry but occur more in clean texts.
    """
    ready(docs.sparkSession)
    sample = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))
    sample = stored(sample.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")), "labels")
    # bounded by sample_docs rows of two numbers
    rows = documents(docs).join(F.broadcast(sample), "doc_id").select("text", "toxic")
    rows = stored(rows.mapInArrow(_fold_keys, "text string, toxic int, key binary").groupBy("key")
                  .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"), "labelled")
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic:
        return Lexicon()

    words = (rows.select("text", "toxic").mapInArrow(_count_words, "word string, toxic long, clean long")
             .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    words = stored(words, "words")
    stems = _terms(lambda k: F.length("word") > k)
    terms = (words.filter("toxic > 0 OR clean > 0").select(F.explode(stems).alias("term"), "toxic", "clean")
             .filter("term IS NOT NULL").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    share = n_clean / n_toxic if n_clean else 1.0  # precision as if both labels were equally frequent
    precise = F.col("toxic") * share / (F.col("toxic") * share + F.col("clean"))
    # bounded by the sample
    chosen = terms.filter((F.col("toxic") >= MIN_ADDED) & (precise >= MIN_PRECISION)).toArrow()
    weight = {t: math.log((toxic + .5) / (n_toxic + 1)) - math.log((clean + .5) / (n_clean + 1)) for t, toxic, clean in
              zip(*(chosen.column(c).to_pylist() for c in ("term", "toxic", "clean")))}
    entries = _cover(rows, weight)
    if not entries:
        return Lexicon()
    # words that begin like an entry, yet are found more in clean documents
    begun = docs.sparkSession.createDataFrame([(t,) for t in entries], "term string")
    benign = [f" {r['word']} " for r in
              words.filter(F.col("clean") > F.col("toxic") * share)
              .select("word", F.explode(_terms(lambda k: F.length("word") >= k)).alias("term"))
              .join(F.broadcast(begun), "term", "left_semi").select("word").distinct().collect()]
    lexicon = Lexicon(entries, tuple(sorted({fold(x) for x in exceptions} | set(benign))))
    lexicon.tau = _threshold(rows, lexicon)
    return lexicon


def _cover(rows: DataFrame, weight: dict[str, float]) -> dict[str, float]:
    """Greedy covering of the sample's toxic documents; their candidate lists are bounded by the sample.

    What a term adds only falls, so the best one is found on a heap of earlier values."""
    terms = sorted(weight)
    number = {t: i for i, t in enumerate(terms)}
    if not terms:
        return {}

    def present(batches):
        machine = ahocorasick.Automaton()
        for t, i in number.items():
            machine.add_word(t, i)
        machine.make_automaton()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.unique([i for _, i in machine.iter(fold(x))]).astype(np.int32).tobytes()
                           for x in b.column(0).to_pylist()], pa.binary())], names=["terms"])

    held = [np.frombuffer(r["terms"], np.int32) for r in
            rows.filter("toxic = 1").select("text").mapInArrow(present, "terms binary").collect()]
    of_term = np.concatenate(held)
    of_doc = np.repeat(np.arange(len(held), dtype=np.int32), [len(h) for h in held])[np.argsort(of_term, kind="stable")]
    at = np.concatenate(([0], np.cumsum(np.bincount(of_term, minlength=len(terms)))))
    is_open = np.ones(len(held), bool)

    def rank(t, gain):  # the most first, then the shorter term
        return -gain * weight[terms[t]], len(terms[t]), -t, gain

    entries = {}
    heap = [rank(t, int(at[t + 1] - at[t])) for t in range(len(terms)) if at[t + 1] > at[t]]
    heapq.heapify(heap)
    while heap:
        _, _, t, gain = heapq.heappop(heap)
        docs = of_doc[at[-t]: at[1 - t]]
        now = int(is_open[docs].sum())
        if now < gain:
            if now:
                heapq.heappush(heap, rank(-t, now))
            continue
        if gain < MIN_ADDED and len(docs) < COMMON_SHARE * len(held):
            continue
        entries[terms[-t]] = weight[terms[-t]]
        is_open[docs] = False
    return entries


def _threshold(rows: DataFrame, lexicon: Lexicon) -> float:
    """The strength that separates the sample's labels best, halfway to the next strength below."""
    def strengths(batches):
        m = lexicon.matcher()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([m.strength(x) for x in b.column(0).to_pylist()], pa.float64()), b.column(1)],
                names=["x", "toxic"])

    got = sorted((r["x"], r["toxic"]) for r in
                 rows.select("text", "toxic").mapInArrow(strengths, "x double, toxic int").collect())
    n_toxic = sum(y for _, y in got)
    n_clean = len(got) - n_toxic
    best, tau, missed, passed = -1.0, 1.0, 0, 0
    last = 0.0
    i = 0
    while i < len(got):
        x = got[i][0]
        if x > 0:
            worth = (1 - missed / max(1, n_toxic)) - 2 * (1 - passed / max(1, n_clean))  # a clean text weighs double
            if worth > best + 1e-12:
                best, tau = worth, (x + last) / 2
        while i < len(got) and got[i][0] == x:
            missed, passed = missed + got[i][1], passed + 1 - got[i][1]
            i += 1
        last = x
    return max(tau, 1e-9)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every document."""
    def run(batches):
        m = lexicon.matcher()
        for b in batches:
            got = [m.score(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(got, pa.float64()), pa.array([int(s >= 0.5) for s in got], pa.int32())],
                names=["doc_id", "score", "predicted"])

    ready(docs.sparkSession)
    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")


def reject_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents that the lexicon does not reject, with their own columns."""
    def keep(batches):
        m = lexicon.matcher()
        for b in batches:
            text = b.column(b.schema.get_field_index("text")).to_pylist()
            mask = pa.array([m.score(x or "") < 0.5 for x in text], pa.bool_())
            yield b.filter(mask)

    ready(docs.sparkSession)
    return docs.mapInArrow(keep, docs.schema)
