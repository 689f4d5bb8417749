"""Importance resampling towards a target distribution, by hashed word n-grams of whole batches.

The texts of a batch are joined with separator sentinels. One regex pass over the joined bytes finds all words;
``searchsorted`` in the documents' offsets says which document a word stands in, so n-grams that would run from one
document into the next are masked before ``bincount`` counts the buckets. A first pass counts the buckets of the
documents and of the target (one row per task and bucket, summed by Spark to ``BUCKETS`` numbers whatever the
corpus size); a second one sums every document's gains. Scores add Gumbel noise drawn from a hash of the id,
and the best are numbered by a range-partitioned sort, so the draw is without replacement and the same on every run.

Nulls and ties: a null text has no words; a row with a null id has its features and weight, but no noise: its
score is null, it doesn't count among the rows drawn from and is never drawn; equal scores go to the smaller id; repeated
rows are rows of their own; texts of any length are worked on in parts of ``PART_BYTES`` that carry the last words
over; an empty table gives an empty result (and an empty target a uniform one); extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import ready, stored
from reportlake.operators.joins import row_index

#: Hash buckets of the features, words of the longest feature, bytes of text joined at once.
BUCKETS, LONGEST, PART_BYTES = 10_000, 3, 1 << 22

#: Words over UTF-8 bytes once A-Z are lower case: digits, a-z and all that isn't ASCII. The sentinel is no word byte.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_SENTINEL = b"\x00"


def parts(text: bytes):
    """``(part, words carried over)``: a long text cut between words, each part led by the last words before it."""
    text = text.lower()
    start, tail = 0, []
    while len(text) - start > PART_BYTES:
        gap = _GAP.search(text, start + PART_BYTES)
        if not gap:
            break
        part = b" ".join([*tail, text[start: gap.start()]])
        yield part, len(tail)
        tail = _WORD.findall(part)[1 - LONGEST:]
        start = gap.start()
    yield b" ".join([*tail, text[start:]]), len(tail)


def features(texts: list[bytes], carried: list[int]):
    """Of texts joined with sentinels: per feature length the text and the bucket of each feature, and the words per text."""
    offsets = np.cumsum([0] + [len(t) + len(_SENTINEL) for t in texts[:-1]])
    words, starts = [], []
    for m in _WORD.finditer(_SENTINEL.join(texts)):
        words.append(m.group())
        starts.append(m.start())
    starts = np.array(starts, np.int64)
    text = np.searchsorted(offsets, starts, side="right") - 1
    place = np.arange(len(words)) - np.searchsorted(starts, offsets)[text]
    carried = np.array(carried, np.int64)
    found = []
    spaced = [b" " + w for w in words]
    sums = list(map(crc32, words))
    for n in range(1, LONGEST + 1):
        if n > 1:  # a checksum goes on from the one of the words before
            sums = list(map(crc32, spaced[n - 1:], sums))
        at = text[n - 1:]
        inside = place[n - 1:] >= np.maximum(carried[at], n - 1)
        found.append((at[inside], (np.array(sums, np.uint32) % BUCKETS)[inside].astype(np.int64)))
    return found, np.bincount(text, minlength=len(texts)) - carried


def _joined(column: pa.Array):
    """The texts of a column in lists of about ``PART_BYTES``: ``(rows, texts, words carried over)``."""
    rows, texts, carried, size = [], [], [], 0
    for row, text in enumerate(column.cast(pa.binary()).to_pylist()):
        if text:
            for part, n in parts(text):
                rows.append(row)
                texts.append(part)
                carried.append(n)
                size += len(part)
                if size >= PART_BYTES:
                    yield rows, texts, carried
                    rows, texts, carried, size = [], [], [], 0
    if rows:
        yield rows, texts, carried


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, joined, carried in _joined(b.column(0)):
                for _, buckets in features(joined, carried)[0]:
                    total += np.bincount(buckets, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    sums = (texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain in thousandths: how much more of the target's features than of the source's it holds."""
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""

    def run(batches):
        for b in batches:
            words, counts, weights = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for rows, joined, carried in _joined(b.column(1)):
                found, n_words = features(joined, carried)
                np.add.at(words, rows, n_words)
                for at, buckets in found:
                    np.add.at(counts, rows, np.bincount(at, minlength=len(rows)))
                    # running sums stay whole numbers, floats of bincount's weights would not
                    sums = np.concatenate(([0], np.cumsum(gain[buckets])))
                    edges = np.searchsorted(at, np.arange(len(rows) + 1))
                    np.add.at(weights, rows, sums[edges[1:]] - sums[edges[:-1]])
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (words, counts, weights))],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``n_words, n_features, weight, score`` and, where it is drawn, its ``rank``."""
    ready(docs.sparkSession)
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    scored = stored(weigh(docs, gain, id_col, text_col)
                    .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = percent * scored.filter(able).count() // 100
    ranked = row_index(scored.filter(able), [F.col("score").desc(), F.col("doc_id"), F.col("weight"), F.col("n_features")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    return ranked.unionByName(scored.filter(~F.coalesce(able, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))
