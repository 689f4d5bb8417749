"""Cross-tokenizer alignment by interval coalescing.

Both tokenizers' tokens are byte intervals over the same text. All intervals of a batch of documents are sorted by
start (``lexsort``), their ends run through ``maximum.accumulate``, and a new group begins wherever a start reaches the
running maximum: there tokens of both sides end. Inside the groups each A token is expanded with the B tokens it
overlaps, which gives the links. A text is encoded in chunks that no token crosses, each distinct chunk once per
worker; long texts are aligned in parts cut between such chunks, so a group never spans two parts.

What the table as a whole says about an id pair is the number of documents that hold it linked. Each document's distinct
pairs are written once; their counts come from one aggregate. Pairs that hold at least one ``HOT``-th of all
(document, pair) rows (so at most ``HOT`` of them) meet their documents by a broadcast, all others by a shuffle, in
which no key is large.

Nulls and ties: a null or empty text, and one whose joined A or B bytes differ from it with a space in front, has no
tokens; rows with a null id and repeated rows are documents of their own; texts of any length are whole; special
tokens written in a text are plain text; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reportlake.llm.common import documents, ready, stored

#: Characters aligned at once, chunks a worker keeps from batch to batch and their length, most pairs that are broadcast.
PART_CHARS, KEPT, KEPT_CHARS, HOT = 1 << 21, 500_000, 200, 400_000

_CUT = regex.compile(r"(?<=\S) ")  # no token of either side runs from a visible character into the space behind it
_SPACED = re.compile(" +[^ ]*")
_ODD = 0xFFFFFFFF
_ODD_BYTES = b"\xff" * 4


def byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 characters stand for their own byte, the others follow from 256."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: how a text is cut into chunks, the ids of many chunks, every id's bytes."""

    def __init__(self, cut, encode, token_bytes: list[bytes]):
        self.cut, self.encode, self.token_bytes = cut, encode, token_bytes
        self.lengths = np.array([len(t) for t in token_bytes], np.int64)
        self.kept: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]):
        found = self.encode(chunks)
        ends = np.cumsum([len(ids) for ids in found])
        ids = np.fromiter(chain.from_iterable(found), "<u4", ends[-1])
        reached = np.append(0, np.cumsum(self.lengths[ids]))[ends]
        alike = (b"".join(map(self.token_bytes.__getitem__, ids.tolist())) == "".join(chunks).encode()
                 and np.array_equal(reached, np.cumsum([len(c.encode()) for c in chunks])))
        data, start = ids.tobytes(), 0
        for chunk, own, end in zip(chunks, found, (4 * ends).tolist()):
            self.kept[chunk] = data[start: end] if alike or self._spells(own, chunk) else _ODD_BYTES
            start = end

    def _spells(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.token_bytes.__getitem__, ids)) == text.encode()

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of texts that begin with a space; None where their bytes don't give the text back."""
        cuts = [self.cut(t) for t in texts]
        if len(self.kept) > KEPT:
            self.kept.clear()
        missing = list(set().union(*cuts).difference(self.kept))
        if missing:
            self._learn(missing)
        out = []
        for text, cut in zip(texts, cuts):
            ids = np.frombuffer(b"".join(map(self.kept.__getitem__, cut)), "<u4")
            if (ids == _ODD).any():
                whole = self.encode([text])[0]
                ids = np.array(whole, "<u4") if self._spells(whole, text) else None
            out.append(ids)
        for chunk in missing:
            if len(chunk) > KEPT_CHARS:
                del self.kept[chunk]
        return out


@lru_cache(maxsize=2)
def sides(a_path: str, b_path: str, pattern: str, ascii_pattern: str) -> tuple[Side, Side, list[str]]:
    """Both tokenizers of a worker, and what a token looks like in a group's text, followed by each separator."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    a_lib = Tokenizer.from_file(a_path)
    a_lib.encode_special_tokens = True
    letters = byte_letters()
    added = {i: t.content for i, t in a_lib.get_added_tokens_decoder().items()}
    a_bytes = [added[i].encode() if i in added else bytes(letters[c] for c in a_lib.id_to_token(i))
               for i in range(a_lib.get_vocab_size())]
    find, find_ascii = regex.compile(pattern).findall, re.compile(ascii_pattern).findall
    a = Side(lambda text: find_ascii(text) if text.isascii() else find(text),
             lambda texts: [e.ids for e in a_lib.encode_batch(texts, add_special_tokens=False)], a_bytes)

    b_lib = sentencepiece.SentencePieceProcessor(model_file=b_path)
    pieces = [b_lib.id_to_piece(i) for i in range(b_lib.get_piece_size())]
    b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    if any("▁" in p.lstrip("▁") for p in pieces):  # a token may run into a space: texts stay whole
        cut = lambda text: [text]
    else:
        cut = _SPACED.findall
    b = Side(cut, lambda texts: b_lib.encode([t[1:] for t in texts], num_threads=1), b_bytes)
    names = [f"{i}{end}" for n, ends in ((len(a_bytes), ",|"), (len(b_bytes), ",;")) for end in ends for i in range(n)]
    return a, b, names


def parts(text: str):
    """A long text cut before spaces that follow a visible character."""
    start = 0
    while len(text) - start > PART_CHARS:
        m = _CUT.search(text, start + PART_CHARS)
        if not m:
            break
        yield text[start: m.start()]
        start = m.start()
    yield text[start:]


def coalesce(a_len: np.ndarray, b_len: np.ndarray):
    """Groups of two tilings of the same bytes: each A and B token's group, and the B tokens ``[lo, hi)`` an A token overlaps."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    a_start, b_start = a_end - a_len, b_end - b_len
    starts = np.concatenate((a_start, b_start))
    ends = np.concatenate((a_end, b_end))
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.concatenate(([0], starts[order][1:] >= reached[:-1]))
    group = np.empty(len(starts), np.int64)
    group[order] = np.cumsum(breaks)
    lo = np.searchsorted(b_end, a_start, side="right")
    hi = np.searchsorted(b_start, a_end, side="left")
    return group[:len(a_len)], group[len(a_len):], lo, hi


def _written(a_ids, b_ids, a_group, b_group, n_a: int, n_b: int) -> np.ndarray:
    """Numbers in the table of names, group by group: A ids, then B ids, each with the separator that follows it."""
    groups = int(a_group[-1]) + 1
    a_before = np.concatenate(([0], np.cumsum(np.bincount(a_group, minlength=groups))))
    b_before = np.concatenate(([0], np.cumsum(np.bincount(b_group, minlength=groups))))
    a_last = np.append(a_group[1:] != a_group[:-1], True)
    b_last = np.append(b_group[1:] != b_group[:-1], True)
    out = np.empty(len(a_ids) + len(b_ids), np.int64)
    out[np.arange(len(a_ids)) + b_before[a_group]] = a_ids + n_a * a_last
    out[np.arange(len(b_ids)) + a_before[b_group + 1]] = b_ids + 2 * n_a + n_b * b_last
    return out


class _Batch:
    """What a batch of documents gives, added up from parts of texts."""

    def __init__(self, a: Side, b: Side, names: list[str], rows: int):
        self.a, self.b, self.names = a, b, names
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(rows, np.int64) for _ in range(4))
        self.digest = [None] * rows
        self.odd: set[int] = set()
        self.keys, self.times = [], []  # row and pair in one number, and how often the row links it

    def add(self, rows: list[int], texts: list[str]):
        coded = list(zip(rows, self.a.ids(texts), self.b.ids(texts)))
        for row in {r for r, a_ids, b_ids in coded if a_ids is None or b_ids is None}:
            self.odd.add(row)
            self._drop(row)
        coded = [c for c in coded if c[0] not in self.odd]
        if not coded:
            return
        rows, a_ids, b_ids = map(list, zip(*coded))
        a_parts, b_parts = np.array([len(x) for x in a_ids]), np.array([len(x) for x in b_ids])
        a_all, b_all = np.concatenate(a_ids).astype(np.int64), np.concatenate(b_ids).astype(np.int64)
        a_group, b_group, lo, hi = coalesce(self.a.lengths[a_all], self.b.lengths[b_all])
        linked = hi - lo
        a_row = np.repeat(rows, a_parts)
        at = np.arange(linked.sum()) - np.repeat(np.cumsum(linked) - linked, linked) + np.repeat(lo, linked)
        pair = np.repeat(a_all, linked) * len(self.b.lengths) + b_all[at]
        keys, times = np.unique((np.repeat(a_row, linked) << 40) + pair, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        first = np.append(True, a_group[1:] != a_group[:-1])
        for total, found in ((self.n_a, np.ones(len(a_all))), (self.n_groups, first), (self.n_links, linked)):
            np.add.at(total, rows, np.add.reduceat(found, np.cumsum(a_parts) - a_parts).astype(np.int64))
        np.add.at(self.n_b, rows, b_parts)
        texts = _written(a_all, b_all, a_group, b_group, len(self.a.lengths), len(self.b.lengths)).tolist()
        end = 0
        for row, n in zip(rows, (a_parts + b_parts).tolist()):
            text = "".join(map(self.names.__getitem__, texts[end: end + n]))[:-1].encode()
            end += n
            if self.digest[row] is None:
                self.digest[row] = hashlib.sha256(text)
            else:
                self.digest[row].update(b";" + text)

    def _drop(self, row: int):
        """Take back what parts of a text have added before one of them turned out odd."""
        for total in (self.n_a, self.n_b, self.n_groups, self.n_links):
            total[row] = 0
        self.digest[row] = None
        for i, keys in enumerate(self.keys):
            other = keys >> 40 != row
            self.keys[i], self.times[i] = keys[other], self.times[i][other]

    def result(self, ids: pa.Array) -> pa.RecordBatch:
        keys = np.concatenate([np.empty(0, np.int64), *self.keys])
        times = np.concatenate([np.empty(0, np.int64), *self.times])
        if len(self.keys) > 1:  # a text may lie in several parts
            keys, back = np.unique(keys, return_inverse=True)
            times = np.bincount(back, times, minlength=len(keys)).astype(np.int64)
        rows = len(self.n_a)
        edges = pa.array(np.searchsorted(keys >> 40, np.arange(rows + 1)).astype(np.int32))
        pairs = pa.ListArray.from_arrays(edges, pa.array(keys & ((1 << 40) - 1)))
        counts = pa.ListArray.from_arrays(edges, pa.array(times.astype(np.int32)))
        sha = pa.array([d.hexdigest() if d else "" for d in self.digest])
        return pa.RecordBatch.from_arrays([ids, *map(pa.array, (self.n_a, self.n_b, self.n_groups, self.n_links)), sha, pairs, counts],
                                          names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, ascii_pattern: str,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` and the document's distinct linked id pairs: ``pairs``
    (A id times the size of B's vocabulary plus B id, ascending) and ``times`` (how often each is linked in it)."""
    ready(docs.sparkSession)

    def run(batches):
        a, b, names = sides(a_path, b_path, pattern, ascii_pattern)
        for batch in batches:
            out = _Batch(a, b, names, batch.num_rows)
            rows, texts, size = [], [], 0
            for row, text in enumerate(batch.column(1).to_pylist()):
                for part in parts(" " + text) if text else ():
                    rows.append(row)
                    texts.append(part)
                    size += len(part)
                    if size >= PART_CHARS:
                        out.add(rows, texts)
                        rows, texts, size = [], [], 0
            if rows:
                out.add(rows, texts)
            yield out.result(batch.column(0))

    return documents(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """``pair, n, best``: the documents that hold a pair linked, and whether no pair of its A id is in more."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    a_id = F.expr(f"pair DIV {b_size}")
    top = counts.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("top"))  # as many rows as A has ids
    return counts.withColumn("a_id", a_id).join(top, "a_id").select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))


def score_links(docs: DataFrame, a_path: str, b_path: str, pattern: str, ascii_pattern: str,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the alignment's numbers, ``n_best`` (links of a pair that is its A id's most frequent one) and
    ``count_sum`` (the pairs' document counts summed over the links)."""
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    aligned = stored(align(docs, a_path, b_path, pattern, ascii_pattern, id_col, text_col)
                     .withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(aligned, b_size), "pair-counts")
    rows = aligned.agg(F.sum(F.size("pairs"))).first()[0] or 0
    hot = F.broadcast(counts.filter(F.col("n") * HOT >= rows))  # at most HOT pairs
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    cold = links.join(hot.select("pair"), "pair", "left_anti").join(counts.filter(F.col("n") * HOT < rows), "pair")
    sums = (links.join(hot, "pair").unionByName(cold).groupBy("row")
            .agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    return (aligned.drop("pairs", "times").join(sums, "row", "left").drop("row")
            .fillna(0, ["n_best", "count_sum"]))
