"""Packing: first-fit decreasing over a tournament tree, in randomised groups of documents.

A document's ids end with an end id and are cut into whole sequences and a remainder. Remainders are dealt
into random groups of about ``GROUP`` documents; each group packs its own, longest first, into the first bin
with room, which a tournament tree over the bins' room finds in logarithmic steps. What room is left is
filled by cutting the pieces of the emptiest bins, so a group ends with one partly filled sequence; gaps
under ``MIN_CUT`` tokens stay.

Nulls and ties: a null or empty text is the end id alone; a null doc_id is packed like any other; repeated
rows are documents of their own; whole sequences of long texts pass through a group one by one and only remainders
are held; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reportlake.llm.common import documents, ready
from reportlake.llm.pretokens import Kept, pieces

LENGTH, GROUP, MIN_CUT = 1024, 8192, 8
#: Bytes of text of a group where texts are long, pieces of a batch between tasks.
GROUP_BYTES, PIECES = 1 << 28, 1000


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file whose pre-tokens ``pattern`` describes.

    Each distinct pre-token goes through the library once; special tokens written in a text are found first,
    as the library does.
    """

    def __init__(self, path: str, pattern: str, ascii_pattern: str | None = None):
        self.library = Tokenizer.from_file(path)
        self.find = regex.compile(pattern).findall
        self.find_ascii = re.compile(ascii_pattern).findall if ascii_pattern else self.find
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in added) + ")") if added else None
        self.added = added
        self.kept = Kept(self._make)

    def _make(self, token: str) -> bytes:
        ids = array("I", self.library.encode(token, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> np.ndarray:
        parts = self.special.split(text) if any(t in text for t in self.added) else [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.kept[part])
            else:
                for piece in pieces(part):
                    found = self.find_ascii(piece) if piece.isascii() else self.find(piece)
                    out.append(b"".join(map(self.kept.__getitem__, found)))
        return np.frombuffer(b"".join(out), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, ascii_pattern: str | None = None) -> Encoder:
    """One encoder for all tasks of a Python worker, with the pre-tokens it has met."""
    return Encoder(path, pattern, ascii_pattern)


class Tournament:
    """Bins in order of opening; the first with enough room is found from the root down."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1
        while self.leaves < max(1, bins):
            self.leaves *= 2
        self.room = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        found = at - self.leaves
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return found


def first_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of item numbers; every size is at most ``length``."""
    tree = Tournament(len(sizes), length)
    bins: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        bins.setdefault(tree.place(sizes[i]), []).append(i)
    return [bins[k] for k in sorted(bins)]


def fill(bins: list[list[int]], sizes: list[int], length: int, min_cut: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, from, to): the emptiest bins are cut up to fill the others."""
    full = sorted(([(i, 0, sizes[i]) for i in b] for b in bins), key=lambda b: -sum(t - f for _, f, t in b))
    used = [sum(t - f for _, f, t in b) for b in full]
    lo, hi = 0, len(full) - 1
    while lo < hi:
        gap = length - used[lo]
        if gap < min_cut:
            lo += 1
            continue
        item, start, stop = full[hi].pop()
        take = min(gap, stop - start)
        full[lo].append((item, start, start + take))
        used[lo] += take
        used[hi] -= take
        if take < stop - start:
            full[hi].append((item, start + take, stop))
        if not full[hi]:
            hi -= 1
    return [b for b in full if b]


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, length: int = LENGTH, end_id: int = 0,
         group: int = GROUP, min_cut: int = MIN_CUT, seed: int = 17, ascii_pattern: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    ``ids`` holds the piece's ids (little-endian unsigned 32 bits).
    ``ascii_pattern``, if given, says for ASCII texts what ``pattern`` says for all, in terms that match faster.
    """
    ready(docs.sparkSession)
    docs = documents(docs, id_col, text_col)
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-n // group), -(-size // GROUP_BYTES))
    dealt = (docs.withColumn("row", F.monotonically_increasing_id())
             .withColumn("grp", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(groups)))
             .select("doc_id", "text", "grp", "row"))

    def encode(batches):
        enc = encoder(tokenizer_path, pattern, ascii_pattern)
        last = np.array([end_id], "<u4")
        for b in batches:
            out = {k: [] for k, _ in _CUT}
            for doc, text, grp, row in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.concatenate((enc.encode(text), last))
                data = ids.tobytes()
                for start in range(0, len(ids), length):
                    piece = data[4 * start: 4 * (start + length)]
                    for k, v in zip(out, (grp, len(piece) < 4 * length, row, start, doc, len(ids), piece)):
                        out[k].append(v)
                    if len(out["grp"]) >= PIECES:
                        yield _batch(out, _CUT)
                        out = {k: [] for k, _ in _CUT}
            yield _batch(out, _CUT)

    def pack_groups(batches):
        """Whole sequences come first in a group and go on as they come; remainders are held and packed at its end."""
        out = {k: [] for k, _ in _PIECES}
        current, sequence, held = None, 0, []

        def put(doc, start, ids, tokens, offset):
            for k, v in zip(out, (doc, start, len(ids) // 4, zlib.crc32(ids), tokens, (current << 32) + sequence, offset, ids)):
                out[k].append(v)

        def full():
            nonlocal out
            if len(out["doc_id"]) >= PIECES:
                yield _batch(out, _PIECES)
                out = {k: [] for k, _ in _PIECES}

        def close():
            nonlocal sequence, held
            sizes = [len(h[3]) // 4 for h in held]
            for b in fill(first_fit_decreasing(sizes, length), sizes, length, min_cut):
                offset = 0
                for item, lo, hi in b:
                    doc, start, tokens, ids = held[item]
                    put(doc, start + lo, ids[4 * lo: 4 * hi], tokens, offset)
                    offset += hi - lo
                sequence += 1
                yield from full()
            held = []

        for b in batches:
            for grp, partial, _, start, doc, tokens, ids in zip(*(c.to_pylist() for c in b.columns)):
                if grp != current:
                    yield from close()
                    current, sequence = grp, 0
                if partial:
                    held.append((doc, start, tokens, ids))
                else:
                    put(doc, start, ids, tokens, 0)
                    sequence += 1
                    yield from full()
        yield from close()
        yield _batch(out, _PIECES)

    cut = dealt.mapInArrow(encode, "grp long, partial boolean, row long, start long, doc_id long, doc_tokens long, ids binary")
    return (cut.repartition("grp").sortWithinPartitions("grp", "partial", "row", "start")
            .mapInArrow(pack_groups, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                                     "offset long, ids binary"))


def _batch(rows: dict[str, list], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[k], t) for k, t in fields], schema=pa.schema(fields))


_CUT = [("grp", pa.int64()), ("partial", pa.bool_()), ("row", pa.int64()), ("start", pa.int64()), ("doc_id", pa.int64()),
        ("doc_tokens", pa.int64()), ("ids", pa.binary())]
_PIECES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
