"""BPE by backtracking: exact merges in linear time, and decoding by an offset table.

A vocabulary's token strings are put into an Aho-Corasick machine. For a pre-token, the longest token at the
present position is tried first; two neighbours are compatible if merging their text from scratch would leave
the border between them, which a walk down the two tokens' merge histories decides (answers are kept in a
table). A token that does not fit gives way to its next shorter prefix token, and a position from which
nothing fits is never tried again. Decoding takes every token's text from one block of bytes by an offset
table.

Nulls and ties: a null or empty text has no ids and decodes to the empty text; repeated rows each get their
own result; a null doc_id is kept; very long texts are handled in pieces that no pre-token crosses; extra
columns are ignored.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from reportlake.llm.common import documents, ready
from reportlake.llm.pretokens import Kept, pieces


def _byte_letters() -> dict[int, str]:
    """The printable stand-in for each byte: printable Latin-1 stays, the others follow from U+0100 on."""
    stay = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(stay)]
    return {b: chr(b) for b in stay} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordBpe:
    """Encoder and decoder for a ``tokenizers`` BPE file with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find = regex.compile(split.replace(r"\s", r"\p{White_Space}")).findall
        # Characters assigned after the Unicode tables of unicodedata: texts with them are cut by the library.
        known = regex.compile(r"\P{Cn}").match
        self.newer = frozenset(c for c in map(chr, range(0x80, sys.maxunicode + 1))
                               if unicodedata.category(c) == "Cn" and known(c))
        self.library = Tokenizer.from_file(path)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.added = added
        letters = _byte_letters()
        # A symbol is a byte, or a byte that ends a word; the latter is a letter of its own from U+0400 on.
        self.plain = {b: chr(0x10000 + b) for b in letters}
        self.final = {b: chr(0x10400 + b) for b in letters}
        byte_of = self.byte_of = {c: b for b, c in letters.items()}

        def inner(token: str) -> str:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            return "".join(self.plain[byte_of[c]] for c in body[:-1]) + (
                (self.final if ends else self.plain)[byte_of[body[-1]]] if body else "")

        # order: base symbols first, then tokens as their merges come
        self.order: dict[str, int] = {}
        self.text: list[str] = []
        self.ids: list[int] = []
        self.halves: list[tuple[int, int]] = []
        self.pair: dict[tuple[int, int], int] = {}

        def enter(text: str, vocab_id: int, halves: tuple[int, int] | None) -> int:
            k = self.order[text] = len(self.text)
            self.text.append(text)
            self.ids.append(vocab_id)
            self.halves.append(halves or (k, k))
            return k

        for token, i in sorted(vocab.items(), key=lambda x: x[1]):
            if len(inner(token)) == 1:
                enter(inner(token), i, None)
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            x, y = inner(a), inner(b)
            if x in self.order and y in self.order and x + y not in self.order:
                self.pair[self.order[x], self.order[y]] = enter(x + y, vocab[a + b], (self.order[x], self.order[y]))
        self.size = [len(t) for t in self.text]
        self.machine = ahocorasick.Automaton()
        for t, k in self.order.items():
            self.machine.add_word(t, k)
        self.machine.make_automaton()
        self.fits = Kept(self._fits, 200_000)
        self.kept = Kept(self._word, 400_000)
        self.prefix = Kept(self._prefix)
        # decoding: every token's text and a space, one after another
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in added.items()}
        blocks = [(names.get(i, "") + " ").encode("utf-8") for i in range(max(names, default=-1) + 1)]
        self.offsets = np.concatenate(([0], np.cumsum([len(x) for x in blocks]))).astype(np.int64)
        self.block = np.frombuffer(b"".join(blocks), np.uint8)

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of a token, or -1."""
        t = self.text[token]
        for n in range(len(t) - 1, 0, -1):
            k = self.order.get(t[:n])
            if k is not None:
                return k
        return -1

    def _fits(self, both: tuple[int, int]) -> bool:
        """Whether merging keeps the border between two tokens.

        The border is lost if, at any time of the merge order, the parts that touch it form a merge that comes
        before either part grows further.
        """
        left, right = both
        limit = len(self.text)
        while True:
            merged = self.pair.get((left, right))
            if merged is not None and merged < limit:
                return False
            # undo the later of the two merges; what touches the border then is its inner half. Symbols come
            # first in the order, so if the later one is a symbol, both are.
            first, second = self.halves[max(left, right)]
            if first == second == max(left, right):
                return True
            if left > right:
                limit, left = left, second
            else:
                limit, right = right + 1, first

    def symbols(self, word: str) -> str:
        data = word.encode("utf-8", "surrogatepass")
        if not data:
            return ""
        last = (self.final if self.suffix else self.plain)[data[-1]]
        return "".join([self.plain[b] for b in data[:-1]]) + last

    def encode_symbols(self, text: str) -> list[int]:
        """Token numbers (merge order) of one pre-token."""
        n = len(text)
        whole = self.order.get(text)
        if n == 1:
            return [whole]
        longest = [-1] * n
        for end, k in self.machine.iter(text):
            longest[end - self.size[k] + 1] = k  # ends rise, so the longest stays
        dead = bytearray(n + 1)
        tokens: list[int] = []
        at, nxt = 0, longest[0]
        while True:
            token = nxt
            while token != -1:
                end = at + self.size[token]
                if not dead[end] and (not tokens or self.fits[tokens[-1], token]):
                    break
                token = self.prefix[token]
            if token != -1:
                tokens.append(token)
                at = end
                if at == n:
                    return tokens
                nxt = longest[at]
            else:
                dead[at] = 1
                nxt = tokens.pop()
                at -= self.size[nxt]

    def _word(self, word: str) -> bytes:
        return np.array([self.ids[k] for k in self.encode_symbols(self.symbols(word))], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, little-endian unsigned 32 bits."""
        parts = self.special.split(text) if self.special and any(t in text for t in self.added) else [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
                continue
            for piece in pieces(part):
                out.append(b"".join(map(self.kept.__getitem__, self._split(piece))))
        return b"".join(out)

    def _split(self, piece: str) -> list[str]:
        """Normalised pre-tokens. Text is composed, then lower-cased letter by letter: a final sigma gets no
        form of its own."""
        if not piece.isascii() and not self.newer.isdisjoint(piece):
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))
            return [bytes(map(self.byte_of.__getitem__, word)).decode("utf-8") for word, _ in cut]
        return self.find(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower())

    def decode(self, data: bytes) -> bytes:
        """Text of ids in UTF-8: the tokens' own texts with single spaces between."""
        ids = np.frombuffer(data, "<u4").astype(np.int64)
        out = []
        for i in range(0, len(ids), 1 << 20):
            part = ids[i: i + (1 << 20)]
            start, size = self.offsets[part], self.offsets[part + 1] - self.offsets[part]
            ends = np.cumsum(size)
            out.append(self.block[np.arange(ends[-1]) + np.repeat(start - (ends - size), size)].tobytes())
        return b"".join(out)[:-1]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One encoder for all tasks of a Python worker, with the pre-tokens it has met."""
    return WordBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (ids as little-endian unsigned 32-bit integers) for every document."""
    def run(batches):
        bpe = word_bpe(path)
        for b in batches:
            ids = [bpe.encode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"])

    ready(docs.sparkSession)
    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the column ``decoded``, the text of its ``ids``."""
    def run(batches):
        bpe = word_bpe(path)
        for b in batches:
            text = [bpe.decode(x or b"") for x in b.column(b.schema.get_field_index("ids")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.binary()).cast(pa.string())],
                                             names=[*b.schema.names, "decoded"])

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields]
    return encoded.mapInArrow(run, ", ".join([*columns, "decoded string"]))
