"""Token counts under a unigram model, by dynamic programming shared over a trie of pre-tokens.

Distinct pre-tokens are put into a trie of bytes. A node holds the best forward score of its prefix and the
number of tokens on the best path, so pre-tokens that begin alike share the work, and a pre-token's count is
read at the node where it ends. The model gives a token of a public rank vocabulary the cost of Zipf's law,
log(rank + 2), in whole units of 1/65536: sums are exact. Equal costs go to fewer tokens.

Nulls and ties: a null or empty text counts 0; repeated rows each get their own result; a null doc_id is
kept; pre-tokens of more than ``TRIE_BYTES`` bytes are counted by the same recurrence without a trie, so
memory stays bounded; extra columns are ignored.
"""

from __future__ import annotations

import base64
import math
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from reportlake.llm.common import documents, ready
from reportlake.llm.pretokens import pieces

TRIE_NODES, TRIE_BYTES = 1_000_000, 1024


def rank_costs(path: str) -> dict[bytes, int]:
    """Token → cost, from a file of base64 tokens and ranks."""
    costs = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                costs[base64.b64decode(token)] = round(65536 * math.log(int(rank) + 2))
    return costs


class Trie:
    """Forward scores of prefixes; ``counts[pre-token]`` is the token number of the best path."""

    def __init__(self, costs: dict[bytes, int]):
        self.costs = costs
        self.longest = max(map(len, costs), default=1)
        self.clear()

    def clear(self):
        self.child: dict[tuple[int, int], int] = {}
        self.best: list[tuple[int, int]] = [(0, 0)]  # cost, tokens
        self.counts: dict[str, int] = {}

    def _forward(self, word: bytes, scores: list[tuple[int, int]]) -> tuple[int, int]:
        """Best (cost, tokens) of ``word``, whose prefixes of length 0, 1, ... have ``scores``."""
        n, found = len(word), None
        for start in range(max(0, n - self.longest), n):
            cost = self.costs.get(word[start:])
            if cost is not None:
                c, k = scores[start - n]
                if found is None or (c + cost, k + 1) < found:
                    found = (c + cost, k + 1)
        if found is None:  # a byte outside the vocabulary is a token that costs more than any other
            c, k = scores[-1]
            found = (c + (1 << 24), k + 1)
        return found

    def count(self, token: str) -> int:
        got = self.counts.get(token)
        if got is not None:
            return got
        word = token.encode("utf-8", "surrogatepass")
        if len(word) > TRIE_BYTES:
            scores = [(0, 0)]
            for i in range(1, len(word) + 1):
                lo = max(0, i - self.longest)
                scores.append(self._forward(word[lo:i], scores[lo - i:]))
                if len(scores) > 2 * self.longest:
                    del scores[: -self.longest - 1]
            return scores[-1][1]
        if len(self.best) > TRIE_NODES:
            self.clear()
        node, scores = 0, [(0, 0)]
        for i, byte in enumerate(word):
            nxt = self.child.get((node, byte))
            if nxt is None:
                nxt = self.child[node, byte] = len(self.best)
                self.best.append(self._forward(word[: i + 1], scores))
            node = nxt
            scores.append(self.best[node])
        self.counts[token] = scores[-1][1]
        return scores[-1][1]


@lru_cache(maxsize=2)
def shared_trie(ranks_path: str) -> Trie:
    """One trie for all tasks of a Python worker."""
    return Trie(rank_costs(ranks_path))


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` for every document."""
    def run(batches):
        trie = shared_trie(ranks_path)
        find = regex.compile(pattern).findall
        for b in batches:
            n_pre, n_tok = [], []
            for text in b.column(1).to_pylist():
                pre = tok = 0
                for piece in pieces(text):
                    found = find(piece)
                    pre += len(found)
                    tok += sum(map(trie.count, found))
                n_pre.append(pre)
                n_tok.append(tok)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_pre, pa.int64()), pa.array(n_tok, pa.int64())],
                names=["doc_id", "n_pretokens", "n_tokens"])

    ready(docs.sparkSession)
    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
