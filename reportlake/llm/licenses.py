"""License scans: template markup compiled into one token automaton.

A template is a line of lower-case words; ``[[...]]`` encloses words that may be left out and ``{{lo-hi}}``
stands for lo to hi words of any wording. All templates become one automaton over words, made
deterministic as it is walked, so a text is read once whatever the number of templates. A text has a
template's label if the mandatory wording stands in it exactly, in order, with only the optional and
replaceable regions between. Plain phrases are templates without regions; their places are counted too.

Nulls and ties: a null or empty text has no words, no labels and score 0; repeated rows each get their own
result; a null doc_id is kept; overlapping places all count; extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from reportlake.llm.common import documents, ready

# The phrases and labels of the contract, and the mandatory wording of public licenses.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
TEMPLATES = {
    "apache-2.0": "licensed under the apache license [[version]] 2 0",
    "mit-notice": "{{1-1}} under the [[terms of the]] mit license",
    "mit-grant": "permission is hereby granted [[free of charge]] to any person obtaining a copy of {{1-14}} "
                 "to deal in the {{1-3}} without restriction",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "gpl-2.0": "gnu general public license [[as published by the free software foundation]] [[either]] version 2",
    "gpl-3.0": "gnu general public license [[as published by the free software foundation]] [[either]] version 3",
    "agpl-3.0": "gnu affero general public license [[as published by the free software foundation]] [[either]] version 3",
    "lgpl": "gnu lesser general public license [[as published by the free software foundation]] [[either]] version {{1-1}}",
    "mpl-2.0": "mozilla public license [[version]] [[v]] 2 0",
    "cc-by-4.0": "[[licensed under]] cc by 4 0",
    "cc-by-sa-4.0": "[[licensed under]] cc by sa 4 0",
    "cc-by-nc-4.0": "[[licensed under]] cc by nc 4 0",
    "cc-by-nd-4.0": "[[licensed under]] cc by nd 4 0",
    "isc": "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee "
           "is hereby granted",
}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"\[\[(.*?)\]\]|\{\{(\d+)-(\d+)\}\}|(\S+)")
_STATES = 20_000  # deterministic states kept before the table starts anew; results don't change


def words(text: str) -> list[bytes]:
    """Words of a text, A-Z lower-cased; every character beyond ASCII belongs to a word."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower())


class TokenAutomaton:
    def __init__(self, templates: list[tuple[str, str, bool]]):
        """``templates``: (label, markup, is a plain phrase whose places count)."""
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]  # state → (word or None for any, next)
        self.skips: list[list[int]] = [[]]
        self.accept: dict[int, tuple[str, int, bool]] = {}  # state → label, mandatory words, phrase
        for label, markup, phrase in templates:
            state, mandatory = self._state(), 0
            self.skips[0].append(state)
            for optional, lo, hi, word in _MARK.findall(markup):
                if word:
                    state = self._step(state, word.encode())
                    mandatory += 1
                elif optional:
                    before = state
                    for w in optional.split():
                        state = self._step(state, w.encode())
                    self.skips[before].append(state)
                else:
                    for _ in range(int(lo)):
                        state = self._step(state, None)
                    ends = [state]
                    for _ in range(int(hi) - int(lo)):
                        state = self._step(state, None)
                        ends.append(state)
                    for e in ends[:-1]:
                        self.skips[e].append(state)
            self.accept[state] = (label, mandatory, phrase)
        first = self._closure({0})
        self.start = first
        self.opening = {w for s in first for w, _ in self.edges[s]}
        self.anywhere = None in self.opening
        self.known = {w for es in self.edges for w, _ in es if w is not None}
        self._reset()

    def _state(self) -> int:
        self.edges.append([])
        self.skips.append([])
        return len(self.edges) - 1

    def _step(self, state: int, word: bytes | None) -> int:
        nxt = self._state()
        self.edges[state].append((word, nxt))
        return nxt

    def _closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def _reset(self):
        self.number = {self.start: 0}
        self.sets = [self.start]
        self.moves: list[dict[bytes | None, int]] = [{}]
        self.found: list[list[tuple[str, int, bool]]] = [self._accepting(self.start)]

    def _accepting(self, states: frozenset[int]) -> list[tuple[str, int, bool]]:
        return [self.accept[s] for s in sorted(states) if s in self.accept]

    def _move(self, state: int, word: bytes | None) -> int:
        here = self.sets[state]
        to = self._closure({n for s in here for w, n in self.edges[s] if w is None or w == word}) | self.start
        if len(self.sets) > _STATES:
            self._reset()
            return self._enter(to)
        self.moves[state][word] = k = self._enter(to)
        return k

    def _enter(self, states: frozenset[int]) -> int:
        k = self.number.get(states)
        if k is None:
            k = self.number[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            self.found.append(self._accepting(states))
        return k

    def scan(self, text_words: list[bytes]):
        """(end, label, mandatory words, phrase) for every place where a template ends."""
        if not self.known or self.known.isdisjoint(text_words):
            return
        state, known = 0, self.known
        for i, w in enumerate(text_words):
            key = w if w in known else None
            nxt = self.moves[state].get(key)
            if nxt is None:
                nxt = self._move(state, key)
            state = nxt
            for label, mandatory, phrase in self.found[state]:
                yield i, label, mandatory, phrase


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is 1 - 1 / (1 + m), m the mandatory words of the longest template found: 0 without one, and the
    nearer to 1 the more wording stands exactly.
    """
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    rules = [(label, text, True) for text, label in phrases.items()] + [(k, v, False) for k, v in templates.items()]

    def run(batches):
        machine = TokenAutomaton(rules)
        for b in batches:
            out = {k: [] for k in ("n", "base", "first", "last", "own", "all", "score")}
            for text in b.column(1).to_pylist():
                ws = words(text)
                own, every, n_base, first, last, most = set(), set(), 0, None, None, 0
                for end, label, mandatory, phrase in machine.scan(ws):
                    every.add(label)
                    most = max(most, mandatory)
                    if phrase:
                        own.add(label)
                        n_base += 1
                        start = end - mandatory + 1
                        first = start if first is None else min(first, start)
                        last = start if last is None else max(last, start)
                for k, v in zip(out, (len(ws), n_base, first, last, ",".join(sorted(own)), ",".join(sorted(every)),
                                      1 - 1 / (1 + most))):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out["n"], pa.int64()), pa.array(out["base"], pa.int64()),
                 pa.array(out["first"], pa.int64()), pa.array(out["last"], pa.int64()),
                 pa.array(out["own"], pa.string()), pa.array(out["all"], pa.string()), pa.array(out["score"], pa.float64())],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    ready(docs.sparkSession)
    return documents(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
             "labels string, score double")
