"""Whole texts cut into pre-tokens, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import regex

#: Characters after which a long text is cut, before a white-space character that follows a visible one.
PIECE_CHARS = 1_000_000
#: Distinct pre-tokens kept by a worker before its table starts anew (a memory bound; results don't change).
KEPT = 1_000_000

_BREAK = regex.compile(r"(?<=\S)\s")


def pieces(text: str) -> Iterator[str]:
    """The text in parts that no pre-token crosses: pre-tokens never run from a visible character into
    the white space behind it."""
    start, n = 0, len(text)
    while n - start > PIECE_CHARS:
        m = _BREAK.search(text, start + PIECE_CHARS)
        if not m:
            break
        yield text[start: m.start()]
        start = m.start()
    yield text[start:]


class Kept(dict):
    """A bounded table of what ``make`` gives for a pre-token."""

    def __init__(self, make, most: int = KEPT):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, token):
        if len(self) >= self.most:
            self.clear()
        got = self[token] = self.make(token)
        return got
