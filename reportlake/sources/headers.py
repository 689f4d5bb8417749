"""Header names: sanitising (letters, digits and ``_`` only) and duplicate resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference behaviour.
FALLBACK_NAME = "COL"
_NOT_WORD = r"[^\p{L}\p{N}_]"


def sanitize_header(col: Column | str) -> Column:
    """Column form: trim, non letter/digit/_ → ``_``, collapse runs, strip one leading and
    trailing ``_``; NULL, blank or nothing left → ``COL``."""
    c = F.col(col) if isinstance(col, str) else col
    trimmed = F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    cleaned = F.regexp_replace(F.regexp_replace(F.regexp_replace(trimmed, _NOT_WORD, "_"), "_+", "_"), "^_|_$", "")
    return F.when(c.isNull() | (trimmed == ""), F.lit(FALLBACK_NAME)).otherwise(
        F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(FALLBACK_NAME)))


def dedupe_names(names: list[str]) -> list[str]:
    """Make a header list unique, case-insensitively: ``a, a, A`` → ``a, a_1, A_2``."""
    seen: dict[str, int] = {}
    taken: set[str] = set()
    out = []
    for n in names:
        key = n.lower()
        if key not in seen:
            seen[key] = 0
            taken.add(key)
            out.append(n)
            continue
        k = seen[key]
        while True:
            k += 1
            cand = f"{n}_{k}"
            if cand.lower() not in taken:
                break
        seen[key] = k
        taken.add(cand.lower())
        out.append(cand)
    return out


def blank_to_positional(names: list[str | None]) -> list[str]:
    """Empty header cells get a positional name ``column<i>``."""
    return [n if (n is not None and n.strip()) else f"column{i}" for i, n in enumerate(names)]
