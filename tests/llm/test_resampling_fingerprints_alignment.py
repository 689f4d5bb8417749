"""Importance resampling, I-Match fingerprints and token alignment against plain Python versions and awkward tables."""

import bisect
import collections
import hashlib
import math
import re
import zlib

import public_tokenizers as P
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from awkward_tables import LONG, awkward, nothing  # noqa: F401
from conftest import SF, plan_text
from reportlake.llm import align, imatch, importance, queries

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Texts with the sentinel, special tokens, the tokenizers' own marks, runs of white space and letters of many scripts.
ODD = ["a\x00b c", "<|endoftext|> x </s><unk> <0x41>", "mark ▁inside", "  two  blanks \n\n and\ttabs  ", "ABC Äpfel ÄÖ 北京 東京 𝐦𝐨 🎉🎉",
       "　x​y", "é" * 50 + " " + "Z" * 300, "\x00", " ", "no-break space   line", "﻿a", "x" * 5000]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


# --- op11 --------------------------------------------------------------------------------------------------

def grams(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def resampled(rows, target, percent=5, least=20):
    found = [(i, *grams(t)) for i, t in rows]
    s, t = collections.Counter(b for _, _, f in found for b in f), collections.Counter(b for x in target for b in grams(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in found:
        weight, score = sum(gain[b] for b in f), None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, len(f), weight, score, None])
    able = sorted((r for r in out if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def held(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")) for r in df.collect()), key=repr)


def test_resampling_whole_table(spark, docs):
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert held(queries.op11_importance_resampling(spark, SF)) == resampled(rows_of(docs), target)


@pytest.mark.parametrize("part", [7, 64, 1 << 22])
def test_resampling_awkward_and_parts(spark, monkeypatch, awkward, nothing, part):
    """Small parts cut texts between words; words that run over a part stay whole."""
    monkeypatch.setattr(importance, "PART_BYTES", part)
    short = awkward.filter("doc_id <> 5 OR doc_id IS NULL") if part < 100 else awkward
    d = short.select("doc_id", "text").unionByName(odd(spark))
    target = ["the lazy dog again", None, "", "one"]
    t = spark.createDataFrame([(x, "n") for x in target], "text string, bucket string")
    assert held(importance.resample(d, t, percent=50, least_words=2)) == resampled(rows_of(d), target, 50, 2)
    assert importance.resample(nothing, nothing).count() == 0
    extra = short.selectExpr("*", "1 AS rank", "2 AS weight", "3 AS n", "4 AS score", "5 AS n_words")
    assert len(held(importance.resample(extra, nothing))) == short.count()


# --- op12 --------------------------------------------------------------------------------------------------

def signed(h, seed=42):
    v = xxhash.xxh64(h, seed=seed & (2**64 - 1)).intdigest()
    return v - 2**64 if v >= 2**63 else v


def fingerprinted(rows):
    """Rows of (id, text), ids not null and different."""
    rows = sorted((i, t or "") for i, t in rows)
    words = lambda t: {w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower()) if w}
    df = collections.Counter(w for _, t in rows for w in words(t))
    kept = {w for w, n in df.items() if imatch.LEAST * len(rows) <= n <= imatch.MOST * len(rows)}

    def fingerprint(text):
        slots = {}
        for w in words(text) & kept:
            h = signed(w.encode())
            for level, m in enumerate(imatch.LEVELS):
                if (h >> 12 * level) % m < imatch.SUBSETS:
                    slots.setdefault(level * imatch.SUBSETS + (h >> 12 * level) % m, set()).add(h)
        out = []
        for i in range(imatch.SUBSETS * len(imatch.LEVELS)):
            seed = 42
            for h in sorted(slots.get(i, ())):
                seed = signed(h.to_bytes(8, "little", signed=True), seed)
            out.append(f"{seed & (2**64 - 1):016x}"[:8] if i in slots else "")
        return ".".join(out) if slots else "text:" + hashlib.sha256(text.encode()).hexdigest()[:32]

    def likeness(a, b):
        if a == b:
            return 1.0
        if a.startswith("text:") or b.startswith("text:"):
            return 0.0
        x, y, best = a.split("."), b.split("."), 0.0
        for i in range(0, len(x), imatch.SUBSETS):
            shown = [(p, q) for p, q in zip(x[i:i + imatch.SUBSETS], y[i:i + imatch.SUBSETS]) if p or q]
            best = max(best, sum(p == q for p, q in shown) / max(len(shown), imatch.LEAST_HASHES))
        return best

    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        f, e, n = map(fingerprint, (t, edited, after))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, likeness(f, e), likeness(f, n)))
    return out


def prints(df):
    return sorted((tuple(r[c] for c in imatch._OUT) for r in df.collect()), key=repr)


def test_fingerprints_whole_table(spark, docs):
    rows = rows_of(docs)
    got = prints(queries.op12_imatch_fingerprints(spark, SF))
    assert got == sorted(fingerprinted(rows), key=repr)
    text = dict(rows)
    assert len({(text[r[0]], r[3]) for r in got}) == len(set(text.values()))
    shown = [r for r in got if r[1] >= 100]
    assert sum(r[5] > r[6] for r in shown) >= 0.95 * len(shown)


def test_fingerprints_over_ranges_and_awkward(spark, monkeypatch, awkward, nothing):
    monkeypatch.setattr(imatch, "WIDTH", 4)
    rows = [(7 * i * i - 50, t) for i, t in enumerate([*ODD, None, "", "some words here", "some words there", LONG])]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, pos string, `range` int").repartition(5)
    assert prints(imatch.fingerprints(d)) == sorted(fingerprinted(rows), key=repr)
    got = {}
    for r in imatch.fingerprints(awkward).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == awkward.count() and len(got[1]) == 2
    assert (got[None][0]["near_edited"], got[None][0]["near_next"], got[None][0]["n_chars"]) == (1.0, None, 20)
    assert {r["fingerprint"] for r in got[1]} == {got[2][0]["fingerprint"]} and {r["near_next"] for r in got[1]} == {1.0}
    assert got[3][0]["fingerprint"] == got[4][0]["fingerprint"] and got[7][0]["edited_sha256"] == hashlib.sha256(b" \t\nt").hexdigest()
    assert imatch.fingerprints(nothing).count() == 0
    (alone,) = imatch.fingerprints(spark.createDataFrame([(9, "just a few words")], "doc_id long, text string")).collect()
    assert alone["near_next"] == 1.0


def test_fingerprints_run_no_python_and_shuffle_texts_once(docs):
    plan = plan_text(imatch.fingerprints(docs))
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert "hashpartitioning(range" in plan and "hashpartitioning(range#" in plan and "pos#" not in "".join(
        line for line in plan.splitlines() if "Exchange" in line)


# --- op13 --------------------------------------------------------------------------------------------------

def aligned(rows):
    a_lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letters = align.byte_letters()

    def a_bytes(i):
        return bytes(letters[c] for c in a_lib.id_to_token(i))

    def b_bytes(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()

    def laid(ids, of):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(of(i))))
            at = out[-1][2]
        return out

    found = []
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a, b = (a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)) if text else ([], [])
        if not text or b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            found.append((doc, 0, 0, collections.Counter(), []))
            continue
        a, b = laid(a, a_bytes), laid(b, b_bytes)
        ends = sorted({t[2] for t in a} & {t[2] for t in b})
        groups = [([], []) for _ in ends]
        for side, tokens in enumerate((a, b)):
            for t in tokens:
                groups[bisect.bisect_left(ends, t[2])][side].append(t)
        links = collections.Counter((x[0], y[0]) for p, q in groups for x in p for y in q if x[1] < y[2] and y[1] < x[2])
        found.append((doc, len(a), len(b), links, groups))
    n = collections.Counter(p for f in found for p in f[3])
    top = collections.Counter()
    for (x, _), k in n.items():
        top[x] = max(top[x], k)
    out = []
    for doc, n_a, n_b, links, groups in found:
        text = ";".join(",".join(str(t[0]) for t in p) + "|" + ",".join(str(t[0]) for t in q) for p, q in groups)
        out.append((doc, n_a, n_b, len(groups), sum(links.values()), sum(k for p, k in links.items() if n[p] == top[p[0]]),
                    sum(k * n[p] for p, k in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def links(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def score(d):
    return align.score_links(d, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), queries.BYTE_PATTERN, queries.BYTE_PATTERN_ASCII)


@pytest.mark.parametrize("hot", [1, 50, 400_000])
def test_alignment_whole_table(spark, monkeypatch, docs, hot):
    """With few, some or all pairs in the broadcast."""
    monkeypatch.setattr(align, "HOT", hot)
    assert links(queries.op13_token_alignment(spark, SF)) == aligned(rows_of(docs))


@pytest.mark.parametrize("part", [16, 1 << 21])
def test_alignment_awkward_and_parts(spark, monkeypatch, awkward, nothing, part):
    monkeypatch.setattr(align, "PART_CHARS", part)
    rest = "plain words before the " + "▁ mark "
    short = awkward.filter("doc_id <> 5 OR doc_id IS NULL") if part < 100 else awkward
    d = short.select("doc_id", "text").unionByName(odd(spark)).unionByName(
        spark.createDataFrame([(100, rest), (101, "plain words before the mark")], "doc_id long, text string"))
    got = links(score(d.selectExpr("*", "1 AS pairs", "'r' AS row", "2 AS n", "3 AS times")))
    assert got == aligned(rows_of(d))
    assert [r for r in got if r[0] == 100][0][1:] == (0, 0, 0, 0, 0, 0, "")
    assert links(score(nothing)) == []
