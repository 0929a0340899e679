"""Secrets: three patterns, and a battery of randomness tests for the rest.

Candidates are runs of 16 or more characters of ``[A-Za-z0-9+/_=-]``.  Their encoding is
inferred as the smallest alphabet that covers them (hex, letters of either case,
lower-case alphanumeric, base32, alphanumeric, base64).  Three tests ask whether the
characters look drawn at random from it: chi-squared uniformity over as many cells as
the length allows, runs above and below the middle of the alphabet, and serial
correlation.  Fisher's method combines their p-values; below ``GATE`` a candidate is out.

Short strings pass such tests easily, so a pass alone means little.  What separates them
is how much likelier the characters are drawn from the alphabet than written: the log
likelihood ratio of the uniform draw to a chain of the corpus's own character pairs
(all runs of the whole texts but the candidates with digits or signs; case and digits by
fixed shares).  The share of false discoveries is controlled by alphabet and length
class: words and numbers of the running text, joined to names, paths and numbered words
(one string per ``NULL_STEP`` characters through every whole text), and the candidates
that are plain numbers, go through the same grading and give the share that passes at
each level.  Past the last ``TAIL`` of them that share falls by the root of the
likelihood ratio.  A class keeps the candidates above the lowest level at which the
expected false share (Benjamini-Hochberg on these p-values) is at most ``FALSE_SHARE``,
and none that is likelier written.  Every candidate is tested; only tables of character
pairs and of (alphabet, length class, level) counts reach the driver.

A null text is an empty text and has no spans.  Rows with equal ids are kept apart
as rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import materialize, small_batches

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16
KINDS = ("assign", "access", "hex", "random")

_TOKENS = re.compile("[A-Za-z]+|[0-9]+")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
FALSE_SHARE = 0.05
NULL_STEP = 200
NULL_LEAST = 200
TAIL = 10
GATE = 1e-3
LEVELS = 256         # half units of the log likelihood ratio, 0 in the middle
CLASSES = 24         # length classes: 16-17, 18-19, ... and the rest

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = [DIGITS + "abcdef", DIGITS + "ABCDEF", LOWER, UPPER, DIGITS + LOWER, UPPER + "234567", DIGITS + UPPER,
             UPPER + LOWER, UPPER + LOWER + DIGITS, UPPER + LOWER + DIGITS + "+/-_="]
_SETS = [(frozenset(a), {c: i for i, c in enumerate(a)}) for a in ALPHABETS]
GROUPS = len(ALPHABETS) * CLASSES

#: Symbols of the pair table: 0 what no candidate holds, 1-26 letters, 27 digits, 28 signs.
SYMBOLS = 29
_SYMBOL = np.zeros(128, dtype=np.int64)
for _i, _c in enumerate(LOWER):
    _SYMBOL[[ord(_c), ord(_c.upper())]] = _i + 1
_SYMBOL[[ord(_c) for _c in DIGITS]] = 27
_SYMBOL[[ord(_c) for _c in "+/-_="]] = 28
FLOOR = 0.03         # share of written pairs that the corpus does not tell


def pair_counts(text: str) -> np.ndarray:
    """Counts of neighbouring symbols in a text, without the candidates that hold digits or signs."""
    text = CANDIDATE.sub(lambda m: m[0] if m[0].isalpha() else " ", text)
    v = _SYMBOL[np.frombuffer(b" " + text.encode("ascii", "replace"), dtype=np.uint8)]
    return np.bincount(v[:-1] * SYMBOLS + v[1:], minlength=SYMBOLS * SYMBOLS)


def written(counts: np.ndarray) -> list[list[float]]:
    """Log probability of every character (ASCII) after every other in written strings."""
    c = counts.reshape(SYMBOLS, SYMBOLS)[:, 1:].astype(float)
    p = (1 - FLOOR) * (c + 1e-3) / (c + 1e-3).sum(axis=1, keepdims=True) + FLOOR / (SYMBOLS - 1)
    within = {27: 1 / 10, 28: 1 / 5}
    out = [[0.0] * 128 for _ in range(128)]
    for a in range(128):
        x = chr(a)
        for y in ALPHABETS[-1]:
            k = int(_SYMBOL[ord(y)])
            if k > 26:
                share = within[k]
            elif x.isalpha():
                share = (0.5 if x.isupper() else 0.07) if y.isupper() else (0.5 if x.isupper() else 0.93)
            else:
                share = 0.4 if y.isupper() else 0.6
            out[a][ord(y)] = math.log(p[_SYMBOL[a], k - 1] * share)
    return out


def chi2_tail(x: float, k: int) -> float:
    """P(chi-squared with k degrees of freedom > x)."""
    h = x / 2.0
    if h > 700:
        return 0.0
    total, term = (0.0, math.exp(-h)) if k % 2 == 0 else (math.erfc(math.sqrt(h)), math.exp(-h) * math.sqrt(h) / math.gamma(1.5))
    for i in range(k // 2):
        total += term
        term *= h / (i + (1 if k % 2 == 0 else 1.5))
    return min(1.0, max(0.0, total))


def battery(s: str, places: dict[str, int]) -> float:
    """Combined p-value of the three tests for the hypothesis "drawn at random"."""
    k, n = len(places), len(s)
    v = np.fromiter(map(places.__getitem__, s), dtype=np.int64, count=n)
    cells = min(k, max(2, n // 4))
    counts = np.bincount(v * cells // k, minlength=cells)
    share = np.bincount(np.arange(k) * cells // k, minlength=cells) / k * n
    p1 = chi2_tail(float(((counts - share) ** 2 / share).sum()), cells - 1)
    high = v * 2 >= k
    n1 = int(high.sum())
    n0 = n - n1
    if n1 and n0:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * n1 * n0 / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p2 = math.erfc(abs(runs - mean) / math.sqrt(2 * var)) if var > 0 else 1.0
    else:
        p2 = 2.0 ** (1 - n)
    d = v - v.mean()
    ss = float(d @ d)
    r = float(d[1:] @ d[:-1]) / ss if ss else 1.0
    p3 = math.erfc(abs(r + 1 / n) * math.sqrt(n / 2))
    return chi2_tail(-2 * sum(math.log(max(p, 1e-300)) for p in (p1, p2, p3)), 6)


def length_class(n: int) -> int:
    return min(CLASSES - 1, (n - 16) // 2)


def grade(s: str, chain: list[list[float]]) -> int:
    """Cell of a string: alphabet, length class and level; level LEVELS - 1 is the least written."""
    chars = set(s)
    k, places = next((k, p) for k, (known, p) in enumerate(_SETS) if chars <= known)
    codes = s.encode()
    ratio = sum(chain[a][b] for a, b in zip(b" " + codes, codes)) + len(s) * math.log(len(places))
    level = min(LEVELS - 1, max(0, LEVELS // 2 - math.floor(2 * ratio)))
    if ratio < 0 and battery(s, places) < GATE:
        level = 0
    return (k * CLASSES + length_class(len(s))) * LEVELS + level


def natural(text: str, chain: list[list[float]]) -> list[int]:
    """Cells of written strings: words and numbers of the text, joined in ways and to lengths that the text itself decides."""
    out = []
    for at in range(0, len(text), NULL_STEP):
        r = zlib.crc32(text[at:at + 64].encode("utf-8", "surrogatepass"))
        r, size = divmod(r, CLASSES)
        r, style = divmod(r, 5)
        r, number = divmod(r, 2)
        words = _TOKENS.findall(text, at, at + 3 * (16 + 2 * size))
        if style == 1:
            words = [w.upper() for w in words]
        elif style == 2:
            words = [w.capitalize() for w in words]
        elif style != 4:
            words = [w.lower() for w in words]
        if number and words:
            words.insert(1 + r % 2, str(r % 10 ** (1 + r % 4)))
        joined = ("_-/"[r % 3] if style > 2 else "").join(words)[:16 + 2 * size]
        if len(joined) >= 16:
            out.append(grade(joined, chain))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, in that order."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
        for text in batch.column(0).to_pylist():
            if text:
                total += pair_counts(text)
        at = total.nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["pair", "n"])


def _first_pass(key: str, chain: list[list[float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        three = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        grades = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cell", pa.int32())]))
        for batch in batches:
            base, found, words = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = base_spans(text)
                here = [{"start": m.start(), "end": m.end(), "cell": grade(m[0], chain)} for m in CANDIDATE.finditer(text)
                        if not any(a <= m.start() and m.end() <= e for a, _, e in spans)]
                base.append([{"start": a, "kind": k, "end": e} for a, k, e in spans])
                found.append(here)
                # plain numbers stand for written strings of either hex alphabet
                numbers = [x["cell"] for x in here if text[x["start"]:x["end"]].isdigit()]
                words.append(natural(text, chain) + numbers + [c + CLASSES * LEVELS for c in numbers])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, three), pa.array(found, grades), pa.array(words, pa.list_(pa.int32()))],
                names=[key, "base", "found", "words"])
    return run


def lowest_levels(candidates: np.ndarray, words: np.ndarray, share: float = FALSE_SHARE) -> np.ndarray:
    """Per alphabet and length class the lowest level kept (LEVELS: none).

    ``candidates`` and ``words`` are (GROUPS, LEVELS) counts.  The p-value of a level is
    the share of words at or above it (one added to both), and past the last ``TAIL``
    words falls by the root of the likelihood ratio; Benjamini-Hochberg runs within the
    group.  A group with fewer than ``NULL_LEAST`` words borrows those of shorter classes
    of its alphabet, which pass more easily.
    """
    words = words.reshape(-1, CLASSES, LEVELS).copy()
    for k in range(CLASSES - 1, -1, -1):
        for shorter in range(k - 1, -1, -1):
            short = words[:, k].sum(axis=1) < NULL_LEAST
            if not short.any():
                break
            words[short, k] += words[short, shorter]
    words = words.reshape(-1, LEVELS)
    up = lambda a: a[:, ::-1].cumsum(axis=1)[:, ::-1]
    c, w = up(candidates), up(words)
    p = (w + 1) / (words.sum(axis=1, keepdims=True) + 1)
    for g in range(len(p)):
        last = int((w[g] >= TAIL).sum()) - 1
        if last >= 0:
            p[g, last:] = p[g, last] * np.exp(-0.25 * np.arange(LEVELS - last))
    ok = (p * candidates.sum(axis=1, keepdims=True) <= share * c) & (c > 0)
    ok[:, :LEVELS // 2 + 1] = False
    return np.where(ok.any(axis=1), ok.argmax(axis=1), LEVELS)


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, spans): spans are (start, kind, end), kind 0-2 the patterns, 3 found by the battery."""
    kind = dict(docs.dtypes)[key]
    counts = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
    pairs = small_batches(docs).select(F.col("text").cast("string").alias("text")).mapInArrow(_pairs, "pair int, n long")
    for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():   # SYMBOLS ** 2 rows at most
        counts[r["pair"]] = r["n"]
    chain = written(counts)
    first = materialize(
        small_batches(docs).select(F.col(f"`{key}`"), F.col("text").cast("string").alias("text")).mapInArrow(
            _first_pass(key, chain), f"`{key}` {kind}, base array<struct<start: int, kind: int, end: int>>, "
                              "found array<struct<start: int, end: int, cell: int>>, words array<int>"), "secrets")

    def table(cells: DataFrame) -> np.ndarray:
        out = np.zeros(GROUPS * LEVELS, dtype=np.int64)
        for r in cells.groupBy("cell").count().collect():   # GROUPS * LEVELS rows at most
            out[r["cell"]] = r["count"]
        return out.reshape(GROUPS, LEVELS)

    lowest = lowest_levels(table(first.select(F.explode("found.cell").alias("cell"))),
                           table(first.select(F.explode("words").alias("cell"))))
    limits = F.array(*[F.lit(int(x)) for x in lowest])
    kept = F.filter("found", lambda x: (x["cell"] % LEVELS) >= F.get(limits, F.floor(x["cell"] / LEVELS).cast("int")))
    more = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))
    return first.select(F.col(f"`{key}`"), F.array_sort(F.concat("base", more)).alias("spans"))


def digest(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per pattern, SHA-256 of the pattern spans, and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def n(k: int):
        return F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return scan(docs, key).select(
        F.col(f"`{key}`"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), n(3).alias("n_random"))
