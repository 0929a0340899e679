"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters of other scripts to Latin,
digits and signs inside words to the letters they stand for, everything else to a
blank.  Entries are whole words or word beginnings.  Accents tell words apart in many
languages, so entries keep theirs; a second pass with accents off finds entries without
accents that are hidden behind some.  The sum of the weights of all matches outside
exception phrases, divided by the length, is turned into a probability.

Lexicon, exceptions and the probability curve are learned from labelled rows
(`fit`): the weight of a term is its log odds ratio between the classes; an
exception is a pair of a matched word and its neighbour that occurs almost only
in harmless texts.  A null or empty text has no match; its score is the curve's
value at zero, the base rate of unmatched texts.  Every row gets a score, repeated ones
and those without an id too; these are never held out nor learned from.  An empty table
gives no rows; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import materialize, small_batches
from beatline.llm.training import fit_logistic, sigmoid, split_remainder, training_sample

#: Letters of Greek and Cyrillic that look like Latin ones (fixed values).
LOOK_ALIKE = dict(zip("аеорсухіјѕԁһӏмтнвкг" "αοεινκτρυχγωβ",
                      "aeopcyxijsdhlmthbkr" "aoeivktpuxywb", strict=True))
#: Digits and signs for letters (fixed values).
LEET = dict(zip("0134578@$!|", "oieastbasil"))
_LEET = re.compile(r"(?:(?<=[^\W\d_])[0134578@$!|]+|(?<!\w)[0134578@$]+)(?=[^\W\d_])")   # between letters, or before one
_LEET_TABLE = str.maketrans(LEET)
_RUN = re.compile(r"\S+")
_SIGNS = re.compile("[0134578@$!|]")
LOOK_ALIKE_TABLE = str.maketrans(LOOK_ALIKE)

PREFIX_LENGTHS = (4, 5, 6, 7)
MIN_SUPPORT = 5          # toxic training texts that hold a term
MIN_SUPPORT_SHARE = 0.004
MIN_WEIGHT = 3.0         # log odds ratio of a term, exception phrases left out
FIRST_WEIGHT = 1.0       # of a term before exception phrases are known
EXCEPTION_SUPPORT = 3
EXCEPTION_SHARE = 0.9


def _folded(c: str) -> str:
    d = LOOK_ALIKE.get(c) or unicodedata.normalize("NFKC", c).lower()[:1] or c
    return d if d.isalnum() else " "


def _stripped(c: str) -> str:
    d = unicodedata.normalize("NFKD", c)[:1]
    return d if d.isalpha() else c


class _Table(dict):
    """Table of the characters up to U+FFFF that change; those above are worked out when they turn up."""

    def __init__(self, change, first: int):
        super().__init__((c, d) for c in range(first, 0x10000) if (d := change(chr(c))) != chr(c))
        self.change = change

    def __missing__(self, c: int) -> str:
        d = self[c] = chr(c) if c < 0x10000 else self.change(chr(c))
        return d


# one character for one character, so offsets in folded text are offsets in the text
_FOLD = _Table(_folded, 0)
_STRIP = _Table(_stripped, 0x80)


def fold(text: str) -> str:
    """Folded text, as long as ``text``."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower()[:1] for c in text)
    if _SIGNS.search(low):
        low = _LEET.sub(lambda m: m[0].translate(_LEET_TABLE), low.translate(LOOK_ALIKE_TABLE))
    return low.translate(_FOLD)


def strip(folded: str) -> str:
    """Folded text without accents, as long as before."""
    return folded.translate(_STRIP)


def terms(folded: str) -> set[str]:
    """Lexicon candidates of a text: ' word ' for whole words, ' begin' for word beginnings."""
    words = {w for w in folded.split() if len(w) >= 3 and not w.isdigit()}
    out = {f" {w} " for w in words}
    for n in PREFIX_LENGTHS:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


class _Shields:
    """Exception phrases around the words of one folded text."""

    def __init__(self, folded: str, phrases: dict[str, list[tuple[list[str], int]]]):
        self.phrases = phrases
        self.words = [(m.start(), m[0]) for m in _RUN.finditer(folded)]

    def __call__(self, at: int) -> bool:
        """Does the word after the blank at ``at`` stand in an exception phrase?  Any blanks may lie between words."""
        i = bisect_left(self.words, (at, ""))
        for words, k in self.phrases.get(self.words[i][1], ()) if i < len(self.words) else ():
            if i >= k and [w for _, w in self.words[i - k:i - k + len(words)]] == words:
                return True
        return False


@dataclass
class ToxicityModel:
    """Weights by term, exception phrases (' word neighbour '), curve coefficients."""
    lexicon: dict[str, float]
    exceptions: frozenset[str] = frozenset()      # phrases of up to six words
    curve: tuple[float, float, float] = (4.0, 1.0, -4.0)
    _auto: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"lexicon": self.lexicon, "exceptions": self.exceptions, "curve": self.curve, "_auto": None}

    def automaton(self):
        if self._auto is None:
            import ahocorasick
            a = ahocorasick.Automaton()
            for t, w in self.lexicon.items():
                a.add_word(t, (t, w))
            if len(a):
                a.make_automaton()
            shields: dict[str, list[tuple[list[str], int]]] = {}
            for phrase in self.exceptions:
                words = phrase.split()
                for k, w in enumerate(words):
                    shields.setdefault(w, []).append((words, k))
            self._auto = a, shields
        return self._auto

    def matches(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, entry, weight) of every counted match; offsets of ``text``, heaviest entry per word."""
        auto, shields = self.automaton()
        if not len(auto):
            return []
        folded = " " + fold(text) + " "
        hits: dict[int, tuple[str, float]] = {}
        for end, (term, weight) in auto.iter(folded):
            start = end - len(term) + 1
            if start not in hits or weight > hits[start][1]:
                hits[start] = term, weight
        if not folded.isascii():
            for end, (term, weight) in auto.iter(strip(folded)):
                if term.isascii():
                    hits.setdefault(end - len(term) + 1, (term, weight))
        shielded = _Shields(folded, shields) if shields and hits else lambda at: False
        return [(s, s + len(t.strip()), t, w) for s, (t, w) in sorted(hits.items()) if not shielded(s)]

    def features(self, text: str) -> tuple[float, float]:
        """Total weight by the square root of length in words, and whether anything matched (soft)."""
        total = sum(m[3] for m in self.matches(text)) if text else 0.0
        return total / math.sqrt(len(text.split()) + 10.0), min(total, 10.0) / 10.0

    def score(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(features @ np.array(self.curve[:2]) + self.curve[2])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            pos, neg = Counter(), Counter()
            piece = batch.slice(k, 500)
            for text, y in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                (pos if y else neg).update(terms(fold(text)))
            keys = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([pos[t] for t in keys], pa.int64()),
                 pa.array([neg[t] for t in keys], pa.int64())], names=["term", "pos", "neg"])


def _neighbours(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: Counter = Counter()
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded = " " + fold(text) + " "
                words = [(m.start(), m[0]) for m in re.finditer(r"\S+", folded)]
                at = {s - 1: i for i, (s, _) in enumerate(words)}
                seen = set()
                for s, _, _, _ in model.matches(text):
                    i = at.get(s)
                    if i is not None:
                        if i:
                            seen.add(f" {words[i - 1][1]} {words[i][1]} ")
                        if i + 1 < len(words):
                            seen.add(f" {words[i][1]} {words[i + 1][1]} ")
                rows.update((p, y) for p in seen)
            keys = list(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([rows[k] if k[1] else 0 for k in keys], pa.int64()),
                 pa.array([0 if k[1] else rows[k] for k in keys], pa.int64())], names=["term", "pos", "neg"])
    return run


def _counted(model: ToxicityModel):
    """Texts per term with a match outside exception phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos, neg = Counter(), Counter()
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (pos if y else neg).update({m[2] for m in model.matches(text)})
            keys = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([pos[t] for t in keys], pa.int64()),
                 pa.array([neg[t] for t in keys], pa.int64())], names=["term", "pos", "neg"])
    return run


def _features(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = [model.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in f], pa.float64()),
                                              pa.array([b for _, b in f], pa.float64()), batch.column(1)],
                                             names=["density", "found", "y"])
    return run


def fit(sample: DataFrame) -> ToxicityModel:
    """Learn a model from (text, y); ``sample`` is bounded (``MAX_TRAINING_DOCS``)."""
    sample = materialize(small_batches(sample), "toxicity-sample")
    n = sample.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    n_pos, n_neg = n[0], n[1]
    if not n_pos or not n_neg:
        return ToxicityModel({}, curve=(0.0, 0.0, math.log((n_pos + 1) / (n_neg + 1))))
    support = max(MIN_SUPPORT, MIN_SUPPORT_SHARE * n_pos)
    weight = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    spec = "term string, pos long, neg long"
    found = {r.term: r.weight for r in
             sample.mapInArrow(_counts, spec).groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .where(F.col("pos") >= support).withColumn("weight", weight).where(F.col("weight") >= FIRST_WEIGHT)
             .select("term", "weight").collect()}   # at most terms-per-text / MIN_SUPPORT_SHARE entries
    keep: dict[str, float] = {}
    for t in sorted(found, key=lambda t: (len(t.strip()), t)):
        shorter = [keep[t[:k]] for k in range(2, len(t)) if t[:k] in keep]
        if not shorter or found[t] > max(shorter) + 0.7:
            keep[t] = found[t]
    model = ToxicityModel(keep)
    pairs = (sample.mapInArrow(_neighbours(model), spec).groupBy("term")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .where((F.col("neg") >= EXCEPTION_SUPPORT)
                    & (F.col("neg") * n_pos >= EXCEPTION_SHARE * (F.col("neg") * n_pos + F.col("pos") * n_neg))))
    model = ToxicityModel(keep, frozenset(r.term for r in pairs.select("term").collect()))
    counted = (sample.mapInArrow(_counted(model), spec).groupBy("term")
               .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") >= support)
               .withColumn("weight", weight).where(F.col("weight") >= MIN_WEIGHT).select("term", "weight").collect())
    model = ToxicityModel({r.term: r.weight for r in counted}, model.exceptions)
    xy = sample.mapInArrow(_features(model), "density double, found double, y int").toPandas()
    w = fit_logistic(xy[["density", "found"]].to_numpy(), xy["y"].to_numpy())
    return ToxicityModel(model.lexicon, model.exceptions, tuple(float(v) for v in w))


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id") -> DataFrame:
    """(key, score, matches): one row per document; matches are (start, end, term, weight) spans."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string()),
                                   ("weight", pa.float64())]))
        for batch in batches:
            spans, feats = [], []
            for t in batch.column(1).to_pylist():
                found = m.matches(t) if t else []
                spans.append([dict(zip(("start", "end", "term", "weight"), f)) for f in found])
                total = sum(f[3] for f in found)
                feats.append((total / math.sqrt(len(t.split()) + 10.0) if found else 0.0, min(total, 10.0) / 10.0))
            p = m.score(np.array(feats, dtype=float).reshape(-1, 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array(spans, span)],
                                             names=[key, "score", "matches"])
    kind = dict(docs.dtypes)[key]
    return small_batches(docs).select(F.col(key), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"`{key}` {kind}, score double, "
             "matches array<struct<start: int, end: int, term: string, weight: double>>")


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_matches of every document (model fitted outside the held-out split)."""
    model = fit(training_sample(docs, labels, "toxic", 5, 0))
    s = score(docs, model)
    return s.select("doc_id", (split_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    F.size("matches").cast("long").alias("n_matches"))
