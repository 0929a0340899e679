"""Quality classifier: a support vector machine on naive-Bayes features.

A text becomes the set of its unigrams and bigrams (words and runs of signs,
lower case), hashed to ``2**BITS`` indicators, with back references for repeated
words ("the same token again", in runs of growing length) that hold for words
never seen before.  Indicators are scaled by the log-count ratio between the
classes and a linear hinge-loss model is fitted by dual coordinate descent: the
sample is dealt into shards by hash, each shard is one task, and the models are
averaged.  Margins become probabilities by a logistic curve.

A null or empty text has no indicator; its margin is the bias.  Every row gets a score,
repeated ones and those without an id too; these are never held out nor learned from.
An empty table gives no rows; columns of any name pass through ``keep_good``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import materialize, own_prefix, small_batches
from beatline.llm.training import fit_logistic, sigmoid, split_remainder, training_sample

BITS = 18
SHARDS = 8
COST = 1.0
EPOCHS = 12
THRESHOLD = 0.7
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE_WORDS = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Codes(dict):
    """Word to 32-bit code; forgets everything when it grows past its bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        code = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return code


_CODES = _Codes()


def indicators(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    words = _TOKEN.findall((text or "").lower())
    if not words:
        return np.zeros(0, dtype=np.int64)
    u = np.fromiter(map(_CODES.__getitem__, words), dtype=np.uint64, count=len(words))
    grams = [u * _MIX]
    if len(u) > 1:
        grams.append((u[:-1] * np.uint64(31) + u[1:] + np.uint64(1)) * _MIX)
        same = np.concatenate([[0], (u[1:] == u[:-1]).astype(np.int64), [0]])
        edges = np.flatnonzero(np.diff(same))
        run = int((edges[1::2] - edges[::2]).max()) if len(edges) else 0
        grams.append(np.arange(1, 1 + min(8, run.bit_length()), dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return np.unique(np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class QualityModel:
    """Weight of every indicator (ratio times hinge weight), bias, curve (slope, intercept)."""
    weights: np.ndarray
    bias: float
    curve: tuple[float, float]

    def margin(self, text: str | None) -> float:
        idx = indicators(text)
        return float(self.weights[idx].sum() / math.sqrt(len(idx)) if len(idx) else 0.0) + self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(margins * self.curve[0] + self.curve[1])


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST,
            epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for min |w|^2/2 + cost * sum of hinge losses; y is +1 or -1.

    Row ``i`` is ``ratio[rows[i]]`` over the root of its size, plus a constant 1 for the bias.
    """
    w, b = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    x = [ratio[r] / math.sqrt(max(1, len(r))) for r in rows]
    square = np.array([float(v @ v) + 1.0 for v in x])
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * (w[rows[i]] @ x[i] + b) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), cost)
            d = (new - alpha[i]) * y[i]
            if d:
                w[rows[i]] += d * x[i]
                b += d
                alpha[i] = new
                moved = max(moved, abs(d))
        if moved < 1e-4:
            break
    return w, b


def _indicator_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % SHARDS for t in texts], pa.int32()),
             pa.array([indicators(t) for t in texts], pa.list_(pa.int64())), batch.column(1)],
            names=["shard", "idx", "y"])


def fit(sample: DataFrame) -> QualityModel:
    """Learn a model from (text, y); ``sample`` is bounded (``MAX_TRAINING_DOCS``)."""
    spark = sample.sparkSession
    rows = materialize(small_batches(sample).mapInArrow(_indicator_rows, "shard int, idx array<long>, y int"), "quality-sample")
    n = rows.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    if not n[0] or not n[1]:
        return QualityModel(np.zeros(1 << BITS), 0.0, (0.0, math.log((n[0] + 1) / (n[1] + 1))))
    counts = (rows.select("y", F.explode("idx").alias("i")).groupBy("i")
              .agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("q")).toPandas())  # 2**BITS rows at most
    p, q = np.ones(1 << BITS), np.ones(1 << BITS)
    p[counts["i"]] += counts["p"]
    q[counts["i"]] += counts["q"]
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    held = spark.sparkContext.broadcast(ratio)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        y = np.where(pdf["y"].to_numpy() > 0, 1.0, -1.0)
        w, b = descend([np.asarray(r, dtype=np.int64) for r in pdf["idx"]], y, held.value)
        i = np.flatnonzero(w)
        return pd.DataFrame({"i": np.append(i, -1), "w": np.append(w[i], b)})

    models = rows.groupBy("shard").applyInPandas(one, "i long, w double")
    n_shards = rows.select("shard").distinct().count()
    mean = models.groupBy("i").agg(F.sum("w").alias("w")).toPandas()
    weights, bias = np.zeros(1 << BITS), 0.0
    inside = mean["i"].to_numpy() >= 0
    weights[mean["i"].to_numpy()[inside]] = mean["w"].to_numpy()[inside] / n_shards
    bias = float(mean["w"].to_numpy()[~inside].sum() / n_shards)
    weights *= ratio
    model = QualityModel(weights, bias, (1.0, 0.0))
    both = spark.sparkContext.broadcast(model)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = both.value
        for batch in batches:
            idx = [np.asarray(r, dtype=np.int64) for r in batch.column(0).to_pylist()]
            out = [m.weights[r].sum() / math.sqrt(len(r)) + m.bias if len(r) else m.bias for r in idx]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64()), batch.column(1)], names=["m", "y"])

    my = rows.select("idx", "y").mapInArrow(margins, "m double, y int").toPandas()
    slope, intercept = fit_logistic(my[["m"]].to_numpy(), my["y"].to_numpy())
    return QualityModel(weights, bias, (float(slope), float(intercept)))


def score(docs: DataFrame, model: QualityModel, name: str = "quality_score") -> DataFrame:
    """``docs`` with a column ``name`` (0 to 1); all other columns stay."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = held.value
        for t in texts:
            yield pd.Series(m.score(np.array([m.margin(x) for x in t], dtype=float)))
    return small_batches(docs).withColumn(name, of(F.col("text").cast("string")))


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (model fitted outside the held-out split)."""
    model = fit(training_sample(docs, labels, "quality", 4, 2))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (split_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject, columns unchanged."""
    model = fit(training_sample(docs, labels, "quality", 4, 2))
    name = f"{own_prefix(docs)}quality"
    return score(docs, model, name).where(F.col(name) >= THRESHOLD).drop(name)
