"""Labelled rows for the two classifiers: the training split and its bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents that a model is fitted on, at most (about; chosen by a hash of the id).
MAX_TRAINING_DOCS = 20_000


def split_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
                    bound: int = MAX_TRAINING_DOCS) -> DataFrame:
    """(text, y) of labelled rows outside the held-out split, about ``bound`` at most.

    Null labels, ids and texts are left out; of several labels of one id the
    largest counts.  Equal texts count once, so copies do not outvote the rest.
    """
    marks = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .where(split_remainder(F.col("doc_id"), modulus) != held_out)
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    n = marks.count()
    if n > bound:
        threshold = int((2 * bound / n - 1) * (1 << 63))   # the hash is uniform over the signed 64-bit range
        marks = marks.where(F.xxhash64(F.col("doc_id"), F.lit("sample")) < F.lit(threshold))
    return (docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
            .join(marks, "doc_id")
            .groupBy(F.sha2("text", 256).alias("h")).agg(F.min_by("text", "doc_id").alias("text"), F.max("y").alias("y"))
            .select("text", "y"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; coefficients, then the intercept (not penalised).

    Targets are shrunk as in Platt's method, so separable classes keep finite
    coefficients; with one class only the intercept moves.
    """
    n1, n0 = float((y > 0).sum()), float((y <= 0).sum())
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    w[-1] = np.log((n1 + 1) / (n0 + 1))
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = sigmoid(a @ w)
        g = a.T @ (p - t) + penalty * w
        h = (a * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
