"""Labelled rows for training: a bounded sample that leaves one fold out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import checkpointed, id_remainder


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, held_out: int, most: int) -> DataFrame:
    """``text`` and ``label`` (0 or 1) of at most ``most`` labelled documents outside the held-out fold, chosen by a hash of the id,
    equal texts once (with the label that most of them have, 0 or 1, rounded to even at half).

    Only label rows decide who is chosen, so the sample is bounded before it meets the documents and is small enough to
    send to all of them. Of several labels of one id the smallest counts; null ids and labels do not.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (id_remainder(F.col("doc_id"), folds) != held_out))
    chosen = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.join(F.broadcast(chosen), "doc_id")
    return checkpointed(found.groupBy("text").agg(F.round(F.avg("label")).cast("int").alias("label")))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights (the constant last) of a ridge logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + ridge * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w -= step * min(1.0, 5 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
