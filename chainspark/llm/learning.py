"""Small helpers for models that are fitted on a bounded sample and applied everywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def may_learn(doc_id: str = "doc_id") -> Column:
    """Rows whose label may be used: crc32 of doc_id as text, modulo 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def sampled(ids: DataFrame, most: int) -> DataFrame:
    """At most `most` rows of a table with one row a doc_id, the same for the same table: smallest hashes of doc_id first."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def marked(labels: DataFrame, column: str, most: int) -> DataFrame:
    """(doc_id, y) of at most `most` documents whose label may be used: one row a doc_id, the more frequent label, 1 at a tie."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).where(may_learn())
    one = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(F.col(column).cast("double")) >= 0.5).cast("int").alias("y"))
    return sampled(one, most)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 25, rows: np.ndarray | None = None) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one is the bias.

    `y` and `weight` belong to x[rows] (all rows by default). Sums run over 4096 rows at a time, so no
    copy of `x` is made.
    """
    rows = np.arange(len(x)) if rows is None else rows
    w = np.zeros(x.shape[1] + 1)
    pull = np.full(len(w), ridge)
    pull[-1] = 1e-6
    for _ in range(steps):
        g, h = pull * w, np.diag(pull)
        for at in range(0, len(rows), 4096):
            part = x[rows[at : at + 4096]].astype(np.float64)
            part = np.hstack([part, np.ones((len(part), 1))])
            wt = weight[at : at + 4096]
            p = sigmoid(part @ w)
            g += part.T @ (wt * (p - y[at : at + 4096]))
            h += (part * (wt * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ part
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def platt(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) that turn a classifier's logits into calibrated ones."""
    w = logistic(logit[:, None], y.astype(float), np.ones(len(y)), ridge=1e-3)
    return float(max(w[0], 1e-3)), float(w[1])
