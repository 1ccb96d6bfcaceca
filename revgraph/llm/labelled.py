"""Bounded labelled samples and score calibration for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revgraph.llm.common import stored


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` documents of each class, by hash of the id, and the number of labelled ids per class.

    ``learn`` says which ids may be learned from. A document labelled twice
    has the larger label; labels other than 0 and 1, null labels and null ids
    are left out; of rows with equal text and label one stays. The sample has
    columns doc_id, text, label and is bounded by ``per_class`` ids a class.
    """
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Few ids are sorted: those in a share of the hash range that is 8 standard deviations wider than needed.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / float(1 << 52)
    ids = known.limit(0)
    for c, n in totals.items():
        near = known.where((F.col("label") == c) & (place <= (per_class + 8 * per_class**0.5) / n))
        ids = ids.unionByName(near.orderBy(place, "doc_id").limit(per_class))
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    return stored(sample.where(F.col("text").isNotNull()).dropDuplicates(["text", "label"]), "labelled"), totals


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weighted logistic regression with an intercept (last), smoothed targets, by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    pos, neg = max(weight[y == 1].sum(), 1e-9), max(weight[y == 0].sum(), 1e-9)
    n = weight.sum()
    target = np.where(y == 1, 1 - 1 / (pos * len(y) / n + 2), 1 / (neg * len(y) / n + 2))
    w, penalty = np.zeros(a.shape[1]), np.full(a.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = sigmoid(a @ w)
        grad = a.T @ (weight * (p - target)) / n + penalty * w
        hess = (a * (weight * p * (1 - p) / n)[:, None]).T @ a + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def class_weights(y: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """Weights that give a sample balanced by class the shares that the classes have among all labelled rows."""
    share = {c: totals.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)}
    w = np.where(y == 1, share[1], share[0])
    return w / max(w.mean(), 1e-12) if len(w) else w
