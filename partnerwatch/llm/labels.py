"""Labelled documents for the classifiers: which rows may teach a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import numpy as np


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the doc_id as text, mod 4, is 2 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """doc_id, label of every labelled document that is not held out; of rows
    that repeat a doc_id the largest label counts, null ids and labels none."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("label"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Intercept and weights of a ridge logistic regression (Newton's method)."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.r_[1e-6, np.full(x.shape[1] - 1, ridge)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w
