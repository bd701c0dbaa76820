"""Labelled documents for the two classifiers, and a small logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import with_text
from casegrid.operators.rows import quoted
from casegrid.operators.storage import fits_broadcast


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    usable: Column,
    sample: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, text, label) of the rows that ``usable`` (over ``id``) lets the learner see.

    A document with several label rows has the largest label; NULL labels, labels but 0 and 1 and NULL ids
    take no part. ``sample`` keeps so many ids, those with the smallest hash. Labels are broadcast only
    if they measure little; otherwise both sides are shuffled by id.
    """
    known = labels.select(
        F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(label)).cast("int").alias("label")
    ).filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    known = known.filter(usable).groupBy("id").agg(F.max("label").alias("label"))
    if sample is not None:
        known = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = with_text(docs, id_col, text_col)
    return rows.filter(usable).join(F.broadcast(known) if fits_broadcast(known) else known, "id")


def fit_logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1e-3, intercept: bool = True, steps: int = 60) -> np.ndarray:
    """Coefficients (intercept last, if any) of a ridge logistic regression, by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))]) if intercept else features
    weights = np.ones(len(x)) if weights is None else weights
    penalty = np.full(x.shape[1], ridge * weights.sum())
    if intercept:
        penalty[-1] = 1e-9
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ beta)
        gradient = x.T @ (weights * (p - labels)) + penalty * beta
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty + 1e-12)
        step = np.linalg.solve(curve, gradient)
        beta -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return beta


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
