"""Logistic regression by Newton steps: each step is one aggregate that returns the gradient and the second derivatives."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Steps end when no weight changes by more than this.
SMALLEST_STEP, STEPS = 1e-9, 50


@dataclass(frozen=True)
class Logistic:
    columns: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def scored(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the probability of label 1."""
        return _scored(rows, self.columns, [*self.weights, self.intercept], name)


def _scored(rows: DataFrame, columns: Sequence[str], weights: Sequence[float], name: str) -> DataFrame:
    # The weights are a value of the query, not constants of its code, which each step would compile anew.
    value = rows.sparkSession.createDataFrame([([float(w) for w in weights],)], "weights array<double>").scalar()
    held = F.col("_weights")
    total = held[len(columns)]
    for i, column in enumerate(columns):
        total = total + held[i] * F.col(column)
    return rows.withColumn("_weights", value).withColumn(name, F.lit(1.0) / (F.lit(1.0) + F.exp(-total))).drop("_weights")


def fit(rows: DataFrame, columns: Sequence[str], label: str, strength: float = 1.0) -> Logistic:
    """The weights with the least summed loss plus half ``strength`` times their squares; the intercept is free.

    ``rows`` is read once per step, about ten times: pass a written or cached table. Both labels occur.
    """
    size = len(columns) + 1
    inputs = [F.col(c) for c in columns] + [F.lit(1.0)]
    weights = np.zeros(size)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    for _ in range(STEPS):
        found = _scored(rows, columns, weights, "_p").agg(
            *[F.sum((F.col("_p") - F.col(label)) * x).alias(f"g{i}") for i, x in enumerate(inputs)],
            *[F.sum(F.col("_p") * (1 - F.col("_p")) * inputs[i] * inputs[j]).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        ridge = np.array([strength] * (size - 1) + [0.0])
        gradient = np.array([found[f"g{i}"] for i in range(size)]) + ridge * weights
        curvature = np.diag(ridge)
        for i, j in pairs:
            curvature[i, j] += found[f"h{i}_{j}"]
            curvature[j, i] = curvature[i, j]
        step = np.linalg.solve(curvature, gradient)
        weights = weights - step
        if np.abs(step).max() < SMALLEST_STEP:
            break
    return Logistic(tuple(columns), tuple(weights[:-1].tolist()), float(weights[-1]))
