"""k-means from several starts at once: one pass per round moves the centres of all starts.

A start takes the rows with the smallest md5 of key and start as centres, so it is the same on every cluster. Only sums per
start and cluster reach the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Tasks get this module's code with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A start has ended when its centres, squared and summed, move no further than this.
MOVEMENT, ROUNDS = 1e-4, 300
# Starts whose cost differs less than this count as equally good; the first wins.
COST_DIGITS = 6

Centers = list[list[float]]


@dataclass(frozen=True)
class KMeans:
    """Centres in the order of their coordinates, and the sum of squared distances to the nearest."""

    columns: tuple[str, ...]
    centers: Centers
    cost: float

    def clustered(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of the nearest centre as ``cluster``; the lower number of two as near."""
        at = []
        for i, center in enumerate(self.centers):
            squared = " + ".join(f"power(`{c}` - {float(v)!r}D, 2)" for c, v in zip(self.columns, center, strict=True))
            at.append(f"named_struct('distance', {squared}, 'cluster', {i})")
        return rows.withColumn("cluster", F.expr(f"array_min(array({', '.join(at)})).cluster"))


def first_centers(rows: DataFrame, key: str, columns: Sequence[str], k: int, starts: int, seed: int) -> dict[int, Centers]:
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}:"), F.col("start").cast("string")))
    dealt = rows.select(key, *columns, F.explode(F.sequence(F.lit(0), F.lit(starts - 1))).alias("start"))
    place = F.row_number().over(Window.partitionBy("start").orderBy(order, key))
    picked = dealt.withColumn("place", place).filter(F.col("place") <= k).orderBy("start", "place").collect()
    return {start: [[r[c] for c in columns] for r in picked if r["start"] == start] for start in range(starts)}


def _moments(rows: DataFrame, columns: Sequence[str], centers: list[Centers]) -> np.ndarray:
    """Per start and cluster: its rows, the sum of each column over them, and that of their squared distances.

    A task adds up its rows by Arrow batches, for all starts, and passes on one number per cell; Spark adds these up.
    """
    at = np.array(centers)
    starts, k, size = at.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((starts, k, size + 2))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(size)])
            for start in range(starts):
                squared = ((x[:, None] - at[start][None]) ** 2).sum(axis=2)
                # The lower number of two centres as near.
                near = squared.argmin(axis=1)
                for i, weights in enumerate([np.ones(len(x)), *x.T, squared[np.arange(len(x)), near]]):
                    total[start, :, i] += np.bincount(near, weights, k)
        yield pa.RecordBatch.from_pydict({"cells": [total.ravel()]})

    partial = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(add, "cells array<double>")
    cells = partial.select(F.posexplode("cells").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    return np.array([r["value"] for r in sorted(cells.collect(), key=lambda r: r["at"])]).reshape(starts, k, size + 2)


def fit(rows: DataFrame, key: str, columns: Sequence[str], k: int, starts: int, seed: int) -> KMeans:
    """The best of all starts. ``rows`` is read once per round: pass a written or cached table that is not empty.

    A cluster that no row is nearest to keeps its centre. With fewer rows than ``k`` there are as many centres as rows.
    """
    centers = np.array([c for _, c in sorted(first_centers(rows, key, columns, k, starts, seed).items())])
    moving = np.arange(starts)
    for _ in range(ROUNDS):
        found = _moments(rows, columns, centers[moving].tolist())
        n = found[:, :, :1]
        moved = np.where(n > 0, found[:, :, 1:-1] / np.maximum(n, 1), centers[moving])
        far = ((moved - centers[moving]) ** 2).sum(axis=(1, 2))
        centers[moving] = moved
        moving = moving[far > MOVEMENT]
        if not len(moving):
            break
    costs = _moments(rows, columns, centers.tolist())[:, :, -1].sum(axis=1)
    best = min(range(starts), key=lambda start: (round(float(costs[start]), COST_DIGITS), start))
    return KMeans(tuple(columns), sorted(centers[best].tolist()), float(costs[best]))
