"""Isolation forest (Liu, Ting, Zhou 2008): grown in tasks on small samples, scored by looking up steps of its path.

With all features but one fixed, a path is a step function of the last one, the axis. The few combinations of the other features
(weekdays, flags, labels) have their steps written as a table, so a row is scored by one binary search and one lookup. Where the
combinations are too many, one SQL expression walks the trees; that of a full forest is too long for the JVM to compile.

Nothing is drawn: which rows a tree sees, and where it splits, follows from md5 of the row's key and of seed, tree and node. So
a forest is the same on every cluster, and any engine with md5 can grow it again. Path lengths are counted in millionths, whole
numbers whose sum does not depend on the order of the trees.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.prefix_scan import values_at_ranks
from tessera.sources.workspace import materialize

# Tasks get this module's code with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 256
EULER = 0.5772156649015329
MILLION = 1_000_000
# Bits of a hash that make a number in [0, 1); few enough for a double.
HASH_HEX, HASH_SPAN = 12, float(1 << 48)
#: Numbers that a table of steps may hold, 64 MB: it is broadcast.
STEPS = 1 << 23


def mean_path(n: int) -> float:
    """Mean length of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def chance(seed: int, tree: int, node: int, use: str) -> float:
    """A number in [0, 1) that belongs to a node."""
    return int(hashlib.md5(f"{seed}:{tree}:{node}:{use}".encode()).hexdigest()[:HASH_HEX], 16) / HASH_SPAN


def pool_hash(key: Column, seed: int) -> Column:
    """The order in which rows enter the pool of a forest."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def sample_of(tree: int, pool: int) -> list[int]:
    """Places in the pool that a tree sees: runs that follow each other, and overlap only where the pool is short."""
    return [(tree * SAMPLE + i) % pool for i in range(min(SAMPLE, pool))]


def grow_tree(x: np.ndarray, n_numeric: int, seed: int, tree: int) -> Iterator[tuple]:
    """Nodes ``(node, feature, value, path)``; the children of ``node`` are ``2 node`` (left) and ``2 node + 1``, the root is 1.

    A leaf has feature -1 and its path in millionths. A feature below ``n_numeric`` splits at ``value``, less to the left; a
    later one is categorical and ``value`` is the code that goes left.
    """
    limit = math.ceil(math.log2(max(len(x), 2)))
    waiting = [(np.arange(len(x)), 1, 0)]
    while waiting:
        rows, node, depth = waiting.pop()
        split = _split(x[rows], n_numeric, seed, tree, node) if depth < limit and len(rows) > 1 else None
        if split is None:
            yield node, -1, 0.0, depth * MILLION + round(mean_path(len(rows)) * MILLION)
            continue
        feature, value = split
        column = x[rows, feature]
        left = column < value if feature < n_numeric else column == value
        yield node, feature, value, 0
        waiting += [(rows[left], 2 * node, depth + 1), (rows[~left], 2 * node + 1, depth + 1)]


def _split(x: np.ndarray, n_numeric: int, seed: int, tree: int, node: int) -> tuple[int, float] | None:
    """One of the features that vary here, as the node's hash says; each category counts as a feature of its own."""
    low, high = x.min(axis=0), x.max(axis=0)
    choices: list[tuple[int, float]] = []
    for feature in np.flatnonzero(low < high):
        codes = np.unique(x[:, feature]) if feature >= n_numeric else [math.nan]
        choices += [(int(feature), float(code)) for code in codes]
    if not choices:
        return None
    feature, value = choices[int(chance(seed, tree, node, "feature") * len(choices))]
    if feature < n_numeric:
        # In (low, high], so that both sides get a row.
        value = float(high[feature] - chance(seed, tree, node, "value") * (high[feature] - low[feature]))
    return feature, value


def path_steps(trees: Sequence[dict], n_numeric: int, row: Sequence[float], axis: int, places: np.ndarray) -> np.ndarray:
    """The summed path of ``row`` in each step of its feature ``axis``: below the first place, from each place to the next, and from the last on.

    A tree maps its nodes to (feature, value, path).
    """
    edges = np.zeros(len(places) + 2, np.int64)
    where = {value: i + 1 for i, value in enumerate(places.tolist())}
    for tree in trees:
        waiting = [(1, 0, len(places) + 1)]
        while waiting:
            node, first, end = waiting.pop()
            feature, value, path = tree[node]
            if feature < 0:
                edges[first] += path
                edges[end] -= path
            elif feature == axis:
                cut = where[value]
                if first < cut:
                    waiting.append((2 * node, first, min(end, cut)))
                if end > cut:
                    waiting.append((2 * node + 1, max(first, cut), end))
            else:
                left = row[feature] < value if feature < n_numeric else row[feature] == value
                waiting.append((2 * node if left else 2 * node + 1, first, end))
    return np.cumsum(edges[:-1])


@dataclass(frozen=True)
class Forest:
    """The nodes of all trees: ``tree, node, feature, value, path``, a bounded table."""

    columns: tuple[str, ...]
    n_numeric: int
    trees: int
    sample: int
    nodes: pd.DataFrame

    def path(self) -> Column:
        """The sum of a row's path lengths over all trees, in millionths: nested conditions that the JVM compiles."""
        texts = []
        for _, tree in self.nodes.groupby("tree", sort=True):
            by_node = {row.node: row for row in tree.itertuples()}

            def text(node: int, by_node: dict = by_node) -> str:
                row = by_node[node]
                if row.feature < 0:
                    return f"{row.path}L"
                sign = "<" if row.feature < self.n_numeric else "="
                return f"if(`{self.columns[row.feature]}`{sign}{float(row.value)!r}D,{text(2 * node)},{text(2 * node + 1)})"

            texts.append(text(1))
        # Pairs of sums, so that the expression stays flat.
        sums = [F.expr(text) for text in texts]
        while len(sums) > 1:
            sums = [a + b for a, b in zip(sums[::2], sums[1::2], strict=False)] + (sums[-1:] if len(sums) % 2 else [])
        return sums[0]

    def axis(self) -> int | None:
        """The numeric feature with the most places to split at."""
        places = self.nodes[self.nodes["feature"].between(0, self.n_numeric - 1)].groupby("feature")["value"].nunique()
        return int(places.idxmax()) if len(places) else None

    def with_path(self, df: DataFrame, most: int = STEPS) -> DataFrame:
        """``df`` with ``path``, as ``path()`` has it. ``df`` is read twice: pass a written table."""
        axis = self.axis()
        if axis is None:
            return df.withColumn("path", self.path())
        places = np.unique(self.nodes.loc[self.nodes["feature"] == axis, "value"].to_numpy(float))
        others = [c for i, c in enumerate(self.columns) if i != axis]
        limit = most // (len(places) + 1)
        met = df.select(*others).distinct().limit(limit + 1).collect() if others else [()]
        if len(met) > limit:
            return df.withColumn("path", self.path())
        cells = [[float("nan") if v is None else float(v) for v in row] for row in met]
        trees = [{row[0]: row[1:] for row in tree[["node", "feature", "value", "path"]].itertuples(index=False)} for _, tree in self.nodes.groupby("tree")]
        n_numeric = self.n_numeric

        def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for cell in batch["id"]:
                    row = cells[cell][:axis] + [math.nan] + cells[cell][axis:]
                    yield pd.DataFrame({"cell": [cell], "steps": [path_steps(trees, n_numeric, row, axis, places).tolist()]})

        spark = df.sparkSession
        tasks = max(1, min(len(cells), spark.sparkContext.defaultParallelism))
        table = materialize(spark.range(0, len(cells), 1, tasks).mapInPandas(steps, "cell long, steps array<long>"), "forest_steps")
        # A null or NaN is less than nothing, so it goes right at every split, as the greatest numbers do: into the last step.
        step = Bucketizer(splits=[-math.inf, *places.tolist(), math.inf], inputCol=self.columns[axis], outputCol="_step", handleInvalid="keep")
        rows = step.transform(df)
        if others:
            named = ", ".join(["cell long", *[f"_other{i} double" for i in range(len(others))]])
            numbered = spark.createDataFrame([(i, *[None if v is None else float(v) for v in row]) for i, row in enumerate(met)], named)
            same = [F.col(c).eqNullSafe(F.col(f"_other{i}")) for i, c in enumerate(others)]
            rows = rows.join(F.broadcast(numbered.join(F.broadcast(table), "cell")), same, "left")
        else:
            rows = rows.crossJoin(F.broadcast(table))
        place = F.least(F.col("_step"), F.lit(float(len(places)))).cast("int")
        return rows.select(*df.columns, F.get("steps", place).alias("path"))

    def score(self, path: Column) -> Column:
        """The anomaly score of a path, in (0, 1]; higher is stranger."""
        return F.pow(F.lit(2.0), -(path / F.lit(float(self.trees * MILLION))) / F.lit(max(mean_path(self.sample), 1e-12)))


def _encoded(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> tuple[DataFrame, list[str]]:
    codes = [f"_code_{name}" for name in categorical]
    if categorical:
        indexer = StringIndexer(inputCols=list(categorical), outputCols=codes, stringOrderType="alphabetAsc")
        df = indexer.fit(df).transform(df)
    named = [f"_x_{name}" for name in numeric]
    return df.withColumns({f"_x_{name}": F.col(name).cast("double") for name in numeric}), [*named, *codes]


def fit_forest(
    df: DataFrame, key: str, n_numeric: int, columns: Sequence[str], trees: int, seed: int
) -> Forest:
    """Grow ``trees`` trees on 256 rows each, at most a few tens of thousands in all: those with the smallest keyed hashes."""
    hashed = df.select(pool_hash(F.col(key), seed).alias("_hash"), F.col(key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in columns])
    pool = hashed.orderBy("_hash", "_key").limit(trees * SAMPLE).toPandas()[list(columns)].to_numpy(dtype=float)

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree in batch["id"]:
                rows = pool[sample_of(int(tree), len(pool))]
                grown = pd.DataFrame(grow_tree(rows, n_numeric, seed, int(tree)), columns=["node", "feature", "value", "path"])
                grown.insert(0, "tree", int(tree))
                yield grown

    spark = df.sparkSession
    tasks = min(trees, spark.sparkContext.defaultParallelism)
    schema = "tree long, node long, feature long, value double, path long"
    nodes = spark.range(0, trees, 1, tasks).mapInPandas(grow, schema).toPandas() if len(pool) else pd.DataFrame(
        {"tree": range(trees), "node": 1, "feature": -1, "value": 0.0, "path": 0}
    )
    return Forest(tuple(columns), n_numeric, trees, min(SAMPLE, len(pool)), nodes)


def isolation_scores(
    df: DataFrame,
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    trees: int = 100,
    seed: int = 42,
) -> DataFrame:
    """``df`` with ``path`` (summed over the trees, in millionths) and ``score`` in (0, 1]; a short path is a high score.

    ``key`` is unique. A null feature goes right at every split.
    """
    encoded, columns = _encoded(df, numeric, categorical)
    forest = fit_forest(encoded, key, len(numeric), columns, trees, seed)
    return forest.with_path(encoded).select(*df.columns, "path").withColumn("score", forest.score(F.col("path")))


def path_cut(scored: DataFrame, contamination: float) -> int | None:
    """The path that a ``contamination`` share of rows stays below; exact."""
    rows = scored.count()
    if not rows:
        return None
    # The value at rank ceil((1 - share) n) from the longest path down.
    return values_at_ranks(scored, "path", [rows - math.ceil((1.0 - contamination) * rows) + 1])[0]
