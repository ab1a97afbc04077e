"""Global rank and running sums without putting all rows into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.workspace import materialize

ROWS_PER_TASK = 1_000_000
_SAMPLED_PER_BUCKET = 64


def hash_share(key: Column, share: float, seed: int = 0) -> Column:
    """Whether a key is among the ``share`` of keys with the lowest hashes."""
    span = 2.0**64
    return F.xxhash64(key, F.lit(seed)).cast("double") < F.lit(share * span - span / 2)


def prefix_scan(
    df: DataFrame,
    order_by: Sequence[Column],
    sums: Mapping[str, str] | None = None,
    rank: str = "rank",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the 1-based ``rank`` and a running sum per ``{new_name: column}``.

    ``order_by`` is a total ascending order (negate a number to sort it down). Rows are
    cut into key ranges of about ``rows_per_task``; each range is scanned by its own task
    and shifted by the totals of the ranges before it. ``df`` is read several times:
    pass a written table.
    """
    sums = dict(sums or {})
    key = F.struct(*[column.alias(f"k{i}") for i, column in enumerate(order_by)])
    rows = df.count()
    buckets = -(-rows // rows_per_task)
    keyed = df.withColumn("_key", key)
    if buckets > 1:
        # About 64 keys per range, chosen by hash; keys are unique, so no value dominates them.
        share = hash_share(F.col("_key"), min(1.0, buckets * _SAMPLED_PER_BUCKET / rows))
        sampled = keyed.filter(share).select("_key").orderBy("_key").collect()
        step = max(1, len(sampled) // buckets)
        types = [field.dataType for field in keyed.schema["_key"].dataType.fields]
        bounds = F.array(*[
            F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(row[0], types))])
            for row in sampled[step::step]
        ])
        keyed = keyed.withColumn("_bucket", F.size(F.filter(bounds, lambda bound: bound < F.col("_key"))))
        totals = keyed.groupBy("_bucket").agg(
            F.count("*").alias("_n"), *[F.sum(column).alias(f"_t_{name}") for name, column in sums.items()]
        )
        # One row per range, so this unpartitioned window and the broadcast below stay small.
        before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            "_bucket",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
            *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_b_{name}") for name in sums],
        )
        keyed = keyed.join(F.broadcast(offsets), "_bucket")
        within = Window.partitionBy("_bucket").orderBy("_key")
    else:
        nothing = {name: F.lit(0) for name in ["_n_before", *[f"_b_{name}" for name in sums]]}
        keyed = keyed.withColumns(nothing)
        within = Window.orderBy("_key")
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return keyed.select(
        *[F.col(c) for c in df.columns],
        (F.row_number().over(within) + F.col("_n_before")).cast("bigint").alias(rank),
        *[(F.sum(column).over(running) + F.col(f"_b_{name}")).alias(name) for name, column in sums.items()],
    )


def values_at_ranks(df: DataFrame, column: str, ranks: Sequence[int], rows_per_task: int = ROWS_PER_TASK) -> list[Any]:
    """The values of ``column`` at 1-based ranks among those not null, from counts per distinct value; None beyond the last."""
    counts = materialize(
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n")),
        "value_counts",
    )
    scanned = prefix_scan(counts, [F.col("v")], {"upto": "n"}, rows_per_task=rows_per_task)
    return list(scanned.agg(*[F.min(F.when(F.col("upto") >= rank, F.col("v"))) for rank in ranks]).first())


def exact_median(df: DataFrame, column: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row ``median``: the mean of the middle values, from counts per distinct value."""
    counts = materialize(
        df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n")),
        "value_counts",
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    scanned = prefix_scan(counts, [F.col("v")], {"upto": "n"}, rows_per_task=rows_per_task)
    low, high = (total + 1) // 2, total // 2 + 1
    return scanned.agg(
        F.min(F.when(F.col("upto") >= low, F.col("v"))).alias("low"),
        F.min(F.when(F.col("upto") >= high, F.col("v"))).alias("high"),
    ).select(((F.col("low").cast("double") + F.col("high").cast("double")) / 2).alias("median"))
