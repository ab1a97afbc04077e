"""Cube queries over the sales star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.money import money_mean, money_total

# dimension table -> (key shared with the fact, {dimension: its column})
DIMENSION_TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "gold_dim_customer": ("customer_id", {"country": "country", "city": "city", "tier": "tier"}),
    "gold_dim_product": ("product_id", {"category": "category", "brand": "brand"}),
    "gold_dim_store": ("store_id", {"store_format": "format"}),
    "gold_dim_date": ("date_id", {"quarter": "quarter", "month_name": "month_name", "year": "year"}),
}
FACT_DIMENSIONS = ("channel",)
DIMENSIONS = (*[dim for _, columns in DIMENSION_TABLES.values() for dim in columns], *FACT_DIMENSIONS)
RESULT_LIMIT = 200
# More ranges of days than this are scanned as one.
MOST_RANGES = 64


def _measures() -> dict[str, Column]:
    return {
        "amount": money_total(F.col("amount")),
        "quantity": F.sum("quantity").cast("bigint"),
        "txn_count": F.count("*"),
        "avg_basket": money_mean(F.col("amount")),
    }


MEASURES = ("amount", "quantity", "txn_count", "avg_basket")


def _checked(dims: Sequence[str], measure: str) -> None:
    for dim in dims:
        if dim not in DIMENSIONS:
            raise ValueError(f"unknown dimension: {dim}")
    if measure not in MEASURES:
        raise ValueError(f"unknown measure: {measure}")


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame], used: Sequence[str]) -> DataFrame:
    """The fact with the columns of the used dimensions; each dimension table joins once.

    Spark broadcasts a dimension that its size estimate allows and shuffles a larger one.
    """
    joined = fact
    for table, (key, columns) in DIMENSION_TABLES.items():
        wanted = [F.col(column).alias(dim) for dim, column in columns.items() if dim in used]
        if wanted:
            joined = joined.join(dims[table].select(key, *wanted), key)
    return joined


def date_runs(dims: Mapping[str, DataFrame], filters: Mapping[str, str | None] | None) -> list[tuple[Any, Any]] | None:
    """The runs of days that the filters on the calendar leave, first and last day each; None without such a filter.

    The calendar bounds what is scanned and collected.
    """
    columns = DIMENSION_TABLES["gold_dim_date"][1]
    wanted = {dim: value for dim, value in active_filters(filters).items() if dim in columns}
    if not wanted:
        return None
    days = dice(dims["gold_dim_date"].select("date_id", *[F.col(columns[dim]).alias(dim) for dim in wanted]), wanted).select("date_id").distinct()
    # Days of one run less their place among all days are the same day.
    placed = days.withColumn("run", F.date_sub("date_id", F.row_number().over(Window.orderBy("date_id"))))
    runs = placed.groupBy("run").agg(F.min("date_id").alias("first"), F.max("date_id").alias("last")).orderBy("first")
    return [(r["first"], r["last"]) for r in runs.collect()]


def within(fact: DataFrame, runs: Sequence[tuple[Any, Any]] | None) -> DataFrame:
    """The fact rows of some runs of days, as ranges that a scan of a fact sorted by date can skip files and row groups by."""
    if runs is None:
        return fact
    if len(runs) > MOST_RANGES:
        runs = [(runs[0][0], runs[-1][1])]
    inside = F.lit(False)
    for first, last in runs:
        inside = inside | F.col("date_id").between(F.lit(first), F.lit(last))
    return fact.filter(inside)


def diced_star(
    fact: DataFrame, dims: Mapping[str, DataFrame], used: Sequence[str], filters: Mapping[str, str | None] | None
) -> DataFrame:
    """The star join under filters; those on the calendar reach the scan of the fact."""
    pruned = within(fact, date_runs(dims, filters))
    return dice(star_join(pruned, dims, [*used, *active_filters(filters)]), filters)


def dice(joined: DataFrame, filters: Mapping[str, str | None] | None) -> DataFrame:
    """Keep the rows where every named dimension has its value; blank or unknown names are skipped."""
    for dim, value in active_filters(filters).items():
        kind = joined.schema[dim].dataType.simpleString()
        wanted = F.lit(str(value))
        joined = joined.filter(F.col(dim) == (wanted if kind == "string" else wanted.try_cast(kind)))
    return joined


def active_filters(filters: Mapping[str, str | None] | None) -> dict[str, str]:
    return {d: v for d, v in (filters or {}).items() if d in DIMENSIONS and v is not None and v != ""}


def cube_query(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    group_by: Sequence[str],
    measure: str = "amount",
    filters: Mapping[str, str | None] | None = None,
    limit: int | None = RESULT_LIMIT,
) -> DataFrame:
    """One measure, called ``value``, per combination of ``group_by``; highest first."""
    _checked(group_by, measure)
    grouped = diced_star(fact, dims, group_by, filters).groupBy(*group_by).agg(_measures()[measure].alias("value"))
    if limit is None:
        return grouped
    return grouped.orderBy(F.desc("value"), *group_by).limit(limit)


def rollup_query(
    fact: DataFrame, dims: Mapping[str, DataFrame], group_by: Sequence[str], measure: str = "amount"
) -> DataFrame:
    """Every roll-up level of ``group_by`` in one job; a rolled-up dimension is NULL."""
    _checked(group_by, measure)
    joined = star_join(fact, dims, group_by)
    return joined.rollup(*group_by).agg(
        F.grouping_id().cast("int").alias("level"), _measures()[measure].alias("value")
    )


def pivot_query(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    rows: str,
    columns: str,
    values: Sequence[str],
    measure: str = "amount",
) -> DataFrame:
    """A matrix: one row per ``rows`` member, one column per listed ``columns`` member, 0 where empty."""
    _checked([rows, columns], measure)
    joined = star_join(fact, dims, [rows, columns])
    return joined.groupBy(rows).pivot(columns, list(values)).agg(_measures()[measure]).fillna(0)


def available() -> dict[str, list[str]]:
    return {"dimensions": list(DIMENSIONS), "measures": list(MEASURES)}
