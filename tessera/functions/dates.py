"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The accepted text formats, tried in this order.
MESSY_FORMATS = ["yyyy-M-d", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "M/d/yyyy"]
# An ISO date that a time of day follows.
ISO_DATETIME = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)(Z|[+-]\d{2}:?\d{2})?$"


def parse_messy_date(text: Column) -> Column:
    """The first format that fits wins; text in no known format gives NULL."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    tries = [F.try_to_date(trimmed, fmt) for fmt in MESSY_FORMATS]
    stamp = F.nullif(F.regexp_extract(trimmed, ISO_DATETIME, 1), F.lit(""))
    return F.coalesce(*tries, stamp.try_cast("timestamp_ntz").cast("date"))


def year_month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_label(day: Column) -> Column:
    """``Apr 2026``."""
    return F.date_format(day, "MMM yyyy")


def month_start(year: int, month: int) -> Column:
    return F.make_date(F.lit(year), F.lit(month), F.lit(1))


def in_month(day: Column, year: int, month: int) -> Column:
    """A half-open date range, so that the filter reaches the parquet scan."""
    start = month_start(year, month)
    return (day >= start) & (day < F.add_months(start, 1))


def in_year(day: Column, year: int) -> Column:
    return (day >= month_start(year, 1)) & (day < month_start(year + 1, 1))


def build_date_dim(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day from ``start`` to ``end``, both included."""
    day = F.col("date_id")
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date_id")
    )
    return days.select(
        day,
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
    )
