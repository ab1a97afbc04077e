"""Straight-line forecasts over daily and monthly totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The width of the band, and how many points a trend needs and uses.
BAND = 1.96
MIN_DAYS = 5
MIN_MONTHS = 3
RECENT_MONTHS = 6


def daily_revenue(fact: DataFrame) -> DataFrame:
    """Revenue and sales per day."""
    return fact.groupBy("date_id").agg(F.sum("amount").alias("revenue"), F.count("*").alias("txns"))


def _indexed(daily: DataFrame) -> DataFrame:
    """Days that have sales, numbered from 0. One row per calendar day, so one task holds them."""
    return daily.select(
        (F.row_number().over(Window.orderBy("date_id")) - 1).alias("t"),
        "date_id",
        F.col("revenue").cast("double").alias("revenue"),
    )


def _line(points: DataFrame) -> Column:
    """The least-squares line as a scalar struct."""
    y, t = F.col("revenue"), F.col("t").cast("double")
    return points.agg(F.struct(
        F.regr_slope(y, t).alias("slope"), F.regr_intercept(y, t).alias("intercept"),
        F.count("*").alias("n"), F.max("date_id").alias("last_day"),
    )).scalar()


def revenue_history(daily: DataFrame) -> DataFrame:
    """Each day's revenue beside the line; no rows for fewer than five days."""
    points = _indexed(daily)
    return points.withColumn("line", _line(points)).filter(F.col("line.n") >= MIN_DAYS).select(
        "date_id", "revenue", (F.col("line.intercept") + F.col("line.slope") * F.col("t")).alias("predicted"), "line"
    )


def revenue_fit(daily: DataFrame) -> DataFrame:
    """The fitted line and the population deviation around it; no row for fewer than five days."""
    residual = F.col("revenue") - F.col("predicted")
    return revenue_history(daily).groupBy("line").agg(
        F.sqrt(F.avg(residual * residual) - F.pow(F.avg(residual), F.lit(2))).alias("sigma")
    ).select("line.*", "sigma")


def revenue_forecast(daily: DataFrame, horizon: int = 30) -> DataFrame:
    """The days after the last one, with a band that widens with the root of the distance."""
    step = F.col("step")
    ahead = revenue_fit(daily).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    predicted = F.col("intercept") + F.col("slope") * (F.col("n") + step - 1)
    width = BAND * F.col("sigma") * F.sqrt(step.cast("double"))
    return ahead.select(
        F.date_add("last_day", step).alias("date_id"),
        predicted.alias("predicted"), (predicted - width).alias("lo"), (predicted + width).alias("hi"),
    )


def recent_months(mart: DataFrame, months: int = RECENT_MONTHS) -> DataFrame:
    """The newest ``months`` rows of each department; months without spend have no row."""
    rows = mart.select("dept_name", (F.col("year") * 12 + F.col("month")).alias("period"), "total_aed")
    newest = Window.partitionBy("dept_name").orderBy(F.desc("period"))
    return rows.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= months).drop("rn")


def next_month_forecast(mart: DataFrame) -> DataFrame:
    """Each department's next month on a line through its recent months.

    Months are counted from the newest one, so the fit keeps its digits. The change is
    taken from the line itself, the shown forecast is not negative.
    """
    newest = F.max("period").over(Window.partitionBy("dept_name"))
    x, y = F.col("x"), F.col("total_aed").cast("double")
    line = (
        recent_months(mart).withColumn("x", (F.col("period") - newest).cast("double")).groupBy("dept_name").agg(
            (F.regr_intercept(y, x) + F.regr_slope(y, x)).alias("forecast"),
            F.max_by(y, x).alias("last"),
            F.count("*").alias("n"),
            F.sort_array(F.collect_list(F.struct("period", F.col("total_aed").alias("amount_aed")))).alias("history"),
        ).filter(F.col("n") >= MIN_MONTHS)
    )
    delta = F.when(F.col("last") == 0, 0.0).otherwise((F.col("forecast") - F.col("last")) / F.col("last") * 100)
    return line.select(
        "dept_name",
        F.round("last", 2).alias("last_actual_aed"),
        F.round(F.greatest("forecast", F.lit(0.0)), 2).alias("forecast_next_aed"),
        F.round(delta, 1).alias("delta_pct"),
        "history",
    )
