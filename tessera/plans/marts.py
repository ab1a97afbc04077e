"""Reports over finance silver and its marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import in_month, in_year, year_month_label
from tessera.functions.money import money_mean, money_total
from tessera.plans.finance import enrich, enrich_few, percent

# An anomaly is explained by these thresholds and texts.
MULTIPLE_OF_MEDIAN = 5
LARGE_AMOUNT = 10_000
REASON_MULTIPLE = "x the median txn"
REASON_WEEKEND = "posted on a weekend"
REASON_LARGE = "amount above 10,000 AED"
REASON_OTHER = "unusual combination of dept + category + amount"


def top_vendors(mart: DataFrame, limit: int = 20) -> DataFrame:
    return mart.orderBy("pareto_rank").limit(limit)


def _drill_columns(*names: str) -> list[str]:
    return ["txn_id", "source", *names, "category", "txn_date", "amount_aed", "original_currency", "original_amount"]


def _largest(rows: DataFrame, limit: int) -> DataFrame:
    return rows.orderBy(F.desc("amount_aed"), "txn_id").limit(limit)


def drill_dept(
    silver: DataFrame, employees: DataFrame, vendors: DataFrame, dept_id: str, year: int, month: int, limit: int = 50
) -> DataFrame:
    """The largest rows behind one department-month."""
    rows = silver.filter((F.col("dept_id") == dept_id) & in_month(F.col("txn_date"), year, month))
    named = enrich_few(_largest(rows, limit), employees=employees, vendors=vendors)
    return named.select(*_drill_columns("employee", "vendor"))


def drill_dept_total(silver: DataFrame, dept_id: str, year: int, month: int) -> DataFrame:
    rows = silver.filter((F.col("dept_id") == dept_id) & in_month(F.col("txn_date"), year, month))
    return rows.agg(F.coalesce(money_total(F.col("amount_aed")), F.lit(0.0)).alias("total_aed"))


def drill_vendor(
    silver: DataFrame, employees: DataFrame, departments: DataFrame, vendor_id: str, limit: int = 50
) -> DataFrame:
    """The largest rows of one vendor."""
    rows = _largest(silver.filter(F.col("vendor_id") == vendor_id), limit)
    named = enrich_few(rows, employees=employees, departments=departments)
    return named.select(*_drill_columns("employee", "department"))


def drill_vendor_total(mart: DataFrame, vendor_id: str) -> DataFrame:
    """The vendor's mart row; zeros if it has none."""
    return mart.filter(F.col("vendor_id") == vendor_id).agg(
        F.max("canonical_name").alias("canonical_name"),
        F.coalesce(F.max("total_aed").cast("double"), F.lit(0.0)).alias("total_aed"),
        F.coalesce(F.max("txn_count"), F.lit(0)).alias("txn_count"),
    )


def in_trailing_window(df: DataFrame, day: str, days: int) -> DataFrame:
    """Rows of the last day and the ``days`` before it."""
    last = df.agg(F.max(day)).scalar()
    return df.filter(F.col(day) >= F.date_sub(last, days))


def daily_trend(silver: DataFrame, window_days: int = 90) -> DataFrame:
    return in_trailing_window(silver, "txn_date", window_days).groupBy(F.col("txn_date").alias("day")).agg(
        money_total(F.col("amount_aed")).alias("total_aed"), F.count("*").alias("txn_count")
    ).orderBy("day")


def split_by(silver: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Spend and rows per currency, feed or another column of silver; highest spend first."""
    return silver.groupBy(F.col(column).alias(name or column)).agg(
        money_total(F.col("amount_aed")).alias("total_aed"), F.count("*").alias("txn_count")
    ).orderBy(F.desc("total_aed"), name or column)


def category_by_dept(silver: DataFrame, departments: DataFrame) -> DataFrame:
    """Spend per department and category; rows without a category are left out."""
    totals = silver.filter("category IS NOT NULL").groupBy("dept_id", "category").agg(
        money_total(F.col("amount_aed")).alias("total_aed")
    )
    return totals.join(departments, "dept_id").select("dept_name", "category", "total_aed").orderBy("dept_name", "category")


def distinct_members(rows: DataFrame) -> DataFrame:
    """The categories and departments that occur in a ``category_by_dept`` result."""
    return rows.select(F.lit("category").alias("kind"), F.col("category").alias("member")).unionByName(
        rows.select(F.lit("department").alias("kind"), F.col("dept_name").alias("member"))
    ).distinct()


def matrix(rows: DataFrame, row: str, column: str, members: Sequence[str], value: str = "total_aed") -> DataFrame:
    """Rows × listed members, 0 where nothing was spent."""
    return rows.groupBy(row).pivot(column, list(members)).agg(F.sum(F.col(value).cast("decimal(38,2)")).cast("double")).fillna(0.0)


def kpis(silver: DataFrame, vendor_mart: DataFrame) -> DataFrame:
    """The headline numbers as one row."""
    top5 = vendor_mart.filter("pareto_rank <= 5").agg(F.coalesce(F.max("cumulative_pct"), F.lit(0.0))).scalar()
    vendors = vendor_mart.agg(F.count("*")).scalar()
    return silver.agg(
        F.coalesce(money_total(F.col("amount_aed")), F.lit(0.0)).alias("total_aed"),
        F.count("*").alias("txn_count"),
        F.min("txn_date").alias("date_min"),
        F.max("txn_date").alias("date_max"),
    ).select("*", vendors.alias("vendor_count"), F.round(top5, 2).alias("top5_concentration_pct"))


def dow_pattern(silver: DataFrame) -> DataFrame:
    """Spend per weekday, Monday = 0."""
    day = F.col("txn_date")
    return silver.groupBy(F.weekday(day).alias("dow"), F.date_format(day, "E").alias("day")).agg(
        money_total(F.col("amount_aed")).alias("total_aed"),
        money_mean(F.col("amount_aed"), 2).alias("avg_aed"),
        F.count("*").alias("txn_count"),
    )


def weekend_share(silver: DataFrame) -> DataFrame:
    amount = F.col("amount_aed")
    weekend = F.coalesce(F.sum(F.when(F.weekday("txn_date") >= 5, amount)), F.lit(0))
    return silver.agg(percent(weekend, F.coalesce(F.sum(amount), F.lit(0))).alias("weekend_share_pct"))


def concentration(vendor_mart: DataFrame) -> DataFrame:
    """Gini coefficient and top-3/5/10 shares, from the ranked mart in one aggregate.

    A vendor at rank ``r`` of ``n`` by falling total is number ``n + 1 - r`` by rising
    total, so Gini needs no second sort.
    """
    total, rank = F.col("total_aed"), F.col("pareto_rank").cast("decimal(20,0)")
    n, spent = F.count("*"), F.sum(total)
    weighted = (n.cast("decimal(20,0)") + 1) * spent - 2 * F.sum(rank * total)
    gini = F.when(spent == 0, 0.0).otherwise(weighted.cast("double") / (n * spent.cast("double")))

    def share(k: int) -> Column:
        return F.max(F.when(F.col("pareto_rank") <= k, F.col("cumulative_pct"))).alias(f"top_{k}_pct")

    return vendor_mart.agg(
        n.alias("vendor_count"), spent.cast("double").alias("total_aed"),
        share(3), share(5), share(10), F.round(gini, 3).alias("gini"),
    )


def leaders(vendor_mart: DataFrame, limit: int = 5) -> DataFrame:
    """The first vendors and their share of the total."""
    whole = vendor_mart.agg(F.sum("total_aed")).scalar()
    return vendor_mart.orderBy("pareto_rank").limit(limit).select(
        F.col("canonical_name").alias("name"), percent(F.col("total_aed"), whole).alias("share_pct")
    )


def anomaly_reasons(amount: Column, day: Column, median: Column) -> Column:
    """Why a flagged row stands out, as an array of texts."""
    base = F.when(median == 0, 1.0).otherwise(median)
    multiple = F.round(amount.cast("double") / base, 1)
    found = F.array_compact(F.array(
        F.when(multiple >= MULTIPLE_OF_MEDIAN, F.concat(multiple.cast("decimal(30,1)").cast("string"), F.lit(REASON_MULTIPLE))),
        F.when(F.weekday(day) >= 5, REASON_WEEKEND),
        F.when(amount >= LARGE_AMOUNT, REASON_LARGE),
    ))
    return F.when(F.size(found) == 0, F.array(F.lit(REASON_OTHER))).otherwise(found)


def month_delta(mart: DataFrame, month_label: str, previous_label: str) -> DataFrame:
    """Growth of each department from one month to the next; a missing month counts 0."""
    now = mart.filter(F.col("month_label") == month_label).select("dept_name", F.col("total_aed").alias("now_aed"))
    before = mart.filter(F.col("month_label") == previous_label).select("dept_name", F.col("total_aed").alias("before_aed"))
    return now.join(before, "dept_name", "left").select(
        "dept_name", (F.col("now_aed") - F.coalesce("before_aed", F.lit(0))).cast("double").alias("delta_aed")
    )


def fastest_growing(mart: DataFrame, month_label: str, previous_label: str) -> DataFrame:
    return month_delta(mart, month_label, previous_label).orderBy(F.desc("delta_aed"), "dept_name").limit(1)


def previous_month_label(day: Column) -> Column:
    """``yyyy-MM`` of the month before a day's month."""
    return year_month_label(F.add_months(F.trunc(day, "MM"), -1))


def dept_last_month(mart: DataFrame, dept_name: str, today: str) -> DataFrame:
    label = previous_month_label(F.lit(today).cast("date"))
    return mart.filter((F.col("dept_name") == dept_name) & (F.col("month_label") == label)).select("total_aed")


def dept_category_spend(silver: DataFrame, departments: DataFrame, dept_name: str, category: str, year: int) -> DataFrame:
    rows = silver.filter((F.col("category") == category) & in_year(F.col("txn_date"), year))
    named = rows.join(departments.filter(F.col("dept_name") == dept_name), "dept_id", "left_semi")
    return named.agg(money_total(F.col("amount_aed")).alias("spend_aed"))


def large_expenses(
    silver: DataFrame, employees: DataFrame, vendors: DataFrame, category: str, threshold: float
) -> DataFrame:
    """Rows of a category above a threshold, with names."""
    rows = silver.filter((F.col("category") == category) & (F.col("amount_aed") > threshold))
    return enrich(rows, employees=employees, vendors=vendors).select(
        "txn_date", F.col("employee").alias("full_name"), F.col("vendor").alias("canonical_name"), "amount_aed"
    ).orderBy(F.desc("amount_aed"), "txn_date", "full_name", "canonical_name")


def vendor_by_month(silver: DataFrame, vendors: DataFrame, canonical_name: str) -> DataFrame:
    wanted = vendors.filter(F.col("canonical_name") == canonical_name)
    return silver.join(wanted, "vendor_id", "left_semi").groupBy(
        year_month_label(F.col("txn_date")).alias("month_label")
    ).agg(money_total(F.col("amount_aed")).alias("spend_aed")).orderBy("month_label")


def vendor_by_source(silver: DataFrame, vendor_id: str) -> DataFrame:
    """Rows per feed of one vendor."""
    return silver.filter(F.col("vendor_id") == vendor_id).groupBy("source").agg(F.count("*").alias("n"))
