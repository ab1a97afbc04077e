"""Finance refresh: two expense feeds -> one normalised table -> spend marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import parse_messy_date, year_month_label
from tessera.functions.money import to_aed
from tessera.operators.canonical import alias_index, canonicalize
from tessera.operators.prefix_scan import ROWS_PER_TASK, prefix_scan
from tessera.schemas import FIN_SILVER
from tessera.sources.workspace import materialize

OK = "ok"
BAD_DATE = "bad_date"
ORPHAN = "orphan_employee"


def padded_id(prefix: str, row_id: Column, width: int = 6) -> Column:
    """``CN-000042``; longer ids keep all their digits."""
    digits = row_id.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def union_feeds(claims: DataFrame, cards: DataFrame) -> DataFrame:
    """Both feeds in one shape. Neither is deduplicated."""
    from_claims = claims.select(
        padded_id("CN-", F.col("row_id")).alias("txn_id"), F.lit("concur").alias("source"),
        "employee_id", F.col("merchant").alias("raw"), "category",
        F.col("submitted_date").alias("date_text"), F.col("amount").alias("original_amount"),
        F.col("currency").alias("original_currency"),
    )
    from_cards = cards.select(
        padded_id("CC-", F.col("row_id")).alias("txn_id"), F.lit("card").alias("source"),
        "employee_id", F.col("vendor_str").alias("raw"), F.lit(None).cast("string").alias("category"),
        F.col("posted_date").alias("date_text"), F.col("amount_usd").alias("original_amount"),
        F.lit("USD").alias("original_currency"),
    )
    return from_claims.unionByName(from_cards)


def vendor_map(claims: DataFrame, cards: DataFrame, vendors: DataFrame) -> DataFrame:
    """``raw, vendor_id, vendor_category`` for every spelling that occurs in a feed."""
    spellings = claims.select(F.col("merchant").alias("raw")).unionByName(
        cards.select(F.col("vendor_str").alias("raw"))
    ).filter("raw IS NOT NULL")
    mapped = canonicalize(spellings, alias_index(vendors))
    categories = vendors.select("vendor_id", F.col("category").alias("vendor_category"))
    return mapped.filter("vendor_id IS NOT NULL").join(categories, "vendor_id").select(
        "raw", "vendor_id", "vendor_category"
    )


def stage_silver(
    claims: DataFrame, cards: DataFrame, mapping: DataFrame, employees: DataFrame
) -> DataFrame:
    """Every feed row, normalised, with ``status`` and whether its vendor was missed."""
    rows = union_feeds(claims, cards)
    joined = rows.join(mapping, "raw", "left").join(employees.select("employee_id", "dept_id"), "employee_id", "left")
    txn_date = parse_messy_date(F.col("date_text"))
    status = F.when(F.col("txn_date").isNull(), BAD_DATE).when(F.col("dept_id").isNull(), ORPHAN).otherwise(OK)
    return (
        joined.withColumn("txn_date", txn_date)
        .withColumn("category", F.when(F.col("source") == "card", F.col("vendor_category")).otherwise(F.col("category")))
        .withColumn("amount_aed", to_aed(F.col("original_amount"), F.col("original_currency")))
        .select(*FIN_SILVER.names, "raw", "date_text", status.alias("status"))
    )


def cluster_by_date(staged: DataFrame) -> DataFrame:
    """Rows of a month together and sorted, so that row groups can be skipped by date.

    The rebalance hint lets Spark cut a busy month into several files and join small ones.
    """
    monthly = staged.withColumn("_month", F.trunc("txn_date", "MM")).hint("rebalance", "_month")
    return monthly.sortWithinPartitions("status", "txn_date", "txn_id").drop("_month")


def silver_of(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("status") == OK).select(*FIN_SILVER.names)


def silver_counts(staged: DataFrame) -> DataFrame:
    """The refresh summary as one row. A missed vendor counts even if the row is then rejected."""
    dated = F.col("status") != BAD_DATE
    return staged.agg(
        F.count_if(F.col("status") == OK).alias("silver_inserted"),
        F.count_if(~dated).alias("bad_dates"),
        F.count_if(dated & F.col("vendor_id").isNull()).alias("vendor_misses"),
        F.count_if(F.col("status") == ORPHAN).alias("orphan_employee"),
        F.count_if(F.col("source") == "concur").alias("concur_total"),
        F.count_if(F.col("source") == "card").alias("card_total"),
    )


def spend_by_dept_month(silver: DataFrame, departments: DataFrame) -> DataFrame:
    """Spend per department and month; departments join after the rows are summed."""
    day = F.col("txn_date")
    months = silver.groupBy(
        "dept_id", F.year(day).alias("year"), F.month(day).alias("month"), year_month_label(day).alias("month_label")
    ).agg(F.sum("amount_aed").alias("total_aed"), F.count("*").alias("txn_count"))
    return months.join(departments, "dept_id").select(
        "dept_id", "dept_name", "year", "month", "month_label", "total_aed", "txn_count"
    )


def vendor_totals(silver: DataFrame, vendors: DataFrame) -> DataFrame:
    """Spend per vendor; rows without a vendor are left out."""
    totals = silver.filter("vendor_id IS NOT NULL").groupBy("vendor_id").agg(
        F.sum("amount_aed").alias("total_aed"), F.count("*").alias("txn_count")
    )
    return totals.join(vendors.select("vendor_id", "canonical_name", "category"), "vendor_id").select(
        "vendor_id", "canonical_name", "category", "total_aed", "txn_count"
    )


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two decimals; a zero whole counts as 1."""
    whole = whole.cast("double")
    return F.round(100 * part.cast("double") / F.when(whole == 0, 1.0).otherwise(whole), 2)


def top_vendors(totals: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Vendor totals with their Pareto rank and cumulative share."""
    totals = materialize(totals, "vendor_totals")
    ranked = prefix_scan(
        totals, [-F.col("total_aed"), F.col("vendor_id")], {"running": "total_aed"},
        rank="pareto_rank", rows_per_task=rows_per_task,
    )
    whole = totals.agg(F.sum("total_aed")).scalar()
    return ranked.select(
        "vendor_id", "canonical_name", "category", "total_aed", "txn_count", "pareto_rank",
        percent(F.col("running"), whole).alias("cumulative_pct"),
    )


def _names(
    employees: DataFrame | None, departments: DataFrame | None, vendors: DataFrame | None
) -> list[tuple[str, DataFrame]]:
    sides = []
    if employees is not None:
        sides.append(("employee_id", employees.select("employee_id", F.col("full_name").alias("employee"))))
    if departments is not None:
        sides.append(("dept_id", departments.select("dept_id", F.col("dept_name").alias("department"))))
    if vendors is not None:
        sides.append(("vendor_id", vendors.select("vendor_id", F.col("canonical_name").alias("vendor"))))
    return sides


def enrich(
    silver: DataFrame, employees: DataFrame | None = None, departments: DataFrame | None = None,
    vendors: DataFrame | None = None,
) -> DataFrame:
    """Rows with the names of their employee, department and vendor, of those given."""
    for key, side in _names(employees, departments, vendors):
        silver = silver.join(side, key, "left")
    return silver


def enrich_few(
    rows: DataFrame, employees: DataFrame | None = None, departments: DataFrame | None = None,
    vendors: DataFrame | None = None,
) -> DataFrame:
    """The same for the rows of a top-k.

    The rows are few because of their limit, so they and the names they need are broadcast,
    and a dimension of any size is filtered where it lies.
    """
    rows = materialize(rows, "few_rows")
    for key, side in _names(employees, departments, vendors):
        wanted = side.join(F.broadcast(rows.select(key).distinct()), key, "left_semi")
        rows = rows.join(F.broadcast(wanted), key, "left")
    return rows
