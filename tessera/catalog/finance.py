"""Finance refresh, marts, drill-downs, forecasts and concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.catalog.ingest import enriched
from tessera.catalog.olap import DEPARTMENTS
from tessera.catalog.registry import query
from tessera.functions.dates import in_month, month_label, parse_messy_date, year_month_label
from tessera.functions.money import money_text, to_aed
from tessera.operators.canonical import alias_index, canonicalize, needle
from tessera.operators.prefix_scan import exact_median
from tessera.plans import finance, forecast, marts
from tessera.plans.warehouse import Warehouse

CATEGORIES = ["Marketing", "Meals", "Office", "Software", "Travel", "Utilities"]
DEPT, VENDOR, VENDOR_NAME, DEPT_NAME = "D-MACHINERY", "V000000000003", "Supplier#000000003", "MACHINERY"
YEAR, MONTH, TODAY = 2001, 7, "2001-08-01"
_SILVER = """SELECT txn_id, source, employee_id, dept_id, vendor_id, category, CAST(txn_date AS VARCHAR) AS txn_date,
CAST(amount_aed AS DOUBLE) AS amount_aed, original_currency, CAST(original_amount AS DOUBLE) AS original_amount"""
_TOTALS = "CAST(sum(amount_aed) AS DOUBLE) AS total_aed, count(*) AS txn_count"


def _silver(w: Warehouse) -> DataFrame:
    return w.table("fin_slv_transactions")


def _mart(w: Warehouse) -> DataFrame:
    return w.table("fin_gld_spend_by_dept_month")


def _vendors(w: Warehouse) -> DataFrame:
    return w.table("fin_gld_top_vendors")


def _stage(w: Warehouse) -> DataFrame:
    return finance.stage_silver(
        w.table("fin_src_concur_expenses"), w.table("fin_src_corporate_card"),
        w.table("fin_vendor_map"), w.table("fin_dim_employee"),
    )


def money_text_sql(value: str) -> str:
    """The twin of ``money_text`` for a DOUBLE."""
    return (
        f"CASE WHEN {value} >= 1000000 THEN format('{{:.2f}}M AED', {value} / 1000000)"
        f" WHEN {value} >= 1000 THEN format('{{:.1f}}K AED', {value} / 1000) ELSE format('{{:,.0f}} AED', {value}) END"
    )


@query("g1_union_feeds", f"{_SILVER} FROM fin_slv_transactions")
def _(w: Warehouse) -> DataFrame:
    return finance.silver_of(_stage(w))


@query("g2_finance_summary", "SELECT * FROM finance_summary")
def _(w: Warehouse) -> DataFrame:
    return finance.silver_counts(_stage(w))


@query("c4_enrich_silver", """
SELECT txn_id, source, employee, department, vendor, category, CAST(txn_date AS VARCHAR) AS txn_date,
       CAST(amount_aed AS DOUBLE) AS amount_aed FROM fin_enriched""")
def _(w: Warehouse) -> DataFrame:
    return enriched(w).select("txn_id", "source", "employee", "department", "vendor", "category", "txn_date", "amount_aed")


@query("c5_orphan_employees", """
SELECT txn_id, source, employee_id FROM fin_staged WHERE status = 'orphan_employee'""")
def _(w: Warehouse) -> DataFrame:
    return _stage(w).filter(F.col("status") == finance.ORPHAN).select("txn_id", "source", "employee_id")


@query("c6_vendor_canonicalisation", """
SELECT s.raw, m.vendor_id FROM spellings s LEFT JOIN vendor_map m ON m.raw = s.raw""")
def _(w: Warehouse) -> DataFrame:
    raw = w.table("fin_src_concur_expenses").select(F.col("merchant").alias("raw")).unionByName(
        w.table("fin_src_corporate_card").select(F.col("vendor_str").alias("raw"))
    ).filter("raw IS NOT NULL")
    return canonicalize(raw, alias_index(w.table("fin_dim_vendor")))


@query("c6_alias_index", "SELECT alias, vendor_id FROM alias_index")
def _(w: Warehouse) -> DataFrame:
    return alias_index(w.table("fin_dim_vendor")).select("alias", "vendor_id")


@query("c7_category_fallback", """
SELECT txn_id, vendor_id, category FROM fin_slv_transactions WHERE source = 'card'""")
def _(w: Warehouse) -> DataFrame:
    return finance.silver_of(_stage(w)).filter("source = 'card'").select("txn_id", "vendor_id", "category")


@query("c8_month_over_month", """
SELECT t.dept_name, CAST(t.total_aed - coalesce(p.total_aed, 0) AS DOUBLE) AS delta_aed
FROM (SELECT * FROM fin_gld_spend_by_dept_month WHERE month_label = '2001-07') t
LEFT JOIN (SELECT * FROM fin_gld_spend_by_dept_month WHERE month_label = '2001-06') p ON p.dept_name = t.dept_name""")
def _(w: Warehouse) -> DataFrame:
    return marts.month_delta(_mart(w), "2001-07", "2001-06")


@query("c10_mart_joins", """
SELECT d.dept_name, v.category AS vendor_category, CAST(sum(amount_aed) AS DOUBLE) AS total_aed
FROM fin_slv_transactions t JOIN fin_dim_department d ON d.dept_id = t.dept_id
JOIN fin_dim_vendor v ON v.vendor_id = t.vendor_id GROUP BY ALL""")
def _(w: Warehouse) -> DataFrame:
    summed = _silver(w).groupBy("dept_id", "vendor_id").agg(F.sum("amount_aed").alias("s"))
    vendors = w.table("fin_dim_vendor").select("vendor_id", F.col("category").alias("vendor_category"))
    return summed.join(w.table("fin_dim_department"), "dept_id").join(vendors, "vendor_id").groupBy(
        "dept_name", "vendor_category"
    ).agg(F.sum("s").alias("total_aed"))


_IN_MONTH = f"dept_id = '{DEPT}' AND year(txn_date) = {YEAR} AND month(txn_date) = {MONTH}"
_DRILL_SHOWN = """category, CAST(txn_date AS VARCHAR) AS txn_date, CAST(amount_aed AS DOUBLE) AS amount_aed, original_currency,
CAST(original_amount AS DOUBLE) AS original_amount"""
_LARGEST = "ORDER BY fin_enriched.amount_aed DESC, txn_id LIMIT 50"


@query("b8_year_month_predicate", f"SELECT txn_id FROM fin_slv_transactions WHERE {_IN_MONTH}")
def _(w: Warehouse) -> DataFrame:
    return _silver(w).filter((F.col("dept_id") == DEPT) & in_month(F.col("txn_date"), YEAR, MONTH)).select("txn_id")


@query("b9_trailing_window", """
SELECT txn_id FROM fin_slv_transactions WHERE txn_date >= (SELECT max(txn_date) FROM fin_slv_transactions) - INTERVAL 30 DAY""")
def _(w: Warehouse) -> DataFrame:
    return marts.in_trailing_window(_silver(w), "txn_date", 30).select("txn_id")


@query("d12_spend_by_dept_month", "SELECT * REPLACE (CAST(total_aed AS DOUBLE) AS total_aed) FROM fin_gld_spend_by_dept_month")
def _(w: Warehouse) -> DataFrame:
    return finance.spend_by_dept_month(_silver(w), w.table("fin_dim_department")).orderBy("year", "month", "dept_name")


@query("d13_vendor_totals", "SELECT * REPLACE (CAST(total_aed AS DOUBLE) AS total_aed) FROM vendor_totals")
def _(w: Warehouse) -> DataFrame:
    return finance.vendor_totals(_silver(w), w.table("fin_dim_vendor"))


@query("d14_top_vendors", """
SELECT * REPLACE (CAST(total_aed AS DOUBLE) AS total_aed) FROM fin_gld_top_vendors ORDER BY pareto_rank LIMIT 20""")
def _(w: Warehouse) -> DataFrame:
    return marts.top_vendors(_vendors(w))


@query("d15_drill_dept", f"SELECT txn_id, source, employee, vendor, {_DRILL_SHOWN} FROM fin_enriched WHERE {_IN_MONTH} {_LARGEST}")
def _(w: Warehouse) -> DataFrame:
    return marts.drill_dept(_silver(w), w.table("fin_dim_employee"), w.table("fin_dim_vendor"), DEPT, YEAR, MONTH)


@query("d15_drill_dept_total", f"""
SELECT coalesce(CAST(sum(amount_aed) AS DOUBLE), 0) AS total_aed FROM fin_slv_transactions WHERE {_IN_MONTH}""")
def _(w: Warehouse) -> DataFrame:
    return marts.drill_dept_total(_silver(w), DEPT, YEAR, MONTH)


@query("d16_drill_vendor", f"""
SELECT txn_id, source, employee, department, {_DRILL_SHOWN} FROM fin_enriched WHERE vendor_id = '{VENDOR}' {_LARGEST}""")
def _(w: Warehouse) -> DataFrame:
    return marts.drill_vendor(_silver(w), w.table("fin_dim_employee"), w.table("fin_dim_department"), VENDOR)


@query("d16_drill_vendor_total", f"""
SELECT max(canonical_name) AS canonical_name, coalesce(CAST(max(total_aed) AS DOUBLE), 0) AS total_aed,
       coalesce(max(txn_count), 0) AS txn_count FROM fin_gld_top_vendors WHERE vendor_id = '{VENDOR}'""")
def _(w: Warehouse) -> DataFrame:
    return marts.drill_vendor_total(_vendors(w), VENDOR)


@query("d17_daily_trend", f"""
SELECT CAST(txn_date AS VARCHAR) AS day, {_TOTALS} FROM fin_slv_transactions t
WHERE t.txn_date >= (SELECT max(txn_date) FROM fin_slv_transactions) - INTERVAL 90 DAY GROUP BY txn_date""")
def _(w: Warehouse) -> DataFrame:
    return marts.daily_trend(_silver(w))


@query("d18_currency_split", f"SELECT original_currency AS currency, {_TOTALS} FROM fin_slv_transactions GROUP BY 1")
def _(w: Warehouse) -> DataFrame:
    return marts.split_by(_silver(w), "original_currency", "currency")


@query("d19_source_split", f"SELECT source, {_TOTALS} FROM fin_slv_transactions GROUP BY source")
def _(w: Warehouse) -> DataFrame:
    return marts.split_by(_silver(w), "source")


_BY_CATEGORY = """SELECT d.dept_name, t.category, CAST(sum(amount_aed) AS DOUBLE) AS total_aed
FROM fin_slv_transactions t JOIN fin_dim_department d ON d.dept_id = t.dept_id WHERE t.category IS NOT NULL GROUP BY ALL"""


@query("d20_category_by_dept", _BY_CATEGORY)
def _(w: Warehouse) -> DataFrame:
    return marts.category_by_dept(_silver(w), w.table("fin_dim_department"))


@query("d20_members", f"""
SELECT DISTINCT 'category' AS kind, category AS member FROM ({_BY_CATEGORY})
UNION ALL SELECT DISTINCT 'department', dept_name FROM ({_BY_CATEGORY})""")
def _(w: Warehouse) -> DataFrame:
    return marts.distinct_members(marts.category_by_dept(_silver(w), w.table("fin_dim_department")))


def _matrix_sql(row: str, source: str) -> str:
    cells = ", ".join(
        f"CAST(coalesce(sum(CAST(total_aed AS DECIMAL(38,2))) FILTER (dept_name = '{name}'), 0) AS DOUBLE) AS {name}" for name in DEPARTMENTS
    )
    return f"SELECT {row}, {cells} FROM {source} GROUP BY {row}"


@query("d21_category_dept_matrix", _matrix_sql("category", f"({_BY_CATEGORY})"))
def _(w: Warehouse) -> DataFrame:
    rows = marts.category_by_dept(_silver(w), w.table("fin_dim_department"))
    return marts.matrix(rows, "category", "dept_name", DEPARTMENTS)


@query("d22_month_dept_matrix", _matrix_sql("month_label", "fin_gld_spend_by_dept_month"))
def _(w: Warehouse) -> DataFrame:
    return marts.matrix(_mart(w), "month_label", "dept_name", DEPARTMENTS)


@query("d23_kpis", """
SELECT CAST(sum(amount_aed) AS DOUBLE) AS total_aed, count(*) AS txn_count, CAST(min(txn_date) AS VARCHAR) AS date_min,
       CAST(max(txn_date) AS VARCHAR) AS date_max, (SELECT count(*) FROM fin_gld_top_vendors) AS vendor_count,
       (SELECT max(cumulative_pct) FROM fin_gld_top_vendors WHERE pareto_rank <= 5) AS top5_concentration_pct
FROM fin_slv_transactions""")
def _(w: Warehouse) -> DataFrame:
    return marts.kpis(_silver(w), _vendors(w))


@query("d24_dow_pattern", """
SELECT CAST(isodow(txn_date) - 1 AS INTEGER) AS dow, substr(dayname(txn_date), 1, 3) AS day,
       CAST(sum(amount_aed) AS DOUBLE) AS total_aed,
       CAST((2 * CAST(sum(amount_aed) * 100 AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_aed,
       count(*) AS txn_count
FROM fin_slv_transactions GROUP BY 1, 2""")
def _(w: Warehouse) -> DataFrame:
    return marts.dow_pattern(_silver(w))


@query("d25_weekend_share", """
SELECT round(100 * CAST(sum(amount_aed) FILTER (isodow(txn_date) >= 6) AS DOUBLE) / CAST(sum(amount_aed) AS DOUBLE), 2)
         AS weekend_share_pct FROM fin_slv_transactions""")
def _(w: Warehouse) -> DataFrame:
    return marts.weekend_share(_silver(w))


@query("d26_median_amount", "SELECT median(CAST(amount_aed AS DOUBLE)) AS median FROM fin_slv_transactions")
def _(w: Warehouse) -> DataFrame:
    return exact_median(_silver(w), "amount_aed")


@query("d30_vendor_by_source", f"SELECT source, count(*) AS n FROM fin_slv_transactions WHERE vendor_id = '{VENDOR}' GROUP BY source")
def _(w: Warehouse) -> DataFrame:
    return marts.vendor_by_source(_silver(w), VENDOR)


@query("e1_pareto_rank", "SELECT * REPLACE (CAST(total_aed AS DOUBLE) AS total_aed) FROM fin_gld_top_vendors")
def _(w: Warehouse) -> DataFrame:
    return finance.top_vendors(finance.vendor_totals(_silver(w), w.table("fin_dim_vendor")))


_RECENT = """SELECT dept_name, period, total_aed FROM (
  SELECT dept_name, CAST(year * 12 + month AS INTEGER) AS period, total_aed,
         row_number() OVER (PARTITION BY dept_name ORDER BY year * 12 + month DESC) AS rn FROM fin_gld_spend_by_dept_month)
WHERE rn <= 6"""


@query("e2_last_six_months", f"SELECT dept_name, period, CAST(total_aed AS DOUBLE) AS total_aed FROM ({_RECENT})")
def _(w: Warehouse) -> DataFrame:
    return forecast.recent_months(_mart(w))


@query("e3_next_month_forecast", f"""
SELECT dept_name, round(last, 2) AS last_actual_aed, round(greatest(f, 0), 2) AS forecast_next_aed,
       round((f - last) / last * 100, 1) AS delta_pct, history
FROM (SELECT dept_name, regr_intercept(y, x) + regr_slope(y, x) AS f, arg_max(y, x) AS last, count(*) AS n,
             string_agg(period || ':' || total_aed, ' ' ORDER BY period) AS history
      FROM (SELECT dept_name, period, total_aed, CAST(total_aed AS DOUBLE) AS y,
                   CAST(period - max(period) OVER (PARTITION BY dept_name) AS DOUBLE) AS x FROM ({_RECENT}))
      GROUP BY dept_name) WHERE n >= 3""")
def _(w: Warehouse) -> DataFrame:
    texts = F.transform("history", lambda h: F.concat(h["period"], F.lit(":"), h["amount_aed"]))
    return forecast.next_month_forecast(_mart(w)).withColumn("history", F.array_join(texts, " "))


@query("e5_e6_concentration", """
SELECT count(*) AS vendor_count, CAST(sum(total_aed) AS DOUBLE) AS total_aed,
       max(cumulative_pct) FILTER (pareto_rank <= 3) AS top_3_pct, max(cumulative_pct) FILTER (pareto_rank <= 5) AS top_5_pct,
       max(cumulative_pct) FILTER (pareto_rank <= 10) AS top_10_pct,
       round(CAST((SELECT sum((2 * i - n - 1) * total_aed)
                   FROM (SELECT total_aed, row_number() OVER (ORDER BY total_aed) AS i, count(*) OVER () AS n FROM fin_gld_top_vendors)) AS DOUBLE)
             / (count(*) * CAST(sum(total_aed) AS DOUBLE)), 3) AS gini
FROM fin_gld_top_vendors""")
def _(w: Warehouse) -> DataFrame:
    return marts.concentration(_vendors(w))


@query("e7_leaders", """
SELECT canonical_name AS name, round(100 * CAST(total_aed AS DOUBLE) / (SELECT CAST(sum(total_aed) AS DOUBLE) FROM fin_gld_top_vendors), 2)
  AS share_pct FROM fin_gld_top_vendors ORDER BY pareto_rank LIMIT 5""")
def _(w: Warehouse) -> DataFrame:
    return marts.leaders(_vendors(w))


@query("h1_parse_messy_date", "SELECT txn_id, date_text, CAST(txn_date AS VARCHAR) AS txn_date FROM fin_staged")
def _(w: Warehouse) -> DataFrame:
    feeds = finance.union_feeds(w.table("fin_src_concur_expenses"), w.table("fin_src_corporate_card"))
    return feeds.select("txn_id", "date_text", parse_messy_date(F.col("date_text")).alias("txn_date"))


@query("h2_to_aed", """
SELECT txn_id, original_currency, CAST(original_amount AS DOUBLE) AS original_amount, CAST(amount_aed AS DOUBLE) AS amount_aed
FROM fin_staged""")
def _(w: Warehouse) -> DataFrame:
    feeds = finance.union_feeds(w.table("fin_src_concur_expenses"), w.table("fin_src_corporate_card"))
    amount, currency = F.col("original_amount"), F.col("original_currency")
    return feeds.select("txn_id", "original_currency", "original_amount", to_aed(amount, currency).alias("amount_aed"))


@query("h3_json_arrays", """
SELECT vendor_id, unnest(from_json(aliases_json, '["VARCHAR"]')) AS alias FROM fin_dim_vendor""")
def _(w: Warehouse) -> DataFrame:
    return w.table("fin_dim_vendor").select("vendor_id", F.explode(F.from_json("aliases_json", "array<string>")).alias("alias"))


@query("h4_prefixes", """
SELECT b.id, substr(b.payload_json, 1, 140) AS preview, CAST(CAST(b.ingested_at AS DATE) AS VARCHAR) AS day FROM bronze_sales_raw b""")
def _(w: Warehouse) -> DataFrame:
    return w.table("bronze_sales_raw").select(
        "id", F.substring("payload_json", 1, 140).alias("preview"), F.to_date("ingested_at").alias("day")
    )


@query("h5_h16_month_labels", """
SELECT txn_id, CAST(year(txn_date) AS INTEGER) AS year, CAST(month(txn_date) AS INTEGER) AS month,
       strftime(txn_date, '%Y-%m') AS year_month, strftime(txn_date, '%b %Y') AS label FROM fin_slv_transactions""")
def _(w: Warehouse) -> DataFrame:
    day = F.col("txn_date")
    return _silver(w).select(
        "txn_id", F.year(day).alias("year"), F.month(day).alias("month"),
        year_month_label(day).alias("year_month"), month_label(day).alias("label"),
    )


@query("h6_previous_month", """
SELECT txn_id, strftime(date_trunc('month', txn_date) - INTERVAL 1 MONTH, '%Y-%m') AS previous,
       CAST(CAST(txn_date - INTERVAL 90 DAY AS DATE) AS VARCHAR) AS window_start FROM fin_slv_transactions""")
def _(w: Warehouse) -> DataFrame:
    day = F.col("txn_date")
    return _silver(w).select("txn_id", marts.previous_month_label(day).alias("previous"), F.date_sub(day, 90).alias("window_start"))


@query("h7_day_difference", """
SELECT txn_id, CAST(date_diff('day', CAST(ts AS DATE), DATE '2001-08-01') AS INTEGER) AS days_ago FROM oltp_transactions""")
def _(w: Warehouse) -> DataFrame:
    today = F.lit(TODAY).cast("date")
    return w.table("oltp_transactions").select("txn_id", F.date_diff(today, F.to_date("ts")).alias("days_ago"))


@query("h8_calendar", """
SELECT txn_id, CAST(isodow(ts) - 1 AS INTEGER) AS dow, dayname(ts) AS day_name, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend FROM banking_transactions""")
def _(w: Warehouse) -> DataFrame:
    day = F.to_date("ts")
    return w.table("banking_transactions").select(
        "txn_id", F.weekday(day).alias("dow"), F.date_format(day, "EEEE").alias("day_name"), F.hour("ts").alias("hour"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
    )


@query("h10_coalesce_cast_round", """
SELECT txn_id, coalesce(category, 'UNK') AS category, CAST(trunc(amount_aed) AS BIGINT) AS whole,
       CAST(round(amount_aed, 1) AS DOUBLE) AS rounded FROM fin_slv_transactions""")
def _(w: Warehouse) -> DataFrame:
    return _silver(w).select(
        "txn_id", F.coalesce("category", F.lit("UNK")).alias("category"), F.col("amount_aed").cast("bigint").alias("whole"),
        F.round("amount_aed", 1).cast("double").alias("rounded"),
    )


@query("h13_needles", "SELECT raw, needle FROM spellings")
def _(w: Warehouse) -> DataFrame:
    feeds = finance.union_feeds(w.table("fin_src_concur_expenses"), w.table("fin_src_corporate_card"))
    return feeds.filter("raw IS NOT NULL").select("raw").distinct().select("raw", needle(F.col("raw")).alias("needle"))


@query("h14_padded_ids", "SELECT txn_id, source FROM fin_staged")
def _(w: Warehouse) -> DataFrame:
    return finance.union_feeds(w.table("fin_src_concur_expenses"), w.table("fin_src_corporate_card")).select("txn_id", "source")


@query("h15_first_token", "SELECT p_partkey, split_part(p_name, ' ', 1) AS brand FROM part")
def _(w: Warehouse) -> DataFrame:
    return w.source("part").select("p_partkey", F.split("p_name", " ")[0].alias("brand"))


@query("h17_money_text", f"""
SELECT txn_id, {money_text_sql("v")} AS shown FROM (SELECT txn_id, CAST(amount_aed AS DOUBLE) AS v FROM fin_slv_transactions)""")
def _(w: Warehouse) -> DataFrame:
    return _silver(w).select("txn_id", money_text(F.col("amount_aed")).alias("shown"))


@query("h18_anomaly_reasons", """
SELECT txn_id, CASE WHEN reasons = '' THEN 'unusual combination of dept + category + amount' ELSE reasons END AS reasons
FROM (SELECT txn_id, concat_ws('; ',
        CASE WHEN multiple >= 5 THEN CAST(CAST(multiple AS DECIMAL(30,1)) AS VARCHAR) || 'x the median txn' END,
        CASE WHEN isodow(txn_date) >= 6 THEN 'posted on a weekend' END,
        CASE WHEN amount_aed >= 10000 THEN 'amount above 10,000 AED' END) AS reasons
      FROM (SELECT *, round(CAST(amount_aed AS DOUBLE) / (SELECT median(CAST(amount_aed AS DOUBLE)) FROM fin_slv_transactions), 1) AS multiple
            FROM fin_slv_transactions))""")
def _(w: Warehouse) -> DataFrame:
    median = exact_median(_silver(w), "amount_aed").scalar()
    reasons = marts.anomaly_reasons(F.col("amount_aed"), F.col("txn_date"), median)
    return _silver(w).select("txn_id", F.array_join(reasons, "; ").alias("reasons"))


@query("l8_dept_last_month", f"""
SELECT CAST(total_aed AS DOUBLE) AS total_aed FROM fin_gld_spend_by_dept_month
WHERE dept_name = '{DEPT_NAME}' AND month_label = '2001-07'""")
def _(w: Warehouse) -> DataFrame:
    return marts.dept_last_month(_mart(w), DEPT_NAME, TODAY)


@query("l9_top_five_vendors", """
SELECT canonical_name, CAST(total_aed AS DOUBLE) AS spend_aed, txn_count FROM fin_gld_top_vendors ORDER BY pareto_rank LIMIT 5""")
def _(w: Warehouse) -> DataFrame:
    return marts.top_vendors(_vendors(w), 5).select("canonical_name", F.col("total_aed").alias("spend_aed"), "txn_count")


@query("l10_dept_category_spend", f"""
SELECT CAST(sum(amount_aed) AS DOUBLE) AS spend_aed FROM fin_slv_transactions t JOIN fin_dim_department d ON d.dept_id = t.dept_id
WHERE d.dept_name = '{DEPT_NAME}' AND t.category = 'Software' AND year(t.txn_date) = {YEAR}""")
def _(w: Warehouse) -> DataFrame:
    return marts.dept_category_spend(_silver(w), w.table("fin_dim_department"), DEPT_NAME, "Software", YEAR)


@query("l11_large_expenses", """
SELECT CAST(txn_date AS VARCHAR) AS txn_date, employee AS full_name, vendor AS canonical_name, CAST(amount_aed AS DOUBLE) AS amount_aed
FROM fin_enriched WHERE category = 'Meals' AND amount_aed > 10000""")
def _(w: Warehouse) -> DataFrame:
    return marts.large_expenses(_silver(w), w.table("fin_dim_employee"), w.table("fin_dim_vendor"), "Meals", 10000)


@query("l12_vendor_by_month", f"""
SELECT strftime(txn_date, '%Y-%m') AS month_label, CAST(sum(amount_aed) AS DOUBLE) AS spend_aed FROM fin_enriched
WHERE vendor = '{VENDOR_NAME}' GROUP BY 1""")
def _(w: Warehouse) -> DataFrame:
    return marts.vendor_by_month(_silver(w), w.table("fin_dim_vendor"), VENDOR_NAME)


@query("l13_fastest_growing_dept", """
SELECT t.dept_name, CAST(t.total_aed - coalesce(p.total_aed, 0) AS DOUBLE) AS delta_aed
FROM (SELECT * FROM fin_gld_spend_by_dept_month WHERE month_label = '2001-07') t
LEFT JOIN (SELECT * FROM fin_gld_spend_by_dept_month WHERE month_label = '2001-06') p ON p.dept_name = t.dept_name
ORDER BY t.total_aed - coalesce(p.total_aed, 0) DESC, t.dept_name LIMIT 1""")
def _(w: Warehouse) -> DataFrame:
    return marts.fastest_growing(_mart(w), "2001-07", "2001-06")
