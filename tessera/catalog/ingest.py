"""Sources, sinks, layer plumbing, and the bronze → silver → gold rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.catalog.registry import query
from tessera.functions.dates import build_date_dim
from tessera.plans import dq, finance, retail
from tessera.plans.warehouse import FINANCE_LAYERS, RETAIL_LAYERS, Warehouse
from tessera.schemas import DQ_EVENTS, FACT_SALES, SILVER_SALES
from tessera.sources import layers, payloads
from tessera.sources.retail import sales
from tessera.sources.workspace import new_path

INJECTED_AT = "2026-04-21 10:15:00"


@query("a1_read_bronze", """
SELECT id, source_system, CAST(ingested_at AS VARCHAR) AS ingested_at, payload_json, is_dirty, dirt_kind FROM bronze_sales_raw""")
def _(w: Warehouse) -> DataFrame:
    return w.table("bronze_sales_raw")


@query("a2_append_bronze", """
SELECT source_system, is_dirty, dirt_kind, count(*) AS n FROM bronze_sales_raw GROUP BY ALL
UNION ALL SELECT 'upstream-fix', 0, NULL, count(*) FROM bronze_sales_raw WHERE is_dirty = 1""")
def _(w: Warehouse) -> DataFrame:
    bronze, path = w.table("bronze_sales_raw"), new_path(w.spark, "bronze_appended")
    layers.adopt_layer(w.spark, path, [w.folder("bronze_sales_raw")])
    batch = payloads.append_bronze(bronze.filter("is_dirty = 1"), "upstream-fix", INJECTED_AT)
    layers.append_layer(batch, path)
    appended = layers.read_layer(w.spark, path, bronze.schema)
    return appended.groupBy("source_system", "is_dirty", "dirt_kind").agg(F.count("*").alias("n"))


@query("a3_rebuild_layer", """
SELECT channel, currency, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM silver_sales GROUP BY ALL""")
def _(w: Warehouse) -> DataFrame:
    silver, path = w.table("silver_sales"), new_path(w.spark, "silver_rebuilt")
    for _ in range(2):
        layers.rebuild_layer(silver, path, cluster_by=("sale_ts", "sale_id"))
    rebuilt = layers.read_layer(w.spark, path, SILVER_SALES)
    return rebuilt.groupBy("channel", "currency").agg(F.count("*").alias("n"), F.sum("amount").alias("total"))


@query("a4_log_dq", "SELECT * FROM data_quality_events")
def _(w: Warehouse) -> DataFrame:
    log = new_path(w.spark, "dq_log")
    dq.log_events(log, retail.silver_counts(w.table("silver_staged")), dq.SILVER_EVENTS, w.run_at, run=0)
    dq.log_events(log, retail.gold_counts(w.table("gold_staged")), dq.GOLD_EVENTS, w.run_at, run=1)
    dq.log_events(log, finance.silver_counts(w.table("fin_staged")), dq.FINANCE_EVENTS, w.run_at, run=2)
    return layers.read_layer(w.spark, log, DQ_EVENTS)


@query("a5_recent_dq_events", """
SELECT layer, kind, detail, rows_affected, created_at FROM data_quality_events ORDER BY id DESC LIMIT 20""")
def _(w: Warehouse) -> DataFrame:
    return dq.recent_events(w.table("data_quality_events"))


def _counts_sql(names: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{layer}' AS layer, count(*) AS n FROM {table}" for layer, table in names.items())


@query("a6_retail_layer_counts", _counts_sql(RETAIL_LAYERS))
def _(w: Warehouse) -> DataFrame:
    return layers.layer_counts({layer: w.table(table) for layer, table in RETAIL_LAYERS.items()})


@query("a7_finance_layer_counts", _counts_sql(FINANCE_LAYERS))
def _(w: Warehouse) -> DataFrame:
    return layers.layer_counts({layer: w.table(table) for layer, table in FINANCE_LAYERS.items()})


_RETAIL_SAMPLES = {
    "bronze": """SELECT id, source_system, CAST(ingested_at AS VARCHAR) AS ingested_at, is_dirty, dirt_kind,
                 substr(payload_json, 1, 140) AS payload_preview FROM bronze_sales_raw ORDER BY id DESC LIMIT 20""",
    "silver": """SELECT * REPLACE (CAST(sale_ts AS VARCHAR) AS sale_ts, CAST(unit_price AS DOUBLE) AS unit_price,
                 CAST(amount AS DOUBLE) AS amount) FROM silver_sales ORDER BY silver_sales.sale_ts DESC, sale_id DESC LIMIT 20""",
    "gold_fact": """SELECT * REPLACE (CAST(date_id AS VARCHAR) AS date_id, CAST(amount AS DOUBLE) AS amount)
                    FROM gold_fact_sales ORDER BY gold_fact_sales.date_id DESC, sale_id DESC LIMIT 20""",
    "gold_dim_customer": "SELECT * FROM gold_dim_customer ORDER BY customer_id LIMIT 20",
    "gold_dim_product": """SELECT * REPLACE (CAST(base_price AS DOUBLE) AS base_price) FROM gold_dim_product
                           ORDER BY product_id LIMIT 20""",
    "gold_dim_store": "SELECT * FROM gold_dim_store ORDER BY store_id LIMIT 20",
    "gold_dim_date": """SELECT * REPLACE (CAST(date_id AS VARCHAR) AS date_id) FROM gold_dim_date
                        ORDER BY gold_dim_date.date_id DESC LIMIT 20""",
}


def _sample_retail(layer: str):
    return lambda w: layers.sample_retail_layer(layer, w.table(RETAIL_LAYERS[layer]))


for _layer, _sql in _RETAIL_SAMPLES.items():
    query(f"a8_sample_{_layer}", _sql)(_sample_retail(_layer))


_FEED_SQL = {
    "concur": "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM fin_src_concur_expenses ORDER BY row_id DESC LIMIT {n}",
    "card": "SELECT * REPLACE (CAST(amount_usd AS DOUBLE) AS amount_usd) FROM fin_src_corporate_card ORDER BY row_id DESC LIMIT {n}",
}
_FINANCE_SAMPLES = {
    **{feed: sql.format(n=20) for feed, sql in _FEED_SQL.items()},
    "silver": """SELECT txn_id, source, employee, department, vendor, category, CAST(txn_date AS VARCHAR) AS txn_date,
                 CAST(amount_aed AS DOUBLE) AS amount_aed, original_currency, CAST(original_amount AS DOUBLE) AS original_amount
                 FROM fin_enriched ORDER BY fin_enriched.txn_date DESC, txn_id DESC LIMIT 20""",
    "gold_spend": """SELECT * REPLACE (CAST(total_aed AS DOUBLE) AS total_aed) FROM fin_gld_spend_by_dept_month
                     ORDER BY year, month, dept_name LIMIT 20""",
    "gold_vendors": """SELECT * REPLACE (CAST(total_aed AS DOUBLE) AS total_aed) FROM fin_gld_top_vendors
                       ORDER BY pareto_rank LIMIT 20""",
}


def enriched(w: Warehouse) -> DataFrame:
    return finance.enrich(
        w.table("fin_slv_transactions"), w.table("fin_dim_employee"), w.table("fin_dim_department"), w.table("fin_dim_vendor")
    )


_FINANCE_TABLES = {
    "concur": "fin_src_concur_expenses", "card": "fin_src_corporate_card", "silver": "fin_slv_transactions",
    "gold_spend": "fin_gld_spend_by_dept_month", "gold_vendors": "fin_gld_top_vendors",
}


def _sample_finance(layer: str):
    def sample(w: Warehouse) -> DataFrame:
        rows = layers.sample_finance_layer(layer, w.table(_FINANCE_TABLES[layer]))
        if layer != "silver":
            return rows
        named = finance.enrich_few(rows, w.table("fin_dim_employee"), w.table("fin_dim_department"), w.table("fin_dim_vendor"))
        return named.select(
            "txn_id", "source", "employee", "department", "vendor", "category", "txn_date", "amount_aed",
            "original_currency", "original_amount",
        )

    return sample


for _layer, _sql in _FINANCE_SAMPLES.items():
    query(f"a9_sample_finance_{_layer}", _sql)(_sample_finance(_layer))


def _raw(feed: str):
    return lambda w: layers.raw_source(w.table(_FINANCE_TABLES[feed]))


for _feed, _sql in _FEED_SQL.items():
    query(f"a10_raw_source_{_feed}", _sql.format(n=25))(_raw(_feed))


@query("a11_build_date_dim", """
SELECT CAST(date_id AS VARCHAR) AS date_id, day, day_of_week, month, month_name, quarter, year, is_weekend FROM (
  SELECT CAST(d AS DATE) AS date_id, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_of_week,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST((month(d) - 1) // 3 + 1 AS INTEGER) AS quarter,
         CAST(year(d) AS INTEGER) AS year, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend
  FROM (SELECT unnest(generate_series((SELECT CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP) FROM orders),
                                      (SELECT CAST(CAST(max(o_orderdate) AS DATE) AS TIMESTAMP) FROM orders), INTERVAL 1 DAY)) AS d))""")
def _(w: Warehouse) -> DataFrame:
    span = w.source("orders").agg(F.min("o_orderdate").cast("date").cast("string"), F.max("o_orderdate").cast("date").cast("string"))
    return build_date_dim(w.spark, *span.first())


@query("a12_star_from_sales", """
SELECT sale_id, CAST(CAST(sale_ts AS DATE) AS VARCHAR) AS date_id, customer_id, product_id, store_id, channel, quantity,
       CAST(amount AS DOUBLE) AS amount FROM silver_sales""")
def _(w: Warehouse) -> DataFrame:
    return retail.star_from_sales(w.table("silver_sales"))


@query("a13_to_bronze_json", "SELECT id, payload_json FROM bronze_sales_raw WHERE substr(id, 1, 1) = '0'")
def _(w: Warehouse) -> DataFrame:
    return sales(w.source("lineitem"), w.source("orders")).select("id", payloads.to_payload().alias("payload_json"))


@query("a14_replay_retail", """
SELECT s.*, g.* FROM silver_summary s, gold_summary g""")
def _(w: Warehouse) -> DataFrame:
    fresh = w.replayed()
    gold = retail.gold_counts(fresh.table("gold_staged"))
    both = gold.select(F.struct("*")).scalar()
    return retail.silver_counts(fresh.table("silver_staged")).select("*", both.alias("gold")).select("*", "gold.*").drop("gold")


@query("a15_replay_finance", """
SELECT f.*, (SELECT count(*) FROM fin_gld_spend_by_dept_month) AS spend_mart_rows,
       (SELECT count(*) FROM fin_gld_top_vendors) AS vendor_mart_rows,
       (SELECT CAST(sum(total_aed) AS DOUBLE) FROM fin_gld_top_vendors) AS total_spend_aed
FROM finance_summary f""")
def _(w: Warehouse) -> DataFrame:
    fresh = w.replayed()
    vendors = fresh.table("fin_gld_top_vendors")
    months = fresh.table("fin_gld_spend_by_dept_month")
    return finance.silver_counts(fresh.table("fin_staged")).select(
        "*",
        months.agg(F.count("*")).scalar().alias("spend_mart_rows"),
        vendors.agg(F.count("*")).scalar().alias("vendor_mart_rows"),
        vendors.agg(F.sum("total_aed")).scalar().alias("total_spend_aed"),
    )


def _after_injection(w: Warehouse, *inject) -> DataFrame:
    bronze = w.table("bronze_sales_raw")
    batches = [add(bronze, INJECTED_AT) for add in inject]
    return reduce(DataFrame.unionByName, batches, bronze)


@query("a16_inject_schema_drift", "SELECT * FROM silver_summary_drift")
def _(w: Warehouse) -> DataFrame:
    return retail.silver_counts(retail.stage_silver(_after_injection(w, payloads.inject_schema_drift)))


@query("a17_inject_dupes", "SELECT * FROM silver_summary_dupes")
def _(w: Warehouse) -> DataFrame:
    return retail.silver_counts(retail.stage_silver(_after_injection(w, payloads.inject_dupes)))


@query("a18_inject_nulls", "SELECT * FROM silver_summary_nulls")
def _(w: Warehouse) -> DataFrame:
    return retail.silver_counts(retail.stage_silver(_after_injection(w, payloads.inject_nulls)))


@query("b1_parse_json", "SELECT id, json_valid(payload_json) AS is_object FROM bronze_sales_raw")
def _(w: Warehouse) -> DataFrame:
    parsed = retail.parsed_payload("payload_json")
    return w.table("bronze_sales_raw").select("id", F.coalesce(parsed["whole"] & parsed["payload"].isNotNull(), F.lit(False)).alias("is_object"))


@query("b2_require_keys", "SELECT id, payload_json FROM parsed WHERE status = 'dropped_schema'")
def _(w: Warehouse) -> DataFrame:
    return retail.classify_bronze(w.table("bronze_sales_raw")).filter(F.col("status") == retail.DROPPED).select("id", "payload_json")


@query("b3_require_non_null_keys", """
SELECT id, sale_id, customer_id, product_id, store_id FROM parsed WHERE status = 'quarantined_nulls'""")
def _(w: Warehouse) -> DataFrame:
    return retail.classify_bronze(w.table("bronze_sales_raw")).filter(F.col("status") == retail.NULLS).select(
        "id", "sale_id", "customer_id", "product_id", "store_id"
    )


@query("b4_dedupe_first", """
SELECT sale_id, min(id) AS bronze_id, count(*) AS copies FROM parsed WHERE status = 'parsed_ok' GROUP BY sale_id""")
def _(w: Warehouse) -> DataFrame:
    staged = retail.stage_silver(w.table("bronze_sales_raw"))
    return staged.filter(F.col("status").isin(retail.OK, retail.BAD_TYPE)).select("sale_id", "bronze_id", "copies")


@query("b4_duplicate_rows", "SELECT id, sale_id FROM judged WHERE status = 'quarantined_dupes'")
def _(w: Warehouse) -> DataFrame:
    classified = retail.classify_bronze(w.table("bronze_sales_raw"))
    return retail.duplicate_rows(classified, w.table("silver_staged")).select("id", "sale_id")


@query("b5_cast_typed", """
SELECT * REPLACE (CAST(sale_ts AS VARCHAR) AS sale_ts, CAST(unit_price AS DOUBLE) AS unit_price, CAST(amount AS DOUBLE) AS amount)
FROM silver_sales""")
def _(w: Warehouse) -> DataFrame:
    # Cast ahead of the join: it shuffles typed fields, not payloads.
    typed = retail.silver_of(retail.cast_typed(retail.classify_bronze(w.table("bronze_sales_raw"))), "id")
    return typed.join(w.table("silver_staged").select(F.col("bronze_id").alias("id")), "id", "left_semi").drop("id")


@query("b6_silver_summary", "SELECT * FROM silver_summary")
def _(w: Warehouse) -> DataFrame:
    return retail.silver_counts(retail.stage_silver(w.table("bronze_sales_raw")))


@query("b6_quarantine", """
SELECT id, status, payload_json FROM judged WHERE status NOT IN ('parsed_ok', 'quarantined_dupes')""")
def _(w: Warehouse) -> DataFrame:
    return retail.quarantine_of(w.table("silver_staged")).select("id", "status", "payload_json")


@query("c3_fk_validation", """
SELECT * REPLACE (CAST(date_id AS VARCHAR) AS date_id, CAST(amount AS DOUBLE) AS amount) FROM (
  SELECT sale_id, date_id, customer_id, product_id, store_id, channel, quantity, amount FROM checked_sales WHERE NOT known)""")
def _(w: Warehouse) -> DataFrame:
    staged = retail.stage_gold(w.table("silver_sales"), w.dims())
    return staged.filter(F.col("status") == retail.ORPHAN).select(*FACT_SALES.names)


@query("c3_gold_summary", "SELECT * FROM gold_summary")
def _(w: Warehouse) -> DataFrame:
    return retail.gold_counts(retail.stage_gold(w.table("silver_sales"), w.dims()))
