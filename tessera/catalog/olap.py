"""Cube queries, OLTP/OLAP aggregates and ad-hoc SQL over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.catalog.registry import query
from tessera.functions.money import money_mean, money_total
from tessera.operators.cube import cube_query, diced_star, pivot_query, rollup_query, star_join
from tessera.plans import dq, reports
from tessera.plans.forecast import daily_revenue
from tessera.plans.warehouse import Warehouse
from tessera.sources import layers

_STAR = """gold_fact_sales f JOIN gold_dim_customer c USING (customer_id) JOIN gold_dim_product p USING (product_id)
JOIN gold_dim_store s USING (store_id) JOIN gold_dim_date d USING (date_id)"""
_AMOUNT = "CAST(sum(f.amount) AS DOUBLE)"


def _cube_sql(columns: list[str], value: str = _AMOUNT, where: str = "true") -> str:
    """A cube twin; it joins every dimension, which changes nothing as all keys resolve."""
    shown = ", ".join(columns)
    names = ", ".join(column.split(" AS ")[-1].split(".")[-1] for column in columns)
    keys = ", ".join(column.split(" AS ")[0] for column in columns)
    return f"SELECT {shown}, {value} AS value FROM {_STAR} WHERE {where} GROUP BY {keys} ORDER BY value DESC, {names} LIMIT 200"


def _cube(w: Warehouse, group_by, measure="amount", filters=None) -> DataFrame:
    return cube_query(w.table("gold_fact_sales"), w.dims(), group_by, measure, filters)


_SLICE = {"quarter": "1"}
_DICE = {"quarter": "1", "country": "ASIA", "channel": "mobile"}


@query("d1_cube_avg_basket", _cube_sql(["s.format AS store_format", "d.year"], "CAST(sum(f.amount) AS DOUBLE) / count(*)"))
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["store_format", "year"], "avg_basket")


@query("d1_cube_quantity", _cube_sql(["c.tier", "d.month_name"], "CAST(sum(f.quantity) AS BIGINT)"))
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["tier", "month_name"], "quantity")


@query("d1_cube_txn_count", "SELECT channel, count(*) AS value FROM gold_fact_sales GROUP BY channel")
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["channel"], "txn_count")


@query("d1_cube_grand_total", f"SELECT {_AMOUNT} AS value FROM gold_fact_sales f")
def _(w: Warehouse) -> DataFrame:
    return _cube(w, [])


@query("d1_cube_city", _cube_sql(["c.city", "p.brand"]))
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["city", "brand"])


@query("d2_slice", _cube_sql(["p.category", "c.country"], where="d.quarter = 1"))
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["category", "country"], filters=_SLICE)


@query("d3_dice", _cube_sql(["p.category"], where="d.quarter = 1 AND c.country = 'ASIA' AND f.channel = 'mobile'"))
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["category"], filters=_DICE)


@query("d4_drill_down", _cube_sql(["p.category", "p.brand"]))
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["category", "brand"])


@query("d5_roll_up", _cube_sql(["p.category"]))
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["category"])


@query("d5b_rollup_levels", f"""
SELECT p.category, p.brand, CAST(GROUPING(p.category, p.brand) AS INTEGER) AS level, {_AMOUNT} AS value
FROM {_STAR} GROUP BY ROLLUP (p.category, p.brand)""")
def _(w: Warehouse) -> DataFrame:
    return rollup_query(w.table("gold_fact_sales"), w.dims(), ["category", "brand"])


@query("d6_pivot", _cube_sql(["c.country", "p.category"]))
def _(w: Warehouse) -> DataFrame:
    return _cube(w, ["country", "category"])


# Fixed values of the given tables.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
DEPARTMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("d6_pivot_matrix", f"""
SELECT c.country, {", ".join(f"CAST(coalesce(sum(f.amount) FILTER (p.category = '{name}'), 0) AS DOUBLE) AS {name}" for name in CATEGORIES)}
FROM {_STAR} GROUP BY c.country""")
def _(w: Warehouse) -> DataFrame:
    return pivot_query(w.table("gold_fact_sales"), w.dims(), "country", "category", CATEGORIES)


@query("d7_oltp_status_summary", """
SELECT status, count(*) AS txn_count, CAST(sum(amount) AS DOUBLE) AS total, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amt
FROM oltp_transactions GROUP BY status""")
def _(w: Warehouse) -> DataFrame:
    amount = F.col("amount")
    return w.table("oltp_transactions").groupBy("status").agg(
        F.count("*").alias("txn_count"), money_total(amount).alias("total"), money_mean(amount).alias("avg_amt")
    )


@query("d8_channel_summary", """
SELECT channel, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amt
FROM gold_fact_sales GROUP BY channel""")
def _(w: Warehouse) -> DataFrame:
    amount = F.col("amount")
    return w.table("gold_fact_sales").groupBy("channel").agg(
        F.count("*").alias("n"), money_total(amount).alias("total"), money_mean(amount).alias("avg_amt")
    ).orderBy(F.desc("total"))


@query("b7_dice_filters", f"SELECT c.tier, count(*) AS n FROM {_STAR} WHERE d.year = 1998 AND f.channel = 'web' GROUP BY c.tier")
def _(w: Warehouse) -> DataFrame:
    filters = {"year": "1998", "channel": "web", "country": "", "city": None, "planet": "Mars"}
    return diced_star(w.table("gold_fact_sales"), w.dims(), ["tier"], filters).groupBy("tier").agg(F.count("*").alias("n"))


@query("b10_threshold_filters", """
SELECT (SELECT count(*) FROM bronze_sales_raw WHERE is_dirty = 1) AS dirty,
       (SELECT count(*) FROM fin_slv_transactions WHERE amount_aed > 10000) AS large,
       (SELECT count(*) FROM fin_slv_transactions WHERE category IS NOT NULL) AS categorised,
       (SELECT count(*) FROM fin_gld_top_vendors WHERE pareto_rank <= 5) AS leaders,
       (SELECT count(*) FROM customer_features WHERE txns > 0) AS buyers""")
def _(w: Warehouse) -> DataFrame:
    def rows(df: DataFrame, condition: str):
        return df.filter(condition).agg(F.count("*")).scalar()

    silver = w.table("fin_slv_transactions")
    buyers = w.table("gold_dim_customer").join(w.table("gold_fact_sales"), "customer_id", "left_semi")
    return w.table("bronze_sales_raw").filter("is_dirty = 1").agg(F.count("*").alias("dirty")).select(
        "dirty",
        rows(silver, "amount_aed > 10000").alias("large"),
        rows(silver, "category IS NOT NULL").alias("categorised"),
        rows(w.table("fin_gld_top_vendors"), "pareto_rank <= 5").alias("leaders"),
        buyers.agg(F.count("*")).scalar().alias("buyers"),
    )


@query("b11_point_lookup", """
SELECT txn_id, customer_id, CAST(amount AS DOUBLE) AS amount, CAST(ts AS VARCHAR) AS ts, status
FROM oltp_transactions WHERE txn_id = 'T42'""")
def _(w: Warehouse) -> DataFrame:
    return w.table("oltp_transactions").filter(F.col("txn_id") == "T42")


@query("c1_star_join", f"""
SELECT c.country, c.tier, p.category, s.format AS store_format, d.year, f.channel, count(*) AS n, {_AMOUNT} AS total
FROM {_STAR} GROUP BY ALL""")
def _(w: Warehouse) -> DataFrame:
    dims = ["country", "tier", "category", "store_format", "year", "channel"]
    joined = star_join(w.table("gold_fact_sales"), w.dims(), dims)
    return joined.groupBy(*dims).agg(F.count("*").alias("n"), F.sum("amount").alias("total"))


@query("d10_daily_revenue", """
SELECT CAST(date_id AS VARCHAR) AS date_id, CAST(revenue AS DOUBLE) AS revenue, txns FROM daily_revenue""")
def _(w: Warehouse) -> DataFrame:
    return daily_revenue(w.table("gold_fact_sales"))


@query("d27_dirty_by_kind", "SELECT dirt_kind, count(*) AS n FROM bronze_sales_raw WHERE is_dirty = 1 GROUP BY dirt_kind")
def _(w: Warehouse) -> DataFrame:
    return reports.dirty_by_kind(w.table("bronze_sales_raw"))


_PAIRS = "SELECT customer_id, product_id, sum(amount) AS spent FROM gold_fact_sales GROUP BY customer_id, product_id"


@query("f5_row_cap", f"SELECT CAST(least(count(*), 500) AS BIGINT) AS row_count, count(*) > 500 AS truncated FROM ({_PAIRS})")
def _(w: Warehouse) -> DataFrame:
    return reports.run_on_layers(w, _PAIRS).truncated


@query("l1_run_sql", """
SELECT brand, channel, CAST(sum(quantity) AS BIGINT) AS units FROM gold_fact_sales JOIN gold_dim_product USING (product_id)
GROUP BY brand, channel ORDER BY brand, channel LIMIT 500""")
def _(w: Warehouse) -> DataFrame:
    return reports.run_on_layers(w, """
        SELECT brand, channel, SUM(quantity) AS units FROM gold_fact_sales JOIN gold_dim_product USING (product_id)
        GROUP BY brand, channel ORDER BY brand, channel;
    """).rows


@query("l2_top_products", """
SELECT p.name, p.category, CAST(sum(f.amount) AS DOUBLE) AS revenue, CAST(sum(f.quantity) AS BIGINT) AS units
FROM gold_fact_sales f JOIN gold_dim_product p USING (product_id) GROUP BY p.name, p.category
ORDER BY sum(f.amount) DESC, p.name, p.category LIMIT 5""")
def _(w: Warehouse) -> DataFrame:
    return reports.top_products(w.table("gold_fact_sales"), w.table("gold_dim_product"))


@query("l3_revenue_by_country_quarter", f"SELECT c.country, d.quarter, {_AMOUNT} AS revenue FROM {_STAR} GROUP BY c.country, d.quarter")
def _(w: Warehouse) -> DataFrame:
    by_quarter = cube_query(w.table("gold_fact_sales"), w.dims(), ["country", "quarter"], limit=None)
    return by_quarter.withColumnRenamed("value", "revenue").orderBy("country", "quarter")


@query("l4_latest_silver", """
SELECT * REPLACE (CAST(sale_ts AS VARCHAR) AS sale_ts, CAST(unit_price AS DOUBLE) AS unit_price, CAST(amount AS DOUBLE) AS amount)
FROM silver_sales ORDER BY silver_sales.sale_ts DESC, sale_id DESC LIMIT 25""")
def _(w: Warehouse) -> DataFrame:
    return layers.sample_retail_layer("silver", w.table("silver_sales"), limit=25)


@query("l5_dirty_by_kind", "SELECT dirt_kind, count(*) AS n FROM bronze_sales_raw WHERE is_dirty = 1 GROUP BY dirt_kind")
def _(w: Warehouse) -> DataFrame:
    return reports.dirty_by_kind(w.table("bronze_sales_raw"))


@query("l6_recent_events", """
SELECT created_at, layer, kind, rows_affected, detail FROM data_quality_events ORDER BY id DESC LIMIT 10""")
def _(w: Warehouse) -> DataFrame:
    return dq.recent_events(w.table("data_quality_events"), limit=10)


@query("l7_revenue_by_category", """
SELECT p.category, count(*) AS sales, CAST(sum(f.amount) AS DOUBLE) AS revenue
FROM gold_fact_sales f JOIN gold_dim_product p USING (product_id) GROUP BY p.category""")
def _(w: Warehouse) -> DataFrame:
    return reports.revenue_by_category(w.table("gold_fact_sales"), w.table("gold_dim_product"))
