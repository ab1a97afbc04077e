"""Retail model tables from the given parquet tables.

What makes a row dirty, an orphan or late is read off the row's own values, so the
share of such rows stays the same at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import build_date_dim
from tessera.sources import payloads as P


def read(spark: SparkSession, source_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{source_dir}/{name}.parquet")


def channel(priority: Column) -> Column:
    return (
        F.when(priority == "1-URGENT", "web")
        .when(priority == "2-HIGH", "mobile")
        .when(priority == "3-MEDIUM", "store")
        .when(priority == "4-NOT SPECIFIED", "partner")
        .otherwise("web")
    )


def order_lines(lineitem: DataFrame) -> DataFrame:
    """The columns a sale is made of."""
    return lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )


def padded(digits: Column, width: int) -> Column:
    """Leading zeros up to ``width``; a longer key is never cut."""
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def sales(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One sale per order line, in payload fields, with a total order key ``id``."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    units = F.col("l_quantity").cast("int")
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat_ws(
            "-",
            F.lit("0"),
            padded(F.col("l_orderkey").cast("string"), 12),
            F.col("l_linenumber").cast("string"),
            padded(F.col("l_partkey").cast("string"), 12),
            padded(F.col("l_suppkey").cast("string"), 12),
            F.col("l_shipdate").cast("date").cast("string"),
            padded(price.cast("string"), 14),
        ).alias("id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("sale_id"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("product_id"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("store_id"),
        F.replace(F.col("o_orderdate").cast("string"), F.lit(" "), F.lit("T")).alias("sale_ts"),
        units.alias("quantity"),
        F.round(price / units, 2).cast("decimal(18,2)").alias("unit_price"),
        price.alias("amount"),
        channel(F.col("o_orderpriority")).alias("channel"),
        F.when(F.col("l_linestatus") == "O", "USD").otherwise("AED").alias("currency"),
        F.col("l_shipdate").alias("ingested_at"),
        "l_returnflag", "l_linestatus", "l_discount", "l_tax",
    )


def bronze_sales(sales_rows: DataFrame) -> DataFrame:
    """Raw payloads: every sale once, and again from each broken feed its values put it in.

    The broken feeds are a branch of their own, over the sales that have one: an expression that holds all feeds is too long
    for the JVM to compile, and would be interpreted for every sale.
    """
    broken = F.lit(False)

    def feed(tag: str, source: str, kind: str | None, payload: Column, flag: str, status: str, discount: float, tax: float) -> Column:
        nonlocal broken
        here = (
            (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)
            & (F.col("l_discount") == discount) & (F.col("l_tax") == tax)
        )
        broken = broken | here
        return F.when(here, _bronze_row(tag, source, kind, payload))

    def renamed(prefix: str) -> Column:
        return F.concat(F.lit(prefix), F.col("sale_id"))

    clean = P.to_payload()
    variants = F.array(
        feed("1", P.DRIFT_FEED, P.SCHEMA_DRIFT, P.drifted_payload(), "A", "O", 0.10, 0.08),
        feed("1", P.DRIFT_FEED, P.SCHEMA_DRIFT, F.substring(clean, 1, 60), "R", "O", 0.08, 0.05),
        feed("1", P.NULL_FEED, P.NULL_FLOOD, P.null_customer_payload(), "N", "F", 0.09, 0.07),
        feed("1", P.NULL_FEED, P.NULL_FLOOD,
             P.to_payload(sale_id=renamed("NULLFLOOD"), store_id=F.lit("")), "N", "F", 0.09, 0.06),
        feed("1", P.REPLAY_FEED, P.DUPES, clean, "R", "F", 0.05, 0.04),
        feed("1", P.CLEAN_FEED, None,
             P.to_payload(sale_id=renamed("BAD"), quantity=F.lit("x")), "A", "F", 0.07, 0.03),
        feed("1", P.CLEAN_FEED, None,
             P.to_payload(sale_id=renamed("NEW"), product_id=F.lit("P-new"), store_id=F.lit("S-new")),
             "A", "F", 0.03, 0.02),
        feed("1", P.CLEAN_FEED, None, P.to_payload(sale_id=renamed("OLD"), sale_ts=F.lit("1901-01-01T00:00:00")), "A", "F", 0.02, 0.01),
        feed("1", P.CLEAN_FEED, None, P.to_payload(sale_id=renamed("TIME"), sale_ts=F.lit("hello")), "A", "F", 0.06, 0.01),
        feed("1", P.DRIFT_FEED, P.SCHEMA_DRIFT, F.concat(clean, F.lit(" xyz")), "R", "F", 0.01, 0.08),
        feed("1", P.DRIFT_FEED, P.SCHEMA_DRIFT, F.translate(clean, '"', "'"), "R", "F", 0.02, 0.07),
    )
    whole = sales_rows.select(_bronze_row("0", P.CLEAN_FEED, None, clean).alias("row"))
    again = sales_rows.filter(broken).select(F.explode(F.array_compact(variants)).alias("row"))
    return whole.unionByName(again).select("row.*")


def _bronze_row(tag: str, source: str, kind: str | None, payload: Column) -> Column:
    return F.struct(
        F.concat(F.lit(tag), F.expr("substring(id, 2)")).alias("id"),
        F.lit(source).alias("source_system"),
        F.col("ingested_at").alias("ingested_at"),
        payload.alias("payload_json"),
        F.lit(0 if kind is None else 1).alias("is_dirty"),
        F.lit(kind).cast("string").alias("dirt_kind"),
    )


def dim_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("C"), F.col("c_custkey")).alias("customer_id"),
            F.col("c_name").alias("name"),
            (F.lit(18) + F.pmod(F.floor(F.abs("c_acctbal")), F.lit(60))).cast("int").alias("age"),
            F.col("c_mktsegment").alias("tier"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            (F.lit(2000) + F.pmod(F.col("c_custkey"), F.lit(20))).cast("int").alias("signup_year"),
        )
    )


def dim_product(part: DataFrame) -> DataFrame:
    return part.select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("base_price"),
    )


def dim_store(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    balance = F.col("s_acctbal")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("S"), F.col("s_suppkey")).alias("store_id"),
            F.col("s_name").alias("name"),
            F.when(balance < 0, "Kiosk").when(balance < 3000, "Express")
            .when(balance < 6000, "Mall").otherwise("Flagship").alias("format"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
        )
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """The days from the first order to the last."""
    day = lambda pick: pick("o_orderdate").cast("date").cast("string")
    return build_date_dim(orders.sparkSession, *orders.agg(day(F.min), day(F.max)).first())


def oltp_transactions(orders: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    return orders.select(
        F.concat(F.lit("T"), F.col("o_orderkey")).alias("txn_id"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("customer_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").alias("ts"),
        F.when(status == "F", "ok").when(status == "O", "pending").otherwise("reversed").alias("status"),
    )


def by_key(table: DataFrame, key: str) -> DataFrame:
    """Rows in ranges of a unique key, sorted: a point read opens one row group. Counts on a cheap pass over the key."""
    return table.repartitionByRange(key).sortWithinPartitions(key)


def banking_transactions(events: DataFrame) -> DataFrame:
    failed = F.col("event_type") == "error"
    return events.select(
        F.concat(F.lit("B"), F.col("event_id")).alias("txn_id"),
        F.concat(F.lit("A"), F.col("user_id")).alias("account_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.when(failed, "unknown-merchant").otherwise(F.col("event_type")).alias("merchant"),
        "ts",
        (failed & (F.col("value") > 100)).cast("int").alias("is_fraud"),
    )
