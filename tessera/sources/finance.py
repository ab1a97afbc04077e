"""Finance model tables from the given parquet tables: two messy feeds and three dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expense_claims(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One claim per order: mixed currencies, date formats and merchant spellings.

    The merchant is the lowest supplier key on the order; an order without lines has none.
    """
    merchants = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("suppkey"))
    status, priority, total = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    day = F.col("o_orderdate").cast("date")
    key = F.col("suppkey").cast("string")
    quarter = F.quarter(day)
    return orders.join(merchants, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("row_id"),
        F.when(total > 499000, "E-left").otherwise(F.concat(F.lit("E"), F.col("o_custkey"))).alias("employee_id"),
        F.when(priority == "1-URGENT", "Travel").when(priority == "2-HIGH", "Meals")
        .when(priority == "3-MEDIUM", "Software").when(priority == "5-LOW", "Office").alias("category"),
        F.when(total < 4000, "unknown shop xyz").when(total < 5000, "splr*")
        .when(status == "F", F.concat(F.lit("Supplier#"), F.lpad(key, 9, "0")))
        .when(status == "O", F.concat(F.lit("  s"), key, F.lit(" ONLINE")))
        .otherwise(F.concat(F.lit("POS SPLR*"), key, F.lit(" DUBAI"))).alias("merchant"),
        total.cast("decimal(18,2)").alias("amount"),
        F.when(priority == "2-HIGH", "USD")
        .when((priority == "1-URGENT") & (status == "P"), "EUR").otherwise("AED").alias("currency"),
        F.when(total < 3000, "not a date").when(quarter == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(quarter == 2, F.date_format(day, "dd/MM/yyyy"))
        .when((quarter == 3) & (status == "P") & (F.year(day) < 2001), F.date_format(day, "MM/dd/yyyy"))
        .when(quarter == 3, F.date_format(day, "MM-dd-yyyy"))
        .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:15:00"))).alias("submitted_date"),
        F.concat(F.lit("receipt/"), F.col("o_orderkey")).alias("receipt_url"),
    )


def corporate_card(events: DataFrame) -> DataFrame:
    """One card line per event, moved back 270 months to meet the claims."""
    kind, value = F.col("event_type"), F.col("value")
    return events.select(
        F.col("event_id").alias("row_id"),
        F.lpad(F.col("user_id").cast("string"), 4, "0").alias("card_last4"),
        F.when((kind == "signup") & (value < 20), F.lit(None))
        .when((kind == "error") & (value > 200), "E-left")
        .otherwise(F.concat(F.lit("E"), F.col("user_id"))).alias("employee_id"),
        F.concat(F.lit("SPLR*"), F.get_json_object("props", "$.k"), F.lit(" "), F.upper(kind)).alias("vendor_str"),
        value.cast("decimal(18,2)").alias("amount_usd"),
        F.date_format(F.add_months(F.col("ts").cast("date"), -270), "yyyy-MM-dd").alias("posted_date"),
    )


def departments(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.concat(F.lit("D-"), F.col("c_mktsegment")).alias("dept_id"),
        F.col("c_mktsegment").alias("dept_name"),
    ).distinct()


def employees(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.concat(F.lit("E"), F.col("c_custkey")).alias("employee_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lit("D-"), F.col("c_mktsegment")).alias("dept_id"),
    )


def vendors(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Vendors with three alias spellings each, as a JSON array text."""
    key, region = F.col("s_suppkey").cast("string"), F.col("n_regionkey")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("V"), F.lpad(key, 12, "0")).alias("vendor_id"),
        F.col("s_name").alias("canonical_name"),
        F.when(region == 0, "Travel").when(region == 1, "Meals").when(region == 2, "Software")
        .when(region == 3, "Marketing").otherwise("Utilities").alias("category"),
        F.to_json(F.array(
            F.concat(F.lit("SPLR*"), key), F.concat(F.lit("SUPPLIER "), key, F.lit(" LLC")),
            F.concat(F.lit("S"), key, F.lit(" ONLINE")),
        )).alias("aliases_json"),
    )
