"""Ad-hoc SQL over the layers, and profiles of a result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.money import money_text
from tessera.functions.sqltext import OK, sql_verdict
from tessera.plans.warehouse import Warehouse

MAX_ROWS = 500
TOP_ROWS = 5
# A trend is called from these ratios of the last to the first value.
RISING = 1.15
FALLING = 0.85
TREND_ROWS = 3
# A number whose name holds one of these words is an amount.
AMOUNT_WORDS = ("aed", "amount", "spend", "total", "sum")
DATE_TEXT = r"^\d{4}-\d{2}(-\d{2})?(T\d{2}:\d{2})?"


def top_products(fact: DataFrame, products: DataFrame, limit: int = 5) -> DataFrame:
    """The product names with the highest revenue; sales are summed per product before names are joined."""
    sold = fact.groupBy("product_id").agg(F.sum("amount").alias("revenue"), F.sum("quantity").alias("units"))
    named = sold.join(products.select("product_id", "name", "category"), "product_id").groupBy("name", "category").agg(
        F.sum("revenue").alias("revenue"), F.sum("units").alias("units")
    )
    return named.orderBy(F.desc("revenue"), "name", "category").limit(limit)


def revenue_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    sold = fact.groupBy("product_id").agg(F.sum("amount").alias("revenue"), F.count("*").alias("sales"))
    return sold.join(products.select("product_id", "category"), "product_id").groupBy("category").agg(
        F.sum("sales").alias("sales"), F.sum("revenue").alias("revenue")
    )


def dirty_by_kind(bronze: DataFrame) -> DataFrame:
    return bronze.filter("is_dirty = 1").groupBy("dirt_kind").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class SqlResult:
    rows: DataFrame
    truncated: DataFrame


def run_sql(spark: SparkSession, sql: str, max_rows: int = MAX_ROWS) -> SqlResult:
    """The first ``max_rows`` rows of a query, and whether it had more; a refused text raises its verdict and never runs."""
    verdict = spark.range(1).select(sql_verdict(F.lit(sql))).first()[0]
    if verdict != OK:
        raise ValueError(verdict)
    probe = spark.sql(sql.strip().rstrip(";")).limit(max_rows + 1)
    truncated = probe.agg(
        F.least(F.count("*"), F.lit(max_rows)).alias("row_count"), (F.count("*") > max_rows).alias("truncated")
    )
    return SqlResult(probe.limit(max_rows), truncated)


def run_on_layers(warehouse: Warehouse, sql: str) -> SqlResult:
    """The same over the layer tables of a warehouse."""
    warehouse.register_views(sql)
    return run_sql(warehouse.spark, sql)


@dataclass(frozen=True)
class Roles:
    text: list[str]
    number: list[str]
    date: list[str]


def date_texts(df: DataFrame) -> tuple[str, ...]:
    """The text columns whose values all look like ISO dates; one aggregate over the result."""
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]
    if not texts:
        return ()
    row = df.agg(*[F.bool_and(F.coalesce(F.col(name).rlike(DATE_TEXT), F.lit(False))).alias(name) for name in texts]).first()
    return tuple(name for name in texts if row[name])


def column_roles(df: DataFrame, date_columns: tuple[str, ...] | None = None) -> Roles:
    """Roles from the schema; text columns that hold ISO dates are looked for unless named."""
    date_columns = date_texts(df) if date_columns is None else date_columns
    roles = Roles([], [], [])
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NumericType):
            roles.number.append(field.name)
        elif field.name in date_columns or isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            roles.date.append(field.name)
        else:
            roles.text.append(field.name)
    return roles


def result_profile(df: DataFrame, date_columns: tuple[str, ...] | None = None) -> DataFrame:
    """The chart that suits a result, with the columns it would show, as one row."""
    roles = column_roles(df, date_columns)
    texts, numbers, dates = roles.text, roles.number, roles.date
    n = F.col("row_count")

    def first(names: list[str]) -> Column:
        return F.lit(names[0] if names else None).cast("string")

    if len(dates) == 1 and numbers and not texts:
        many = ("area", dates, numbers, [])
    elif len(texts) == 1 and len(numbers) >= 2:
        many = ("composed", texts, numbers, numbers[1:])
    elif len(texts) == 1 and len(numbers) == 1:
        many = ("bar", texts, numbers, [])
    else:
        many = ("table", [], [], [])
    kind = F.lit(many[0])
    if many[0] == "bar":
        kind = F.when(n.between(2, 6), "donut").otherwise("bar")
    single = ("stat", texts, numbers, []) if numbers else ("table", [], [], [])

    def pick(one: Column, more: Column) -> Column:
        return F.when(n == 1, one).when(n > 1, more)

    return df.agg(F.count("*").alias("row_count")).select(
        n,
        F.coalesce(pick(F.lit(single[0]), kind), F.lit("empty")).alias("chart"),
        pick(first(single[1]), first(many[1])).alias("label_col"),
        pick(first(single[2]), first(many[2])).alias("value_col"),
        pick(first(single[3]), first(many[3])).alias("secondary_col"),
    )


def value_text(df: DataFrame, column: str) -> Column:
    """How a value reads in a narrative."""
    name, kind = column.lower(), df.schema[column].dataType
    if not isinstance(kind, T.NumericType):
        shown = F.col(column).cast("string")
    elif any(word in name for word in ("aed", "amount", "spend")):
        shown = money_text(F.col(column))
    elif isinstance(kind, T.IntegralType):
        shown = F.format_number(column, 0)
    else:
        shown = F.format_number(column, 2)
    return F.coalesce(shown, F.lit("—"))


def result_highlights(
    df: DataFrame, order_by: tuple[str, ...] = (), date_columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Row count, the five largest rows by the first number, their share, and the trend, as one row.

    ``order_by`` ends with a unique column and breaks ties among the largest.
    """
    roles = column_roles(df, date_columns)
    if not roles.number:
        return df.agg(F.count("*").alias("row_count")).select(
            "row_count", F.lit(None).cast("string").alias("top"), F.lit(None).cast("double").alias("top_share_pct"),
            F.lit(None).cast("string").alias("total_text"), F.lit(None).cast("string").alias("trend"),
        )
    number = roles.number[0]
    label = (roles.text or roles.date or [None])[0]
    value = F.coalesce(F.col(number).cast("decimal(38,2)"), F.lit(0))
    named = F.col(label).cast("string") if label else F.lit("row")
    bullet = F.concat(named, F.lit(" — "), value_text(df, number))
    if len(roles.number) > 1:
        second = roles.number[1]
        bullet = F.concat(bullet, F.lit(f" · {second}: "), value_text(df, second))
    top = df.orderBy(value.desc(), *order_by).limit(TOP_ROWS).select(
        F.struct((-value).alias("v"), *[F.col(c) for c in order_by], bullet.alias("text")).alias("row"), value.alias("v")
    ).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("row")), lambda r: r["text"]), "\n").alias("top"),
        F.sum("v").alias("top_total"),
    )
    day = F.col(roles.date[0]) if roles.date else F.lit(None)
    whole = df.agg(
        F.count("*").alias("row_count"), F.sum(value).alias("total"),
        F.min_by(value, day).cast("double").alias("first"), F.max_by(value, day).cast("double").alias("last"),
    )
    joined = whole.select("*", top.select(F.struct("top", "top_total")).scalar().alias("t"))
    money = any(word in number.lower() for word in AMOUNT_WORDS)
    total = F.col("total").cast("double")
    share = F.when((total != 0) & (F.col("row_count") > TOP_ROWS), F.round(F.col("t.top_total").cast("double") / total * 100, 0))
    enough = F.lit(bool(roles.date)) & (F.col("row_count") >= TREND_ROWS)
    trend = F.when(enough & (F.col("last") > F.col("first") * RISING), "rising").when(
        enough & (F.col("last") < F.col("first") * FALLING), "falling")
    return joined.select(
        "row_count",
        F.when(F.col("row_count") > 0, F.col("t.top")).alias("top"),
        (share if money else F.lit(None).cast("double")).alias("top_share_pct"),
        (money_text(F.col("total")) if money else F.lit(None).cast("string")).alias("total_text"),
        trend.alias("trend"),
    )
