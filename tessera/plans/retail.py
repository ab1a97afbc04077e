"""Retail refresh: raw payloads -> typed, distinct sales -> star-schema fact."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import FACT_SALES, MONEY, NON_NULL_KEYS, PAYLOAD, REQUIRED_KEYS, SILVER_SALES
from tessera.sources.workspace import materialize, sized

# The counters of the refresh summary.
OK = "parsed_ok"
DROPPED = "dropped_schema"
NULLS = "quarantined_nulls"
DUPES = "quarantined_dupes"
BAD_TYPE = "bad_type"
ACCEPTED = "gold_inserted"
ORPHAN = "orphaned_fk"


def parsed_payload(text: str) -> Column:
    """``payload``, and ``whole`` if the text is one JSON object and nothing else.

    The parser stops behind the first object, so the text is read as a field of a larger one: text behind the object, or
    single quotes, leave the field after it unread.
    """
    wrapped = F.concat(F.lit('{"payload":'), text, F.lit(',"whole":true}'))
    schema = T.StructType([T.StructField("payload", PAYLOAD), T.StructField("whole", T.BooleanType())])
    return F.from_json(wrapped, schema, {"allowSingleQuotes": "false"})


def classify_bronze(bronze: DataFrame, *carry: str) -> DataFrame:
    """Parse each payload and say whether it may enter silver; nothing is removed.

    ``carry`` names further bronze columns to keep.
    """
    # Exploded from an array of one: a filter on the status is not pushed below it, where each payload would be parsed again.
    parsed = bronze.select(
        "id", *carry, "payload_json", F.explode(F.array(parsed_payload("payload_json"))).alias("p")
    )
    required = F.array(*[F.lit(key) for key in REQUIRED_KEYS])
    keys = F.json_object_keys("payload_json")
    # Ten values from a text with one brace had ten keys; only other texts are read again for their keys.
    given = F.locate("{", F.col("payload_json"), 2) == 0
    for key in REQUIRED_KEYS:
        given = given & F.col(f"p.payload.{key}").isNotNull()
    missing = F.when(F.coalesce(given, F.lit(False)), F.lit(False)).otherwise(keys.isNull() | (F.size(F.array_except(required, keys)) > 0))
    incomplete = ~F.coalesce(F.col("p.whole"), F.lit(False)) | missing
    blank = F.lit(False)
    for key in NON_NULL_KEYS:
        blank = blank | (F.coalesce(F.col(f"p.payload.{key}"), F.lit("")) == "")
    status = F.when(incomplete, DROPPED).when(blank, NULLS).otherwise(OK)
    return parsed.select("id", *carry, status.alias("status"), "p.payload.*", "payload_json")


def _typed(rows: DataFrame) -> DataFrame:
    """Text fields to silver types; a value that cannot be cast becomes NULL."""
    return rows.withColumns({
        "sale_ts": F.col("sale_ts").try_cast("timestamp_ntz"),
        "quantity": F.col("quantity").try_cast("double").try_cast("int"),
        "unit_price": F.col("unit_price").try_cast(MONEY),
        "amount": F.col("amount").try_cast(MONEY),
    })


def _uncastable() -> Column:
    return F.col("sale_ts").isNull() | F.col("quantity").isNull() | F.col("unit_price").isNull() | F.col("amount").isNull()


def _bad_types_marked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("status", F.when((F.col("status") == OK) & _uncastable(), BAD_TYPE).otherwise(F.col("status")))


def cast_typed(rows: DataFrame) -> DataFrame:
    """Classified rows in silver types; a valid row with an uncastable number or time becomes ``bad_type``."""
    return _bad_types_marked(_typed(rows))


def stage_silver(bronze: DataFrame) -> DataFrame:
    """Silver rows and quarantined rows of one pass over bronze, told apart by ``status``.

    Of the payloads with one ``sale_id`` the first by ``id`` stays and ``copies`` counts
    them all. The minimum is combined before the shuffle, so a repeated id costs one row
    per map task. Refused payloads group by their own id and keep their text.
    """
    typed = _typed(classify_bronze(bronze))
    good = F.col("status") == OK
    refused_text = F.when(~good | _uncastable(), F.col("payload_json"))
    # The struct is made ahead of the aggregate, which sorts its input: the text of a good row must not be sorted with it.
    keyed = typed.select(
        "status", F.when(good, F.col("sale_id")).otherwise(F.col("id")).alias("_key"),
        F.struct("id", *REQUIRED_KEYS, refused_text.alias("payload_json")).alias("first"),
    )
    winners = (
        keyed.groupBy("status", "_key").agg(F.min("first").alias("first"), F.count("*").alias("copies"))
        .select("status", "first.*", "copies")
    )
    return _bad_types_marked(winners).withColumnRenamed("id", "bronze_id")


def first_payloads(bronze: DataFrame) -> DataFrame:
    """The silver part of ``stage_silver`` alone, as one aggregate by sale, which a stream can keep as state."""
    typed = _typed(classify_bronze(bronze)).filter(F.col("status") == OK)
    first = F.struct("id", *REQUIRED_KEYS, F.when(_uncastable(), F.col("payload_json")).alias("payload_json"))
    winners = typed.select("sale_id", first.alias("first")).groupBy("sale_id").agg(F.min("first").alias("first"), F.count("*").alias("copies"))
    marked = _bad_types_marked(winners.select(F.lit(OK).alias("status"), "first.*", "copies"))
    return marked.select(F.col("id").alias("bronze_id"), *SILVER_SALES.names, "payload_json", "copies", "status")


def silver_changes(silver: DataFrame, bronze: DataFrame, batches: Mapping[str, DataFrame]) -> DataFrame:
    """Per batch, how many rows ``silver`` and the silver of bronze with that batch do not share, repeats counted.

    ``batch, violations``, one row per batch. Bronze is parsed and shuffled once for all batches: a sale keeps its first payload
    of bronze and that of each batch, and the lesser of the two is what the refresh with the batch would keep.
    """
    names = list(batches)
    tagged = bronze.withColumn("batch", F.lit(-1))
    for i, name in enumerate(names):
        tagged = tagged.unionByName(batches[name].withColumn("batch", F.lit(i)))
    typed = _typed(classify_bronze(tagged, "batch")).filter(F.col("status") == OK)
    # Never null, so that sales and silver rows meet by plain equality, where the sales already lie.
    met_by = F.coalesce(F.concat(F.lit("="), F.col("sale_id")), F.lit("")).alias("_key")
    keyed = typed.select("batch", met_by, F.struct("id", *REQUIRED_KEYS).alias("first"))
    of = lambda i: F.min(F.when(F.col("batch") == i, F.col("first")))
    firsts = keyed.groupBy("_key").agg(of(-1).alias("bronze"), *[of(i).alias(f"batch{i}") for i in range(len(names))])
    for i in range(len(names)):
        first = F.least("bronze", f"batch{i}")
        castable = F.lit(True)
        for key in ("sale_ts", "quantity", "unit_price", "amount"):
            castable = castable & first[key].isNotNull()
        row = F.struct(*[first[key].alias(key) for key in SILVER_SALES.names])
        firsts = firsts.withColumn(f"after{i}", F.when(first.isNotNull() & castable, row))
    before = silver.select(met_by, F.struct(*SILVER_SALES.names).alias("before"))
    per_sale = before.join(firsts, "_key", "full").groupBy("_key").agg(
        F.count("before").alias("rows"),
        *[F.count_if(F.col("before").isNotNull() & F.col("before").eqNullSafe(F.col(f"after{i}"))).alias(f"same{i}") for i in range(len(names))],
        *[F.max(F.col(f"after{i}").isNotNull().cast("int")).alias(f"kept{i}") for i in range(len(names))],
    )
    uneven = [F.sum(F.col("rows") - F.col(f"same{i}") + F.abs(F.col(f"same{i}") - F.col(f"kept{i}"))) for i in range(len(names))]
    sums = per_sale.agg(F.array(*[F.coalesce(total, F.lit(0)).cast("bigint") for total in uneven]).alias("sums"))
    labels = F.array(*[F.lit(name) for name in names])
    return sums.select(F.explode(F.arrays_zip(labels.alias("batch"), F.col("sums").alias("violations"))).alias("row")).select("row.*")


def silver_of(staged: DataFrame, *carry: str) -> DataFrame:
    """Silver rows; ``carry`` names further columns to keep."""
    return staged.filter(F.col("status") == OK).select(*carry, *SILVER_SALES.names)


def quarantine_of(staged: DataFrame) -> DataFrame:
    """Refused payloads with the reason."""
    return staged.filter(F.col("status") != OK).select(F.col("bronze_id").alias("id"), "status", "sale_id", "payload_json")


def duplicate_rows(classified: DataFrame, staged: DataFrame) -> DataFrame:
    """The valid payloads that lost to an earlier one with the same ``sale_id``.

    Silver says which sales came more than once; only these are met, never the ids of all of silver. Written first, they are
    broadcast if they are few, and else dealt out with the valid rows by sale. Valid rows are never broadcast.
    """
    repeated = sized(materialize(
        staged.filter(F.col("status").isin(OK, BAD_TYPE) & (F.col("copies") > 1))
        .select(F.col("sale_id").alias("_sale"), F.col("bronze_id").alias("_first")), "repeated_sales"
    ))
    lost = F.col("sale_id").eqNullSafe(F.col("_sale")) & (F.col("id") != F.col("_first"))
    return classified.filter(F.col("status") == OK).join(repeated, lost, "left_semi")


def silver_counts(staged: DataFrame) -> DataFrame:
    """The refresh summary as one row."""

    def rows(status: str) -> Column:
        return F.count_if(F.col("status") == status).alias(status)

    return staged.agg(
        rows(OK), rows(DROPPED), rows(NULLS),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias(DUPES),
        rows(BAD_TYPE),
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("bronze_total"),
    )


def stage_gold(silver: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows with ``status``: accepted, or orphan if any of the four keys is unknown.

    No hint: Spark broadcasts the dimensions its size estimate allows, and splits skewed
    partitions of the others at run time.
    """
    rows = silver.withColumn("date_id", F.to_date("sale_ts"))
    known = F.lit(True)
    for table, key in (
        ("gold_dim_date", "date_id"), ("gold_dim_store", "store_id"),
        ("gold_dim_product", "product_id"), ("gold_dim_customer", "customer_id"),
    ):
        rows = rows.join(dims[table].select(key, F.lit(1).alias(f"_{key}")), key, "left")
        known = known & F.col(f"_{key}").isNotNull()
    return rows.select(
        *FACT_SALES.names, F.when(known, ACCEPTED).otherwise(ORPHAN).alias("status")
    )


_GROWING_DIMS = {"gold_dim_store": "store_id", "gold_dim_product": "product_id", "gold_dim_customer": "customer_id"}


def gold_by_date(silver: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """``stage_gold`` in the order of the date, so that a date filter skips files and row groups of the fact.

    The ranges are cut on silver, ahead of the checks: pass a written table, and dimensions with unique keys. Distinct keys are
    checked first, and the unknown ones, which are few, are written; so the rows are not dealt anew by the keys of dimensions
    too large to broadcast. Where the unknown keys are many, Spark shuffles, which costs the order, not a row.
    """
    ranged = silver.repartitionByRange("sale_ts", "sale_id").withColumn("date_id", F.to_date("sale_ts"))
    rows = ranged.join(dims["gold_dim_date"].select("date_id", F.lit(1).alias("_date")), "date_id", "left")
    known = F.col("_date").isNotNull()
    strangers = sized(materialize(reduce(DataFrame.unionByName, [
        silver.filter(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
        .join(dims[table].select(F.col(key).alias("key")), "key", "left_anti").select(F.lit(key).alias("of"), "key")
        for table, key in _GROWING_DIMS.items()
    ]), "unknown_keys"))
    for key in _GROWING_DIMS.values():
        rows = rows.join(strangers.filter(F.col("of") == key).select(F.col("key").alias(key), F.lit(1).alias(f"_no_{key}")), key, "left")
        known = known & F.col(key).isNotNull() & F.col(f"_no_{key}").isNull()
    staged = rows.select(*FACT_SALES.names, F.when(known, ACCEPTED).otherwise(ORPHAN).alias("status"))
    return staged.sortWithinPartitions("status", "date_id", "sale_id")


def fact_of(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("status") == ACCEPTED).select(*FACT_SALES.names)


def star_from_sales(sales: DataFrame) -> DataFrame:
    """The fact projection of clean sales, without a key check."""
    return sales.withColumn("date_id", F.to_date("sale_ts")).select(*FACT_SALES.names)


def gold_counts(staged: DataFrame) -> DataFrame:
    return staged.agg(
        F.count_if(F.col("status") == ACCEPTED).alias(ACCEPTED),
        F.count_if(F.col("status") == ORPHAN).alias(ORPHAN),
        F.count("*").alias("silver_total"),
    )
