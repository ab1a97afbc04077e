"""JSON sales payloads: making clean ones, and the ways a feed breaks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schemas import PAYLOAD, REQUIRED_KEYS
from tessera.sources.workspace import materialize

# The kinds of dirt an injected batch is labelled with.
SCHEMA_DRIFT = "schema_drift"
DUPES = "dupes"
NULL_FLOOD = "null_flood"
# The feeds the batches come from.
CLEAN_FEED = "pos-retail-v1"
DRIFT_FEED = "pos-retail-v2-BROKEN"
REPLAY_FEED = "pos-retail-v1-replay"
NULL_FEED = "crm-customer-feed"
STREAM_FEED = "pos-stream-v1"


def to_payload(**replaced: Column | None) -> Column:
    """The ten payload fields as JSON text.

    A keyword replaces a field's value; ``None`` leaves the field out; an unknown
    name adds a field. Null values stay in the text as ``null``.
    """
    fields = {key: F.col(key) for key in REQUIRED_KEYS} | replaced
    present = [value.alias(key) for key, value in fields.items() if value is not None]
    return F.to_json(F.struct(*present), {"ignoreNullFields": "false"})


def drifted_payload() -> Column:
    """``amount`` renamed to ``amt``, ``currency`` dropped."""
    return to_payload(
        sale_id=F.concat(F.lit("DRIFT"), F.col("sale_id")),
        amount=None, currency=None, amt=F.col("amount"),
    )


def null_customer_payload() -> Column:
    return to_payload(
        sale_id=F.concat(F.lit("NULLFLOOD"), F.col("sale_id")),
        customer_id=F.lit(None).cast("string"),
    )


def append_bronze(
    rows: DataFrame, source_system: str, ingested_at: Column | str, dirt_kind: str | None = None
) -> DataFrame:
    """``(id, payload_json)`` rows with the lineage columns of the bronze table."""
    return rows.select(
        "id",
        F.lit(source_system).alias("source_system"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("ingested_at"),
        "payload_json",
        F.lit(0 if dirt_kind is None else 1).alias("is_dirty"),
        F.lit(dirt_kind).cast("string").alias("dirt_kind"),
    )


def _pick_clean(bronze: DataFrame, n: int, salt: str) -> DataFrame:
    """``n`` clean rows in an order that looks random and is the same on every run.

    The rows are picked and written before their payloads are parsed: with the parsing above the limit, Spark would sort all
    of bronze instead of keeping the first ``n`` rows of each task.
    """
    first = bronze.filter("is_dirty = 0").orderBy(F.md5(F.concat(F.col("id"), F.lit(salt))), "id").limit(n)
    picked = materialize(first.select("id", "payload_json"), f"picked_{salt}")
    return (
        picked.select(F.concat(F.lit(f"2-{salt}-"), F.col("id")).alias("id"), "payload_json", F.from_json("payload_json", PAYLOAD).alias("p"))
        .select("id", "payload_json", "p.*")
    )


def inject_schema_drift(bronze: DataFrame, ingested_at: Column | str, n: int = 30) -> DataFrame:
    """A batch of ``n`` payloads from a feed that renamed one key and lost another."""
    rows = _pick_clean(bronze, n, "drift").select("id", drifted_payload().alias("payload_json"))
    return append_bronze(rows, DRIFT_FEED, ingested_at, SCHEMA_DRIFT)


def inject_dupes(bronze: DataFrame, ingested_at: Column | str, n: int = 40) -> DataFrame:
    """A batch that repeats the payloads of ``n`` clean rows."""
    rows = _pick_clean(bronze, n, "dupes").select("id", "payload_json")
    return append_bronze(rows, REPLAY_FEED, ingested_at, DUPES)


def inject_nulls(bronze: DataFrame, ingested_at: Column | str, n: int = 25) -> DataFrame:
    """A batch of ``n`` payloads whose ``customer_id`` is null."""
    rows = _pick_clean(bronze, n, "nulls").select("id", null_customer_payload().alias("payload_json"))
    return append_bronze(rows, NULL_FEED, ingested_at, NULL_FLOOD)
