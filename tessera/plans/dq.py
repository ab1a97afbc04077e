"""The data-quality event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schemas import DQ_EVENTS
from tessera.sources.layers import append_layer

# Per counter the layer, the event kind and the text around the count.
SILVER_EVENTS = [
    ("dropped_schema", "silver", "schema_drift", "dropped ", " rows with malformed/missing keys"),
    ("quarantined_nulls", "silver", "null_flood", "quarantined ", " rows with NULL keys"),
    ("quarantined_dupes", "silver", "dupes", "quarantined ", " duplicate sale_id rows"),
    ("bad_type", "silver", "bad_type", "quarantined ", " rows with uncastable values"),
]
GOLD_EVENTS = [
    ("orphaned_fk", "gold", "orphaned_fk", "rejected ", " rows with unknown dim keys"),
]
FINANCE_EVENTS = [
    ("bad_dates", "finance", "bad_date_format", "dropped ", " rows with unparseable dates"),
    ("vendor_misses", "finance", "vendor_unmatched", "", " rows landed in Silver with NULL vendor_id"),
    ("orphan_employee", "finance", "orphan_employee", "quarantined ", " rows with missing/unknown employee"),
]
# Ids leave room for this many events per run, so a later run sorts after an earlier one.
EVENTS_PER_RUN = 10


def dq_events(
    counts: DataFrame, kinds: Sequence[tuple[str, str, str, str, str]], created_at: Column | str, first_id: int = 1
) -> DataFrame:
    """One event per counter that is not zero, from a one-row summary."""
    entries = F.array(*[
        F.struct(
            F.lit(first_id + i).cast("bigint").alias("id"),
            F.lit(layer).alias("layer"),
            F.lit(kind).alias("kind"),
            F.concat(F.lit(before), F.col(counter), F.lit(after)).alias("detail"),
            F.col(counter).cast("bigint").alias("rows_affected"),
        )
        for i, (counter, layer, kind, before, after) in enumerate(kinds)
    ])
    return (
        counts.select(F.inline(entries))
        .filter("rows_affected > 0")
        .withColumn("created_at", F.lit(created_at).cast("timestamp_ntz"))
        .select(*DQ_EVENTS.names)
    )


def log_events(
    log_path: str, counts: DataFrame, kinds: Sequence[tuple[str, str, str, str, str]], created_at: Column | str, run: int
) -> None:
    """Append a run's events to the log. Nothing ever clears it; ``run`` orders the runs."""
    append_layer(dq_events(counts, kinds, created_at, run * EVENTS_PER_RUN + 1), log_path)


def recent_events(log: DataFrame, limit: int = 20) -> DataFrame:
    """The newest events first."""
    return log.orderBy(F.desc("id")).limit(limit).select("layer", "kind", "detail", "rows_affected", "created_at")
