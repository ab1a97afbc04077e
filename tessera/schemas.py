"""Declared schemas of the model tables; readers enforce them instead of inferring."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# The ten keys every sales payload must carry, in payload order.
REQUIRED_KEYS = [
    "sale_id", "customer_id", "product_id", "store_id", "sale_ts",
    "quantity", "unit_price", "amount", "channel", "currency",
]
# The keys that may not be null or empty.
NON_NULL_KEYS = ["customer_id", "product_id", "store_id", "sale_ts"]

PAYLOAD = T.StructType([T.StructField(key, T.StringType()) for key in REQUIRED_KEYS])


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "date": T.DateType(),
    "timestamp": T.TimestampNTZType(), "money": MONEY,
}


def _table(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BRONZE_SALES = _table(
    "id string, source_system string, ingested_at timestamp, payload_json string, is_dirty int, dirt_kind string"
)
SILVER_SALES = _table(
    "sale_id string, customer_id string, product_id string, store_id string, sale_ts timestamp,"
    " quantity int, unit_price money, amount money, channel string, currency string"
)
FACT_SALES = _table(
    "sale_id string, date_id date, customer_id string, product_id string, store_id string,"
    " channel string, quantity int, amount money"
)
DQ_EVENTS = _table(
    "id bigint, layer string, kind string, detail string, rows_affected bigint, created_at timestamp"
)
FIN_SILVER = _table(
    "txn_id string, source string, employee_id string, dept_id string, vendor_id string,"
    " category string, txn_date date, amount_aed money, original_currency string, original_amount money"
)
