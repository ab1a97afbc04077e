"""The registered queries and their DuckDB twins, filled by the modules beside this one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.catalog.twins import twin
from tessera.plans.warehouse import Warehouse, warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}

Query = Callable[[Warehouse], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Report types: money as DOUBLE, dates and times as ISO text."""
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)

    def shown(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, times):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[shown(field) for field in df.schema.fields])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over the warehouse of a folder, and its twin if SQL can say it."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, source_dir: present(build(warehouse(spark, source_dir)))
        if sql is not None:
            TWINS[name] = twin(sql)
        return build

    return register
