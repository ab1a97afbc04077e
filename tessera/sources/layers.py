"""Looking at, counting, rebuilding and appending to layer tables.

A layer is a folder with a log and data folders. Data folders are written once and never changed. Each commit adds one file
to the log: the layer's version and the data folders that make it up. A job that fails or is killed before its commit leaves
an unused folder behind and the version before it readable; a reader that has opened a version goes on reading its folders
while later ones are committed. An append adds a folder to those of the version before, so it copies nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how much of a payload a preview shows.
PREVIEW_CHARS = 140
_LOG = "version bigint, token string, folders array<string>, partition_by array<string>"


@dataclass(frozen=True)
class Version:
    """What one commit made of a layer; number 0 is a layer without a commit."""

    number: int
    folders: tuple[str, ...]
    partition_by: tuple[str, ...] = ()


def layer_versions(spark: SparkSession, path: str) -> DataFrame:
    """The log of a layer: a row per commit."""
    try:
        return spark.read.schema(_LOG).parquet(f"{path}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)


def current_version(spark: SparkSession, path: str) -> Version:
    """The last commit. Writers of one layer take turns; of two commits with one number all readers see the same."""
    last = layer_versions(spark, path).orderBy(F.desc("version"), F.desc("token")).first()
    return Version(last["version"], tuple(last["folders"]), tuple(last["partition_by"])) if last else Version(0, ())


def _commit(spark: SparkSession, path: str, number: int, folders: Sequence[str], partition_by: Sequence[str]) -> Version:
    # One task writes one file, which the job's commit moves into the log as a whole.
    row = [(number, uuid.uuid4().hex, list(folders), list(partition_by))]
    spark.createDataFrame(row, _LOG).coalesce(1).write.mode("append").parquet(f"{path}/log")
    return Version(number, tuple(folders), tuple(partition_by))


def _written(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    folder = f"{path}/data/{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return folder


def open_version(spark: SparkSession, version: Version, schema: T.StructType) -> DataFrame:
    if not version.folders:
        return spark.createDataFrame([], schema)
    # Folders may lie anywhere, so each finds its own partitions.
    if version.partition_by:
        return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(folder) for folder in version.folders])
    return spark.read.schema(schema).parquet(*version.folders)


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current version of a layer with its declared schema; later commits do not change the returned table."""
    return open_version(spark, current_version(spark, path), schema)


def append_layer(df: DataFrame, path: str) -> Version:
    """Add rows to a layer: they become visible at once, and what is there is neither read nor copied."""
    spark, before = df.sparkSession, current_version(df.sparkSession, path)
    folder = _written(df, path, before.partition_by)
    return _commit(spark, path, before.number + 1, [*before.folders, folder], before.partition_by)


def adopt_layer(spark: SparkSession, path: str, folders: Sequence[str], partition_by: Sequence[str] = ()) -> Version:
    """Make a layer of written folders without copying them; appends to it leave those folders as they are."""
    return _commit(spark, path, current_version(spark, path).number + 1, folders, partition_by)


def rebuild_layer(
    df: DataFrame, path: str, cluster_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> Version:
    """Replace a layer by ``df``. Until the new rows are committed as a whole, readers keep the version before.

    ``cluster_by`` sorts rows into key ranges first, so that files can be skipped by
    their statistics; end it with a unique column to let a hot value span several files.
    The ranges come from a first pass over ``df``, so pass a written table then.
    """
    spark = df.sparkSession
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    folder = _written(df, path, partition_by)
    return _commit(spark, path, current_version(spark, path).number + 1, [folder], partition_by)


def unused_folders(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Data folders that none of the last ``keep`` versions holds, for the owner of the storage to drop."""
    log = layer_versions(spark, path).orderBy(F.desc("version"), F.desc("token")).collect()
    held = {folder for row in log[:keep] for folder in row["folders"]}
    return sorted({folder for row in log for folder in row["folders"]} - held)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """``layer, n``; each count reads file statistics or one column."""
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("layer"), "n") for name, df in layers.items()]
    return reduce(DataFrame.unionByName, counted)


# layer -> the order a sample is taken in, newest first where the table has a time; ends with a unique key.
_SAMPLE_ORDER = {
    "bronze": [F.desc, "id"],
    "silver": [F.desc, "sale_ts", "sale_id"],
    "gold_fact": [F.desc, "date_id", "sale_id"],
    "gold_dim_customer": [F.asc, "customer_id"],
    "gold_dim_product": [F.asc, "product_id"],
    "gold_dim_store": [F.asc, "store_id"],
    "gold_dim_date": [F.desc, "date_id"],
}


def sample_retail_layer(layer: str, table: DataFrame, limit: int = 20) -> DataFrame:
    if layer not in _SAMPLE_ORDER:
        raise ValueError(f"unknown layer: {layer}")
    direction, *keys = _SAMPLE_ORDER[layer]
    rows = table.orderBy(*[direction(key) for key in keys]).limit(limit)
    if layer == "bronze":
        rows = rows.select(
            "id", "source_system", "ingested_at", "is_dirty", "dirt_kind",
            F.substring("payload_json", 1, PREVIEW_CHARS).alias("payload_preview"),
        )
    return rows


# The same for the finance layers.
_FINANCE_SAMPLE_ORDER = {
    "concur": [F.desc, "row_id"],
    "card": [F.desc, "row_id"],
    "silver": [F.desc, "txn_date", "txn_id"],
    "gold_spend": [F.asc, "year", "month", "dept_name"],
    "gold_vendors": [F.asc, "pareto_rank"],
}


def sample_finance_layer(layer: str, table: DataFrame, limit: int = 20) -> DataFrame:
    """Newest rows of a feed or of silver, first rows of a mart in reading order."""
    if layer not in _FINANCE_SAMPLE_ORDER:
        raise ValueError(f"unknown finance layer: {layer}")
    direction, *keys = _FINANCE_SAMPLE_ORDER[layer]
    return table.orderBy(*[direction(key) for key in keys]).limit(limit)


def raw_source(feed: DataFrame, limit: int = 25) -> DataFrame:
    """The newest raw rows of one feed."""
    return feed.orderBy(F.desc("row_id")).limit(limit)
