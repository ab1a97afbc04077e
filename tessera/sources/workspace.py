"""Where intermediate tables live.

Everything written goes below the shared folder the session names in
``spark.checkpoint.dir``, so any executor can read it back after another is lost.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    already_set = context._jsc.sc().getCheckpointDir()
    if already_set.isDefined():
        return already_set.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
    return context._jsc.sc().getCheckpointDir().get()


def new_path(spark: SparkSession, label: str) -> str:
    """A path that no other run uses, below the shared folder's part for this application.

    That part can be dropped as a whole once the application has ended.
    """
    return f"{shared_dir(spark)}/tessera/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{label}"


def materialize(
    df: DataFrame, label: str, partition_by: Sequence[str] = (), path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` as a parquet table and read it back: cuts the lineage, keeps statistics."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    writer = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A broadcast takes some hundred bytes of the driver for each of its rows, whatever the files take; a table with more rows is none.
BROADCAST_ROWS = 500_000


def sized(table: DataFrame) -> DataFrame:
    """A written table as a side of joins; one of many rows is dealt out by key there, never broadcast.

    Spark judges a written table by its files, where sorted or repeating keys take a few bytes a row: millions of rows look small
    enough to go through the driver. The rows are counted from the footers of the files.
    """
    return table.hint("merge") if table.count() > BROADCAST_ROWS else table


def spread(df: DataFrame) -> DataFrame:
    """Use every core for the costly work ahead of a scan that has fewer splits than that.

    A large input has more splits than cores and passes through unshuffled. Pass a scan
    with projections and filters only: counting the splits of a join would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
