"""Streaming forms of the retail ingest steps.

The streams run until their input is used up (``availableNow``) or forever, with the
trigger the caller passes. The batch refresh stays the authority. What a batch writes
lies in a folder of its own, which a repeated batch replaces; views put the folders together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.plans.retail import ACCEPTED, OK, ORPHAN, classify_bronze, first_payloads, stage_gold
from tessera.schemas import BRONZE_SALES, FACT_SALES, SILVER_SALES
from tessera.sources.layers import current_version, open_version, rebuild_layer
from tessera.sources.payloads import STREAM_FEED, append_bronze
from tessera.sources.workspace import materialize, sized

# How many rows one tick may bring.
MIN_TICK, MAX_TICK = 1, 50
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session for stateful streams: one state partition per core, state on disk instead of the heap.

    A batch uploads what it changed in the state, not the state. Ingest times carry no zone; the streams take them as UTC.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    session.conf.set(f"{ROCKSDB}.changelogCheckpointing.enabled", "true")
    # The state and its log are whole rows, on disk: zstd takes less of it than the default codec.
    session.conf.set(f"{ROCKSDB}.compression", "zstd")
    session.conf.set("spark.sql.streaming.stateStore.compression.codec", "zstd")
    return session


def _start(df: DataFrame, checkpoint: str, trigger: dict[str, Any] | None) -> Any:
    return df.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))


def _written(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """What batches have written below ``path``, with the ``batch`` of each row; nothing before the first."""
    fields = T.StructType([*(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields, T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(fields).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)


def _write(rows: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(f"{path}/batch={batch_id}")


def bronze_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE_SALES)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def layer_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The rows of a bronze layer as a stream over its folders."""
    folders = current_version(spark, path).folders
    return reduce(DataFrame.unionByName, [bronze_stream(spark, folder, files_per_trigger) for folder in folders])


def check_tick(n: int) -> int:
    if not MIN_TICK <= n <= MAX_TICK:
        raise ValueError(f"n must be between {MIN_TICK} and {MAX_TICK}")
    return n


def tick_rows(clean: DataFrame, n: int, ingested_at: Column | str) -> DataFrame:
    """One tick: ``n`` valid payloads for bronze, under ids no sale has yet."""
    rows = clean.orderBy(F.md5("id"), "id").limit(check_tick(n)).select(
        F.concat(F.lit("3-"), F.col("id")).alias("id"), "payload_json"
    )
    return append_bronze(rows, STREAM_FEED, ingested_at)


STAGED = T.StructType([
    T.StructField("bronze_id", T.StringType()), *SILVER_SALES.fields,
    T.StructField("payload_json", T.StringType()), T.StructField("copies", T.LongType()), T.StructField("status", T.StringType()),
])


def silver_stream(
    bronze: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Typed sales below ``path``: of each sale the first valid payload by ``id`` of all that have arrived.

    The state holds one row per sale, in RocksDB, without a horizon: a sale may arrive at any time. A batch looks up the
    sales it brings and nothing else, so what it reads and writes follows its own rows, however long the stream has run.
    A payload that comes later but has a smaller ``id`` replaces the sale, as in the batch refresh; each batch writes the
    sales it touched, and ``streamed_silver`` takes the last word on each.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _write(batch, f"{path}/changes", batch_id)

    return _start(first_payloads(bronze), checkpoint, trigger).outputMode("update").foreachBatch(write).start()


def streamed_silver(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The last word on each sale: of the compacted rows and the changes after them.

    ``columns`` names those wanted, if not all; the others are not shuffled.
    """
    base = current_version(spark, f"{path}/base")
    changes = _written(spark, f"{path}/changes", STAGED)
    if base.number:
        compacted = open_version(spark, base, T.StructType([*STAGED.fields, T.StructField("batch", T.LongType()), T.StructField("upto", T.LongType())]))
        upto = compacted.agg(F.max("upto")).first()[0]
        changes = compacted.drop("upto").unionByName(changes.filter(F.col("batch") > F.lit(upto)))
    # A sale is one row per batch that touched it; rows are combined before the shuffle.
    last = changes.groupBy("sale_id").agg(F.max_by(F.struct(*(columns or [*STAGED.names, "batch"])), "batch").alias("last"))
    return last.select("last.*")


def compact_silver(spark: SparkSession, path: str) -> None:
    """Put the changes so far into one sorted table, so that readers go through each sale once; the stream may go on."""
    done = _written(spark, f"{path}/changes", STAGED).agg(F.max("batch")).first()[0]
    if done is None:
        return
    settled = materialize(streamed_silver(spark, path).filter(F.col("batch") <= done).withColumn("upto", F.lit(done).cast("bigint")), "settled")
    rebuild_layer(settled, f"{path}/base", cluster_by=("sale_id",), partition_by=("upto",))


def rejects_stream(bronze: DataFrame) -> DataFrame:
    """Refused payloads with the reason."""
    return classify_bronze(bronze).filter(F.col("status") != OK).select("id", "status", "payload_json")


def append_table(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any] | None = None,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append a stream to a parquet table, exactly once per checkpoint."""
    writer = _start(rows, checkpoint, trigger).format("parquet").option("path", path).outputMode("append")
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


DimsReader = Callable[[], tuple[int, Mapping[str, DataFrame]]]


def dims_reader(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, T.StructType]) -> DimsReader:
    """Reads dimension layers as they are when a batch starts, with a number that grows with every commit to one of them."""

    def read() -> tuple[int, Mapping[str, DataFrame]]:
        versions = {name: current_version(spark, path) for name, path in paths.items()}
        return sum(v.number for v in versions.values()), {name: sized(open_version(spark, v, schemas[name])) for name, v in versions.items()}

    return read


def gold_stream(
    silver: DataFrame, dims: DimsReader, path: str, checkpoint: str, trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Check the keys of arriving sales against the dimensions as each batch finds them.

    A sale with an unknown key waits among the orphans. Once a dimension has changed, the waiting ones are checked again, and
    those that now pass enter the fact with that batch; while none changes, a batch reads its own rows and the dimensions.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version, tables = dims()
        checked = materialize(stage_gold(batch, tables), "checked")
        accepted = checked.filter(F.col("status") == ACCEPTED).select(*FACT_SALES.names)
        before = _written(spark, f"{path}/dims", "version long").filter(F.col("batch") < batch_id)
        seen = before.agg(F.max_by("version", "batch")).first()[0]
        if seen is not None and seen != version:
            waiting = _waiting(spark, path, batch_id).drop("batch").withColumn("sale_ts", F.col("date_id").cast("timestamp_ntz"))
            again = stage_gold(waiting.drop("date_id"), tables)
            accepted = accepted.unionByName(again.filter(F.col("status") == ACCEPTED).select(*FACT_SALES.names))
        _write(accepted, f"{path}/fact", batch_id)
        _write(checked.filter(F.col("status") == ORPHAN).select(*FACT_SALES.names), f"{path}/orphans", batch_id)
        _write(spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1), f"{path}/dims", batch_id)

    return _start(silver, checkpoint, trigger).foreachBatch(write).start()


def _waiting(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Orphans that no batch (before the given one) has accepted since."""
    orphans, facts = _written(spark, f"{path}/orphans", FACT_SALES), streamed_fact(spark, path)
    if before is not None:
        orphans, facts = orphans.filter(F.col("batch") < before), facts.filter(F.col("batch") < before)
    return orphans.join(facts.select("sale_id"), "sale_id", "left_anti")


def streamed_fact(spark: SparkSession, path: str) -> DataFrame:
    return _written(spark, f"{path}/fact", FACT_SALES)


def waiting_orphans(spark: SparkSession, path: str) -> DataFrame:
    """Sales with a key that is still unknown."""
    return _waiting(spark, path)


_COUNTS = "window_start timestamp_ntz, status string, n long"


def live_counts(
    bronze: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any] | None = None,
    width: str = "30 days", delay: str = "60 days",
) -> StreamingQuery:
    """Rows per ingest window and status; a row that comes after its window has closed is counted on the side.

    The clock is the latest ingest time seen. A window closes once the clock is ``delay`` past its end: its counts are written
    for good and leave the state, which holds the open windows only. Nothing is lost: closed, open and late counts add up to
    all rows. A row without an ingest time has no window and counts as late.
    """
    end = F.expr(f"window_start + INTERVAL {width}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        start = F.window(F.col("ingested_at").cast("timestamp"), width)["start"].cast("timestamp_ntz")
        # Without a time there is no window; such rows would fall out of the window expression.
        timed = classify_bronze(batch, "ingested_at").withColumn("known", F.col("ingested_at").isNotNull())
        windows = timed.filter("known").select(start.alias("window_start"), "status", "ingested_at")
        unknown = timed.filter("not known").select(F.lit(None).cast("timestamp_ntz").alias("window_start"), "status", "ingested_at")
        counts = materialize(
            windows.unionByName(unknown).groupBy("window_start", "status").agg(F.count("*").alias("n"), F.max("ingested_at").alias("latest")), "batch_counts"
        )
        before = _written(spark, f"{path}/clock", "clock timestamp_ntz").filter(F.col("batch") < batch_id).agg(F.max("clock").cast("string")).first()[0]
        clock = counts.agg(F.greatest(F.max("latest"), F.lit(before).cast("timestamp_ntz")).cast("string")).first()[0]
        passed, passes = (F.lit(at).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}") for at in (before, clock))
        late = F.col("window_start").isNull() | F.coalesce(end <= passed, F.lit(False))
        opened = _written(spark, f"{path}/open", _COUNTS).filter(F.col("batch") == batch_id - 1).select("window_start", "status", "n")
        on_time = counts.filter(~late).select("window_start", "status", "n")
        merged = materialize(opened.unionByName(on_time).groupBy("window_start", "status").agg(F.sum("n").alias("n")).coalesce(1), "windows")
        closes = F.coalesce(end <= passes, F.lit(False))
        _write(counts.filter(late).select("window_start", "status", "n").coalesce(1), f"{path}/late", batch_id)
        _write(merged.filter(closes), f"{path}/closed", batch_id)
        _write(merged.filter(~closes), f"{path}/open", batch_id)
        _write(spark.range(1).select(F.lit(clock).cast("timestamp_ntz").alias("clock")).coalesce(1), f"{path}/clock", batch_id)

    return _start(bronze, checkpoint, trigger).foreachBatch(write).start()


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of closed windows, and of the open ones as the last batch left them."""
    last = _written(spark, f"{path}/clock", "clock timestamp_ntz").agg(F.max("batch")).first()[0]
    closed, opened = (_written(spark, f"{path}/{part}", _COUNTS) for part in ("closed", "open"))
    return closed.unionByName(opened.filter(F.col("batch") == F.lit(last).cast("long"))).select("window_start", "status", "n")


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came after their window had closed, by that window."""
    return _written(spark, f"{path}/late", _COUNTS).groupBy("window_start", "status").agg(F.sum("n").alias("n"))
