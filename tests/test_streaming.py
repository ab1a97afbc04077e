"""Streams against the batch refresh: many batches, late and repeated payloads, changing dimensions, closed windows."""

from __future__ import annotations

import datetime as dt
import json
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import quality, retail
from tessera.schemas import BRONZE_SALES, REQUIRED_KEYS, SILVER_SALES
from tessera.sources import layers
from tessera.sources.payloads import append_bronze
from tessera.sources.workspace import new_path
from tessera.streaming import retail as streams


def sale(sale_id, **changed):
    row = dict.fromkeys(REQUIRED_KEYS, "1") | {"sale_id": sale_id, "sale_ts": "2026-04-21T10:00:00", "store_id": "S1"} | changed
    return json.dumps(row)


def bronze(spark, items, first=0, at="2026-04-21 12:00:00"):
    rows = spark.createDataFrame([(f"0-{first + i:06d}", text) for i, text in enumerate(items)], "id string, payload_json string")
    return append_bronze(rows, "test", at)


def run_silver(spark, arriving, sink, checkpoint, files=None):
    session = streams.streaming_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    query = streams.silver_stream(streams.bronze_stream(session, arriving, files), sink, checkpoint)
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"]]


def test_silver_equals_batch(spark):
    items = [sale(f"S{i % 40}", customer_id=f"C{i}") for i in range(120)] + ['{"broken', sale("N", customer_id=None), sale("B", quantity="x")]
    rows, arriving = bronze(spark, items), new_path(spark, "arriving")
    # Files in no order of ids: a later batch may hold the first payload of a sale.
    rows.repartition(6, F.xxhash64("id")).write.parquet(arriving)
    sink, checkpoint = new_path(spark, "silver"), new_path(spark, "checkpoint")
    assert len(run_silver(spark, arriving, sink, checkpoint, files=2)) == 3

    def agrees(rows):
        got, want = streams.streamed_silver(spark, sink), retail.stage_silver(rows).filter(F.col("status").isin(retail.OK, retail.BAD_TYPE))
        columns = ["bronze_id", "copies", "status", *SILVER_SALES.names]
        assert quality.same_rows(want.select(*columns), got.select(*columns), "x").first().violations == 0

    agrees(rows)
    # Rows already seen are not read again; late copies are known, a smaller id replaces its sale, a castable copy a bad one.
    late = bronze(spark, [sale("S1", customer_id="late"), sale("NEW")], first=900_000)
    earlier = bronze(spark, [sale("S2", customer_id="first"), sale("B", quantity="3")]).withColumn("id", F.concat(F.lit("+"), "id"))
    rows = rows.unionByName(late).unionByName(earlier)
    late.unionByName(earlier).withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 5 YEARS")).write.mode("append").parquet(arriving)
    streams.compact_silver(spark, sink)
    run_silver(spark, arriving, sink, checkpoint)
    agrees(rows)
    streams.compact_silver(spark, sink)
    agrees(rows)
    assert streams.streamed_silver(spark, sink).filter("sale_id = 'S2'").first().customer_id == "first"


def test_batches_stay_flat(spark):
    """Each of fifty batches looks up and writes its own sales only."""
    arriving, sink, checkpoint = (new_path(spark, label) for label in ("arriving", "silver", "checkpoint"))
    items = [sale(f"S{i % 700}") for i in range(1000)]
    bronze(spark, items).repartition(50, F.xxhash64("id")).write.option("maxRecordsPerFile", 1000).parquet(arriving)
    progress = run_silver(spark, arriving, sink, checkpoint, files=1)
    assert len(progress) >= 45
    for p in progress:
        assert p["stateOperators"][0]["numRowsUpdated"] <= p["numInputRows"]
        assert p["stateOperators"][0]["customMetrics"]["rocksdbGetCount"] <= 2 * p["numInputRows"]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 700
    written = spark.read.parquet(f"{sink}/changes").groupBy("batch").count().agg(F.max("count")).first()[0]
    assert written <= max(p["numInputRows"] for p in progress)
    assert streams.streamed_silver(spark, sink).count() == 700


def test_layer_stream_follows_appends_without_copies(spark):
    held, path = new_path(spark, "held"), new_path(spark, "layer")
    bronze(spark, [sale("A"), sale("B")]).write.parquet(held)
    layers.adopt_layer(spark, path, [held])
    tick = streams.tick_rows(layers.read_layer(spark, path, BRONZE_SALES), 1, "2026-04-21 12:00:00")
    version = layers.append_layer(tick, path)
    assert version.folders[0] == held and len(version.folders) == 2
    out, checkpoint = new_path(spark, "out"), new_path(spark, "checkpoint")
    streams.append_table(streams.layer_stream(streams.streaming_session(spark), path), out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def dim(spark, key, values, cast="string"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(key, T.StringType())])).withColumn(key, F.col(key).cast(cast))


def test_orphans_enter_the_fact_once_their_key_arrives(spark):
    tables = {
        "gold_dim_store": dim(spark, "store_id", ["S1"]), "gold_dim_product": dim(spark, "product_id", ["1"]),
        "gold_dim_customer": dim(spark, "customer_id", ["1"]), "gold_dim_date": dim(spark, "date_id", ["2026-04-21"], "date"),
    }
    paths = {name: new_path(spark, name) for name in tables}
    for name, table in tables.items():
        layers.rebuild_layer(table, paths[name])
    reader = streams.dims_reader(spark, paths, {name: table.schema for name, table in tables.items()})
    arriving, path, checkpoint = (new_path(spark, label) for label in ("silver", "gold", "checkpoint"))

    def arrive(*items):
        silver = retail.silver_of(retail.stage_silver(bronze(spark, items)))
        silver.coalesce(1).write.mode("append").parquet(arriving)
        rows = streams.streaming_session(spark).readStream.schema(SILVER_SALES).parquet(arriving)
        streams.gold_stream(rows, reader, path, checkpoint).awaitTermination()
        facts = sorted(r.sale_id for r in streams.streamed_fact(spark, path).collect())
        return facts, sorted(r.sale_id for r in streams.waiting_orphans(spark, path).collect())

    assert arrive(sale("A"), sale("late", store_id="S2"), sale("never", store_id="S9")) == (["A"], ["late", "never"])
    assert arrive(sale("B")) == (["A", "B"], ["late", "never"])
    layers.append_layer(dim(spark, "store_id", ["S2"]), paths["gold_dim_store"])
    assert arrive(sale("C", store_id="S2")) == (["A", "B", "C", "late"], ["never"])
    assert arrive(sale("D")) == (["A", "B", "C", "D", "late"], ["never"])
    row = streams.streamed_fact(spark, path).filter("sale_id = 'late'").first()
    assert row.date_id == dt.date(2026, 4, 21) and row.batch == 2


def test_windows_close_and_late_rows_are_counted_aside(spark):
    arriving, path, checkpoint = (new_path(spark, label) for label in ("bronze", "counts", "checkpoint"))
    parts = [("2026-01-05", 3), ("2026-01-20", 2), ("2026-03-01", 4), ("2026-01-06", 5), (None, 1), ("2026-03-02", 1)]
    open_windows = []
    for i, (day, n) in enumerate(parts):
        at = F.lit(None if day is None else f"{day} 10:00:00").cast("timestamp_ntz")
        bronze(spark, [sale(f"{i}-{k}") for k in range(n)] + ["{"], at=at).coalesce(1).write.mode("append").parquet(arriving)
        rows = streams.bronze_stream(streams.streaming_session(spark), arriving)
        streams.live_counts(rows, path, checkpoint, width="10 days", delay="10 days").awaitTermination()
        open_windows.append(spark.read.parquet(f"{path}/open").filter(F.col("batch") == i).select("window_start").distinct().count())
    on_time, late = streams.latest_counts(spark, path), streams.late_counts(spark, path)
    assert late.filter("window_start IS NOT NULL AND status = 'parsed_ok'").first().n == 5
    assert late.filter("window_start IS NULL AND status = 'parsed_ok'").first().n == 1
    assert on_time.unionByName(late).agg(F.sum("n")).first()[0] == sum(n + 1 for _, n in parts)
    assert max(open_windows) <= 2
    by_window = {(str(r.window_start)[:10], r.status): r.n for r in on_time.collect()}
    assert by_window[("2026-03-01", "parsed_ok")] == 5 if ("2026-03-01", "parsed_ok") in by_window else sum(n for (_, s), n in by_window.items() if s == "parsed_ok") == 10


@pytest.mark.parametrize("partition_by", [(), ("kind",)])
def test_a_failed_rebuild_leaves_the_layer(spark, partition_by):
    path, schema = new_path(spark, "layer"), T.StructType.fromDDL("id long, kind string")
    assert layers.read_layer(spark, path, schema).count() == 0
    old = spark.range(100).withColumn("kind", F.lit("old"))
    layers.rebuild_layer(old, path, cluster_by=("id",), partition_by=partition_by)
    opened = layers.read_layer(spark, path, schema)
    broken = spark.range(1000, numPartitions=4).withColumn("kind", F.when(F.col("id") < 990, "new").otherwise(F.raise_error(F.lit("lost"))))
    for change in (layers.rebuild_layer, layers.append_layer):
        with pytest.raises(Exception, match="lost"):
            change(broken, path, **({"partition_by": partition_by} if change is layers.rebuild_layer else {}))
        assert layers.read_layer(spark, path, schema).count() == 100
    layers.append_layer(spark.range(100, 110).withColumn("kind", F.lit("more")), path)
    assert layers.read_layer(spark, path, schema).groupBy("kind").count().collect() != [] and layers.read_layer(spark, path, schema).count() == 110
    layers.rebuild_layer(spark.range(7).withColumn("kind", F.lit("new")), path, partition_by=partition_by)
    assert layers.read_layer(spark, path, schema).count() == 7
    # Who opened the first version goes on reading it.
    assert opened.count() == 100
    assert layers.current_version(spark, path).number == 3
    assert len(layers.unused_folders(spark, path, keep=1)) == 2 and layers.unused_folders(spark, path, keep=3) == []


def test_a_killed_rebuild_leaves_the_layer(spark):
    """The job is cancelled while its tasks write: some have ended, some never would."""
    path, schema = new_path(spark, "layer"), T.StructType.fromDDL("id long")
    layers.rebuild_layer(spark.range(100).toDF("id"), path)

    def slow(batches):
        for batch in batches:
            yield batch
            time.sleep(120 if batch["id"].iloc[0] >= 4000 else 0)

    failed = []

    def rebuild():
        try:
            layers.rebuild_layer(spark.range(0, 8000, 1, 4).mapInPandas(slow, "id long"), path)
        except Exception as error:
            failed.append(error)

    thread = threading.Thread(target=rebuild)
    thread.start()
    tracker = spark.sparkContext.statusTracker()

    def some_ended():
        stages = [tracker.getStageInfo(stage) for stage in tracker.getActiveStageIds()]
        return any(stage and stage.numTasks == 4 and stage.numCompletedTasks == 2 for stage in stages)

    until = time.time() + 60
    while not some_ended() and time.time() < until:
        time.sleep(0.1)
    spark.sparkContext.cancelAllJobs()
    thread.join()
    assert failed and layers.read_layer(spark, path, schema).count() == 100
    assert layers.current_version(spark, path).number == 1


def test_a_reader_shuffles_the_wanted_columns(spark):
    arriving, sink, checkpoint = (new_path(spark, label) for label in ("arriving", "silver", "checkpoint"))
    bronze(spark, [sale(f"S{i % 9}") for i in range(20)]).write.parquet(arriving)
    run_silver(spark, arriving, sink, checkpoint)
    wanted = ["status", *SILVER_SALES.names]
    whole, narrow = streams.streamed_silver(spark, sink), streams.streamed_silver(spark, sink, *wanted)
    assert narrow.columns == wanted
    assert quality.same_rows(whole.select(*wanted), narrow, "x").first().violations == 0
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (whole, narrow)]
    assert ["bronze_id" in plan for plan in plans] == [True, False]
