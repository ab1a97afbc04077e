from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.catalog import streams as streams_catalog
from tessera.plans import dq, finance, forecast, marts, mining, quality, reports, retail
from tessera.plans.warehouse import Warehouse
from tessera.schemas import BRONZE_SALES, DQ_EVENTS
from tessera.sources import layers, payloads
from tessera.sources.workspace import BROADCAST_ROWS, materialize, new_path, sized
from tessera.streaming import retail as streams


def sale(sale_id="S1", **changes):
    fields = {
        "sale_id": sale_id, "customer_id": "C1", "product_id": "P1", "store_id": "T1", "sale_ts": "2026-01-02T10:00:00",
        "quantity": 1, "unit_price": 2.5, "amount": 2.5, "channel": "web", "currency": "AED",
    }
    fields.update(changes)
    return {key: value for key, value in fields.items() if value is not ...}


def bronze(spark, items):
    texts = [item if isinstance(item, str) else json.dumps(item) for item in items]
    at = dt.datetime(2026, 1, 1)
    return spark.createDataFrame([(f"{i:04d}", "pos", at, text, 0, None) for i, text in enumerate(texts)], BRONZE_SALES)


def test_silver_rules(spark):
    items = [
        '{"sale_id": "S0", "customer', "[1, 2]", sale("S9", amount=..., currency=..., amt=1.0), sale("S1", customer_id=None),
        sale("S2", store_id=""), sale("S1", amount=7.0), sale("S1", amount=8.0), sale("S3", quantity=2.7), sale("S4", quantity="x"),
        sale("S5", extra="kept out"), sale("S6", currency=None), sale("S4", quantity=3),
    ]
    staged = retail.stage_silver(bronze(spark, items)).persist()
    assert retail.silver_counts(staged).first().asDict() == {
        "parsed_ok": 4, "dropped_schema": 3, "quarantined_nulls": 2, "quarantined_dupes": 2, "bad_type": 1, "bronze_total": 12,
    }
    silver = {r.sale_id: r for r in retail.silver_of(staged).collect()}
    assert silver["S1"].amount == Decimal("7.00") and silver["S3"].quantity == 2 and silver["S6"].currency is None
    assert {r.status for r in retail.quarantine_of(staged).collect()} == {"dropped_schema", "quarantined_nulls", "bad_type"}
    lost = retail.duplicate_rows(retail.classify_bronze(bronze(spark, items)), staged)
    assert sorted(r.id for r in lost.collect()) == ["0006", "0011"]


def test_hot_sale_id_keeps_the_first(spark):
    hot = [sale("HOT", amount=float(i)) for i in range(400)]
    rest = [sale(f"S{i}") for i in range(800)]
    staged = retail.stage_silver(bronze(spark, rest[:3] + hot + rest[3:]).repartition(6)).persist()
    counts = retail.silver_counts(staged).first()
    assert (counts.parsed_ok, counts.quarantined_dupes) == (801, 399)
    assert staged.filter("sale_id = 'HOT'").first().amount == Decimal("0.00")


def test_empty_bronze(spark):
    staged = retail.stage_silver(bronze(spark, []).filter("false"))
    assert retail.silver_counts(staged).first().bronze_total == 0
    assert dq.dq_events(retail.silver_counts(staged), dq.SILVER_EVENTS, F.lit("2026-01-01")).count() == 0


def test_event_log_keeps_every_run(spark):
    counts = retail.silver_counts(retail.stage_silver(bronze(spark, ["{", sale("S1"), sale("S1")])))
    log = new_path(spark, "log")
    for run, at in enumerate(["2026-04-21", "2026-04-22"]):
        dq.log_events(log, counts, dq.SILVER_EVENTS, at, run)
    events = layers.read_layer(spark, log, DQ_EVENTS)
    assert events.count() == 4
    newest = dq.recent_events(events, limit=3).collect()
    assert [(e.kind, e.created_at.day) for e in newest] == [("dupes", 22), ("schema_drift", 22), ("dupes", 21)]


def tiny_dims(spark):
    return {
        "gold_dim_customer": spark.createDataFrame([("C1",)], "customer_id string"),
        "gold_dim_product": spark.createDataFrame([("P1",)], "product_id string"),
        "gold_dim_store": spark.createDataFrame([("T1",)], "store_id string"),
        "gold_dim_date": spark.createDataFrame([(dt.date(2026, 1, 2),)], "date_id date"),
    }


def test_foreign_keys(spark):
    items = [
        sale("ok"), sale("c", customer_id="C?"), sale("p", product_id="P?"), sale("s", store_id="T?"),
        sale("d", sale_ts="2030-01-01T00:00:00"), sale("two", customer_id="C?", store_id="T?"), sale("odd", sale_ts="not a time"),
    ]
    silver = retail.silver_of(retail.stage_silver(bronze(spark, items)))
    staged = retail.stage_gold(silver, tiny_dims(spark))
    assert retail.gold_counts(staged).first().asDict() == {"gold_inserted": 1, "orphaned_fk": 5, "silver_total": 6}
    events = dq.dq_events(retail.gold_counts(staged), dq.GOLD_EVENTS, F.lit("2026-04-21 00:00:00")).collect()
    assert [(e.kind, e.detail) for e in events] == [("orphaned_fk", "rejected 5 rows with unknown dim keys")]


def test_injectors_reach_the_right_counter(spark):
    clean = bronze(spark, [sale(f"S{i}") for i in range(60)])
    batches = {
        "dropped_schema": payloads.inject_schema_drift(clean, "2026-04-21"),
        "quarantined_dupes": payloads.inject_dupes(clean, "2026-04-21"),
        "quarantined_nulls": payloads.inject_nulls(clean, "2026-04-21"),
    }
    sizes = {"dropped_schema": 30, "quarantined_dupes": 40, "quarantined_nulls": 25}
    everything = clean
    for batch in batches.values():
        everything = everything.unionByName(batch)
    counts = retail.silver_counts(retail.stage_silver(everything)).first()
    assert {name: counts[name] for name in sizes} == sizes
    assert counts.parsed_ok == 60
    assert batches["quarantined_nulls"].first().dirt_kind == "null_flood"
    assert batches["dropped_schema"].first().source_system == "pos-retail-v2-BROKEN"


def test_layer_samples_refuse_unknown_names(spark):
    with pytest.raises(ValueError):
        layers.sample_retail_layer("platinum", spark.range(1))
    with pytest.raises(ValueError):
        layers.sample_finance_layer("platinum", spark.range(1))


def finance_fixture(spark):
    claims = spark.createDataFrame([
        (1, "E1", "Travel", "UBER *TRIP", Decimal("100.00"), "USD", "21/04/2026"),
        (2, "E1", None, "who knows", Decimal("50.00"), "AED", "2026-04-20"),
        (3, "E?", "Meals", "who knows", Decimal("10.00"), "AED", "2026-04-20"),
        (4, "E1", "Meals", "Uber", Decimal("10.00"), "AED", "someday"),
    ], "row_id bigint, employee_id string, category string, merchant string, amount decimal(18,2), currency string, submitted_date string")
    cards = spark.createDataFrame([
        (1, "E1", "uber trip dubai", Decimal("10.00"), "2026-04-19"), (2, None, "UBER BV", Decimal("1.00"), "2026-04-19"),
        (3, "E1", "UBER BV", Decimal("1.00"), "2026-04-19"),
    ], "row_id bigint, employee_id string, vendor_str string, amount_usd decimal(18,2), posted_date string")
    vendors = spark.createDataFrame([("V02", "Uber", "Travel", '["UBER *TRIP", "UBER BV"]')],
                                    "vendor_id string, canonical_name string, category string, aliases_json string")
    employees = spark.createDataFrame([("E1", "Sara", "D01")], "employee_id string, full_name string, dept_id string")
    departments = spark.createDataFrame([("D01", "Marketing")], "dept_id string, dept_name string")
    return claims, cards, vendors, employees, departments


def test_finance_silver_and_marts(spark):
    claims, cards, vendors, employees, departments = finance_fixture(spark)
    mapping = finance.vendor_map(claims, cards, vendors)
    staged = finance.stage_silver(claims, cards, mapping, employees).persist()
    assert finance.silver_counts(staged).first().asDict() == {
        "silver_inserted": 4, "bad_dates": 1, "vendor_misses": 2, "orphan_employee": 2, "concur_total": 4, "card_total": 3,
    }
    silver = {r.txn_id: r for r in finance.silver_of(staged).collect()}
    assert set(silver) == {"CN-000001", "CN-000002", "CC-000001", "CC-000003"}
    assert silver["CN-000001"].amount_aed == Decimal("367.25") and silver["CN-000001"].vendor_id == "V02"
    assert silver["CC-000001"].category == "Travel" and silver["CN-000002"].vendor_id is None
    rows = finance.silver_of(staged)
    months = finance.spend_by_dept_month(rows, departments).collect()
    assert [(m.month_label, float(m.total_aed), m.txn_count) for m in months] == [("2026-04", 457.65, 4)]
    mart = finance.top_vendors(finance.vendor_totals(rows, vendors)).collect()
    assert [(m.vendor_id, m.pareto_rank, m.cumulative_pct) for m in mart] == [("V02", 1, 100.0)]
    assert quality.employee_in_dept(rows, employees).first().violations == 0


def test_drills(spark):
    claims, cards, vendors, employees, departments = finance_fixture(spark)
    silver = finance.silver_of(finance.stage_silver(claims, cards, finance.vendor_map(claims, cards, vendors), employees))
    rows = marts.drill_dept(silver, employees, vendors, "D01", 2026, 4, limit=2).collect()
    assert [r.txn_id for r in rows] == ["CN-000001", "CN-000002"] and rows[0].vendor == "Uber" and rows[1].vendor is None
    assert marts.drill_dept_total(silver, "D01", 2030, 1).first().total_aed == 0.0
    mart = finance.top_vendors(finance.vendor_totals(silver, vendors))
    assert marts.drill_vendor_total(mart, "V99").first().asDict() == {"canonical_name": None, "total_aed": 0.0, "txn_count": 0}
    assert marts.drill_vendor(silver, employees, departments, "V02").count() == 3


@pytest.mark.parametrize("rows_per_task", [1_000_000, 3])
def test_pareto_with_ties(spark, rows_per_task):
    totals = spark.createDataFrame(
        [(f"V{i:02d}", f"n{i}", "x", Decimal(10), 1) for i in range(10)] + [("V99", "big", "x", Decimal(100), 1)],
        "vendor_id string, canonical_name string, category string, total_aed decimal(28,2), txn_count bigint")
    mart = finance.top_vendors(totals, rows_per_task).orderBy("pareto_rank").collect()
    assert [m.vendor_id for m in mart] == ["V99", *[f"V{i:02d}" for i in range(10)]]
    assert [m.cumulative_pct for m in mart] == [50.0 + 5 * i for i in range(11)]


def test_concentration(spark):
    rows = [(f"V{i}", f"n{i}", Decimal(v), i + 1, p) for i, (v, p) in enumerate([(60, 60.0), (30, 90.0), (10, 100.0)])]
    mart = spark.createDataFrame(rows, "vendor_id string, canonical_name string, total_aed decimal(28,2), pareto_rank bigint, cumulative_pct double")
    got = marts.concentration(mart).first()
    assert got.gini == pytest.approx((-2 * 10 + 0 * 30 + 2 * 60) / (3 * 100), abs=5e-4)
    assert (got.top_3_pct, got.top_5_pct, got.top_10_pct) == (100.0, 100.0, 100.0)
    assert [r.share_pct for r in marts.leaders(mart, 2).collect()] == [60.0, 30.0]


def test_next_month_forecast(spark):
    rows = [("short", 2026, m, Decimal(10)) for m in (1, 2)]
    rows += [("falling", 2026, m, Decimal(v)) for m, v in ((1, 300), (2, 150), (3, 10))]
    rows += [("line", 2025, m, Decimal(100 * m)) for m in range(1, 13)] + [("line", 2026, 1, Decimal(1300))]
    mart = spark.createDataFrame(rows, "dept_name string, year int, month int, total_aed decimal(28,2)")
    got = {r.dept_name: r for r in forecast.next_month_forecast(mart).collect()}
    assert set(got) == {"falling", "line"}
    assert got["falling"].forecast_next_aed == 0.0 and got["falling"].delta_pct < -100
    assert got["line"].forecast_next_aed == 1400.0 and len(got["line"].history) == 6
    assert got["line"].history[-1].period == 2026 * 12 + 1


def test_revenue_forecast(spark):
    days = [(dt.date(2026, 1, 1) + dt.timedelta(days=2 * i), Decimal(100 + 10 * i)) for i in range(6)]
    daily = spark.createDataFrame(days, "date_id date, revenue decimal(18,2)")
    ahead = forecast.revenue_forecast(daily, 3).orderBy("date_id").collect()
    assert [r.date_id for r in ahead] == [dt.date(2026, 1, 12), dt.date(2026, 1, 13), dt.date(2026, 1, 14)]
    assert [r.predicted for r in ahead] == pytest.approx([160, 170, 180])
    assert all(r.lo <= r.predicted <= r.hi for r in ahead)
    assert forecast.revenue_forecast(daily.limit(4)).count() == 0


def features(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id string, txns bigint, total_spend double, avg_basket double, recency_days int")


def test_clusters(spark):
    rows = [(f"a{i}", 2, 10.0 + i, 5.0, 100) for i in range(10)] + [(f"b{i}", 50, 900.0 + i, 18.0, 3) for i in range(10)]
    found = mining.cluster_customers(features(spark, rows), k=2)
    groups = {frozenset(r.ids) for r in found.points.groupBy("cluster").agg(F.collect_set("customer_id").alias("ids")).collect()}
    assert groups == {frozenset(f"a{i}" for i in range(10)), frozenset(f"b{i}" for i in range(10))}
    assert sorted(round(r.total_spend, 1) for r in found.centroids.collect()) == [14.5, 904.5]
    assert found.summary.agg(F.sum("n")).first()[0] == 20
    assert mining.cluster_customers(features(spark, rows).filter("false")).points.count() == 0


def test_churn(spark):
    rows = [(f"a{i}", 2 + i % 3, 10.0 + i, 5.0, 100) for i in range(20)] + [(f"b{i}", 40 + i % 5, 900.0 + i, 18.0, 3) for i in range(20)]
    rows.append(("never", 0, 0.0, 0.0, 0))
    churn = mining.churn_classifier(features(spark, rows))
    assert churn.summary.first().asDict() == {"churned": 20, "active": 20, "accuracy": 1.0, "error": None}
    grid = churn.grid.collect()
    assert len(grid) == 900 and all(0 <= c.churn_prob <= 1 for c in grid)
    assert min(c.total_spend for c in grid) == 10.0 and max(c.txns for c in grid) == pytest.approx(44.0)
    one_sided = mining.churn_classifier(features(spark, rows), threshold_days=500)
    summary = one_sided.summary.first()
    assert (summary.churned, summary.active, summary.accuracy) == (0, 40, None) and "500d" in summary.error
    assert one_sided.grid.count() == 0


def test_spend_anomalies(small, spark):
    assert [mining.clamp_sensitivity(s) for s in (0.0, 0.05, 0.99)] == [0.005, 0.05, 0.30]
    found = mining.spend_anomalies(
        small.table("spend_scores"), small.table("fin_dim_employee"), small.table("fin_dim_vendor"), sensitivity=0.05, top_k=7)
    flagged, summary = found.flagged.collect(), found.summary.first()
    assert len(flagged) == 7 and all(r.reasons for r in flagged)
    assert summary.outlier_count == pytest.approx(0.05 * summary.total_rows, rel=0.1)
    assert [r.amount_aed for r in flagged] == sorted((r.amount_aed for r in flagged), reverse=True)


def test_run_sql(spark):
    spark.range(600).createOrReplaceTempView("numbers")
    for sql, count, more in [("SELECT * FROM numbers;", 500, True), ("SELECT * FROM numbers WHERE id < 500", 500, False), ("SELECT 1 AS x", 1, False)]:
        result = reports.run_sql(spark, sql)
        assert result.rows.count() == count
        assert tuple(result.truncated.first()) == (count, more)


def test_result_profile(spark):
    def profile(df):
        return reports.result_profile(df).first().asDict()

    names = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "name string, spend double")
    assert profile(names) == {"row_count": 2, "chart": "donut", "label_col": "name", "value_col": "spend", "secondary_col": None}
    assert profile(names.limit(1))["chart"] == "stat" and profile(names.filter("false"))["chart"] == "empty"
    assert profile(names.unionByName(names).unionByName(names).unionByName(names))["chart"] == "bar"
    days = spark.createDataFrame([("2026-01", 1.0), ("2026-02", 2.0)], "month string, spend double")
    assert profile(days)["chart"] == "area"
    assert profile(names.selectExpr("name", "name other"))["chart"] == "table"
    assert profile(names.selectExpr("name").limit(1))["chart"] == "table"
    assert profile(names.selectExpr("name", "spend", "spend * 2 twice"))["secondary_col"] == "twice"


def test_result_highlights(spark):
    days = spark.createDataFrame([(f"2026-01-{d:02d}", 1000.0 * d) for d in range(1, 8)], "day string, spend_aed double")
    got = reports.result_highlights(days, ("day",)).first()
    assert got.trend == "rising" and got.row_count == 7 and got.top_share_pct == 89.0 and got.total_text == "28.0K AED"
    assert got.top.split("\n")[0] == "2026-01-07 — 7.0K AED"
    assert reports.result_highlights(days.limit(2), ("day",)).first().trend is None
    falling = days.withColumn("spend_aed", 9000.0 - F.col("spend_aed"))
    assert reports.result_highlights(falling, ("day",)).first().trend == "falling"


def test_tick_bounds(spark):
    for n in (0, 51):
        with pytest.raises(ValueError, match="between 1 and 50"):
            streams.check_tick(n)
    assert streams.tick_rows(bronze(spark, [sale("S1"), sale("S2")]), 1, "2026-04-21").count() == 1


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_silver_sorts_no_payloads(spark):
    # The aggregate takes a finished struct; made inside it, the payload of every good row was sorted along, and spilled.
    staged = retail.stage_silver(bronze(spark, [sale("S1"), sale("S1", amount=9.0)]))
    assert "partial_min(first#" in plan_of(staged) and staged.first().copies == 2


def test_keys_are_read_where_values_do_not_show_them(spark):
    whole = json.dumps(sale("S1"))
    items = [whole, json.dumps(sale("S2", currency=None)), json.dumps(sale("S3", currency=...)), '{"sale_id": 1}, "payload": ' + whole, " " + whole]
    found = {r.id: r.status for r in retail.classify_bronze(bronze(spark, items)).collect()}
    assert [found[f"{i:04d}"] for i in range(5)] == ["parsed_ok", "parsed_ok", "dropped_schema", "dropped_schema", "parsed_ok"]


def test_gold_keeps_one_row_per_sale_and_its_order(spark):
    items = [sale("ok"), sale("c", customer_id="C?"), sale("p", product_id="P?"), sale("s", store_id="T?"), sale("d", sale_ts="2030-01-01T00:00:00")]
    dims = tiny_dims(spark)
    dims["gold_dim_customer"] = dims["gold_dim_customer"].unionByName(dims["gold_dim_customer"])
    staged = retail.gold_by_date(retail.silver_of(retail.stage_silver(bronze(spark, items))), dims)
    assert retail.gold_counts(staged).first().asDict() == {"gold_inserted": 1, "orphaned_fk": 4, "silver_total": 5}


def test_injected_rows_are_picked_without_a_sort_of_bronze(spark):
    clean = bronze(spark, [sale(f"S{i}") for i in range(60)])
    for inject in (payloads.inject_schema_drift, payloads.inject_dupes, payloads.inject_nulls):
        assert "rangepartitioning" not in plan_of(inject(clean, "2026-04-21"))


def test_silver_changes_counts_what_each_batch_changes(spark):
    first = bronze(spark, [sale("S1"), sale("S2"), sale("S3"), sale(None), sale("S3", amount=8.0)])
    silver = retail.silver_of(retail.stage_silver(first))
    silver = silver.unionByName(silver.filter("sale_id = 'S3'"))
    batches = {}
    for name, items in {"same": [sale("S1")], "earlier": [sale("S2", amount=9.0), sale("NEW"), sale("S1", quantity="x")], "null": [sale(None, amount=1.0)]}.items():
        batch = bronze(spark, items)
        batches[name] = batch.withColumn("id", F.concat(F.lit("-" if name != "same" else "9"), "id"))
    found = {r["batch"]: r.violations for r in retail.silver_changes(silver, first, batches).collect()}
    for name, batch in batches.items():
        want = quality.same_rows(silver, retail.silver_of(retail.stage_silver(first.unionByName(batch))), name).first().violations
        assert found[name] == want, name
    assert found == {"same": 1, "earlier": 5, "null": 3}


def test_arriving_files_grow_with_their_table():
    assert [streams_catalog.files_per_batch(n) for n in (0, 600_000, 6_000_000, 216_000_000)] == [2, 2, 2, 72]


def test_duplicates_meet_only_repeated_sales(spark):
    items = [sale(f"S{i}") for i in range(40)] + [sale("S1", amount=1.0), sale("S4", quantity="x"), sale(None), sale(None, amount=3.0)]
    staged = retail.stage_silver(bronze(spark, items)).persist()
    lost = retail.duplicate_rows(retail.classify_bronze(bronze(spark, items)), staged)
    assert sorted(r.id for r in lost.collect()) == ["0040", "0041", "0043"]
    # Few repeated sales are broadcast: the payloads stay where they lie.
    plan = lost._jdf.queryExecution().executedPlan().toString()
    assert "_first" in plan and "hashpartitioning" not in plan


def test_a_filter_on_the_status_parses_once(spark):
    rows = bronze(spark, [sale("S1"), "{", sale("S2", quantity="x")])
    for refined in (retail.classify_bronze(rows).filter("status = 'parsed_ok'").select("sale_id"), retail.first_payloads(rows)):
        assert refined._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
        assert refined.count() == 2


def test_a_replay_builds_only_the_sources_it_reads(spark, small):
    w = Warehouse(spark, small.source_dir)
    again = w.replayed()
    assert again.table("fin_slv_transactions").count() > 0
    assert not {"bronze_sales_raw", "gold_dim_customer", "gold_dim_product"} & set(w._tables)
    # Sources are shared, derived layers are not.
    assert again.folder("fin_dim_employee") == w.folder("fin_dim_employee")
    assert again.folder("fin_staged") != w.folder("fin_staged")


def broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def test_many_rows_in_small_files_are_not_broadcast(spark, tmp_path):
    """The keys of a dimension take few bytes in its files; what counts for a broadcast are its rows."""
    key = F.col("id").cast("bigint")
    names = [F.lit(text).alias(name) for name, text in {"c_name": "n", "c_mktsegment": "s"}.items()]
    customers = spark.range(BROADCAST_ROWS + 1).select(key.alias("c_custkey"), *names, F.lit(0).alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"))
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    w = Warehouse(spark, str(tmp_path))
    sold = materialize(spark.sql("SELECT concat('C', id) AS customer_id, 1.0 AS amount FROM range(499990, 500010)"), "sold")
    known = sold.join(w.table("gold_dim_customer").select("customer_id", "city"), "customer_id", "left")
    unknown = sold.join(w.table("gold_dim_customer").select("customer_id"), "customer_id", "left_anti")
    assert known.filter("city = 'N'").count() == 11 and unknown.count() == 9
    assert broadcasts(known) == broadcasts(unknown) == 0
    few = sized(materialize(spark.range(10).select(F.concat(F.lit("C"), "id").alias("customer_id")), "few"))
    assert broadcasts(sold.join(few, "customer_id", "left_anti")) == 1


def test_enough_files_arrive_as_they_lie(spark):
    """A table is copied for a stream only if its files are too few for the batches."""
    w, rows = Warehouse(spark, "unused"), bronze(spark, [sale(f"S{i}") for i in range(40)])
    for files, per_batch, copied in ((7, 3, False), (6, 2, False), (2, 2, True)):
        folder = new_path(spark, "bronze_sales_raw")
        rows.repartition(files).write.parquet(folder)
        w._tables["bronze_sales_raw"], w._folders["bronze_sales_raw"] = spark.read.schema(BRONZE_SALES).parquet(folder), folder
        path, batch = streams_catalog._arriving(w, "bronze_sales_raw", "arriving")
        assert (path != folder, batch) == (copied, per_batch)
        counts, checkpoint = new_path(spark, "counts"), new_path(spark, "checkpoint")
        streams.live_counts(streams.bronze_stream(streams.streaming_session(spark), path, batch), counts, checkpoint).awaitTermination()
        assert spark.read.parquet(f"{counts}/clock").count() == streams_catalog.BATCHES
        assert streams.latest_counts(spark, counts).agg(F.sum("n")).first()[0] == 40
