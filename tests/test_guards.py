"""Refused queries never run; keys and itemsets at the edge are kept."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions.dates import parse_messy_date
from tessera.functions.sqltext import BAD_LEAD, BLOCKED, EMPTY, STACKED
from tessera.operators.rules import frequent_itemsets
from tessera.plans.reports import run_sql
from tessera.plans.retail import BAD_TYPE, DROPPED, OK, stage_silver
from tessera.schemas import REQUIRED_KEYS
from tessera.sources.retail import padded


@pytest.mark.parametrize(
    "text, verdict",
    [("", EMPTY), ("CREATE OR REPLACE TEMPORARY VIEW v AS SELECT 1", BAD_LEAD), ("WITH x AS (SELECT 1) DELETE FROM x", BLOCKED), ("SELECT 1; SELECT 2", STACKED)],
)
def test_refused(spark, text, verdict):
    with pytest.raises(ValueError, match=verdict):
        run_sql(spark, text)
    assert not spark.catalog.tableExists("v")


@pytest.mark.parametrize(
    "change, status",
    [
        (lambda text: text, OK), (lambda text: f" {text}\n", OK), (lambda text: text + " xyz", DROPPED), (lambda text: text + text, DROPPED),
        (lambda text: text.replace('"', "'"), DROPPED), (lambda text: f"[{text}]", DROPPED), (lambda text: text.replace("2026-04-21T10:00:00", "hello"), BAD_TYPE),
        (lambda text: None, DROPPED), (lambda text: "", DROPPED), (lambda text: text[:-1], DROPPED),
    ],
)
def test_only_whole_json_with_a_time_enters_silver(spark, change, status):
    sale = dict.fromkeys(REQUIRED_KEYS, "1") | {"sale_ts": "2026-04-21T10:00:00"}
    bronze = spark.createDataFrame([("0", change(json.dumps(sale)))], "id string, payload_json string")
    assert [r["status"] for r in stage_silver(bronze).collect()] == [status]


def test_long_keys_are_not_cut(spark):
    row = spark.range(1).select(padded(F.lit("1234567890123"), 12).alias("long"), padded(F.lit("7"), 3).alias("short")).first()
    assert (row["long"], row["short"]) == ("1234567890123", "007")


def test_dates_padded_with_tabs(spark):
    row = spark.range(1).select(parse_messy_date(F.lit("\t2026-04-21\n")).cast("string").alias("d")).first()
    assert row["d"] == "2026-04-21"


def test_itemset_exactly_at_the_support(spark):
    rows = [(str(i), "d", name, 1) for i in range(100) for name in (("a", "b") if i < 7 else ("c", f"x{i}"))]
    items = spark.createDataFrame(rows, "customer_id string, date_id string, name string, n long")
    found, total = frequent_itemsets(items, 0.07)
    assert total == 100 and ["a", "b"] in [sorted(r["items"]) for r in found.collect()]
