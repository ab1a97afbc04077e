from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions.dates import build_date_dim, month_label, parse_messy_date
from tessera.functions.money import money_text, to_aed
from tessera.functions.sqltext import extract_sql, sql_verdict
from tessera.plans.finance import padded_id
from tessera.plans.marts import anomaly_reasons, previous_month_label


def apply(spark, values, expression, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_messy_dates(spark):
    cases = {
        "2026-04-21": dt.date(2026, 4, 21), "21/04/2026": dt.date(2026, 4, 21), "04-21-2026": dt.date(2026, 4, 21),
        " 2026-4-1 ": dt.date(2026, 4, 1), "not a date": None, "": None, None: None,
        "04-05-2026": dt.date(2026, 4, 5), "13-05-2026": dt.date(2026, 5, 13), "05/13/2026": dt.date(2026, 5, 13),
        "2026-04-21T10:15:00": dt.date(2026, 4, 21), "2026-04-21 10:15": dt.date(2026, 4, 21),
        "2026-04-21T25:00:00": None, "2026-02-30": None, "31/04/2026": None, "2026-04-21 trailing": None,
        "2026-04-21T10:15:00+04:00": dt.date(2026, 4, 21), "21/04/26": None,
    }
    assert apply(spark, list(cases), parse_messy_date) == list(cases.values())


def test_fx(spark):
    df = spark.createDataFrame([("100", "USD"), ("123.45", "AED"), ("7.10", "EUR"), (None, "USD")], "a string, c string")
    got = [row[0] for row in df.select(to_aed(F.col("a").cast("decimal(18,2)"), F.col("c"))).collect()]
    assert [None if v is None else float(v) for v in got] == [367.25, 123.45, 7.10, None]


def test_money_text_reads_like_python(spark):
    values = [0.0, 10.5, 11.5, 999.4, 999.5, 1000.0, 1234.56, 4449.0, 4450.0, 1_005_000.0, 2_345_678.9, 1.5e9, -5000.0]

    def expected(v):
        if v >= 1_000_000:
            return f"{v / 1_000_000:.2f}M AED"
        return f"{v / 1_000:.1f}K AED" if v >= 1_000 else f"{v:,.0f} AED"

    assert apply(spark, values, money_text, "v double") == [expected(v) for v in values]


@pytest.mark.parametrize("sql, verdict", [
    ("DELETE FROM x", "only"), ("UPDATE x SET a = 1", "only"), ("DROP TABLE x", "only"), ("INSERT INTO x VALUES (1)", "only"),
    ("ALTER TABLE x ADD y", "only"), ("CREATE TABLE x (a)", "only"), ("PRAGMA table_info(x)", "only"), ("VACUUM", "only"),
    ("ATTACH 'x' AS y", "only"), ("", "empty"), ("   ", "empty"), (None, "empty"), ("SELECT 1; DELETE FROM x", "DML"),
    ("SELECT 1; SELECT 2", "only one"), ("SELECT replace(a, 'b', 'c') FROM x", "DML"), ("-- note\nSELECT 1", "only SELECT"),
    ("SELECT 1", "ok"), ("SELECT 1;", "ok"), ("select 1 ;; ", "ok"), ("WITH x AS (SELECT 1) SELECT * FROM x", "ok"),
    ("SELECT updated_at FROM x", "ok"),
])
def test_sql_verdict(spark, sql, verdict):
    assert apply(spark, [sql], sql_verdict)[0].startswith(verdict)


def test_extract_sql(spark):
    cases = {
        "Sure:\n```sql\nSELECT 1;\n```\nDone. ```SELECT 9```": "SELECT 1;", "```\nSELECT 3\n```": "SELECT 3;", "SQL: SELECT 2;": "SELECT 2;",
        "sqlite : SELECT 4 ;;": "SELECT 4;", "SELECT 5": "SELECT 5;", "": "", "```SQL\nSELECT\n 6 ;\n```": "SELECT\n 6;",
    }
    assert apply(spark, list(cases), extract_sql) == list(cases.values())


def test_date_dim(spark):
    rows = {row.date_id: row for row in build_date_dim(spark, "2026-01-01", "2026-04-21").collect()}
    assert len(rows) == 111
    last = rows[dt.date(2026, 4, 21)]
    assert (last.day, last.day_of_week, last.month, last.month_name, last.quarter, last.year, last.is_weekend) == (
        21, "Tuesday", 4, "April", 2, 2026, 0)
    assert rows[dt.date(2026, 4, 19)].is_weekend == 1


def test_labels_and_ids(spark):
    days = [dt.date(2026, 4, 21), dt.date(2026, 3, 31), dt.date(2026, 1, 1)]
    assert apply(spark, days, month_label, "v date") == ["Apr 2026", "Mar 2026", "Jan 2026"]
    assert apply(spark, days, previous_month_label, "v date") == ["2026-03", "2026-02", "2025-12"]
    assert apply(spark, [7, 1234567], lambda c: padded_id("CN-", c), "v bigint") == ["CN-000007", "CN-1234567"]


def test_anomaly_reasons(spark):
    df = spark.createDataFrame(
        [(600.0, dt.date(2026, 4, 20)), (12000.0, dt.date(2026, 4, 19)), (100.0, dt.date(2026, 4, 20))], "a double, d date")
    got = [row[0] for row in df.select(anomaly_reasons(F.col("a"), F.col("d"), F.lit(100.0))).collect()]
    assert got == [
        ["6.0x the median txn"], ["120.0x the median txn", "posted on a weekend", "amount above 10,000 AED"],
        ["unusual combination of dept + category + amount"],
    ]
