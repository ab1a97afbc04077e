"""Query texts, replies and result profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.catalog.finance import money_text_sql
from tessera.catalog.registry import query
from tessera.functions.sqltext import extract_sql, sql_verdict
from tessera.plans import marts, reports
from tessera.plans.warehouse import Warehouse

# One query text per event, worded by the event's own values.
_STATEMENTS = """
SELECT event_id, CASE
  WHEN event_type = 'view' AND value > 50 THEN 'SELECT replace(props, ''k'', ''key'') FROM events WHERE event_id = ' || event_id
  WHEN event_type = 'view' THEN '  select value from events where event_id = ' || event_id || ' ; '
  WHEN event_type = 'click' AND value > 50 THEN 'explain SELECT ''update'' AS word, ' || user_id
  WHEN event_type = 'click' THEN '-- ' || user_id || ' SELECT 1'
  WHEN event_type = 'signup' THEN 'WITH x AS (SELECT ' || user_id || ' AS user_id) SELECT * FROM x;;'
  WHEN event_type = 'purchase' THEN 'SELECT ' || event_id || '; SELECT ' || user_id
  WHEN value > 100 THEN '   '
  WHEN value > 50 THEN 'DELETE FROM events WHERE event_id = ' || event_id
  ELSE NULL END AS sql_text
FROM events"""


@query("l14_audit_sql_log", f"""
SELECT event_id, CASE
  WHEN sql_text IS NULL OR regexp_full_match(sql_text, '\\s*') THEN 'empty query'
  WHEN NOT regexp_matches(sql_text, '(?i)^\\s*(WITH|SELECT|EXPLAIN)\\b') THEN 'only SELECT / WITH / EXPLAIN allowed'
  WHEN regexp_matches(sql_text, '(?i)\\b(INSERT|UPDATE|DELETE|DROP|ALTER|CREATE|REPLACE|ATTACH|DETACH|PRAGMA|VACUUM)\\b')
    THEN 'DML and DDL keywords are blocked'
  WHEN contains(rtrim(trim(sql_text), ';'), ';') THEN 'only one statement per run'
  ELSE 'ok' END AS verdict
FROM ({_STATEMENTS})""")
def _(w: Warehouse) -> DataFrame:
    w.source("events").createOrReplaceTempView("events")
    return w.spark.sql(_STATEMENTS).select("event_id", sql_verdict(F.col("sql_text")).alias("verdict"))


# One reply per conversation turn: fenced after the prose, prefixed before it, or bare.
_REPLIES = """
SELECT conv_id, turn, role, CASE role
  WHEN 'assistant' THEN text || '{nl}```sql{nl}SELECT ' || turn || ' AS turn;{nl}```{nl}```SELECT 2```'
  WHEN 'user' THEN 'SQL: ' || text || ';; '
  ELSE text END AS reply
FROM conversations"""


@query("l15_extract_sql", f"""
SELECT conv_id, turn, role, CASE WHEN reply = '' OR reply IS NULL THEN '' ELSE
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '^\\s+|\\s+$', '', 'g'), ';+$', ''), '^\\s+|\\s+$', '', 'g'),
                 '^(?i:sql|sqlite)\\s*:\\s*', '') || ';' END AS statement
FROM (SELECT *, CASE WHEN regexp_matches(reply, '(?is)```(?:sql)?\\s*(.*?)```')
                     THEN regexp_extract(reply, '(?is)```(?:sql)?\\s*(.*?)```', 1) ELSE reply END AS body
      FROM ({_REPLIES.replace("{nl}", "' || chr(10) || '")}))""")
def _(w: Warehouse) -> DataFrame:
    w.source("conversations").createOrReplaceTempView("conversations")
    replies = w.spark.sql(_REPLIES.replace("{nl}", "' || chr(10) || '"))
    return replies.select("conv_id", "turn", "role", extract_sql(F.col("reply")).alias("statement"))


def _results(w: Warehouse) -> dict[str, DataFrame]:
    silver, mart = w.table("fin_slv_transactions"), w.table("fin_gld_spend_by_dept_month")
    trend = marts.daily_trend(silver)
    return {
        "kpis": marts.kpis(silver, w.table("fin_gld_top_vendors")).select("total_aed", "txn_count"),
        "trend": trend,
        "vendors": w.table("fin_gld_top_vendors").select("canonical_name", "total_aed", "txn_count"),
        "sources": marts.split_by(silver, "source").select("source", "total_aed"),
        "employees": silver.groupBy("employee_id").agg(F.sum("amount_aed").alias("total_aed")),
        "months": mart.select("dept_name", "month_label", "total_aed"),
        "nothing": trend.filter(F.col("total_aed") < 0),
    }


def _profile_sql(name: str, source: str, single: tuple, many: tuple) -> str:
    def text(value: str | None) -> str:
        return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

    kind = "CASE WHEN n BETWEEN 2 AND 6 THEN 'donut' ELSE 'bar' END" if many[0] == "bar" else text(many[0])
    columns = ", ".join(
        f"CASE WHEN n = 1 THEN {text(one)} WHEN n > 1 THEN {text(more)} END AS {label}"
        for label, one, more in zip(("label_col", "value_col", "secondary_col"), single[1:], many[1:])
    )
    return (
        f"SELECT '{name}' AS result, n AS row_count, CASE WHEN n = 0 THEN 'empty' WHEN n = 1 THEN '{single[0]}' ELSE {kind} END AS chart,"
        f" {columns} FROM (SELECT count(*) AS n FROM ({source}))"
    )


_LAST_90 = """SELECT txn_date, sum(amount_aed) AS total_aed, count(*) AS txn_count FROM fin_slv_transactions t
WHERE t.txn_date >= (SELECT max(txn_date) FROM fin_slv_transactions) - INTERVAL 90 DAY GROUP BY txn_date"""


@query("l16_result_profile", " UNION ALL ".join([
    _profile_sql("kpis", "SELECT count(*) FROM fin_slv_transactions", ("stat", None, "total_aed", None), ("table", None, None, None)),
    _profile_sql("trend", _LAST_90, ("stat", None, "total_aed", None), ("area", "day", "total_aed", None)),
    _profile_sql("vendors", "SELECT * FROM fin_gld_top_vendors", ("stat", "canonical_name", "total_aed", None),
                 ("composed", "canonical_name", "total_aed", "txn_count")),
    _profile_sql("sources", "SELECT DISTINCT source FROM fin_slv_transactions", ("stat", "source", "total_aed", None),
                 ("bar", "source", "total_aed", None)),
    _profile_sql("employees", "SELECT DISTINCT employee_id FROM fin_slv_transactions", ("stat", "employee_id", "total_aed", None),
                 ("bar", "employee_id", "total_aed", None)),
    _profile_sql("months", "SELECT * FROM fin_gld_spend_by_dept_month", ("stat", "dept_name", "total_aed", None), ("bar", "dept_name", "total_aed", None)),
    _profile_sql("nothing", f"SELECT * FROM ({_LAST_90}) WHERE total_aed < 0", ("stat", None, "total_aed", None), ("area", "day", "total_aed", None)),
]))
def _(w: Warehouse) -> DataFrame:
    profiles = [
        reports.result_profile(df).select(F.lit(name).alias("result"), "*") for name, df in _results(w).items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def _highlights_sql(source: str, label: str, day: str | None) -> str:
    """The twin for a source with ``total_aed``, ``txn_count`` and a unique ``label``."""
    trend = "CAST(NULL AS VARCHAR)"
    if day:
        trend = f"""CASE WHEN count(*) >= 3 AND arg_max(v, {day}) > arg_min(v, {day}) * 1.15 THEN 'rising'
                         WHEN count(*) >= 3 AND arg_max(v, {day}) < arg_min(v, {day}) * 0.85 THEN 'falling' END"""
    shown = f"{label} || ' — ' || {money_text_sql("v")} || ' · txn_count: ' || format('{{:,}}', txn_count)"
    return f"""
SELECT count(*) AS row_count, string_agg({shown}, chr(10) ORDER BY rn) FILTER (rn <= 5) AS top,
       CASE WHEN count(*) > 5 THEN round(CAST(sum(total_aed) FILTER (rn <= 5) AS DOUBLE) / CAST(sum(total_aed) AS DOUBLE) * 100, 0) END AS top_share_pct,
       {money_text_sql("CAST(sum(total_aed) AS DOUBLE)")} AS total_text, {trend} AS trend
FROM (SELECT *, CAST(total_aed AS DOUBLE) AS v,
             row_number() OVER (ORDER BY total_aed DESC, {label}) AS rn FROM ({source}))"""


@query("l17_trend_highlights", _highlights_sql(f"SELECT CAST(txn_date AS VARCHAR) AS day, total_aed, txn_count FROM ({_LAST_90})", "day", "day"))
def _(w: Warehouse) -> DataFrame:
    return reports.result_highlights(_results(w)["trend"], ("day",))


@query("l17_vendor_highlights", _highlights_sql("SELECT canonical_name, total_aed, txn_count FROM fin_gld_top_vendors", "canonical_name", None))
def _(w: Warehouse) -> DataFrame:
    return reports.result_highlights(_results(w)["vendors"], ("canonical_name",))
