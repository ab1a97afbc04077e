"""DuckDB twins of the model tables, as named subqueries over the given parquet views.

``twin(sql)`` puts the subqueries that ``sql`` needs in front of it.
"""

from __future__ import annotations

import re


def _payload(**replaced: str | None) -> str:
    """JSON text of the ten payload fields; a value is SQL that yields the JSON of the field."""

    def text(column: str) -> str:
        return f"'\"' || {column} || '\"'"

    fields: dict[str, str | None] = {
        "sale_id": text("sale_id"), "customer_id": text("customer_id"), "product_id": text("product_id"),
        "store_id": text("store_id"), "sale_ts": text("sale_ts"), "quantity": "quantity",
        "unit_price": "unit_price", "amount": "amount", "channel": text("channel"), "currency": text("currency"),
    }
    fields |= replaced
    parts = [f"'\"{key}\":' || {value}" for key, value in fields.items() if value is not None]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _renamed(prefix: str) -> str:
    return f"'\"{prefix}' || sale_id || '\"'"


def _feed(source: str, kind: str | None, payload: str, flag: str, status: str, discount: float, tax: float) -> str:
    dirty, label = (0, "CAST(NULL AS VARCHAR)") if kind is None else (1, f"'{kind}'")
    return (
        f"SELECT '1' || substr(id, 2), '{source}', ingested_at, {payload}, {dirty}, {label} FROM sales"
        f" WHERE l_returnflag = '{flag}' AND l_linestatus = '{status}' AND l_discount = {discount} AND l_tax = {tax}"
    )


_DRIFTED = _payload(sale_id=_renamed("DRIFT"), amount=None, currency=None, amt="amount")
_NULLED = _payload(sale_id=_renamed("NULLFLOOD"), customer_id="'null'")

_BRONZE = "\nUNION ALL ".join([
    f"SELECT id, 'pos-retail-v1' AS source_system, ingested_at, {_payload()} AS payload_json,"
    " 0 AS is_dirty, CAST(NULL AS VARCHAR) AS dirt_kind FROM sales",
    _feed("pos-retail-v2-BROKEN", "schema_drift", _DRIFTED, "A", "O", 0.10, 0.08),
    _feed("pos-retail-v2-BROKEN", "schema_drift", f"substr({_payload()}, 1, 60)", "R", "O", 0.08, 0.05),
    _feed("crm-customer-feed", "null_flood", _NULLED, "N", "F", 0.09, 0.07),
    _feed("crm-customer-feed", "null_flood", _payload(sale_id=_renamed("NULLFLOOD"), store_id="'\"\"'"), "N", "F", 0.09, 0.06),
    _feed("pos-retail-v1-replay", "dupes", _payload(), "R", "F", 0.05, 0.04),
    _feed("pos-retail-v1", None, _payload(sale_id=_renamed("BAD"), quantity="'\"x\"'"), "A", "F", 0.07, 0.03),
    _feed("pos-retail-v1", None,
          _payload(sale_id=_renamed("NEW"), product_id="'\"P-new\"'", store_id="'\"S-new\"'"), "A", "F", 0.03, 0.02),
    _feed("pos-retail-v1", None, _payload(sale_id=_renamed("OLD"), sale_ts="'\"1901-01-01T00:00:00\"'"), "A", "F", 0.02, 0.01),
    _feed("pos-retail-v1", None, _payload(sale_id=_renamed("TIME"), sale_ts="'\"hello\"'"), "A", "F", 0.06, 0.01),
    _feed("pos-retail-v2-BROKEN", "schema_drift", f"{_payload()} || ' xyz'", "R", "F", 0.01, 0.08),
    _feed("pos-retail-v2-BROKEN", "schema_drift", f"translate({_payload()}, '\"', chr(39))", "R", "F", 0.02, 0.07),
])

_KEYS = "['sale_id','customer_id','product_id','store_id','sale_ts','quantity','unit_price','amount','channel','currency']"

TABLES: dict[str, str] = {
    "sales": """
SELECT '0-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber || '-'
         || lpad(CAST(l_partkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') || '-'
         || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || '-'
         || lpad(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), 14, '0') AS id,
       l_orderkey || '-' || l_linenumber AS sale_id,
       'C' || o_custkey AS customer_id, 'P' || l_partkey AS product_id, 'S' || l_suppkey AS store_id,
       replace(CAST(o_orderdate AS VARCHAR), ' ', 'T') AS sale_ts,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(((2 * CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) + CAST(l_quantity AS BIGINT))
             // (2 * CAST(l_quantity AS BIGINT))) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS unit_price,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'web' WHEN '2-HIGH' THEN 'mobile' WHEN '3-MEDIUM' THEN 'store'
            WHEN '4-NOT SPECIFIED' THEN 'partner' ELSE 'web' END AS channel,
       CASE WHEN l_linestatus = 'O' THEN 'USD' ELSE 'AED' END AS currency,
       l_shipdate AS ingested_at, l_returnflag, l_linestatus, l_discount, l_tax
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bronze_sales_raw": _BRONZE,
    "parsed": f"""
SELECT id, ingested_at, payload_json, CASE
    WHEN NOT json_valid(payload_json) THEN 'dropped_schema'
    WHEN NOT list_has_all(json_keys(CASE WHEN json_valid(payload_json) THEN payload_json ELSE '{{}}' END), {_KEYS})
      THEN 'dropped_schema'
    WHEN coalesce(j->>'$.customer_id', '') = '' OR coalesce(j->>'$.product_id', '') = ''
      OR coalesce(j->>'$.store_id', '') = '' OR coalesce(j->>'$.sale_ts', '') = '' THEN 'quarantined_nulls'
    ELSE 'parsed_ok' END AS status,
  j->>'$.sale_id' AS sale_id, j->>'$.customer_id' AS customer_id, j->>'$.product_id' AS product_id,
  j->>'$.store_id' AS store_id, TRY_CAST(j->>'$.sale_ts' AS TIMESTAMP) AS sale_ts,
  CAST(trunc(TRY_CAST(j->>'$.quantity' AS DOUBLE)) AS INTEGER) AS quantity,
  TRY_CAST(j->>'$.unit_price' AS DECIMAL(18,2)) AS unit_price, TRY_CAST(j->>'$.amount' AS DECIMAL(18,2)) AS amount,
  j->>'$.channel' AS channel, j->>'$.currency' AS currency
FROM (SELECT *, CAST(CASE WHEN json_valid(payload_json) THEN payload_json ELSE '{{}}' END AS JSON) AS j
      FROM bronze_sales_raw)""",
    "judged": """
SELECT * EXCLUDE (status, rn),
       CASE WHEN status <> 'parsed_ok' THEN status WHEN rn > 1 THEN 'quarantined_dupes'
            WHEN sale_ts IS NULL OR quantity IS NULL OR unit_price IS NULL OR amount IS NULL THEN 'bad_type' ELSE status END AS status
FROM (SELECT *, row_number() OVER (PARTITION BY status, CASE WHEN status = 'parsed_ok' THEN sale_id ELSE id END
                                   ORDER BY id) AS rn FROM parsed)""",
    "silver_sales": """
SELECT sale_id, customer_id, product_id, store_id, sale_ts, quantity, unit_price, amount, channel, currency
FROM judged WHERE status = 'parsed_ok'""",
    "silver_summary": """
SELECT count(*) FILTER (status = 'parsed_ok') AS parsed_ok, count(*) FILTER (status = 'dropped_schema') AS dropped_schema,
       count(*) FILTER (status = 'quarantined_nulls') AS quarantined_nulls,
       count(*) FILTER (status = 'quarantined_dupes') AS quarantined_dupes,
       count(*) FILTER (status = 'bad_type') AS bad_type, count(*) AS bronze_total
FROM judged""",
    "gold_dim_customer": """
SELECT 'C' || c_custkey AS customer_id, c_name AS name, CAST(18 + CAST(floor(abs(c_acctbal)) AS BIGINT) % 60 AS INTEGER) AS age,
       c_mktsegment AS tier, n_name AS city, r_name AS country, CAST(2000 + c_custkey % 20 AS INTEGER) AS signup_year
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "gold_dim_product": """
SELECT 'P' || p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
       CAST(p_retailprice AS DECIMAL(18,2)) AS base_price FROM part""",
    "gold_dim_store": """
SELECT 'S' || s_suppkey AS store_id, s_name AS name,
       CASE WHEN s_acctbal < 0 THEN 'Kiosk' WHEN s_acctbal < 3000 THEN 'Express' WHEN s_acctbal < 6000 THEN 'Mall'
            ELSE 'Flagship' END AS format, n_name AS city, r_name AS country
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "gold_dim_date": """
SELECT CAST(d AS DATE) AS date_id, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_of_week,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST((month(d) - 1) // 3 + 1 AS INTEGER) AS quarter,
       CAST(year(d) AS INTEGER) AS year, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend
FROM (SELECT unnest(generate_series((SELECT CAST(min(o_orderdate) AS DATE) FROM orders)::TIMESTAMP, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)::TIMESTAMP,
                                    INTERVAL 1 DAY)) AS d)""",
    "checked_sales": """
SELECT s.*, CAST(sale_ts AS DATE) AS date_id,
       customer_id IN (SELECT customer_id FROM gold_dim_customer) AND product_id IN (SELECT product_id FROM gold_dim_product)
       AND store_id IN (SELECT store_id FROM gold_dim_store)
       AND CAST(sale_ts AS DATE) IN (SELECT date_id FROM gold_dim_date) AS known
FROM silver_sales s""",
    "gold_fact_sales": """
SELECT sale_id, date_id, customer_id, product_id, store_id, channel, quantity, amount FROM checked_sales WHERE known""",
    "gold_summary": """
SELECT count(*) FILTER (known) AS gold_inserted, count(*) FILTER (NOT known) AS orphaned_fk, count(*) AS silver_total
FROM checked_sales""",
    "oltp_transactions": """
SELECT 'T' || o_orderkey AS txn_id, 'C' || o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
       o_orderdate AS ts, CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'pending' ELSE 'reversed' END AS status
FROM orders""",
    "banking_transactions": """
SELECT 'B' || event_id AS txn_id, 'A' || user_id AS account_id, CAST(value AS DECIMAL(18,2)) AS amount,
       CASE WHEN event_type = 'error' THEN 'unknown-merchant' ELSE event_type END AS merchant, ts,
       CAST(event_type = 'error' AND value > 100 AS INTEGER) AS is_fraud
FROM events""",
    "fin_src_concur_expenses": """
SELECT o_orderkey AS row_id, CASE WHEN o_totalprice > 499000 THEN 'E-left' ELSE 'E' || o_custkey END AS employee_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Travel' WHEN '2-HIGH' THEN 'Meals' WHEN '3-MEDIUM' THEN 'Software'
            WHEN '5-LOW' THEN 'Office' END AS category,
       CASE WHEN o_totalprice < 4000 THEN 'unknown shop xyz' WHEN o_totalprice < 5000 THEN 'splr*'
            WHEN o_orderstatus = 'F' THEN 'Supplier#' || lpad(CAST(suppkey AS VARCHAR), 9, '0')
            WHEN o_orderstatus = 'O' THEN '  s' || suppkey || ' ONLINE'
            ELSE 'POS SPLR*' || suppkey || ' DUBAI' END AS merchant,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
       CASE WHEN o_orderpriority = '2-HIGH' THEN 'USD' WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'EUR'
            ELSE 'AED' END AS currency,
       CASE WHEN o_totalprice < 3000 THEN 'not a date' WHEN quarter(o_orderdate) = 1 THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN quarter(o_orderdate) = 2 THEN strftime(o_orderdate, '%d/%m/%Y')
            WHEN quarter(o_orderdate) = 3 AND o_orderstatus = 'P' AND year(o_orderdate) < 2001 THEN strftime(o_orderdate, '%m/%d/%Y')
            WHEN quarter(o_orderdate) = 3 THEN strftime(o_orderdate, '%m-%d-%Y')
            ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T10:15:00' END AS submitted_date,
       'receipt/' || o_orderkey AS receipt_url
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS suppkey FROM lineitem GROUP BY l_orderkey) m
  ON o_orderkey = l_orderkey""",
    "fin_src_corporate_card": """
SELECT event_id AS row_id, lpad(CAST(user_id AS VARCHAR), 4, '0') AS card_last4,
       CASE WHEN event_type = 'signup' AND value < 20 THEN NULL WHEN event_type = 'error' AND value > 200 THEN 'E-left'
            ELSE 'E' || user_id END AS employee_id,
       'SPLR*' || (props->>'$.k') || ' ' || upper(event_type) AS vendor_str, CAST(value AS DECIMAL(18,2)) AS amount_usd,
       strftime(CAST(ts AS DATE) - INTERVAL 270 MONTH, '%Y-%m-%d') AS posted_date
FROM events""",
    "fin_dim_department": """
SELECT DISTINCT 'D-' || c_mktsegment AS dept_id, c_mktsegment AS dept_name FROM customer""",
    "fin_dim_employee": """
SELECT 'E' || c_custkey AS employee_id, c_name AS full_name, 'D-' || c_mktsegment AS dept_id FROM customer""",
    "fin_dim_vendor": """
SELECT 'V' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS vendor_id, s_name AS canonical_name,
       CASE n_regionkey WHEN 0 THEN 'Travel' WHEN 1 THEN 'Meals' WHEN 2 THEN 'Software' WHEN 3 THEN 'Marketing'
            ELSE 'Utilities' END AS category,
       '["SPLR*' || s_suppkey || '","SUPPLIER ' || s_suppkey || ' LLC","S' || s_suppkey || ' ONLINE"]' AS aliases_json
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "alias_index": """
SELECT lower(name) AS alias, min(vendor_id || i) AS pos, max(vendor_id) AS vendor_id
FROM (SELECT vendor_id, unnest([canonical_name] || from_json(aliases_json, '["VARCHAR"]')) AS name,
             unnest([0, 1, 2, 3]) AS i FROM fin_dim_vendor)
GROUP BY lower(name)""",
    "spellings": """
SELECT DISTINCT raw, nullif(lower(trim(raw)), '') AS needle
FROM (SELECT merchant AS raw FROM fin_src_concur_expenses UNION ALL SELECT vendor_str FROM fin_src_corporate_card)
WHERE raw IS NOT NULL""",
    "vendor_map": """
SELECT raw, vendor_id, v.category AS vendor_category
FROM (SELECT s.raw, coalesce(e.vendor_id, l.vendor_id) AS vendor_id
      FROM spellings s LEFT JOIN alias_index e ON s.needle = e.alias
      LEFT JOIN (SELECT needle, arg_max(vendor_id, n) AS vendor_id
                 FROM (SELECT m.needle, a.vendor_id,
                              row_number() OVER (PARTITION BY m.needle ORDER BY length(a.alias), a.pos DESC) AS n
                       FROM (SELECT DISTINCT needle FROM spellings
                             WHERE needle IS NOT NULL AND needle NOT IN (SELECT alias FROM alias_index)) m
                       JOIN alias_index a ON contains(m.needle, a.alias) OR contains(a.alias, m.needle))
                 GROUP BY needle) l ON s.needle = l.needle) x
JOIN fin_dim_vendor v USING (vendor_id)""",
    "feeds": """
SELECT 'CN-' || CASE WHEN length(CAST(row_id AS VARCHAR)) > 6 THEN CAST(row_id AS VARCHAR)
                     ELSE lpad(CAST(row_id AS VARCHAR), 6, '0') END AS txn_id,
       'concur' AS source, employee_id, merchant AS raw, category, submitted_date AS date_text,
       amount AS original_amount, currency AS original_currency FROM fin_src_concur_expenses
UNION ALL
SELECT 'CC-' || CASE WHEN length(CAST(row_id AS VARCHAR)) > 6 THEN CAST(row_id AS VARCHAR)
                     ELSE lpad(CAST(row_id AS VARCHAR), 6, '0') END,
       'card', employee_id, vendor_str, NULL, posted_date, amount_usd, 'USD' FROM fin_src_corporate_card""",
    "fin_staged": """
SELECT txn_id, source, f.employee_id, e.dept_id, m.vendor_id,
       CASE WHEN source = 'card' THEN m.vendor_category ELSE f.category END AS category, txn_date,
       CASE WHEN original_currency = 'USD'
            THEN CAST(round(original_amount * CAST(3.6725 AS DECIMAL(5,4)), 2) AS DECIMAL(18,2))
            ELSE original_amount END AS amount_aed,
       original_currency, original_amount, f.raw, date_text,
       CASE WHEN txn_date IS NULL THEN 'bad_date' WHEN e.dept_id IS NULL THEN 'orphan_employee' ELSE 'ok' END AS status
FROM (SELECT *, CAST(coalesce(try_strptime(trim(date_text), ['%Y-%m-%d', '%d/%m/%Y', '%m-%d-%Y', '%d-%m-%Y', '%m/%d/%Y']),
                              TRY_CAST(trim(date_text) AS TIMESTAMP)) AS DATE) AS txn_date FROM feeds) f
LEFT JOIN vendor_map m ON f.raw = m.raw LEFT JOIN fin_dim_employee e ON f.employee_id = e.employee_id""",
    "fin_slv_transactions": """
SELECT txn_id, source, employee_id, dept_id, vendor_id, category, txn_date, amount_aed, original_currency, original_amount
FROM fin_staged WHERE status = 'ok'""",
    "finance_summary": """
SELECT count(*) FILTER (status = 'ok') AS silver_inserted, count(*) FILTER (status = 'bad_date') AS bad_dates,
       count(*) FILTER (status <> 'bad_date' AND vendor_id IS NULL) AS vendor_misses,
       count(*) FILTER (status = 'orphan_employee') AS orphan_employee,
       count(*) FILTER (source = 'concur') AS concur_total, count(*) FILTER (source = 'card') AS card_total
FROM fin_staged""",
    "fin_gld_spend_by_dept_month": """
SELECT t.dept_id, d.dept_name, CAST(year(txn_date) AS INTEGER) AS year, CAST(month(txn_date) AS INTEGER) AS month,
       strftime(txn_date, '%Y-%m') AS month_label, sum(amount_aed) AS total_aed, count(*) AS txn_count
FROM fin_slv_transactions t JOIN fin_dim_department d ON d.dept_id = t.dept_id GROUP BY ALL""",
    "vendor_totals": """
SELECT v.vendor_id, v.canonical_name, v.category, sum(t.amount_aed) AS total_aed, count(*) AS txn_count
FROM fin_slv_transactions t JOIN fin_dim_vendor v ON v.vendor_id = t.vendor_id GROUP BY ALL""",
    "fin_gld_top_vendors": """
SELECT *, CAST(row_number() OVER (ORDER BY total_aed DESC, vendor_id) AS BIGINT) AS pareto_rank,
       round(100 * CAST(sum(total_aed) OVER (ORDER BY total_aed DESC, vendor_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
             / CAST(sum(total_aed) OVER () AS DOUBLE), 2) AS cumulative_pct
FROM vendor_totals""",
    "fin_enriched": """
SELECT t.*, e.full_name AS employee, d.dept_name AS department, v.canonical_name AS vendor
FROM fin_slv_transactions t LEFT JOIN fin_dim_employee e ON e.employee_id = t.employee_id
LEFT JOIN fin_dim_department d ON d.dept_id = t.dept_id LEFT JOIN fin_dim_vendor v ON v.vendor_id = t.vendor_id""",
    "dq_entries": """
SELECT 1 AS id, 'silver' AS layer, 'schema_drift' AS kind, dropped_schema AS n,
       'dropped ' || dropped_schema || ' rows with malformed/missing keys' AS detail FROM silver_summary
UNION ALL SELECT 2, 'silver', 'null_flood', quarantined_nulls,
       'quarantined ' || quarantined_nulls || ' rows with NULL keys' FROM silver_summary
UNION ALL SELECT 3, 'silver', 'dupes', quarantined_dupes,
       'quarantined ' || quarantined_dupes || ' duplicate sale_id rows' FROM silver_summary
UNION ALL SELECT 4, 'silver', 'bad_type', bad_type, 'quarantined ' || bad_type || ' rows with uncastable values' FROM silver_summary
UNION ALL SELECT 11, 'gold', 'orphaned_fk', orphaned_fk, 'rejected ' || orphaned_fk || ' rows with unknown dim keys' FROM gold_summary
UNION ALL SELECT 21, 'finance', 'bad_date_format', bad_dates, 'dropped ' || bad_dates || ' rows with unparseable dates' FROM finance_summary
UNION ALL SELECT 22, 'finance', 'vendor_unmatched', vendor_misses, vendor_misses || ' rows landed in Silver with NULL vendor_id' FROM finance_summary
UNION ALL SELECT 23, 'finance', 'orphan_employee', orphan_employee,
       'quarantined ' || orphan_employee || ' rows with missing/unknown employee' FROM finance_summary""",
    "data_quality_events": """
SELECT CAST(id AS BIGINT) AS id, layer, kind, detail, CAST(n AS BIGINT) AS rows_affected, '2026-04-21 00:00:00' AS created_at
FROM dq_entries WHERE n > 0""",
    "daily_revenue": """
SELECT date_id, sum(amount) AS revenue, count(*) AS txns FROM gold_fact_sales GROUP BY date_id""",
    "customer_stats": """
SELECT customer_id, count(*) AS txns, CAST(sum(amount) AS DOUBLE) AS total_spend,
       CAST(sum(amount) AS DOUBLE) / count(*) AS avg_basket,
       CAST(date_diff('day', max(date_id), DATE '2001-08-01') AS INTEGER) AS recency_days
FROM gold_fact_sales GROUP BY customer_id""",
    "customer_features": """
SELECT c.customer_id, age, tier, country, coalesce(txns, 0) AS txns, coalesce(total_spend, 0.0) AS total_spend,
       coalesce(avg_basket, 0.0) AS avg_basket, CAST(coalesce(recency_days, 0) AS INTEGER) AS recency_days
FROM gold_dim_customer c LEFT JOIN customer_stats s ON s.customer_id = c.customer_id""",
    "basket_items": """
SELECT customer_id, date_id, name, count(*) AS n
FROM gold_fact_sales JOIN gold_dim_product USING (product_id) GROUP BY ALL""",
    "baskets": """
SELECT customer_id, date_id, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS item_count
FROM basket_items GROUP BY ALL HAVING sum(n) >= 2""",
}


def _derived_again(names: list[str], suffix: str, **bases: str) -> None:
    """Derive tables a second time under names with a suffix; ``bases`` replaces tables they start from."""
    other = {name: f"{name}_{suffix}" for name in names} | bases
    for name in names:
        TABLES[other[name]] = re.sub(r"\w+", lambda word: other.get(word[0], word[0]), TABLES[name])


def _injected(salt: str, n: int, changes: dict[str, str | None]) -> str:
    """``n`` clean payloads, changed; a value is SQL, None drops the key."""
    fields = {key: f"j->'$.{key}'" for key in re.findall(r"\w+", _KEYS)} | changes
    payload = ", ".join(f"'{key}', {value}" for key, value in fields.items() if value is not None)
    return f"""
SELECT id, source_system, ingested_at, payload_json, is_dirty, dirt_kind FROM bronze_sales_raw
UNION ALL
SELECT '2-{salt}-' || id, 'injected', ingested_at, CAST(json_object({payload}) AS VARCHAR), 1, '{salt}'
FROM (SELECT id, ingested_at, CAST(payload_json AS JSON) AS j FROM bronze_sales_raw WHERE is_dirty = 0 ORDER BY md5(id || '{salt}'), id LIMIT {n})"""


INJECTIONS = {
    "drift": _injected("drift", 30, {"sale_id": "'DRIFT' || (j->>'$.sale_id')", "amount": None, "currency": None, "amt": "j->'$.amount'"}),
    "dupes": _injected("dupes", 40, {}),
    "nulls": _injected("nulls", 25, {"sale_id": "'NULLFLOOD' || (j->>'$.sale_id')", "customer_id": "NULL"}),
}
for _salt, _sql in INJECTIONS.items():
    TABLES[f"bronze_{_salt}"] = _sql
    _derived_again(["parsed", "judged", "silver_sales", "silver_summary"], _salt, bronze_sales_raw=f"bronze_{_salt}")
_SOURCES = ("sales", "bronze_sales_raw", "oltp_transactions", "banking_transactions")
_derived_again([name for name in TABLES if name not in _SOURCES and not name.startswith(("gold_dim", "fin_src", "fin_dim")) and not name.endswith(tuple(INJECTIONS))], "again")


def differing(table: str, other: str) -> str:
    """How many rows are in one of two tables only, counting repeats."""
    return f"SELECT count(*) FROM ((FROM {table} EXCEPT ALL FROM {other}) UNION ALL (FROM {other} EXCEPT ALL FROM {table}))"


def twin(sql: str) -> str:
    """``sql`` with the subqueries it needs, directly or through others, in front."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\w+", text)):
            if word in TABLES and word not in needed:
                needed.add(word)
                visit(TABLES[word])

    visit(sql)
    heads = [f"{name} AS MATERIALIZED ({TABLES[name].strip()})" for name in TABLES if name in needed]
    return f"WITH {', '.join(heads)}\n{sql.strip()}" if heads else sql.strip()
