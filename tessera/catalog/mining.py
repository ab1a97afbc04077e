"""Mining queries. The twins of fitted models fit them again in SQL."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.catalog.forest import cut_of, forest_twin
from tessera.catalog.ingest import enriched
from tessera.catalog.registry import query
from tessera.operators import kmeans, rules
from tessera.plans import forecast, mining
from tessera.plans.warehouse import AS_OF, Warehouse

MIN_SUPPORT, MIN_CONFIDENCE = 0.001, 0.05


def _features(w: Warehouse) -> DataFrame:
    return mining.customer_features(w.table("gold_dim_customer"), w.table("gold_fact_sales"), AS_OF)


def _items(w: Warehouse) -> DataFrame:
    return rules.basket_items(w.table("gold_fact_sales"), w.table("gold_dim_product"))


@query("c2_j8_customer_features", "SELECT * FROM customer_features")
def _(w: Warehouse) -> DataFrame:
    return _features(w)


@query("d9_customer_stats", "SELECT * FROM customer_stats")
def _(w: Warehouse) -> DataFrame:
    return mining.customer_stats(w.table("gold_fact_sales"), AS_OF)


@query("c9_basket_items", "SELECT customer_id, CAST(date_id AS VARCHAR) AS date_id, name, n FROM basket_items")
def _(w: Warehouse) -> DataFrame:
    return _items(w)


@query("d11_baskets", "SELECT customer_id, CAST(date_id AS VARCHAR) AS date_id, row_count, item_count FROM baskets")
def _(w: Warehouse) -> DataFrame:
    return rules.baskets(_items(w))


_FIT = """SELECT *, i + s * t AS predicted FROM (SELECT *, row_number() OVER (ORDER BY date_id) - 1 AS t FROM daily_revenue)
CROSS JOIN (SELECT regr_slope(CAST(revenue AS DOUBLE), t) AS s, regr_intercept(CAST(revenue AS DOUBLE), t) AS i, count(*) AS n
            FROM (SELECT revenue, row_number() OVER (ORDER BY date_id) - 1 AS t FROM daily_revenue))"""


@query("e4_j4_revenue_forecast", f"""
SELECT CAST(CAST(last_day + to_days(CAST(step AS INTEGER)) AS DATE) AS VARCHAR) AS date_id, round(p, 2) AS predicted,
       round(p - 1.96 * sigma * sqrt(step), 2) AS lo, round(p + 1.96 * sigma * sqrt(step), 2) AS hi
FROM (SELECT step, last_day, sigma, i + s * (n + step - 1) AS p
      FROM (SELECT max(date_id) AS last_day, max(s) AS s, max(i) AS i, max(n) AS n,
                   stddev_pop(CAST(revenue AS DOUBLE) - predicted) AS sigma FROM ({_FIT}))
      CROSS JOIN (SELECT unnest(generate_series(1, 30)) AS step))""")
def _(w: Warehouse) -> DataFrame:
    ahead = forecast.revenue_forecast(forecast.daily_revenue(w.table("gold_fact_sales")))
    return ahead.select("date_id", *[F.round(c, 2).alias(c) for c in ("predicted", "lo", "hi")])


@query("e4_revenue_history", f"""
SELECT CAST(date_id AS VARCHAR) AS date_id, CAST(revenue AS DOUBLE) AS revenue, round(predicted, 2) AS predicted FROM ({_FIT})""")
def _(w: Warehouse) -> DataFrame:
    history = forecast.revenue_history(forecast.daily_revenue(w.table("gold_fact_sales")))
    return history.select("date_id", "revenue", F.round("predicted", 2).alias("predicted"))


@query("e4_revenue_fit", f"""
SELECT round(max(s), 4) AS slope, round(max(i), 2) AS intercept, round(stddev_pop(CAST(revenue AS DOUBLE) - predicted), 2) AS sigma,
       CAST(max(n) AS BIGINT) AS n FROM ({_FIT})""")
def _(w: Warehouse) -> DataFrame:
    fit = forecast.revenue_fit(forecast.daily_revenue(w.table("gold_fact_sales")))
    return fit.select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("sigma", 2).alias("sigma"), "n")


_Z = ", ".join(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS z{i}" for i, c in enumerate(mining.CLUSTER_FEATURES))
_ZS = [f"z{i}" for i in range(len(mining.CLUSTER_FEATURES))]
_DISTANCE = " + ".join(f"(p.{z} - c.{z}) * (p.{z} - c.{z})" for z in _ZS)
_CLUSTERS = f"""
WITH RECURSIVE points AS MATERIALIZED (SELECT *, {_Z} FROM customer_features),
dealt AS (SELECT *, row_number() OVER (PARTITION BY start ORDER BY md5(concat(customer_id, ':{mining.SEED}:', start)), customer_id) - 1 AS cluster
          FROM points, range({mining.RESTARTS}) r(start)),
moves AS (
  SELECT 0 AS round, start, cluster, {", ".join(_ZS)}, 1e9 AS moved FROM dealt WHERE cluster < 4
  UNION ALL
  SELECT round, start, cluster, {", ".join(_ZS)}, sum(step) OVER (PARTITION BY start) AS moved FROM (
    SELECT o.round + 1 AS round, o.start, o.cluster, {", ".join(f"coalesce(m.{z}, o.{z}) AS {z}" for z in _ZS)},
           {" + ".join(f"pow(coalesce(m.{z}, o.{z}) - o.{z}, 2)" for z in _ZS)} AS step
    FROM moves o LEFT JOIN (
      SELECT start, cluster, {", ".join(f"avg({z}) AS {z}" for z in _ZS)} FROM (
        SELECT c.start, p.customer_id, {", ".join(f"any_value(p.{z}) AS {z}" for z in _ZS)}, arg_min(c.cluster, {_DISTANCE}) AS cluster
        FROM points p, moves c WHERE c.moved > {kmeans.MOVEMENT} GROUP BY c.start, p.customer_id)
      GROUP BY start, cluster) m ON m.start = o.start AND m.cluster = o.cluster
    WHERE o.moved > {kmeans.MOVEMENT} AND o.round < {kmeans.ROUNDS})),
ends AS MATERIALIZED (SELECT * FROM moves QUALIFY round = max(round) OVER (PARTITION BY start)),
best AS (
  SELECT start FROM (SELECT start, sum(d) AS cost FROM (
    SELECT c.start, p.customer_id, min({_DISTANCE}) AS d FROM points p, ends c GROUP BY c.start, p.customer_id) GROUP BY start)
  ORDER BY round(cost, {kmeans.COST_DIGITS}), start LIMIT 1),
centers AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY {", ".join(_ZS)}) - 1 AS INTEGER) AS cluster, {", ".join(_ZS)} FROM ends WHERE start = (SELECT start FROM best)),
clustered AS MATERIALIZED (
  SELECT p.customer_id, any_value(total_spend) AS total_spend, any_value(recency_days) AS recency_days, any_value(txns) AS txns,
         arg_min(c.cluster, {_DISTANCE}) AS cluster FROM points p, centers c GROUP BY p.customer_id)"""


@query("j1_cluster_points", f"SELECT * FROM ({_CLUSTERS} SELECT * FROM clustered)")
def _(w: Warehouse) -> DataFrame:
    return w.table("cluster_points")


def _real(column: str) -> str:
    z = f"c.z{mining.CLUSTER_FEATURES.index(column)}"
    return f"round({z} * (SELECT coalesce(nullif(stddev_pop({column}), 0), 1) FROM points) + (SELECT avg({column}) FROM points), 6)"


@query("j1_d28_cluster_summary", f"""SELECT * FROM ({_CLUSTERS}
SELECT s.*, {_real("total_spend")} AS centroid_spend, {_real("recency_days")} AS centroid_recency
FROM (SELECT cluster, count(*) AS n, round(avg(total_spend), 6) AS avg_spend, round(avg(txns), 6) AS avg_txns, round(avg(recency_days), 6) AS avg_recency
      FROM clustered GROUP BY cluster) s JOIN centers c USING (cluster))""")
def _(w: Warehouse) -> DataFrame:
    summary = mining.cluster_summary(w.table("cluster_points")).join(w.table("cluster_centroids"), "cluster")
    return summary.select(
        "cluster", "n", *[F.round(c, 6).alias(c) for c in ("avg_spend", "avg_txns", "avg_recency")],
        F.round("total_spend", 6).alias("centroid_spend"), F.round("recency_days", 6).alias("centroid_recency"),
    )


_LABELS = """SELECT customer_id, total_spend, txns, CAST(recency_days > 30 AS INTEGER) AS churned FROM customer_features WHERE txns > 0"""


@query("j2_churn_labels", _LABELS)
def _(w: Warehouse) -> DataFrame:
    return mining.churn_labels(_features(w))


@query("j2_churn_counts", f"""
SELECT count(*) FILTER (churned = 1) AS churned, count(*) FILTER (churned = 0) AS active FROM ({_LABELS})""")
def _(w: Warehouse) -> DataFrame:
    return mining.churn_counts(mining.churn_labels(_features(w)))


def _newton(steps: int) -> str:
    """Newton steps as a recursive query; the 3 x 3 system is solved by determinants."""
    g = "g0, g1, g2, h00, h01, h02, h11, h12, h22"
    det = "(h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02))"
    d0 = "(g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2))"
    d1 = "(h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02))"
    d2 = "(h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02))"
    return f"""
WITH RECURSIVE labels AS MATERIALIZED (SELECT * FROM ({_LABELS})),
scale AS MATERIALIZED (SELECT avg(total_spend) AS m0, coalesce(nullif(stddev_pop(total_spend), 0), 1) AS s0, avg(txns) AS m1,
  coalesce(nullif(stddev_pop(txns), 0), 1) AS s1, min(total_spend) AS low0, max(total_spend) AS high0, min(txns)::DOUBLE AS low1, max(txns)::DOUBLE AS high1 FROM labels),
z AS MATERIALIZED (SELECT churned, (total_spend - m0) / s0 AS z0, (txns - m1) / s1 AS z1 FROM labels, scale),
steps AS (
  SELECT 0 AS step, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2
  UNION ALL
  SELECT step + 1, w0 - {d0} / {det}, w1 - {d1} / {det}, w2 - {d2} / {det} FROM (
    SELECT step, w0, w1, w2, sum((p - churned) * z0) + w0 AS g0, sum((p - churned) * z1) + w1 AS g1, sum(p - churned) AS g2,
           sum(p * (1 - p) * z0 * z0) + 1 AS h00, sum(p * (1 - p) * z0 * z1) AS h01, sum(p * (1 - p) * z0) AS h02,
           sum(p * (1 - p) * z1 * z1) + 1 AS h11, sum(p * (1 - p) * z1) AS h12, sum(p * (1 - p)) AS h22
    FROM (SELECT step, w0, w1, w2, z0, z1, churned, 1 / (1 + exp(-(w0 * z0 + w1 * z1 + w2))) AS p FROM steps, z WHERE step < {steps})
    GROUP BY step, w0, w1, w2)),
model AS MATERIALIZED (SELECT w0, w1, w2 FROM steps ORDER BY step DESC LIMIT 1)"""


@query("j2_churn_classifier", f"""SELECT * FROM ({_newton(25)}
SELECT count(*) FILTER (churned = 1) AS churned, count(*) FILTER (churned = 0) AS active,
       round(avg(CASE WHEN (1 / (1 + exp(-(w0 * z0 + w1 * z1 + w2))) > 0.5) = (churned = 1) THEN 1.0 ELSE 0.0 END), 3) AS accuracy,
       CAST(NULL AS VARCHAR) AS error FROM z, model)""")
def _(w: Warehouse) -> DataFrame:
    return mining.churn_classifier(_features(w)).summary


@query("j3_decision_grid", f"""SELECT * FROM ({_newton(25)}
SELECT round(total_spend, 6) AS total_spend, round(txns, 6) AS txns,
       round(1 / (1 + exp(-(w0 * (total_spend - m0) / s0 + w1 * (txns - m1) / s1 + w2))), 6) AS churn_prob
FROM (SELECT low0 + x * ((high0 - low0) / {mining.GRID - 1}) AS total_spend, low1 + y * ((high1 - low1) / {mining.GRID - 1}) AS txns
      FROM scale, range({mining.GRID}) a(x), range({mining.GRID}) b(y)), scale, model)""")
def _(w: Warehouse) -> DataFrame:
    grid = mining.churn_classifier(_features(w)).grid
    return grid.select(*[F.round(c, 6).alias(c) for c in ("total_spend", "txns", "churn_prob")])


# Itemsets of one to three names that reach the support, with counts.
_ITEMSETS = f"""
total AS MATERIALIZED (SELECT count(*) AS n FROM baskets),
valid AS MATERIALIZED (SELECT i.customer_id, i.date_id, i.name FROM basket_items i
  JOIN baskets b ON b.customer_id = i.customer_id AND b.date_id = i.date_id),
itemsets AS MATERIALIZED (SELECT * FROM (
  SELECT [name] AS items, count(*) AS freq FROM valid GROUP BY name
  UNION ALL SELECT [a.name, b.name], count(*) FROM valid a
    JOIN valid b ON a.customer_id = b.customer_id AND a.date_id = b.date_id AND a.name < b.name GROUP BY a.name, b.name
  UNION ALL SELECT [a.name, b.name, c.name], count(*) FROM valid a
    JOIN valid b ON a.customer_id = b.customer_id AND a.date_id = b.date_id AND a.name < b.name
    JOIN valid c ON a.customer_id = c.customer_id AND a.date_id = c.date_id AND b.name < c.name
    GROUP BY a.name, b.name, c.name)
  WHERE freq >= (SELECT ceil({MIN_SUPPORT} * n) FROM total))"""


def _with_itemsets(sql: str) -> str:
    """Subqueries of this module follow the shared ones that ``twin`` puts first."""
    return f"SELECT * FROM (WITH {_ITEMSETS.strip()} {sql})"


@query("j5_frequent_itemsets", _with_itemsets("SELECT array_to_string(items, ', ') AS items, freq FROM itemsets"))
def _(w: Warehouse) -> DataFrame:
    itemsets, _ = rules.frequent_itemsets(_items(w), MIN_SUPPORT)
    return itemsets.select(F.array_join("items", ", ").alias("items"), "freq")


@query("j5_f3_association_rules", _with_itemsets(f"""
SELECT array_to_string(antecedents, ', ') AS antecedents, array_to_string(consequents, ', ') AS consequents,
       round(support, 4) AS support, round(confidence, 4) AS confidence, round(lift, 3) AS lift
FROM (SELECT i.antecedents, i.consequents, CAST(i.freq AS DOUBLE) / n AS support, CAST(i.freq AS DOUBLE) / a.freq AS confidence,
             CAST(i.freq AS DOUBLE) * n / (CAST(a.freq AS DOUBLE) * c.freq) AS lift
      FROM (SELECT items, freq, antecedents, list_filter(items, lambda x: NOT list_contains(antecedents, x)) AS consequents
            FROM (SELECT items, freq, unnest(CASE WHEN len(items) = 2 THEN [[items[1]], [items[2]]]
                    ELSE [[items[1]], [items[2]], [items[3]], [items[1], items[2]], [items[1], items[3]], [items[2], items[3]]] END) AS antecedents
                  FROM itemsets WHERE len(items) >= 2)) i
      JOIN itemsets a ON a.items = i.antecedents JOIN itemsets c ON c.items = i.consequents CROSS JOIN total)
WHERE confidence >= {MIN_CONFIDENCE}
QUALIFY row_number() OVER (ORDER BY lift DESC, support DESC, antecedents, consequents) <= 25"""))
def _(w: Warehouse) -> DataFrame:
    itemsets, total = rules.frequent_itemsets(_items(w), MIN_SUPPORT)
    found = rules.association_rules(itemsets, total, MIN_CONFIDENCE)
    return found.withColumns({c: F.array_join(c, ", ") for c in ("antecedents", "consequents")})


_BANKING = """
SELECT txn_id, CAST(amount AS DOUBLE) AS amount, merchant, is_fraud, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(hour(ts) >= 22 OR hour(ts) <= 5 AS INTEGER) AS is_night,
       CAST(starts_with(merchant, 'unknown') AS INTEGER) AS is_unknown_merchant FROM banking_transactions"""


@query("j9_h9_banking_features", _BANKING)
def _(w: Warehouse) -> DataFrame:
    return mining.banking_features(w.table("banking_transactions"))


_FRAUD = f"""
scored AS MATERIALIZED (SELECT b.*, f.path, f.score FROM ({_BANKING}) b
  JOIN {forest_twin(_BANKING, "txn_id", ["amount", "is_night", "is_unknown_merchant"], [], mining.FRAUD_TREES, mining.SEED)} f ON f.k = b.txn_id)"""


def _with_fraud(sql: str) -> str:
    return f"SELECT * FROM (WITH {_FRAUD.strip()} {sql})"


@query("j6_f2_top_anomalies", _with_fraud(f"""
SELECT txn_id, amount, hour, merchant, is_fraud, round(score, 9) AS score FROM scored ORDER BY path, txn_id LIMIT {mining.TOP_ANOMALIES}"""))
def _(w: Warehouse) -> DataFrame:
    return mining.top_anomalies(w.table("fraud_scores")).withColumn("score", F.round("score", 9))


@query("j6_d29_confusion", _with_fraud(f"""
SELECT count(*) FILTER (is_fraud = 1 AND flagged) AS true_fraud_flagged, count(*) FILTER (is_fraud = 1 AND NOT flagged) AS true_fraud_missed,
       count(*) FILTER (is_fraud = 0 AND flagged) AS false_positive, count(*) FILTER (is_fraud = 0 AND NOT flagged) AS true_negative
FROM (SELECT *, path < {cut_of("scored", 0.03)} AS flagged FROM scored)"""))
def _(w: Warehouse) -> DataFrame:
    return mining.confusion(mining.flag_fraud(w.table("fraud_scores")))


@query("d29_confusion_of_rule", f"""
SELECT count(*) FILTER (is_fraud = 1 AND flagged = 1) AS true_fraud_flagged, count(*) FILTER (is_fraud = 1 AND flagged = 0) AS true_fraud_missed,
       count(*) FILTER (is_fraud = 0 AND flagged = 1) AS false_positive, count(*) FILTER (is_fraud = 0 AND flagged = 0) AS true_negative
FROM (SELECT *, CAST(is_night = 1 AND amount > 100 AS INTEGER) AS flagged FROM ({_BANKING}))""")
def _(w: Warehouse) -> DataFrame:
    rows = mining.banking_features(w.table("banking_transactions"))
    return mining.confusion(rows.withColumn("flagged", ((F.col("is_night") == 1) & (F.col("amount") > 100)).cast("int")))


@query("h11_spend_features", """
SELECT txn_id, round(ln(1 + greatest(CAST(amount_aed AS DOUBLE), 0)), 9) AS log_amount, CAST(isodow(txn_date) - 1 AS INTEGER) AS dow,
       coalesce(department, 'UNK') AS dept_label, coalesce(category, 'UNK') AS category_label FROM fin_enriched""")
def _(w: Warehouse) -> DataFrame:
    return mining.spend_features(enriched(w)).select(
        "txn_id", F.round("log_amount", 9).alias("log_amount"), "dow", "dept_label", "category_label"
    )


def _one_hot_sql(label: str) -> str:
    return f"""(SELECT string_agg(CASE WHEN l = f.{label} THEN '1' ELSE '0' END, '' ORDER BY l)
                FROM (SELECT DISTINCT {label} AS l FROM spend_labels)) AS {label}"""


@query("h12_one_hot", f"""
SELECT * FROM (WITH spend_labels AS MATERIALIZED (
  SELECT txn_id, coalesce(department, 'UNK') AS dept_label, coalesce(category, 'UNK') AS category_label FROM fin_enriched)
SELECT txn_id, {_one_hot_sql("dept_label")}, {_one_hot_sql("category_label")} FROM spend_labels f)""")
def _(w: Warehouse) -> DataFrame:
    hot = mining.one_hot(mining.spend_features(enriched(w)), ["dept_label", "category_label"])
    return hot.select("txn_id", *[F.array_join(vector_to_array(f"{c}_vec").cast("array<int>"), "").alias(c) for c in ("dept_label", "category_label")])


_SPEND_FEATURES = f"""
SELECT txn_id, round(ln(1 + greatest(CAST(amount_aed AS DOUBLE), 0)), {mining.LOG_DIGITS}) AS log_amount, CAST(isodow(txn_date) - 1 AS INTEGER) AS dow,
       coalesce(department, 'UNK') AS dept_label, coalesce(category, 'UNK') AS category_label FROM fin_enriched"""
_SPEND = f"""
scored AS MATERIALIZED (SELECT b.*, f.path, f.score FROM fin_enriched b
  JOIN {forest_twin(_SPEND_FEATURES, "txn_id", ["log_amount", "dow"], ["dept_label", "category_label"], mining.FINANCE_TREES, mining.FINANCE_SEED)} f
    ON f.k = b.txn_id),
cut AS MATERIALIZED (SELECT {cut_of("scored", 0.05)} AS path),
middle AS MATERIALIZED (SELECT coalesce(nullif(median(CAST(amount_aed AS DOUBLE)), 0), 1.0) AS m FROM scored)"""


def _with_spend(sql: str) -> str:
    return f"SELECT * FROM (WITH {_SPEND.strip()} {sql})"


def _spend_anomalies(w: Warehouse) -> mining.SpendAnomalies:
    return mining.spend_anomalies(w.table("spend_scores"), w.table("fin_dim_employee"), w.table("fin_dim_vendor"))


@query("j7_f4_spend_anomalies", _with_spend("""
SELECT txn_id, source, employee, department, vendor, category, CAST(txn_date AS VARCHAR) AS txn_date, amount AS amount_aed,
       round(score - (SELECT max(score) FROM scored WHERE path = (SELECT path FROM cut)), 4) AS anomaly_score,
       CASE WHEN reasons = '' THEN 'unusual combination of dept + category + amount' ELSE reasons END AS reasons
FROM (SELECT *, concat_ws('; ',
        CASE WHEN multiple >= 5 THEN CAST(CAST(multiple AS DECIMAL(30,1)) AS VARCHAR) || 'x the median txn' END,
        CASE WHEN isodow(txn_date) >= 6 THEN 'posted on a weekend' END,
        CASE WHEN amount >= 10000 THEN 'amount above 10,000 AED' END) AS reasons
      FROM (SELECT *, CAST(amount_aed AS DOUBLE) AS amount, round(CAST(amount_aed AS DOUBLE) / (SELECT m FROM middle), 1) AS multiple FROM scored))
WHERE path < (SELECT path FROM cut) ORDER BY amount DESC, path, txn_id LIMIT 25"""))
def _(w: Warehouse) -> DataFrame:
    flagged = _spend_anomalies(w).flagged
    return flagged.withColumn("reasons", F.array_join("reasons", "; "))


@query("j7_spend_anomaly_summary", _with_spend("""
SELECT count(*) AS total_rows, count(*) FILTER (path < (SELECT path FROM cut)) AS outlier_count, 0.05::DOUBLE AS sensitivity,
       round(max(m), 2) AS median_amount_aed FROM scored, middle"""))
def _(w: Warehouse) -> DataFrame:
    return _spend_anomalies(w).summary
