"""Mining jobs over customers, baskets, card payments and spend rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import kmeans, logistic
from tessera.operators.isolation_forest import isolation_scores, path_cut
from tessera.operators.prefix_scan import exact_median
from tessera.plans.finance import enrich, enrich_few
from tessera.plans.marts import anomaly_reasons
from tessera.sources.workspace import materialize, spread

# The defaults of the mining jobs.
CLUSTER_FEATURES = ["txns", "total_spend", "avg_basket", "recency_days"]
CHURN_FEATURES = ["total_spend", "txns"]
RESTARTS = 10
SEED = 42
GRID = 30
TOP_ANOMALIES = 50
FINANCE_SEED = 20260421
FRAUD_TREES, FINANCE_TREES = 100, 120
# Digits of the log amount that a model sees; libraries differ beyond them.
LOG_DIGITS = 6
SENSITIVITY_RANGE = (0.005, 0.30)


def customer_stats(fact: DataFrame, as_of: str) -> DataFrame:
    """Sales, spend, mean basket and days since the last sale per customer."""
    return fact.groupBy("customer_id").agg(
        F.count("*").alias("txns"),
        F.sum("amount").cast("double").alias("total_spend"),
        (F.sum("amount").cast("double") / F.count("amount")).alias("avg_basket"),
        F.date_diff(F.lit(as_of).cast("date"), F.max("date_id")).alias("recency_days"),
    )


def customer_features(customers: DataFrame, fact: DataFrame, as_of: str) -> DataFrame:
    """Every customer; one without sales has zeros, also for the recency."""
    stats = customer_stats(fact, as_of)
    return customers.join(stats, "customer_id", "left").select(
        "customer_id", "age", "tier", "country",
        F.coalesce("txns", F.lit(0)).alias("txns"),
        F.coalesce("total_spend", F.lit(0.0)).alias("total_spend"),
        F.coalesce("avg_basket", F.lit(0.0)).alias("avg_basket"),
        F.coalesce("recency_days", F.lit(0)).alias("recency_days"),
    )


def _scaling(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column is left at scale 1."""
    row = df.agg(*[
        f(F.col(c).cast("double")).alias(f"{f.__name__}_{c}") for c in columns for f in (F.avg, F.stddev_pop)
    ]).first()
    return {c: (row[f"avg_{c}"], row[f"stddev_pop_{c}"] or 1.0) for c in columns}


def _standardised(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({f"z_{c}": (F.col(c) - F.lit(mean)) / F.lit(deviation) for c, (mean, deviation) in scale.items()})


@dataclass(frozen=True)
class Clusters:
    points: DataFrame
    centroids: DataFrame
    summary: DataFrame


def cluster_customers(features: DataFrame, k: int = 4) -> Clusters:
    """k-means on standardised behaviour, best of ten starts; centroids in real units."""
    features = materialize(features, "customer_features")
    spark = features.sparkSession
    centroid_schema = "cluster int, txns double, total_spend double, avg_basket double, recency_days double"
    if features.isEmpty():
        points, centers = features.withColumn("cluster", F.lit(0)), []
    else:
        scale = _scaling(features, CLUSTER_FEATURES)
        ready = materialize(_standardised(features, scale), "standardised")
        model = kmeans.fit(ready, "customer_id", [f"z_{c}" for c in CLUSTER_FEATURES], k, RESTARTS, SEED)
        points, centers = model.clustered(ready), model.centers
    real = [
        (i, *[v * scale[c][1] + scale[c][0] for c, v in zip(CLUSTER_FEATURES, center, strict=True)])
        for i, center in enumerate(centers)
    ]
    kept = materialize(points.select("customer_id", "total_spend", "recency_days", "txns", "cluster"), "cluster_points")
    return Clusters(kept, spark.createDataFrame(real, centroid_schema), cluster_summary(kept))


def cluster_summary(points: DataFrame) -> DataFrame:
    return points.groupBy("cluster").agg(
        F.count("*").alias("n"), F.avg("total_spend").alias("avg_spend"),
        F.avg("txns").alias("avg_txns"), F.avg("recency_days").alias("avg_recency"),
    )


def churn_labels(features: DataFrame, threshold_days: int = 30) -> DataFrame:
    """Customers with sales; ``churned`` if the last one is older than the threshold."""
    return features.filter("txns > 0").select(
        "customer_id", "total_spend", "txns",
        (F.col("recency_days") > threshold_days).cast("int").alias("churned"),
    )


def churn_counts(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count_if(F.col("churned") == 1).alias("churned"), F.count_if(F.col("churned") == 0).alias("active"))


@dataclass(frozen=True)
class Churn:
    summary: DataFrame
    points: DataFrame
    grid: DataFrame


def churn_classifier(features: DataFrame, threshold_days: int = 30) -> Churn:
    """Churn from spend and sales by logistic regression.

    ``summary`` has the class counts and the in-sample accuracy; with a single class there
    is no model: the accuracy is NULL, ``error`` says why and the grid is empty.
    """
    labels = materialize(churn_labels(features, threshold_days), "churn_labels")
    counts = churn_counts(labels)
    churned, active = counts.first()
    spark = features.sparkSession
    if not churned or not active:
        reason = "no customers with transactions" if not churned + active else (
            f"all customers on same side of threshold ({threshold_days}d)")
        summary = counts.select("*", F.lit(None).cast("double").alias("accuracy"), F.lit(reason).alias("error"))
        return Churn(summary, labels, spark.range(0).selectExpr("0D total_spend", "0D txns", "0D churn_prob"))
    scale = _scaling(labels, CHURN_FEATURES)
    ready = materialize(_standardised(labels, scale), "standardised")
    # An L2 strength of 1 on the summed loss.
    model = logistic.fit(ready, [f"z_{c}" for c in CHURN_FEATURES], "churned")
    hits = F.avg(((F.col("p") > 0.5).cast("int") == F.col("churned")).cast("double"))
    accuracy = model.scored(ready, "p").agg(F.round(hits, 3)).first()[0]
    summary = counts.select("*", F.lit(accuracy).alias("accuracy"), F.lit(None).cast("string").alias("error"))
    low_high = labels.agg(*[f(c).cast("double") for c in CHURN_FEATURES for f in (F.min, F.max)]).first()
    cells = spark.range(GRID * GRID).select(
        _linspace(F.pmod("id", F.lit(GRID)), low_high[0], low_high[1]).alias("total_spend"),
        _linspace(F.floor(F.col("id") / GRID), low_high[2], low_high[3]).alias("txns"),
    )
    grid = model.scored(_standardised(cells, scale), "churn_prob").select("total_spend", "txns", "churn_prob")
    return Churn(summary, labels, grid)


def _linspace(step: Column, low: float, high: float) -> Column:
    return F.lit(low) + step * F.lit((high - low) / (GRID - 1))


def banking_features(banking: DataFrame) -> DataFrame:
    """Hour, night flag and unknown-merchant flag of each payment."""
    hour = F.hour("ts")
    return banking.select(
        "txn_id", "amount", "merchant", "is_fraud", hour.alias("hour"),
        ((hour >= 22) | (hour <= 5)).cast("int").alias("is_night"),
        F.col("merchant").startswith("unknown").cast("int").alias("is_unknown_merchant"),
    )


def fraud_scores(banking: DataFrame) -> DataFrame:
    """Every payment with its path and score; write it once for all reports on it."""
    features = materialize(banking_features(spread(banking)), "banking_features")
    return isolation_scores(features, "txn_id", ["amount", "is_night", "is_unknown_merchant"], trees=FRAUD_TREES, seed=SEED)


def flag_fraud(scored: DataFrame, contamination: float = 0.03) -> DataFrame:
    """Scored payments with the flag of the strangest share."""
    return scored.withColumn("flagged", F.coalesce(F.col("path") < F.lit(path_cut(scored, contamination)), F.lit(False)).cast("int"))


def top_anomalies(scored: DataFrame, limit: int = TOP_ANOMALIES) -> DataFrame:
    return scored.orderBy("path", "txn_id").limit(limit).select(
        "txn_id", "amount", "hour", "merchant", "is_fraud", "score"
    )


def confusion(scored: DataFrame, label: str = "is_fraud", flag: str = "flagged") -> DataFrame:
    def both(actual: int, predicted: int) -> Column:
        return F.count_if((F.col(label) == actual) & (F.col(flag) == predicted))

    return scored.agg(
        both(1, 1).alias("true_fraud_flagged"), both(1, 0).alias("true_fraud_missed"),
        both(0, 1).alias("false_positive"), both(0, 0).alias("true_negative"),
    )


def clamp_sensitivity(sensitivity: float) -> float:
    low, high = SENSITIVITY_RANGE
    return max(low, min(high, float(sensitivity)))


def spend_features(with_department: DataFrame) -> DataFrame:
    """The columns the spend model sees: log amount, weekday, department and category."""
    return with_department.select(
        "*",
        F.log1p(F.greatest(F.col("amount_aed").cast("double"), F.lit(0.0))).alias("log_amount"),
        F.weekday("txn_date").alias("dow"),
        F.coalesce("department", F.lit("UNK")).alias("dept_label"),
        F.coalesce("category", F.lit("UNK")).alias("category_label"),
    )


def one_hot(features: DataFrame, columns: list[str]) -> DataFrame:
    """One 0/1 vector per label column, one place per label in alphabetical order."""
    codes, vectors = [f"{c}_code" for c in columns], [f"{c}_vec" for c in columns]
    indexed = StringIndexer(inputCols=columns, outputCols=codes, stringOrderType="alphabetAsc").fit(features).transform(features)
    encoder = OneHotEncoder(inputCols=codes, outputCols=vectors, dropLast=False)
    return encoder.fit(indexed).transform(indexed).drop(*codes)


@dataclass(frozen=True)
class SpendAnomalies:
    flagged: DataFrame
    summary: DataFrame


def spend_scores(silver: DataFrame, departments: DataFrame) -> DataFrame:
    """Every spend row with its path and score; write it once for all reports on it."""
    features = spend_features(enrich(spread(silver), departments=departments))
    features = materialize(features.withColumn("log_amount", F.round("log_amount", LOG_DIGITS)), "spend_features")
    return isolation_scores(
        features, "txn_id", ["log_amount", "dow"], ["dept_label", "category_label"], trees=FINANCE_TREES, seed=FINANCE_SEED
    )


def spend_anomalies(
    scored: DataFrame, employees: DataFrame, vendors: DataFrame, sensitivity: float = 0.05, top_k: int = 25,
) -> SpendAnomalies:
    """The largest of the strangest spend rows, each with its reasons, and the totals."""
    sensitivity = clamp_sensitivity(sensitivity)
    cut = path_cut(scored, sensitivity)
    is_outlier = F.coalesce(F.col("path") < F.lit(cut), F.lit(False))
    cut_score = scored.filter(F.col("path") == F.lit(cut)).agg(F.max("score")).first()[0]
    excess = scored.withColumn("anomaly_score", F.col("score") - F.lit(cut_score))
    median = exact_median(scored, "amount_aed").first()[0] or 1.0
    largest = excess.filter(is_outlier).orderBy(F.desc("amount_aed"), "path", "txn_id").limit(top_k)
    flagged = enrich_few(largest, employees=employees, vendors=vendors).select(
        "txn_id", "source", "employee", "department", "vendor", "category", "txn_date",
        F.col("amount_aed").cast("double").alias("amount_aed"),
        F.round("anomaly_score", 4).alias("anomaly_score"),
        anomaly_reasons(F.col("amount_aed"), F.col("txn_date"), F.lit(median)).alias("reasons"),
    )
    summary = scored.agg(
        F.count("*").alias("total_rows"), F.count_if(is_outlier).alias("outlier_count")
    ).select("*", F.lit(sensitivity).alias("sensitivity"), F.lit(round(median, 2)).alias("median_amount_aed"))
    return SpendAnomalies(flagged, summary)
