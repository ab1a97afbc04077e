"""Association rules over baskets of product names."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.workspace import materialize

MAX_ITEMS = 3
TOP_RULES = 25
BASKET = ["customer_id", "date_id"]


def basket_items(fact: DataFrame, products: DataFrame) -> DataFrame:
    """``customer_id, date_id, name, n``: what a customer bought on a day, one row per product name."""
    return fact.join(products.select("product_id", "name"), "product_id").groupBy(*BASKET, "name").agg(
        F.count("*").alias("n")
    )


def baskets(items: DataFrame) -> DataFrame:
    """Baskets of two rows or more; a product bought twice counts as two rows and one item."""
    return items.groupBy(*BASKET).agg(
        F.sum("n").alias("row_count"), F.count("*").alias("item_count")
    ).filter("row_count >= 2")


def frequent_itemsets(items: DataFrame, min_support: float) -> tuple[DataFrame, int]:
    """Itemsets of up to three names that reach the support, with counts; and the number of baskets.

    Level by level: a basket's frequent names are paired, and only pairs that are frequent themselves are extended by the
    names behind them. Rows of a level are counted before the shuffle, so a pair that a third of all baskets hold costs one
    row per task. A basket's names are an array in order; there are at most (names per basket) / support of them.
    """
    # Written once, as the arrays of names: every level below reads it, and the join behind the items runs a single time.
    held = materialize(
        items.groupBy(*BASKET).agg(F.sum("n").alias("row_count"), F.array_sort(F.collect_list(F.struct("name"))).alias("names"))
        .filter("row_count >= 2").select(*BASKET, F.col("names.name").alias("names")), "baskets"
    )
    total = held.count()
    # In decimals: an itemset exactly at the support is kept.
    needed = max(1, math.ceil(Decimal(str(min_support)) * total))
    reached = F.col("freq") >= needed
    named = held.dropna(subset=BASKET).select(*BASKET, F.explode("names").alias("name"))
    single = materialize(named.groupBy(F.array("name").alias("items")).agg(F.count("*").alias("freq")).filter(reached), "single")
    # Only baskets with a rare name are put together anew.
    rare = named.join(single.select(F.col("items")[0].alias("name")), "name", "left_anti")
    several = materialize(_without(held.dropna(subset=BASKET), rare).filter(F.size("names") > 1).select("names"), "several")
    pairs = _extended(several.select("names", F.posexplode("names").alias("at", "a")).withColumn("items", F.array("a")))
    double = materialize(pairs.groupBy("items").agg(F.count("*").alias("freq")).filter(reached), "double")
    triples = _extended(pairs.join(double.select("items"), "items", "left_semi"))
    triple = triples.groupBy("items").agg(F.count("*").alias("freq")).filter(reached)
    return single.unionByName(double).unionByName(triple), total


def _without(held: DataFrame, rare: DataFrame) -> DataFrame:
    """Baskets without their rare names and without nulls. The rare names are written first, so that few of them are broadcast."""
    out = materialize(rare.groupBy(*BASKET).agg(F.collect_list("name").alias("rare")), "rare_names")
    left = F.when(F.col("rare").isNull(), F.col("names")).otherwise(F.array_except("names", "rare"))
    return held.join(out, BASKET, "left").select(*BASKET, F.array_compact(left).alias("names"))


def _extended(sets: DataFrame) -> DataFrame:
    """``names, items, at``: each itemset with each name of its basket behind ``at``, the place of its last one."""
    behind = F.posexplode(F.slice("names", F.col("at") + 2, F.size("names"))).alias("step", "next")
    longer = sets.filter(F.col("at") + 1 < F.size("names")).select("names", "items", "at", behind)
    return longer.select("names", F.concat("items", F.array("next")).alias("items"), (F.col("at") + 1 + F.col("step")).alias("at"))


def association_rules(
    itemsets: DataFrame, baskets_total: int, min_confidence: float = 0.2, top: int = TOP_RULES
) -> DataFrame:
    """Every split of every itemset into antecedents and consequents; highest lift first."""
    # Each number up to 2^size - 2 picks one non-empty proper subset by its bits.
    splits = F.expr(
        "transform(sequence(1, shiftleft(1, size(items)) - 2),"
        " picks -> filter(items, (item, i) -> (shiftright(picks, i) & 1) = 1))"
    )
    rules = itemsets.filter(F.size("items") >= 2).withColumn("antecedents", F.explode(splits)).withColumn(
        "consequents", F.array_except("items", "antecedents")
    )
    left = itemsets.select(F.col("items").alias("antecedents"), F.col("freq").alias("left_freq"))
    right = itemsets.select(F.col("items").alias("consequents"), F.col("freq").alias("right_freq"))
    n = float(baskets_total)
    both, a, c = (F.col(name).cast("double") for name in ("freq", "left_freq", "right_freq"))
    scored = rules.join(left, "antecedents").join(right, "consequents").select(
        "antecedents", "consequents", (both / n).alias("support"), (both / a).alias("confidence"),
        (both * n / (a * c)).alias("lift"),
    )
    return (
        scored.filter(F.col("confidence") >= min_confidence)
        .orderBy(F.desc("lift"), F.desc("support"), "antecedents", "consequents").limit(top)
        .select(
            "antecedents", "consequents", F.round("support", 4).alias("support"),
            F.round("confidence", 4).alias("confidence"), F.round("lift", 3).alias("lift"),
        )
    )
