from __future__ import annotations

import datetime as dt
import itertools
import math
import random
import re
from decimal import Decimal

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import canonical, kmeans, logistic
from tessera.operators.canonical import alias_index, canonicalize, containing
from tessera.operators.cube import MOST_RANGES, active_filters, available, cube_query, date_runs, within
from tessera.operators.isolation_forest import MILLION, fit_forest, isolation_scores, mean_path, path_cut
from tessera.operators.prefix_scan import exact_median, prefix_scan
from tessera.operators.rules import association_rules, basket_items, frequent_itemsets
from tessera.plans import quality
from tessera.sources import workspace


def vendors(spark, rows):
    return spark.createDataFrame(rows, "vendor_id string, canonical_name string, category string, aliases_json string")


def lookup(spark, vendor_rows, raws):
    spelled = spark.createDataFrame([(r,) for r in raws], "raw string")
    return {r.raw: r.vendor_id for r in canonicalize(spelled, alias_index(vendors(spark, vendor_rows))).collect()}


def test_grams_are_cut_on_every_core(spark, monkeypatch):
    found, parts = canonical.containing, []
    monkeypatch.setattr(canonical, "containing", lambda *sides: parts.extend(side.rdd.getNumPartitions() for side in sides) or found(*sides))
    many = [(f"V{i:05}", f"Shop {i:05}", "Office", f'["SHOP*{i:05}"]') for i in range(300)]
    spelled = spark.createDataFrame([(f"pos shop*{i:05} dubai",) for i in range(300)], "raw string").coalesce(1)
    got = {r.raw: r.vendor_id for r in canonical.canonicalize(spelled, alias_index(vendors(spark, many).coalesce(1))).collect()}
    assert got == {f"pos shop*{i:05} dubai": f"V{i:05}" for i in range(300)}
    assert min(parts) >= spark.sparkContext.defaultParallelism


def test_containing_equals_brute_force(spark):
    rng = random.Random(4)
    words = ["a", "é", "ab", "shop", "supplier#0001", "supplier#00012", "supplier#000123", "漢字 stores", "stores", "x y"]
    texts = {"".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(150)} | set(words) | {"ab" * 5000, "shop " * 2000 + "supplier#000123"}
    patterns = {"".join(rng.choices(words, k=rng.randint(1, 2))) for _ in range(60)} | set(words)
    frames = [spark.createDataFrame([(v,) for v in sorted(values)], f"{name} string") for name, values in (("text", texts), ("pattern", patterns))]
    got = {(r.text, r.pattern) for r in containing(*frames).collect()}
    assert got == {(t, p) for t in texts for p in patterns if p in t}
    assert containing(frames[0].filter("false"), frames[1]).count() == 0 and containing(frames[0], frames[1].filter("false")).count() == 0


def test_vendor_lookup(spark):
    amazon = [("V01", "Amazon", "Software", '["AMZN MKTPLACE", "Amazon.ae"]')]
    got = lookup(spark, amazon, ["Amazon", " amazon.AE ", "amzn mktplace charges", "totally unknown vendor xyz", "amzn", "  ", ""])
    assert got == {"Amazon": "V01", " amazon.AE ": "V01", "amzn mktplace charges": "V01", "totally unknown vendor xyz": None,
                   "amzn": "V01", "  ": None, "": None}


def test_vendor_lookup_matches_brute_force(spark):
    rng = random.Random(7)

    def word(most):
        return "".join(rng.choice("abc*") for _ in range(rng.randint(1, most)))

    rows = []
    for i in range(12):
        aliases = '["' + '", "'.join(word(4) for _ in range(3)) + '"]'
        rows.append((f"V{i:02d}", word(5).upper(), "x", aliases))
    raws = sorted({word(8) for _ in range(200)})
    index: dict[str, str] = {}
    for vendor_id, name, _, aliases in rows:
        for alias in [name, *eval(aliases)]:
            index[alias.lower()] = vendor_id

    def wanted(raw):
        text = raw.strip().lower()
        if text in index:
            return index[text]
        hits = [alias for alias in index if alias in text or text in alias]
        return index[max(hits, key=len)] if hits else None

    assert lookup(spark, rows, raws) == {raw: wanted(raw) for raw in raws}


@pytest.mark.parametrize("rows_per_task", [1_000_000, 7, 1])
def test_prefix_scan(spark, rows_per_task):
    rng = random.Random(3)
    data = [(f"k{i:03d}", Decimal(rng.choice([1, 1, 1, 5, 9]))) for i in range(60)]
    df = spark.createDataFrame(data, "key string, amount decimal(18,2)").repartition(5)
    got = prefix_scan(df, [-F.col("amount"), F.col("key")], {"running": "amount"}, rows_per_task=rows_per_task)
    expected, running = [], Decimal(0)
    for rank, (key, amount) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])), start=1):
        running += amount
        expected.append((key, amount, rank, running))
    assert [tuple(r) for r in got.orderBy("rank").collect()] == expected


@pytest.mark.parametrize("values", [[], [4.0], [1.0, 2.0], [5.0] * 9 + [1.0], [3.0, 1.0, 2.0, 10.0, 10.0, 11.0]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_median(df, "v", rows_per_task=2).first()[0]
    assert got == (float(np.median(values)) if values else None)


def star(spark):
    fact = spark.createDataFrame(
        [("C1", "P1", "web", 1, Decimal("10.00")), ("C1", "P2", "store", 2, Decimal("5.00")), ("C2", "P1", "web", 3, Decimal("1.00"))],
        "customer_id string, product_id string, channel string, quantity int, amount decimal(18,2)")
    customers = spark.createDataFrame([("C1", "India", "x", "Gold"), ("C2", "Oman", "y", "Gold")],
                                      "customer_id string, country string, city string, tier string")
    products = spark.createDataFrame([("P1", "Home", "B1"), ("P2", "Toys", "B2")], "product_id string, category string, brand string")
    return fact, {"gold_dim_customer": customers, "gold_dim_product": products}


def test_cube(spark):
    fact, dims = star(spark)
    rows = cube_query(fact, dims, ["category", "country"]).collect()
    assert [tuple(r) for r in rows] == [("Home", "India", 10.0), ("Toys", "India", 5.0), ("Home", "Oman", 1.0)]
    assert [tuple(r) for r in cube_query(fact, dims, ["channel"], "quantity").collect()] == [("web", 4), ("store", 2)]
    assert cube_query(fact, dims, [], "avg_basket").first()[0] == pytest.approx(16 / 3)
    filtered = cube_query(fact, dims, ["channel"], filters={"country": "India", "tier": "", "city": None, "planet": "x"})
    assert {tuple(r) for r in filtered.collect()} == {("web", 10.0), ("store", 5.0)}


def test_cube_joins_only_what_it_uses(spark):
    fact, dims = star(spark)

    def joins(df):
        return df._jdf.queryExecution().analyzed().toString().count("Join Inner")

    assert joins(cube_query(fact, dims, ["channel"])) == 0
    assert joins(cube_query(fact, dims, ["country", "city", "tier"], filters={"country": "India"})) == 1
    assert joins(cube_query(fact, dims, ["channel"], filters={"country": ""})) == 0


def test_cube_refuses_unknown_names(spark):
    fact, dims = star(spark)
    with pytest.raises(ValueError, match="unknown dimension: planet"):
        cube_query(fact, dims, ["planet"])
    with pytest.raises(ValueError, match="unknown measure: weight"):
        cube_query(fact, dims, ["channel"], "weight")
    assert active_filters({"country": "", "planet": "x", "channel": "web"}) == {"channel": "web"}
    assert len(available()["dimensions"]) == 10 and len(available()["measures"]) == 4


def test_rules_match_brute_force(spark):
    rng = random.Random(5)
    rows, names = [], [(f"P{i}", name) for i, name in enumerate("abcdefgg")]
    for customer in range(60):
        for _ in range(rng.randint(1, 6)):
            rows.append((f"C{customer}", "2026-01-01", rng.choice(names)[0]))
    rows += [("C-twice", "2026-01-01", "P0"), ("C-twice", "2026-01-01", "P0")]
    fact = spark.createDataFrame(rows, "customer_id string, date_id string, product_id string")
    products = spark.createDataFrame(names, "product_id string, name string")
    by_customer: dict[str, list[str]] = {}
    for customer, _, product in rows:
        by_customer.setdefault(customer, []).append(dict(names)[product])
    sets = [frozenset(items) for items in by_customer.values() if len(items) >= 2]
    need = 0.05
    support = {}
    for size in (1, 2, 3):
        for combo in itertools.combinations("abcdefg", size):
            hits = sum(set(combo) <= items for items in sets)
            if hits / len(sets) >= need:
                support[combo] = hits
    itemsets, total = frequent_itemsets(basket_items(fact, products), need)
    assert total == len(sets)
    assert {tuple(r["items"]): r["freq"] for r in itemsets.collect()} == support

    expected = []
    for combo, hits in support.items():
        for size in range(1, len(combo)):
            for left in itertools.combinations(combo, size):
                right = tuple(x for x in combo if x not in left)
                if hits / support[left] >= 0.3:
                    expected.append((-hits * total / (support[left] * support[right]), -hits, left, right))
    expected = [(left, right) for _, _, left, right in sorted(expected)[:25]]
    got = association_rules(itemsets, total, 0.3).collect()
    assert [(tuple(r.antecedents), tuple(r.consequents)) for r in got] == expected
    assert all(r.confidence >= 0.3 for r in got)


def test_itemsets_read_their_items_once(spark):
    read = spark.sparkContext.accumulator(0)
    rows = [("C1", "d1", "a"), ("C1", "d1", "b"), ("C1", "d1", "z"), ("C2", "d1", "a"), ("C2", "d1", "b"), ("C3", "d1", None), ("C3", "d1", "a"), (None, "d1", "a"), (None, "d1", "b")]

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    schema = "customer_id string, date_id string, name string, n long"
    items = spark.createDataFrame([(*row, 1) for row in rows], schema).mapInArrow(counted, schema)
    itemsets, total = frequent_itemsets(items, 0.5)
    # Rare names, a null name and a basket without a key behave as in the SQL.
    assert total == 4 and {tuple(r["items"]): r["freq"] for r in itemsets.collect()} == {("a",): 3, ("b",): 2, ("a", "b"): 2}
    assert read.value == len(rows)


def planted(spark):
    rng = np.random.default_rng(0)
    rows = [(f"r{i:05d}", float(a), int(d), "x") for i, (a, d) in enumerate(zip(rng.normal(100, 10, 3000), rng.integers(0, 5, 3000)))]
    rows += [(f"out{i}", 1000.0 + i, 6, "y") for i in range(10)]
    return spark.createDataFrame(rows, "key string, amount double, dow int, label string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_isolation_forest(spark):
    df = planted(spark)
    scored = isolation_scores(df, "key", ["amount", "dow"], ["label"], trees=60, seed=1)
    assert not any(word in plan_of(scored) for word in ("Python", "Pandas", "Arrow"))
    scored = scored.persist()
    flagged = scored.filter(F.col("path") < path_cut(scored, 0.03))
    # Rows that share the path of the cut stay out.
    assert 0.02 * 3010 <= flagged.count() <= 0.03 * 3010 + 1
    top = [r.key for r in scored.orderBy("path").limit(10).collect()]
    assert all(key.startswith("out") for key in top)
    again = isolation_scores(df.repartition(7), "key", ["amount", "dow"], ["label"], trees=60, seed=1)
    both = scored.select("key", "path", "score").join(again.select("key", F.col("path").alias("other")), "key")
    assert both.count() == 3010 and both.filter("path <> other").count() == 0
    assert scored.agg(F.min("score"), F.max("score")).first()[1] <= 1.0


def test_forest_expression_walks_its_nodes(spark):
    df = planted(spark).withColumns({"_x_amount": F.col("amount"), "_x_dow": F.col("dow").cast("double"), "_code_label": (F.col("label") == "y").cast("double")})
    columns = ["_x_amount", "_x_dow", "_code_label"]
    forest = fit_forest(df, "key", 2, columns, 9, 5)
    nodes = {(n.tree, n.node): n for n in forest.nodes.itertuples()}

    def walk(row, tree, node=1):
        at = nodes[tree, node]
        if at.feature < 0:
            return at.path
        left = row[columns[at.feature]] < at.value if at.feature < 2 else row[columns[at.feature]] == at.value
        return walk(row, tree, 2 * node + (not left))

    for row in df.withColumn("path", forest.path()).limit(200).collect():
        assert row["path"] == sum(walk(row, tree) for tree in range(9))
    # A leaf's path counts its rows; those of a tree add up to the sample.
    assert all(n.path % MILLION in {round(mean_path(k) * MILLION) % MILLION for k in range(257)} for n in forest.nodes.itertuples() if n.feature < 0)


def test_forest_is_looked_up_as_its_expression_walks(spark):
    df = planted(spark).withColumns({"_x_amount": F.col("amount"), "_x_dow": F.col("dow").cast("double"), "_code_label": (F.col("label") == "y").cast("double")})
    forest = fit_forest(df, "key", 2, ["_x_amount", "_x_dow", "_code_label"], 120, 5)
    cut = forest.nodes[forest.nodes["feature"] == 0]["value"].iloc[:20].tolist()
    odd = [(a, d, c) for a in [None, float("nan"), float("inf"), -float("inf"), *cut] for d in (None, 2.0) for c in (None, 0.0, 7.0)]
    rows = df.select("_x_amount", "_x_dow", "_code_label").unionByName(spark.createDataFrame(odd, "_x_amount double, _x_dow double, _code_label double"))
    looked_up = forest.with_path(rows)
    # The expression of a full forest doesn't compile, and was walked for every row.
    assert "bucketizer" in plan_of(looked_up).lower() and not any(word in plan_of(looked_up) for word in ("Python", "Pandas", "Arrow"))
    both = looked_up.withColumn("walked", forest.path())
    assert both.count() == rows.count() and both.filter("not path <=> walked").count() == 0
    # Too many combinations for a table: the expression.
    assert forest.with_path(rows, most=1).exceptAll(looked_up).count() == 0


def test_path_cut_is_exact(spark):
    rows = spark.createDataFrame([(float(i), int(p)) for i, p in enumerate([5, 5, 1, 2, 9, 9, 9, 3, 7, 8])], "k double, path long")
    paths = sorted(r.path for r in rows.collect())
    for share in (0.0, 0.1, 0.25, 0.5, 0.9):
        cut = path_cut(rows, share)
        assert cut == paths[10 - math.ceil((1 - share) * 10)] and rows.filter(F.col("path") < cut).count() <= share * 10
    assert path_cut(rows.filter("false"), 0.1) is None


def test_isolation_forest_on_few_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 9.0)], "key string, amount double")
    scores = {r.key: r.score for r in isolation_scores(df, "key", ["amount"], trees=20).collect()}
    assert scores["c"] > scores["a"] == scores["b"]
    assert isolation_scores(df.filter("false"), "key", ["amount"], trees=20).count() == 0
    assert isolation_scores(df.limit(1), "key", ["amount"], trees=3).first().path == 0


def test_kmeans_rounds(spark):
    """Every start, moved together, ends where it would alone."""
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.3, (40, 2)) for c in ((0, 0), (4, 0), (0, 5))])
    rows = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id long, a double, b double").persist()
    model = kmeans.fit(rows, "id", ["a", "b"], 3, 6, 1)
    best = math.inf
    for start, centers in kmeans.first_centers(rows, "id", ["a", "b"], 3, 6, 1).items():
        at = np.array(centers)
        assert at.shape == (3, 2)
        for _ in range(100):
            near = ((points[:, None] - at) ** 2).sum(axis=2).argmin(axis=1)
            new = np.array([points[near == i].mean(axis=0) if (near == i).any() else at[i] for i in range(3)])
            far, at = ((new - at) ** 2).sum(), new
            if far <= kmeans.MOVEMENT:
                break
        best = min(best, ((points[:, None] - at) ** 2).sum(axis=2).min(axis=1).sum())
    assert model.cost == pytest.approx(best)
    got = model.clustered(rows).withColumnRenamed("cluster", "c").groupBy("c").agg(F.avg("a").alias("a"), F.avg("b").alias("b")).orderBy("c").collect()
    assert [[r.a, r.b] for r in got] == [pytest.approx(c, abs=0.05) for c in model.centers] and model.centers == sorted(model.centers)
    assert len(kmeans.fit(rows.limit(2), "id", ["a", "b"], 4, 2, 1).centers) == 2


def test_logistic_is_the_minimum(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    y = (x @ [1.5, -2.0] + 0.3 + rng.normal(size=300) > 0).astype(int)
    rows = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y, strict=True)], "a double, b double, y int").persist()
    model = logistic.fit(rows, ["a", "b"], "y")
    w, p = np.array(model.weights), 1 / (1 + np.exp(-(x @ np.array(model.weights) + model.intercept)))
    assert np.abs(x.T @ (p - y) + w).max() < 1e-6 and abs((p - y).sum()) < 1e-6
    # Separable labels have no minimum without the squares; with them they do.
    apart = rows.withColumn("y", (F.col("a") > 0).cast("int")).persist()
    assert np.isfinite(logistic.fit(apart, ["a", "b"], "y").weights).all()


def test_calendar_filters_become_ranges(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(800)]
    dim = spark.createDataFrame([(d, (d.month - 1) // 3 + 1, d.strftime("%B"), d.year) for d in days], "date_id date, quarter int, month_name string, year int")
    dim = {"gold_dim_date": dim}
    assert date_runs(dim, {"country": "x", "year": ""}) is None
    assert date_runs(dim, {"quarter": "1"}) == [(dt.date(y, 1, 1), min(dt.date(y, 3, 31), days[-1])) for y in (2024, 2025, 2026)]
    assert date_runs(dim, {"quarter": "2", "year": "2025", "channel": "web"}) == [(dt.date(2025, 4, 1), dt.date(2025, 6, 30))]
    assert date_runs(dim, {"year": "1999"}) == [] and date_runs(dim, {"quarter": "none"}) == []
    fact = spark.createDataFrame([(d,) for d in days], "date_id date")
    assert within(fact, []).count() == 0 and within(fact, None).count() == 800
    assert within(fact, [(dt.date(2024, 1, 5), dt.date(2024, 1, 6)), (dt.date(2025, 1, 1), dt.date(2025, 1, 1))]).count() == 3
    many = [(d, d) for d in days[:: 2][: MOST_RANGES + 1]]
    assert within(fact, many).count() == 2 * MOST_RANGES + 1


def test_filters_reach_the_scans(spark, small):
    """The calendar filter as ranges on the fact, the key of a point read on a sorted table with bloom filters."""
    quarter = cube_query(small.table("gold_fact_sales"), small.dims(), ["category"], filters={"quarter": "1"})
    scan = next(part for part in re.split("FileScan", plan_of(quarter)) if "product_id" in part and "PushedFilters" in part and "date_id" in part.split("PushedFilters")[1].split("]")[0])
    pushed = scan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(date_id," in pushed and "LessThanOrEqual(date_id," in pushed
    point = small.table("oltp_transactions").filter("txn_id = 'T42'")
    assert "EqualTo(txn_id,T42)" in plan_of(point)
    files = [f.removeprefix("file:") for f in small.table("oltp_transactions").inputFiles()]
    groups = [(g.column(i).statistics, file) for file in files for m in [pq.ParquetFile(file).metadata] for g in [m.row_group(n) for n in range(m.num_row_groups)]
              for i in range(g.num_columns) if g.column(i).path_in_schema == "txn_id"]
    assert sum(s.min <= "T42" <= s.max for s, _ in groups) <= 1
    facts = [f.removeprefix("file:") for f in small.table("gold_staged").filter("status = 'gold_inserted'").inputFiles()]
    for file in facts:
        dates = pq.read_table(file, columns=["date_id"]).column("date_id").to_pylist()
        assert dates == sorted(dates)


def test_quality_checks_find_violations(spark):
    mart = spark.createDataFrame([(1, 60.0), (2, 50.0), (3, 98.0)], "pareto_rank bigint, cumulative_pct double")
    got = {r.check: r.violations for r in quality.cumulative_share(mart, slice_ranks=2).collect()}
    assert got == {"cumulative_pct falls": 1, "cumulative_pct ends below 99": 1}
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    two = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    assert quality.same_rows(one, two, "x").first()["violations"] == 2
    assert quality.same_rows(one, one, "x").first()["violations"] == 0
    assert quality.unique_key(one, "k").first()["violations"] == 1


def test_an_index_of_many_aliases_is_not_broadcast(spark, monkeypatch):
    vendors = spark.createDataFrame([("V1", "Acme", '["acme corp", "acm"]'), ("V2", "Zeta", "[]")], "vendor_id string, canonical_name string, aliases_json string")
    spellings = spark.createDataFrame([("ACME",), (" zeta ",), ("zeta shop",), ("none",)], "raw string")

    def mapped():
        found = canonical.canonicalize(spellings, canonical.alias_index(vendors))
        plan = found._jdf.queryExecution().executedPlan().toString()
        return sorted((r.raw, r.vendor_id) for r in found.collect()), plan.count("BroadcastHashJoin [needle") + plan.count("BroadcastHashJoin [alias")

    few, many = mapped(), (monkeypatch.setattr(workspace, "BROADCAST_ROWS", 1), mapped())[1]
    assert few[0] == many[0] == [(" zeta ", "V2"), ("ACME", "V1"), ("none", None), ("zeta shop", "V2")]
    assert few[1] > 0 and many[1] == 0
