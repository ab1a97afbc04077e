"""What the learned and the estimated steps must find, through Spark: rewritten personal data, links just at the limit, repeat groups."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import pii, quality, repeats, sketches

DOCUMENTS = "/root/testdata/sf0.1/documents.parquet"


def test_rewritten_spans_are_found_through_the_query(spark):
    """Documents that the network has not seen, their spans written in ways the base patterns miss."""
    docs = spark.read.parquet(DOCUMENTS)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = pii.trained(pii.training_windows(docs.filter(~held_out)))
    held = [(r["doc_id"], r["text"] or "") for r in docs.filter(held_out).select("doc_id", "text").collect()]
    rewritten, clean, want = [], [], {}
    for doc_id, text in held:
        spans = pii.base_spans(text)
        if not spans:
            clean.append((doc_id, text))
            continue
        other, labels = pii.varied(text, spans, zlib.crc32(text.encode()))
        rewritten.append((doc_id, other))
        want[doc_id] = {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in labels}
    forms = {-1: "call (555) 123-4567 now", -2: "mail jane.doe (at) example.org", -3: "john dot smith at host dot com"}
    rows = spark.createDataFrame([*rewritten, *clean, *forms.items()], "doc_id long, text string")
    got = {r["doc_id"]: set(filter(None, r["spans"].split(","))) for r in pii.scanned(rows, model).collect()}
    total = sum(map(len, want.values()))
    assert total > 60 and sum(len(want[i] & got[i]) for i in want) >= 0.9 * total
    assert sum(bool(got[i]) for i, _ in clean) <= 0.01 * len(clean)
    assert [got[-1], got[-2], got[-3]] == [{"phone:5:19"}, {"email:5:30"}, {"email:0:30"}]


def test_nothing_is_proposed_where_nothing_was_learned(spark):
    rows = spark.createDataFrame([(1, "call (555) 123-4567 now"), (2, "jane (at) example.org"), (None, None)], "doc_id long, text string")
    assert {r["spans"] for r in pii.scanned(rows).collect()} == {""}


def test_links_just_at_the_limit(spark):
    """Pairs of 70 shingles each, 60 in common: 60 of 80, exactly three quarters; and pairs one shingle below."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    rows, pairs = [], 2500
    for i in range(pairs):
        common = 64 if i % 5 else 63
        head = [word() for _ in range(common)]
        rows += [(2 * i + side, " ".join(head + [word() for _ in range(74 - common)])) for side in (0, 1)]
    got = {r["doc_id"]: r["component_id"] for r in sketches.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    for i in range(pairs):
        assert got[2 * i] == 2 * i and got[2 * i + 1] == (2 * i if i % 5 else 2 * i + 1)


def test_hot_copies_stay_out_of_the_sample(spark, monkeypatch):
    """One text in a third of all rows does not fill the partition that the rules are timed on."""
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 50)
    monkeypatch.setattr(quality, "MOST_SAMPLED", 200)
    hot = "this text stands in very many rows " * 10
    rows = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, hot).otherwise(F.concat(F.lit("some words of document "), "id")).alias("text"))
    order = quality.ranked(rows)
    assert len(order) == len(quality.RULES)
    kept = quality.judged(rows).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in kept} == {False: 9000}


@pytest.mark.parametrize("hot", [2000, 3])
def test_repeat_groups_hold_all_occurrences(spark, monkeypatch, hot):
    """Each group's occurrences hold the same bytes and are all there are; together they are what is removed."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(8)
    some = lambda n: "".join(rng.choices("abcdefghij é\n", k=n))
    passages = [some(n) for n in (450, 700, 1500, 420)]
    texts = [some(rng.randint(0, 900)) + rng.choice(passages) + some(rng.randint(0, 300)) + rng.choice(["", rng.choice(passages)]) for _ in range(40)]
    texts += [texts[0], "", None, "x" * 1200, passages[2] + passages[2]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    data = {i: (t or "").encode() for i, t in enumerate(texts)}
    groups: dict = {}
    for r in repeats.repeat_groups(docs).collect():
        groups.setdefault((r["repeat"], r["length"]), set()).add((r["doc_id"], r["offset"]))
    gone = {i: set() for i in data}
    for (_, length), at in groups.items():
        held = {data[i][o : o + length] for i, o in at}
        assert len(held) == 1 and len(at) > 1 and length >= repeats.LENGTH and len(min(held)) == length
        for i, o in at:
            gone[i] |= set(range(o, o + length))
    for r in repeats.removed(docs).collect():
        assert r["n_removed"] == len(gone[r["doc_id"]])
    # No occurrence of a group is missing.
    for (name, length), at in list(groups.items())[:40]:
        i, o = min(at)
        wanted = data[i][o : o + length]
        every = {(k, j) for k, d in data.items() for j in range(len(d) - length + 1) if d[j : j + length] == wanted}
        assert at == every or not name.startswith(("slice:", "window:")) and at <= every, name
