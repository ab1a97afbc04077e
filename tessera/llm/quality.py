"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a boolean column that rejects a document. ``ranked`` measures on a sample what a rule costs and how much it
rejects; ``cascade`` tests the rules by rejections per cost, the best first, and stops at the first that rejects.
The order follows the sample, the verdict does not: a document is kept if no rule rejects it.

Defined results. A null or empty text has no words and is rejected. Words are runs without the bytes 20 and 09-0D.
Repeated rows are judged alike, each by itself. An empty table gives an empty table. Columns other than the text are
carried along untouched, whatever their names. Eight-word windows are compared by 64-bit hashes within one text. Work
per document is n log n in its words.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import whole_text

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Documents that the cascade times its rules on; more change the order of the rules only.
SAMPLE_DOCS, MOST_SAMPLED = 1000, 4000


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the measures by name and gives a boolean column."""

    name: str
    rejects: Callable[[dict[str, Column]], Column]


#: The first two are the base rules. The others leave running prose alone in any language with spaces.
RULES = (
    Rule("few_words", lambda m: m["n_words"] < 20),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    Rule("symbols", lambda m: 5 * m["n_symbols"] > m["n_words"]),
    Rule("capitals", lambda m: 2 * m["n_capitals"] > m["word_chars"]),
    Rule("shouting", lambda m: 10 * m["n_shouts"] > 3 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 60 * m["n_words"]),
    Rule("stutter", lambda m: 10 * m["n_stutters"] > 3 * m["n_words"]),
)
BASE = ("few_words", "repeated_windows")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def repeat_words(words: Column) -> Column:
    """Words that lie in an eight-word window found twice or more."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(
            placed,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])),
                    lambda e: e["i"],
                )
            ),
        )
        own = lambda p: F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return let(again, lambda p: F.aggregate(own(p), F.lit(0), lambda total, x: total + x))

    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW)))
    )
    found = let(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))
    )
    return F.when(F.size(words) > WINDOW, found).otherwise(F.lit(0)).cast("long")


def dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """Every measure as a column of a text and its word list."""
    less = lambda characters: F.length(text) - F.length(F.translate(text, characters, ""))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": less(SYMBOLS).cast("long"),
        "n_dup_lines": dup_lines(text),
        "n_repeat_words": repeat_words(words),
        "n_capitals": less("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_shouts": (F.length(text) - F.length(F.replace(text, F.lit("!!"), F.lit("")))) / 2,
        "n_stutters": F.size(F.filter(words, lambda w, i: (i > 0) & (F.get(words, i - 1) == w))),
    }


def ranked(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> list[tuple[Rule, float, float]]:
    """The rules by rejections per cost, with the seconds and the share that each one rejects on the sample.

    The sample is a share of all rows, by hash of id and text, that holds about ``SAMPLE_DOCS`` documents: every task picks
    from its own rows, and only what is picked, at most ``MOST_SAMPLED`` documents, meets in one partition.
    """
    rows = docs.count()
    share = max(1, rows // SAMPLE_DOCS)
    known = [whole_text(text).alias("text"), *([F.col("doc_id")] if "doc_id" in docs.columns else [])]
    known = docs.select(*known)
    picked = known.filter(F.pmod(F.xxhash64(*known.columns), F.lit(share)) == 0).limit(MOST_SAMPLED)
    # One partition in memory: what is timed is the rule and not the scan.
    sample = picked.select("text", word_list(F.col("text")).alias("words")).persist()
    found = measures(F.col("text"), F.col("words"))
    try:
        shares = sample.agg(*[F.avg(rule.rejects(found).cast("double")).alias(rule.name) for rule in rules]).first()

        def seconds(column: Column) -> float:
            start = time.perf_counter()
            sample.agg(F.sum(column.cast("long"))).first()
            return time.perf_counter() - start

        nothing = min(seconds(F.length("text")) for _ in range(2))
        costs = {rule.name: max(1e-3, seconds(rule.rejects(found)) - nothing) for rule in rules}
    finally:
        sample.unpersist()
    rates = {rule.name: (shares[rule.name] or 0.0) for rule in rules}
    order = sorted(rules, key=lambda rule: (-rates[rule.name] / costs[rule.name], costs[rule.name], rule.name))
    return [(rule, costs[rule.name], rates[rule.name]) for rule in order]


def cascade(order: list[Rule], found: dict[str, Column]) -> Column:
    """The name of the first rule that rejects, else null; later rules are not computed."""
    first, *rest = order
    verdict = F.when(first.rejects(found), F.lit(first.name))
    for rule in rest:
        verdict = verdict.when(rule.rejects(found), F.lit(rule.name))
    return verdict


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, the base measures, ``base_failed`` and ``kept`` of every row."""
    order = [rule for rule, _, _ in ranked(docs, text=text)]
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    split = docs.select("doc_id", whole_text(text).alias("text")).withColumn("words", word_list(F.col("text")))
    found = measures(F.col("text"), F.col("words"))
    measured = split.select("*", *[found[name].alias(name) for name in base])
    found |= {name: F.col(name) for name in base}
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.select("doc_id", *base, failed.alias("base_failed"), cascade(order, found).isNull().alias("kept"))


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns."""
    order = [rule for rule, _, _ in ranked(docs, text=text)]
    # The word list is bound inside one expression, so that a pushed-down filter does not split a text once per rule.
    verdict = let(word_list(whole_text(text)), lambda words: cascade(order, measures(whole_text(text), words)))
    return docs.filter(verdict.isNull())


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM t),
g AS (SELECT r, i, list_slice(words, i, i + 7) AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM again) GROUP BY r),
lines AS (SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
  coalesce(covered.n, 0)::BIGINT AS n_repeat_words, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS capitals,
  (length(text) - length(replace(text, '!!', ''))) / 2 AS shouts,
  len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS stutters
  FROM w LEFT JOIN covered USING (r) LEFT JOIN dups USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR 2 * capitals > word_chars OR 10 * shouts > 3 * n_words
    OR word_chars > 60 * n_words OR 10 * stutters > 3 * n_words) AS kept
FROM f
"""
