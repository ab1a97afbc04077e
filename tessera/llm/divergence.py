"""How far the sources of a language diverge: exact term counts per source from sparse document vectors, compared in whole numbers.

A vectorizer of the CountVectorizer kind turns documents into sparse vectors of counts. Its vocabulary is what a fit with minDF
and the largest vocabSize keeps per language: languages share a model but not a word, as a word is the language, a zero
character, and the term. Tasks count document frequencies and build vectors by Arrow blocks; with Spark's own estimator, which
handles every word of every document as an object, the same counts took several times the CPU time (README). The vocabulary
is cut by hash into as many slices as keep a model's word list, which the driver and each task hold, at ``SLICE_TERMS`` words
on average; a slice is a further pass over the documents, and no word is lost.

The vectors of a group (language and source) are added up entry by entry, in the block and then by Spark before and after the
shuffle, as a Summarizer adds them; a dense sum per group would need room for every word of every language. Pairs are compared sparsely: a term that
neither source has adds the distance of their two shares at count 0, so that part is one product; what differs from it is
summed over blocks of terms. A task gets one block for at most two tiles of sources, hence a bounded matrix; all terms of a
hot source are dealt over the blocks.

Defined results. Null text, language and source count as ''. A group without terms takes part in every pair; where the
language keeps no term all values are 0. Repeated rows count again. Ties rank by item in UTF-8 order. An empty table gives no
rows. Columns other than text, lang and source are not read. doc_id is not used, so null or repeated ones change nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import LOWER, text_blocks, utf8, whole_text
from tessera.sources.workspace import materialize

#: Documents a term must occur in, the scale and the smoothing of a share, how many terms are reported.
MIN_DOCS, UNIT, SMOOTH, TOP_TERMS = 30, 1_000_000_000, 5, 50
#: Words of a model; entries of a block of terms; sources in a tile; terms a task compares at a time.
SLICE_TERMS, BLOCK_CELLS, TILE, CHUNK = 1 << 20, 1 << 18, 256, 4096
LARGEST_VOCABULARY = 2**31 - 1
BETWEEN = "\x00"
#: A term is a run of letters A-Z (lower-cased) and of bytes beyond ASCII.
IN_TERM = np.zeros(256, bool)
IN_TERM[0x61:0x7B] = IN_TERM[0x80:] = True

Batches = Iterator[pa.RecordBatch]


def block_words(block: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """Every word of a block of documents (language, zero, term), and how many words lie before each document and the end."""
    data, bounds = utf8(block.column("text"))
    data = LOWER[data]
    inside = IN_TERM[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    behind = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    ends = np.flatnonzero(inside & (~behind | first[1:])) + 1
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    wide = offsets[-1] > 2**31 - 1
    make = pa.LargeStringArray if wide else pa.StringArray
    terms = make.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64 if wide else np.int32)), pa.py_buffer(data[inside].tobytes()))
    words_before = np.searchsorted(starts, bounds)
    langs = block.column("lang").take(pa.array(np.repeat(np.arange(block.num_rows), np.diff(words_before))))
    return pc.binary_join_element_wise(langs.cast(terms.type), terms, pa.scalar(BETWEEN, terms.type)), words_before


def document_vectors(words: list[str]) -> Callable[[Batches], Batches]:
    """``lang, source, indices, values``: of each document the places in ``words`` it holds, rising, and how often."""

    def transform(batches: Batches) -> Batches:
        places = pa.array(words, pa.large_string())
        for block in text_blocks(batches):
            indices, values, ends = sparse(*block_words(block), places)
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (indices, values)]
            yield pa.RecordBatch.from_arrays([block.column("lang"), block.column("source"), *lists], names=["lang", "source", "indices", "values"])

    return transform


def sparse(found: pa.Array, bounds: np.ndarray, places: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents as rows of a sparse matrix: places, counts, and where each document starts and the last ends."""
    coded = found.dictionary_encode()
    of_code = np.asarray(pc.index_in(coded.dictionary.cast(pa.large_string()), places).fill_null(-1), np.int64)
    place = of_code[np.asarray(coded.indices, np.int64)] if len(of_code) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    kept = place >= 0
    cells, counts = np.unique(doc[kept] * max(1, len(places)) + place[kept], return_counts=True)
    ends = np.searchsorted(cells, np.arange(len(bounds)) * max(1, len(places)))
    return (cells % max(1, len(places))).astype(np.int32), counts.astype(np.int64), ends


def vector_sums(words: list[str]) -> Callable[[Batches], Batches]:
    """``lang, source, place, count``: the vectors of a block's documents, added up within each group."""

    def add(batches: Batches) -> Batches:
        places = pa.array(words, pa.large_string())
        for block in text_blocks(batches):
            indices, values, ends = sparse(*block_words(block), places)
            lang, source = block.column("lang").dictionary_encode(), block.column("source").dictionary_encode()
            group = np.asarray(lang.indices, np.int64) * len(source.dictionary) + np.asarray(source.indices, np.int64)
            cells, at = np.unique(np.repeat(group, np.diff(ends)) * len(words) + indices, return_inverse=True)
            count = np.bincount(at, weights=values, minlength=len(cells)).astype(np.int64)
            group = cells // len(words)
            yield pa.RecordBatch.from_arrays(
                [
                    lang.dictionary.take(pa.array(group // len(source.dictionary))), source.dictionary.take(pa.array(group % len(source.dictionary))),
                    pa.array((cells % len(words)).astype(np.int32)), pa.array(count),
                ],
                names=["lang", "source", "place", "count"],
            )

    return add


def document_counts(batches: Batches) -> Batches:
    """``word, docs``: the words of a block with the number of its documents that hold them."""
    for block in text_blocks(batches):
        words, bounds = block_words(block)
        coded = words.dictionary_encode()
        distinct = len(coded.dictionary)
        if distinct:
            doc = np.repeat(np.arange(block.num_rows), np.diff(bounds))
            pairs = np.unique(doc * distinct + np.asarray(coded.indices, np.int64))
            docs = np.bincount(pairs % distinct, minlength=distinct)
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(docs)], names=["word", "docs"])


def selected(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    return docs.select(whole_text(lang).alias("lang"), whole_text(source).alias("source"), whole_text(text).alias("text"))


def vocabulary(rows: DataFrame, min_docs: int) -> DataFrame:
    """``word`` for each term of at least ``min_docs`` documents of a language."""
    counted = rows.select("lang", "text").mapInArrow(document_counts, "word string, docs long")
    return counted.groupBy("word").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("word")


def vectors(rows: DataFrame, words: list[str]) -> DataFrame:
    """``lang, source, indices, values``: the sparse vector of each document over the given words."""
    return rows.mapInArrow(document_vectors(words), "lang string, source string, indices array<int>, values array<long>")


def group_sums(rows: DataFrame, min_docs: int, slice_terms: int) -> DataFrame:
    """``lang, source, term_no, term, count``: the sums of the vectors of each group, where they are not 0."""
    spark = rows.sparkSession
    kept = materialize(vocabulary(rows, min_docs), "vocabulary")
    parts = max(1, math.ceil(kept.count() / slice_terms))
    found = spark.createDataFrame([], "lang string, source string, term_no long, term string, count long")
    for part in range(parts):
        words = sorted(r["word"] for r in kept.filter(F.pmod(F.xxhash64("word"), F.lit(parts)) == part).collect())
        if not words:
            continue
        names = spark.createDataFrame(pd.DataFrame({"place": np.arange(len(words), dtype=np.int32), "word": words}), "place int, word string")
        partial = rows.mapInArrow(vector_sums(words), "lang string, source string, place int, count long")
        sums = partial.groupBy("lang", "source", "place").agg(F.sum("count").alias("count"))
        term_no = F.lit(part).cast("long") * LARGEST_VOCABULARY + F.col("place")
        named = sums.join(names, "place").select("lang", "source", term_no.alias("term_no"), F.substring_index("word", BETWEEN, -1).alias("term"), "count")
        found = found.unionByName(materialize(named, "group_sums"))
    return found


def share(count: Column, n: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTH) / (n + SMOOTH * terms)), in decimals: a count may be larger than a long allows."""
    above = (count.cast("decimal(19,0)") + SMOOTH) * F.lit(UNIT).cast("decimal(10,0)")
    below = n.cast("decimal(19,0)") + terms.cast("decimal(19,0)") * SMOOTH
    return F.lit(1) + F.call_function("div", above, below)


def group_table(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """A row per group: its ``n``, its number ``no`` in the language, the language's ``terms``, ``sources`` and share at count 0."""
    groups = rows.select("lang", "source").distinct()
    totals = sums.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    kept = sums.groupBy("lang").agg(F.count_distinct("term_no").alias("terms"))
    sized = groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").fillna(0, ["n", "terms"])
    numbered = Window.partitionBy("lang")
    return sized.select(
        "lang", "source", "n", "terms",
        F.when(F.col("terms") > 0, share(F.lit(0), F.col("n"), F.col("terms"))).otherwise(0).alias("p0"),
        (F.row_number().over(numbered.orderBy("source")) - 1).alias("no"),
        F.count("*").over(numbered).alias("sources"),
        F.sum("n").over(numbered).alias("lang_n"),
    )


def compared(rows: pd.DataFrame, first: int, second: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of numbers from two tiles and what the block's terms add to their distance beyond that of unseen terms."""
    base = rows[rows["term_no"] < 0].sort_values("no")
    numbers, unseen = base["no"].to_numpy(), base["p0"].to_numpy()
    seen = rows[rows["term_no"] >= 0]
    at = np.searchsorted(numbers, seen["no"].to_numpy())
    terms, column = np.unique(seen["term_no"].to_numpy(), return_inverse=True)
    p = seen["p"].to_numpy()
    order = np.argsort(column, kind="stable")
    left = np.flatnonzero(numbers // TILE == first)
    right = np.flatnonzero(numbers // TILE == second)
    far = np.abs(unseen[left][:, None] - unseen[right][None, :])
    added = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, len(terms), CHUNK):
        a, b = np.searchsorted(column[order], [start, start + CHUNK])
        part = order[a:b]
        width = min(CHUNK, len(terms) - start)
        shares = np.repeat(unseen[:, None], width, axis=1)
        shares[at[part], column[part] - start] = p[part]
        for i, line in enumerate(left):
            added[i] += np.abs(shares[line] - shares[right]).sum(axis=1) - width * far[i]
    i, j = np.nonzero(numbers[left][:, None] < numbers[right][None, :])
    yield numbers[left][i], numbers[right][j], added[i, j]


def pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, added`` for pairs of numbers a < b."""
    tiles = F.ceil(F.col("sources") / TILE)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.least("sources", F.lit(2 * TILE)) / BLOCK_CELLS)).cast("int")
    tile = F.floor(F.col("no") / TILE)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), tiles - 1)).alias("other")
    entries = cells.select("lang", "no", "term_no", "p", "p0", F.pmod(F.xxhash64("term_no"), blocks).alias("block"), tile.alias("tile"), other)
    marks = groups.filter("terms > 0").select(
        "lang", "no", F.lit(-1).cast("bigint").alias("term_no"), F.lit(0).cast("bigint").alias("p"), "p0",
        F.explode(F.sequence(F.lit(0).cast("bigint"), blocks.cast("bigint") - 1)).alias("block"), tile.alias("tile"), tiles.alias("tiles"),
    ).select("lang", "no", "term_no", "p", "p0", "block", "tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("other"))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, _, first, second = key
        a, b, added = next(compared(rows, first, second))
        return pd.DataFrame({"lang": lang, "a": a, "b": b, "added": added})

    dealt = entries.unionByName(marks).select(
        "lang", "block", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "no", "term_no", "p", "p0"
    )
    sums = dealt.groupBy("lang", "block", "first", "second").applyInPandas(compare, "lang string, a long, b long, added long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("added").alias("added"))


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, slice_terms: int = SLICE_TERMS,
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances to the language's other sources, and terms it has more of."""
    rows = selected(docs, text, lang, source)
    sums = group_sums(rows, min_docs, slice_terms)
    groups = materialize(group_table(rows, sums), "groups")
    named = groups.select("lang", "source", "no", "n", "terms", "p0", "sources", "lang_n")
    cells = materialize(
        sums.join(named, ["lang", "source"])
        .withColumn("in_lang", F.sum("count").over(Window.partitionBy("lang", "term_no")))
        .select(
            "lang", "source", "no", "term_no", "term", "terms", "sources", "p0",
            share(F.col("count"), F.col("n"), F.col("terms")).alias("p"),
            share(F.col("in_lang"), F.col("lang_n"), F.col("terms")).alias("q"),
        ),
        "cells",
    )
    terms = cells.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    def side(letter: str) -> DataFrame:
        return groups.select("lang", "terms", F.col("no").cast("long").alias(letter), F.col("source").alias(f"source_{letter}"), F.col("p0").alias(f"p0_{letter}"))

    # Every source is compared with every other of its language: that is the result's size.
    pairs = side("a").join(side("b").drop("terms"), "lang").filter("a < b").join(pair_sums(cells, groups), ["lang", "a", "b"], "left")
    value = F.col("terms") * F.abs(F.col("p0_a") - F.col("p0_b")) + F.coalesce("added", F.lit(0))
    both = pairs.select("lang", value.alias("value"), "source_a", "source_b").select(
        "lang", "value",
        F.inline(F.array(
            F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
            F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")),
        )),
    )
    return ranked(both, "pair").unionByName(ranked(terms, "term").filter(F.col("rank") <= top_terms))


ORACLE = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT lang, source, doc, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(f.c, 0) AS c
  FROM groups g JOIN kept k USING (lang) LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
shares AS (
  SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER (PARTITION BY lang, source) + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (sum(c) OVER (PARTITION BY lang, term) + 5)) // (sum(c) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM cells JOIN size USING (lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
