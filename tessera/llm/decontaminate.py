"""Benchmark decontamination by a distributed positional inverted index over the training documents.

A window is ten consecutive words of a test item, or all words of a shorter one. Per block of test items:

1. count how often each test word stands in the training documents;
2. store, for the two rarest words of every window, their postings: row, position and the test words around;
3. shift the lists of both words by their place in the window, intersect them on (row, start), and keep the places where
   the words around agree with the whole window (``exact``), or where enough of them stand near (``near``).

Only blocks of test items reach the driver and the tasks; their size is bounded by ``BLOCK_WORDS`` and any number of blocks
can follow each other. Documents, postings and matches stay distributed. A test word that a third of all documents hold
is stored by range of (word, row) and so split over files.

Defined results. Null texts and texts without words have none: no item is found in them, no window comes from them. A null
item_id counts for hits but is not listed. Items that repeat count once per item_id; repeated document rows are judged
each by itself. Empty documents or an empty benchmark give zero hits. Columns of other names are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import text_blocks, whole_text
from tessera.sources.workspace import new_path

WINDOW = 10
#: Words of the test items that are searched for in one pass.
BLOCK_WORDS = 2_000_000
#: Lists that are intersected before the words around are compared.
LISTS = 2
#: Bytes to words: A-Z lower-cased, digits, a-z and bytes over 7F kept, the rest blank.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


def numbered(block: pa.RecordBatch, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the test words of a block of documents, -1 for other words; words per document."""
    lists = [words_of(t) for t in block.column("text").to_pylist()]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(map(vocabulary.get, chain.from_iterable(lists), repeat(-1)), np.int32, int(sizes.sum())), sizes


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items as word lists, some at a time."""
    block: list[tuple[object, list[bytes]]] = []
    held = 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        words = words_of(row["text"])
        if not words:
            continue
        block.append((row["item_id"], words))
        held += len(words)
        if held >= block_words:
            yield block
            block, held = [], 0
    if block:
        yield block


def word_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> np.ndarray:
    """How often each test word stands in all documents."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known.value), np.int64)
        for block in text_blocks(batches):
            ids, _ = numbered(block, known.value)
            total += np.bincount(ids[ids >= 0], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["word", "n"])

    counts = np.zeros(len(vocabulary), np.int64)
    texts = docs.select(whole_text().alias("text"))
    for row in texts.mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["word"]] = row["n"]
    known.unpersist()
    return counts


def windows_of(items: list[tuple[object, list[bytes]]], vocabulary: dict[bytes, int], counts: np.ndarray) -> list[tuple]:
    """(window, item_id, words, and for each list: its word and its place), distinct by item and words."""
    rows, seen = [], set()
    for item, words in items:
        ids = [vocabulary[w] for w in words]
        for first in range(max(1, len(ids) - WINDOW + 1)):
            window = tuple(ids[first : first + WINDOW])
            if (item, window) in seen:
                continue
            seen.add((item, window))
            places = sorted(range(len(window)), key=lambda i: (counts[window[i]], window[i], i))
            picked = [places[min(k, len(places) - 1)] for k in range(LISTS)]
            rows.append((len(rows), None if item is None else str(item), list(window), *chain.from_iterable((window[p], p) for p in picked)))
    return rows


WINDOW_SCHEMA = "window int, item_id string, words array<int>, word0 int, place0 int, word1 int, place1 int"


def forward(docs: DataFrame, vocabulary: dict[bytes, int], listed: np.ndarray) -> DataFrame:
    """One row per document with its postings: word, position, and the test words up to nine places before and behind."""
    known = docs.sparkSession.sparkContext.broadcast((vocabulary, listed))
    reach = WINDOW - 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, wanted = known.value
        wanted = np.append(wanted, False)  # the last one is for -1
        row = TaskContext.get().partitionId() << 33
        for block in text_blocks(batches):
            ids, sizes = numbered(block, words)
            ends = np.cumsum(sizes)
            at = np.flatnonzero(wanted[ids])
            doc = np.searchsorted(ends, at, "right")
            first, last = (ends - sizes)[doc], ends[doc]
            around = at[:, None] + np.arange(-reach, reach + 1)
            inside = (around >= first[:, None]) & (around < last[:, None])
            context = np.where(inside, ids[np.clip(around, 0, max(0, len(ids) - 1))] if len(ids) else 0, -2).astype(np.int32)
            n = block.num_rows
            postings = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)),
                pa.StructArray.from_arrays(
                    [
                        pa.array(ids[at]),
                        pa.array((at - first).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * (2 * reach + 1)), pa.array(context.ravel())),
                    ],
                    names=["word", "pos", "context"],
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), block.column("doc_id"), block.column("hash"), pa.array(sizes), postings],
                names=["row", "doc_id", "hash", "n_words", "postings"],
            )
            row += n

    schema = "row long, doc_id long, hash long, n_words long, postings array<struct<word:int,pos:int,context:array<int>>>"
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), whole_text().alias("text"))
    return named.mapInArrow(rows, schema)


def write_index(docs: DataFrame, vocabulary: dict[bytes, int], listed: np.ndarray, folder: str) -> None:
    """``folder/documents`` (a row each) and ``folder/postings``, ordered by word and row."""
    spark = docs.sparkSession
    forward(docs, vocabulary, listed).write.parquet(f"{folder}/forward")
    stored = spark.read.parquet(f"{folder}/forward")
    stored.select("row", "n_words", F.explode("postings").alias("p")).select("p.word", "row", "p.pos", "n_words", "p.context").repartitionByRange(
        "word", "row"
    ).sortWithinPartitions("word", "row", "pos").write.parquet(f"{folder}/postings")


def intersected(spark: SparkSession, folder: str, windows: DataFrame, near: int | None = None) -> DataFrame:
    """(row, start, size, item_id) of each place where the shifted lists of a window meet and the words around agree.

    With ``near``, a place counts if that many of the window's words stand within the window's length of its rarest word,
    in any order; ``start`` is then the place of the rarest word.
    """
    postings = spark.read.parquet(f"{folder}/postings")
    size = F.size("words")
    shifted = [
        windows.join(postings, windows[f"word{k}"] == postings["word"]).withColumn("start", F.col("pos") - F.col(f"place{k}"))
        for k in range(LISTS)
    ]
    if near is not None:
        found = F.size(F.array_intersect("words", "context"))
        return shifted[0].filter(found >= F.least(F.lit(near), F.size(F.array_distinct("words")))).select(
            "row", F.col("pos").alias("start"), F.lit(1).alias("size"), "item_id"
        )
    inside = [lists.filter((F.col("start") >= 0) & (F.col("start") + size <= F.col("n_words"))) for lists in shifted]
    # Context position 10 (from 1) is the word itself.
    agrees = F.slice("context", F.lit(WINDOW) - F.col("place0"), size) == F.col("words")
    whole = inside[0].filter(agrees).select("window", "row", "start", size.alias("size"), "item_id")
    other = inside[1].select("window", "row", "start").distinct()
    return whole.join(other, ["window", "row", "start"]).select("row", "start", "size", "item_id")


def found_in(docs: DataFrame, benchmark: DataFrame, near: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: row, doc_id, hash of its text, n_words, merged places and item ids."""
    spark = docs.sparkSession
    folder = new_path(spark, "index")
    hits: DataFrame | None = None
    base: DataFrame | None = None
    for number, items in enumerate(item_blocks(benchmark, block_words)):
        vocabulary = {w: i for i, w in enumerate(sorted(Counter(chain.from_iterable(words for _, words in items))))}
        rows = windows_of(items, vocabulary, word_counts(docs, vocabulary))
        listed = np.zeros(len(vocabulary), bool)
        listed[[row[3 + 2 * k] for row in rows for k in range(LISTS)]] = True
        at = f"{folder}/{number}"
        write_index(docs, vocabulary, listed, at)
        windows = spark.createDataFrame(rows, WINDOW_SCHEMA)
        found = intersected(spark, at, windows, near)
        documents = spark.read.parquet(f"{at}/forward").select("row", "doc_id", "hash", "n_words")
        # The scan deals out the rows alike each time, so a row has the same number in every block.
        base = documents if base is None else base
        hits = found if hits is None else hits.unionByName(found)
    if base is None:
        forward(docs, {}, np.zeros(0, bool)).write.parquet(f"{folder}/forward")
        base = spark.read.parquet(f"{folder}/forward").select("row", "doc_id", "hash", "n_words")
        hits = base.select("row", F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit("").alias("item_id")).limit(0)
    per_row = hits.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("places"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    return base.join(per_row, "row", "left")


def covered(places: str) -> Column:
    """Positions in the union of sorted places."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda seen, one: F.struct(
        F.greatest(seen["end"], one["end"]).alias("end"),
        (seen["n"] + F.greatest(F.lit(0), one["end"] - F.greatest(seen["end"], one["start"]))).alias("n"),
    )
    return F.coalesce(F.aggregate(places, start, step)["n"], F.lit(0)).cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """n_words, n_hit, items and ``contaminated`` of every document."""
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found_in(docs, benchmark).select(
        "doc_id", "n_words", covered("places").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (covered("places") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no test window."""
    found = found_in(docs, benchmark).filter(F.col("places").isNotNull()).select(F.col("doc_id").alias("found_id"), F.col("hash").alias("found_hash"))
    key = docs["doc_id"].cast("long").eqNullSafe(found["found_id"]) & F.xxhash64(docs["text"]).eqNullSafe(found["found_hash"])
    return docs.join(found.distinct(), key, "left_anti")


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(list_slice(words, i, i + 9), ' ') AS gram, least(len(words), 10) AS size
  FROM (SELECT item_id, words, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
grams AS (SELECT r, i, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS gram
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM t, sizes WHERE len(words) >= size)),
hits AS (SELECT r, i, g.size, item_id FROM grams g JOIN win USING (gram, size)),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM t LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""
