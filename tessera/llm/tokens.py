"""Token ids in Parquet list columns, laid out for selective reads.

``write_tokens`` encodes whole texts, ends each with an end id and writes rows in ascending ``doc_id`` order: one file per
range of ids, small row groups with page indexes, ids dictionary-encoded, numbers delta-encoded. A second folder holds the
index (doc_id, start, n_tokens, checksum, file), made from the written files, so a reader finds a document's place without
touching any token and reads only the row groups it needs (``read_documents``).

Defined results. Null and empty texts hold the end id alone. Rows that share a doc_id are kept and stand in the order of
their texts' hashes; a null doc_id stands first. An empty table gives empty files. Columns of other names are not read.
Starts are sums over ranges: per file in its own task, then over one total per file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import keyed, text_blocks, worker_state
from tessera.sources.workspace import new_path

#: Pieces of text with their ids that a worker remembers; beyond, it forgets all and starts anew.
REMEMBERED = 1_000_000
#: Marks that end a word.
STOPS = ".,"
#: Bytes of text that a task encodes at a time.
ENCODE_BYTES = 8 << 20
#: Bytes of a row group and of a page, and rows of a page: what one selective read has to touch.
LAYOUT = {
    "compression": "zstd", "parquet.block.size": str(8 << 20), "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "2000", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true",
}
#: What makes a text go to the library in one go: white space side by side, or other than blank and line feed, and the
#: start of special tokens. The second part holds what a text in ASCII cannot.
RARE = ("  ", "\n ", " \n", "<|", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
RARE_BEYOND_ASCII = ("\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")


class Encoder:
    """Whole-text byte-level BPE that encodes each piece between white space once.

    The tokenizer's pattern always starts a token group at a blank or line feed between two visible characters, so a text
    without two white space characters side by side falls into pieces that can be encoded alone. Pieces are counted and
    told apart in Arrow; only those that are new to the worker go to the library.
    Other texts go to it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.forget()

    def forget(self) -> None:
        # Flat arrays take a tenth of the memory of a dictionary of strings.
        self.known, self.ids, self.ends = pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def raw(self, texts: list[str], at_once: int = 4000) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of each text's."""
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for first in range(0, len(texts), at_once):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[first : first + at_once], add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(found), np.int32))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        return np.concatenate(ids), np.concatenate(sizes)

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Where the distinct pieces stand in the table; new ones are added to it."""
        place = pc.index_in(pieces, value_set=self.known)
        places = np.array(place.fill_null(-1), np.int64)
        new = np.flatnonzero(places < 0)
        if not len(new):
            return places
        words = pieces.take(pa.array(new)).to_pylist()
        # A word and the point or comma behind it are separate groups of the pattern.
        ended = np.fromiter((w[-1] in STOPS and w[:-1].isalpha() and (w.isascii() or max(w) < "\u0250") for w in (x or " " for x in words)), bool, len(words))
        plain = [w for w, e in zip(words, ended, strict=True) if not e]
        places[new[~ended]] = len(self.known) + np.arange(len(plain))
        self.add(pa.array(plain, pa.string()), *self.raw([w if w[:1] == "\n" else " " + w for w in plain]))
        if ended.any():
            behind = [w for w, e in zip(words, ended, strict=True) if e]
            stems = pa.array([w[:-1] for w in behind], pa.string()).dictionary_encode()
            stem = self.places(stems.dictionary)[np.asarray(stems.indices)]
            stop = len(self.known) + np.array([STOPS.index(w[-1]) for w in behind])
            stop_ids, _ = self.raw(list(STOPS))
            ids, sizes = taken(
                np.concatenate([self.ids, stop_ids]), np.append(np.diff(self.ends), np.ones(len(STOPS), np.int64)), np.stack([stem, stop], 1).ravel()
            )
            places[new[ended]] = len(self.known) + np.arange(len(behind))
            self.add(pa.array(behind, pa.string()), ids, sizes.reshape(-1, 2).sum(1))
        return places

    def add(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, pieces])
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of each text's."""
        n = len(texts)
        alone = [any(map(t.__contains__, RARE)) or not t.isascii() and any(map(t.__contains__, RARE_BEYOND_ASCII)) for t in texts]
        # A line feed starts a piece of its own where no other follows; elsewhere it stays inside one.
        split = pc.split_pattern(pa.array(["" if a else t if "\n\n" in t else t.replace("\n", " \n") for t, a in zip(texts, alone, strict=True)], pa.string()), " ")
        bounds = np.asarray(split.offsets, np.int64)
        firsts = split.values.take(pa.array(bounds[:-1])).to_pylist()
        coded = split.values.dictionary_encode()
        if len(self.known) > REMEMBERED:
            self.forget()
        places = self.places(coded.dictionary)
        # The runs of ids: known pieces, then the first piece of each text (no blank before it), then the end.
        ids, sizes = self.raw([t if a else first for t, a, first in zip(texts, alone, firsts, strict=True)])
        order = places[np.asarray(coded.indices)]
        order[bounds[:-1]] = len(self.known) + np.arange(n)
        order = np.insert(order, bounds[1:], len(self.known) + n)
        ids, sizes = taken(np.concatenate([self.ids, ids, [end_id]]).astype(np.int32), np.concatenate([np.diff(self.ends), sizes, [1]]), order)
        return ids, np.add.reduceat(sizes, bounds[:-1] + np.arange(n))


def taken(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids, of the given sizes, put one after the other in another order; and the sizes in that order."""
    starts = np.cumsum(sizes) - sizes
    each = sizes[order]
    at = np.repeat((starts[order] - (np.cumsum(each) - each)).astype(np.int32), each)
    at += np.arange(len(at), dtype=np.int32)
    return ids[at], each


def one_thread() -> None:
    """The library's own threads would take cores that Spark has given to other tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def encoded_rows(path: str, end_id: int):
    schema = pa.schema(
        [("part", pa.int32()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        encoder = worker_state("bytebpe_" + path, lambda: Encoder(path))
        part, pos = TaskContext.get().partitionId(), 0
        for block in text_blocks(batches, ENCODE_BYTES):
            ids, lengths = encoder.encode(block.column("text").to_pylist(), end_id)
            bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(pos, pos + n)), block.column("doc_id"), pa.array(lengths), lists],
                schema=schema,
            )
            pos += n

    return rows


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and crc32 of the ids of each row, as read from a file."""
    for batch in batches:
        lists = batch.column("ids")
        bounds = np.asarray(lists.offsets, np.int64) * 4
        data = memoryview(np.ascontiguousarray(np.asarray(lists.values, np.int32))).cast("B")
        sums = [zlib.crc32(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("pos"), batch.column("doc_id"), pa.array(np.diff(bounds) // 4, pa.int64()), pa.array(sums, pa.int64())],
            names=["part", "pos", "doc_id", "n_tokens", "ids_crc32"],
        )


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, text: str = "text") -> str:
    """Write ``folder/tokens`` and ``folder/index``; gives the folder."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The hash deals out rows that share a doc_id; it also fixes their order.
    order = ["doc_id", F.xxhash64("text")]
    ranged = keyed(docs, text).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.mapInArrow(
        encoded_rows(tokenizer, end_id), "part int, pos long, doc_id long, n_tokens long, ids array<int>"
    ).write.options(**LAYOUT).parquet(f"{folder}/tokens")
    read = spark.read.parquet(f"{folder}/tokens").mapInArrow(
        checksums, "part int, pos long, doc_id long, n_tokens long, ids_crc32 long"
    )
    read.write.options(**LAYOUT).parquet(f"{folder}/sums")
    sums = spark.read.parquet(f"{folder}/sums")
    totals = sums.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row per file.
    before = totals.select(
        "part", (F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before")
    )
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    sums.withColumn("within", F.coalesce(within, F.lit(0))).join(before, "part").select(
        "doc_id", (F.coalesce("before", F.lit(0)) + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "part", "pos"
    ).sortWithinPartitions("part", "pos").write.options(**LAYOUT).parquet(f"{folder}/index")
    return folder


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Places and checksums without reading a token."""
    return spark.read.parquet(f"{folder}/index")


def read_documents(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """Ids of the documents from ``first`` to ``last``: the filter reaches the row groups and page indexes."""
    return spark.read.parquet(f"{folder}/tokens").filter(F.col("doc_id").between(first, last)).select("doc_id", "n_tokens", "ids")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2, text: str = "text") -> DataFrame:
    """Write the files below the shared folder and return the index read back from them."""
    folder = write_tokens(docs, tokenizer, new_path(docs.sparkSession, "tokens"), end_id, text)
    return read_index(docs.sparkSession, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
