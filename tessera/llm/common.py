"""What the operators share: tables, Arrow text blocks, byte hashes, state that outlives a task."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (never null): columns of other names cannot clash."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))


def worker_state(name: str, make: Callable[[], Any]) -> Any:
    """A value that a Python worker keeps from task to task; every task can make it anew.

    A worker keeps values of one kind (the name up to the first ``_``) at a time, so operators that follow each other do not
    add up in memory.
    """
    kept = sys.modules.setdefault("tessera_llm_worker", types.ModuleType("tessera_llm_worker"))
    if not hasattr(kept, name):
        kind = name.split("_")[0]
        for other in [n for n in vars(kept) if not n.startswith("__") and n.split("_")[0] != kind]:
            delattr(kept, other)
        release()
        setattr(kept, name, make())
    return getattr(kept, name)


def release() -> None:
    """Give memory that is no longer used back to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows that hold about ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = utf8(batch.column("text"))[1][1:]
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    release()


def utf8(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without copies, and the n + 1 places where its rows start and end."""
    if pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type):
        width: Any = np.int64
    else:
        width = np.int32
    _, offsets, data = strings.buffers()
    bounds = np.frombuffer(offsets, width)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


RADIX = 0x9E3779B97F4A7C15 | 1


class Rolling:
    """Hashes of any byte range of ``data`` in constant time: a polynomial modulo 2**64, then mixed."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers, inverse = radix_powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self.sums[1:])
        self.inverse = inverse

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """The hash of the ``width`` bytes from each place on."""
        n = max(0, len(self.sums) - width)
        return mix((self.sums[width : width + n] - self.sums[:n]) * self.inverse[:n])


def radix_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2**64, kept by the worker up to a bounded length."""
    size = 1 << max(16, int(n - 1).bit_length())

    def make(radix: int) -> np.ndarray:
        out = np.full(size, radix, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def both() -> tuple[np.ndarray, np.ndarray]:
        return make(RADIX), make(pow(RADIX, -1, 1 << 64))

    # Usual block sizes are kept; a single longer document makes its own.
    return worker_state(f"powers_{size}", both) if size <= BLOCK_BYTES else both()


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word (A-Z lower-cased, between white space in ASCII) of some texts: hash, text, bytes, and if all are ASCII."""
    data, bounds = utf8(texts)
    data = LOWER[data]
    space = IS_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds[bounds < len(data)]] = True
    starts = np.flatnonzero(~space & (np.append(True, space[:-1])[: len(space)] | first[:-1]))
    ends = np.flatnonzero(~space & (np.append(space[1:], True)[: len(space)] | np.append(first[1:-1], True)[: len(space)])) + 1
    beyond = np.concatenate([[0], np.cumsum(data > 0x7F)])
    return Rolling(data).ranges(starts, ends), np.searchsorted(bounds, starts, "right") - 1, ends - starts, beyond[ends] == beyond[starts]
