"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash over the last bytes cuts a text where its value has some bits zero, so equal passages fall into equal chunks
wherever they stand. A worker encodes each chunk once and keeps it as (tail of a word cut before, body of whole words, head
of a word cut after). A join agrees exactly if it lies at a blank. Else the strip from the last blank before it to the first
blank behind it is encoded again; while the strip meets another cut before it meets a blank, it grows by the next chunk.
White space bounds every token of this kind of vocabulary (word ends, white space dropped), so such strips are exact.

Defined results. Null and empty texts have no tokens; a text without white space is one strip. Strings of special tokens in
a text become special ids, as in the library. Rows are independent, so ties, repeated rows and empty tables need no rule.
Columns other than doc_id and text are not read; ``token_rows`` gives ids, ``encoded`` their digests.

Chunks are shared within a worker, across its tasks: sharing them by a shuffle would move all distinct text twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BLOCK_BYTES, keyed, text_blocks, utf8, worker_state
from tessera.llm.tokens import one_thread

#: Bytes that decide a cut, and the mean bytes between cuts.
CUT_WIDTH, CUT_MEAN = 16, 256
#: Chunks and words a worker remembers; beyond, it forgets all and starts anew.
REMEMBERED_CHUNKS, REMEMBERED_WORDS = 15_000, 200_000
BLANKS = b" \t\n\r\x0b\x0c"

#: What a run of whole words gives: tokens, ids as decimal text, token strings; both joined by blanks.
Run = tuple[int, str, str]
EMPTY: Run = (0, "", "")


def cut_places(data: np.ndarray, bounds: np.ndarray, width: int = CUT_WIDTH, mean: int = CUT_MEAN) -> np.ndarray:
    """Where chunks start within ``data`` (documents end to end): content-defined, never inside a character."""
    places = np.zeros(0, np.int64)
    if len(data) > width:
        # A Buzhash-like sum over the last bytes: each byte's random number, rotated by its distance.
        table = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)
        value = table[data]
        step = 1
        while step < width:  # doubling: the hash of 2k bytes from those of k
            value = value[step:] ^ (value[:-step] << np.uint64(step) | value[:-step] >> np.uint64(64 - step))
            step *= 2
        places = np.flatnonzero(value & np.uint64(mean - 1) == 0) + width
        places = places[places < len(data)]
        places = places[(data[places] & 0xC0) != 0x80]
        # A hash that reaches across the start of a document is not of that document.
        places = places[places - bounds[np.searchsorted(bounds, places, "right") - 1] >= width]
    return np.union1d(places, bounds[:-1])


class ChunkEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.names = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.words: dict[bytes, Run] = {}
        self.chunks: dict[bytes, tuple[bytes, Run, bytes] | None] = {}
        self.encoded = self.reused = self.repaired = 0

    def learn(self, wanted: set[bytes]) -> None:
        """Encode words that are not known yet."""
        new = list(wanted - self.words.keys())
        for word, e in zip(new, self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False), strict=True):
            self.words[word] = (len(e.ids), " ".join(map(str, e.ids)), " ".join([self.names[i] for i in e.ids]))

    def run(self, text: bytes) -> Run:
        """Whole words, from the table."""
        return joined([self.words[w] for w in text.split()])

    def split(self, chunk: bytes) -> tuple[bytes, bytes, bytes] | None:
        """Tail of the word cut before, whole words, head of the word cut after; nothing if there is no blank."""
        first = len(chunk) - len(chunk.lstrip(BLANKS))
        if not first:
            parts = chunk.split(None, 1)
            if len(parts[0]) == len(chunk):
                return None
            first = len(parts[0])
        if chunk[-1] in BLANKS:
            last = len(chunk)
        else:
            last = len(chunk) - len(chunk.rsplit(None, 1)[-1])
        return chunk[:first].rstrip(BLANKS), chunk[first:last], chunk[last:]

    def encode(self, documents: list[list[bytes]]) -> list[Run]:
        """Each document, given as its chunks."""
        if len(self.words) > REMEMBERED_WORDS:
            self.words.clear()
        if len(self.chunks) > REMEMBERED_CHUNKS:
            self.chunks.clear()
        fresh = {c for chunks in documents for c in chunks} - self.chunks.keys()
        self.encoded += len(fresh)
        self.reused += sum(map(len, documents)) - len(fresh)
        parts = {c: self.split(c) for c in fresh}
        self.learn({w for p in parts.values() if p for w in p[1].split()})
        self.chunks.update((c, p and (p[0], self.run(p[1]), p[2])) for c, p in parts.items())
        plans: list[list[bytes | Run]] = []
        strips = set()
        for chunks in documents:
            plan: list[bytes | Run] = []
            strip: list[bytes] = []
            for chunk in chunks:
                kept = self.chunks[chunk]
                if kept is None:  # the strip goes on through the whole chunk
                    strip.append(chunk)
                    continue
                tail, body, head = kept
                strip.append(tail)
                plan.append(b"".join(strip))
                plan.append(body)
                strip = [head]
            plan.append(b"".join(strip))
            strips.update(p for p in plan if p and isinstance(p, bytes))
            plans.append(plan)
        self.repaired += len(strips)
        self.learn(strips)
        known = self.words
        return [joined([(known[p] if p else EMPTY) if isinstance(p, bytes) else p for p in plan]) for plan in plans]


def joined(runs: list[Run]) -> Run:
    runs = [r for r in runs if r[0]]
    return (sum(r[0] for r in runs), " ".join([r[1] for r in runs]), " ".join([r[2] for r in runs]))


def encode_block(path: str, block: pa.RecordBatch) -> list[Run]:
    encoder = worker_state("wordbpe_" + path, lambda: ChunkEncoder(path))
    data, bounds = utf8(block.column("text"))
    starts = cut_places(data, bounds)
    whole = data.tobytes()
    ends = np.append(starts[1:], len(data)).tolist()
    chunks = [whole[a:b] for a, b in zip(starts.tolist(), ends, strict=True)]
    # An empty document starts where the next one does, and has no chunk.
    first, last = np.searchsorted(starts, bounds[:-1]), np.searchsorted(starts, bounds[1:])
    return encoder.encode([chunks[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)])


def mapped(docs: DataFrame, path: str, schema: str, columns: Callable[[list[Run]], list[pa.Array]], text: str) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        names = ["doc_id", *[part.split()[0] for part in schema.split(", ")]]
        for block in text_blocks(batches, BLOCK_BYTES // 2):
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), *columns(encode_block(path, block))], names=names)

    return keyed(docs, text).mapInArrow(rows, "doc_id long, " + schema)


def encoded(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""

    def digests(runs: list[Run]) -> list[pa.Array]:
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return [
            pa.array([r[0] for r in runs], pa.int64()),
            pa.array([sha(r[1]) for r in runs], pa.string()),
            pa.array([sha(r[2]) for r in runs], pa.string()),
        ]

    return mapped(docs, tokenizer, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests, text)


def token_rows(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """doc_id, ids and the decoded text."""

    def outputs(runs: list[Run]) -> list[pa.Array]:
        bounds = pa.array(np.concatenate([[0], np.cumsum([r[0] for r in runs])]).astype(np.int32))
        ids = np.array(" ".join([r[1] for r in runs]).split(), np.int32)
        return [pa.ListArray.from_arrays(bounds, pa.array(ids)), pa.array([r[2] for r in runs], pa.string())]

    return mapped(docs, tokenizer, "ids array<int>, decoded string", outputs, text)


def decoded(rows: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """The text that the library's decode gives for each row's ids, as column ``decoded``."""
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def decode(column):
        one_thread()
        encoder = worker_state("wordbpe_" + tokenizer, lambda: ChunkEncoder(tokenizer))
        return column.map(lambda x: encoder.tokenizer.decode([] if x is None else list(x), skip_special_tokens=False))

    return rows.withColumn("decoded", decode(F.col(ids)))
