"""Scores whole documents with a gated recurrent language model, beside an add-one unigram score.

A chunk is some megabytes of documents as token numbers with the chunk's own list of distinct words. Only these lists are
shuffled to count words: a word that stands everywhere is one entry per chunk. The counts come back to the chunks, and every
document becomes a sequence of model symbols.

The model is a GRU in numpy. Its output is factored: first a class, then the word in the class. The most frequent words
share classes of ``CLASS_WORDS``, whose number grows with the square root of the distinct words (``word_classes``); every
other word belongs to a class of words of like count, length and script, in which it has its share of the class's training
tokens. Words that training never saw are one word per class, as the base score has one slot for them all. Training reads
every training document once, at every size: each task trains a copy by truncated backpropagation through windows of
``BPTT`` steps, states carried from window to window and started anew at each document, and the copies are averaged after
each of ``ROUNDS`` rounds, which share a task's documents among them. Scoring carries the state through the whole document.

Defined results. Null and empty texts are one end token. A null doc_id counts as empty text in the fold. Without any
training document all counts are 0 and every word is new. Repeated rows are scored alike, ties in frequency are broken by
the word's hash. Words are told apart by 64-bit hashes. Documents are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_blocks, whole_text, word_hashes
from tessera.llm.language import fold
from tessera.llm.sketches import HASHED_BYTES
from tessera.sources.workspace import materialize

CHUNK_BYTES = 8 << 20
#: Classes of frequent words at least, and words in each.
WORD_CLASSES, CLASS_WORDS = 32, 32
BANDS = 24
KINDS = 4  # short or long, ASCII or not
LONG = 7
HIDDEN, BPTT, ROUNDS, STREAMS, RATE = 16, 16, 3, 128, 0.02
#: Training tokens of one task, and those it lays out at a time.
SHARD_TOKENS, LAID_TOKENS = 1_600_000, 400_000
#: Steps whose classes are scored together.
ROWS_AT_ONCE = 1024
#: Numbers of the model that are averaged together.
SLICE = 256
END = np.uint64(0x2545F4914F6CDD1C)
#: Frequent words and inputs (these words, the other classes, and the start) of the smallest model.
FREQUENT = WORD_CLASSES * CLASS_WORDS
SYMBOLS = FREQUENT + BANDS * KINDS + 1


def word_classes(distinct: int) -> int:
    """Classes of frequent words: the power of two from a sixteenth of the root of the distinct words on."""
    return max(WORD_CLASSES, 1 << max(0, int(np.ceil(np.log2(np.sqrt(max(distinct, 1)) / 16)))))


def symbol_type(classes: int) -> type:
    return np.int16 if classes * CLASS_WORDS + BANDS * KINDS < 1 << 15 else np.int32


def band(counts: np.ndarray) -> np.ndarray:
    """0 for new words, then one band for each doubling of the count."""
    return np.minimum(np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))) + 1, 0), BANDS - 1).astype(np.int64)


# ---- counting


def chunked(docs: DataFrame) -> DataFrame:
    """One row per chunk; token numbers index the chunk's sorted distinct word hashes, whose two lowest bits are the kind."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, chunk = 0, TaskContext.get().partitionId() << 24

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate([h[0] for h in held])
            lengths = np.concatenate([h[1] for h in held])
            learns = ~np.concatenate([h[3] for h in held])
            words, ids = np.unique(tokens, return_inverse=True)
            counts = np.bincount(ids, weights=np.repeat(learns, lengths), minlength=len(words)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int64()), pa.array([np.concatenate([h[2] for h in held])], pa.list_(pa.int64())), pa.array([learns], pa.list_(pa.bool_())),
                    pa.array([lengths], pa.list_(pa.int64())), pa.array([words.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary()),
                    pa.array([ids.astype(np.int32).tobytes()], pa.binary()),
                ],
                names=["chunk", "doc_ids", "learns", "lengths", "words", "counts", "ids"],
            )

        for block in text_blocks(batches, HASHED_BYTES):
            hashes, doc, sizes, ascii_only = word_hashes(block.column("text"))
            kind = (sizes > LONG).astype(np.uint64) + np.uint64(2) * (~ascii_only).astype(np.uint64)
            words = np.bincount(doc, minlength=block.num_rows)
            tokens = np.insert(hashes & ~np.uint64(3) | kind, np.cumsum(words), END & ~np.uint64(3))
            # A null id is the least one until the rows are written out.
            ids = np.asarray(block.column("doc_id").fill_null(-(1 << 63)), np.int64)
            held.append((tokens, words + 1, ids, np.asarray(block.column("held_out").to_pylist(), bool)))
            size += block.nbytes
            if size >= CHUNK_BYTES:
                yield flush()
                held, size, chunk = [], 0, chunk + 1
        if held:
            yield flush()

    schema = "chunk long, doc_ids array<long>, learns array<boolean>, lengths array<long>, words binary, counts binary, ids binary"
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", 7) == 2).alias("held_out"), whole_text().alias("text"))
    return named.mapInArrow(rows, schema)


def counted(chunks: DataFrame, parts: int) -> DataFrame:
    """Per chunk and range of hashes the words' counts over all training documents; per range (chunk -1) its distinct words and counts."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
        for batch in batches:
            for chunk, words, counts in zip(batch.column("chunk").to_pylist(), batch.column("words"), batch.column("counts"), strict=True):
                words, counts = np.frombuffer(words.as_py(), np.uint64), np.frombuffer(counts.as_py(), np.int64)
                cuts = np.concatenate([[0], np.searchsorted(words, edges), [len(words)]])
                slices = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(parts), pa.int32()), pa.array([chunk] * parts, pa.int64()),
                        pa.array([words[a:b].tobytes() for a, b in slices], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in slices], pa.binary()),
                    ],
                    names=["part", "chunk", "words", "counts"],
                )

    def total(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        words = np.frombuffer(b"".join(group["words"]), np.uint64)
        distinct, place = np.unique(words, return_inverse=True)
        sums = np.bincount(place, weights=np.frombuffer(b"".join(group["counts"]), np.int64), minlength=len(distinct)).astype(np.int64)
        ends = np.cumsum([len(w) // 8 for w in group["words"]])
        back = [sums[place[a:b]].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]
        out = pd.DataFrame({"chunk": group["chunk"].to_numpy(), "part": group["part"].to_numpy(), "counts": back, "words": None})
        own = pd.DataFrame({"chunk": [-1], "part": [int(group["part"].iloc[0])], "counts": [sums.tobytes()], "words": [distinct.tobytes()]})
        return pd.concat([out, own], ignore_index=True)

    dealt = chunks.select("chunk", "words", "counts").mapInArrow(deal, "part int, chunk long, words binary, counts binary")
    return dealt.groupBy("part").applyInPandas(total, "chunk long, part int, counts binary, words binary")


def statistics(counts: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """Training tokens, distinct training words, the frequent words and their counts, and training tokens per rare class."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, found in zip(batch.column("words"), batch.column("counts"), strict=True):
                words, found = np.frombuffer(words.as_py(), np.uint64), np.frombuffer(found.as_py(), np.int64)
                kind = band(found) * KINDS + (words & np.uint64(3)).astype(np.int64)
                tokens = np.bincount(kind, weights=found, minlength=BANDS * KINDS).astype(np.int64)
                distinct = np.bincount(kind[found > 0], minlength=BANDS * KINDS)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(BANDS * KINDS), pa.int64()), pa.array(tokens), pa.array(distinct, pa.int64())], names=["class", "tokens", "words"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, found in zip(batch.column("words"), batch.column("counts"), strict=True):
                words, found = np.frombuffer(words.as_py(), np.int64), np.frombuffer(found.as_py(), np.int64)
                top = np.lexsort((words, -found))[:frequent]
                top = top[found[top] > 0]
                yield pa.RecordBatch.from_arrays([pa.array(words[top]), pa.array(found[top])], names=["word", "n"])

    own = counts.filter("chunk = -1")
    rows = own.mapInArrow(sums, "class long, tokens long, words long").groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect()
    rare = np.zeros(BANDS * KINDS, np.int64)
    distinct = 0
    for r in rows:
        rare[r["class"]] = r["tokens"]
        distinct += r["words"]
    tokens = int(rare.sum())
    frequent = word_classes(distinct) * CLASS_WORDS
    top = own.mapInArrow(best, "word long, n long").orderBy(F.desc("n"), "word").limit(frequent).collect()
    words = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in top], np.int64)
    np.subtract.at(rare, band(n) * KINDS + (words & np.uint64(3)).astype(np.int64), n)
    return tokens, distinct, words, n, rare


def sequences(chunks: DataFrame, counts: DataFrame, found: tuple) -> DataFrame:
    """One row per document: the counts and scores that need no network, and its symbols."""
    tokens, distinct, words, _, rare = found
    classes = word_classes(distinct)
    kinds_from, kept_as = classes * CLASS_WORDS, symbol_type(classes)
    shared = chunks.sparkSession.sparkContext.broadcast((words.tobytes(), rare.tolist()))
    denominator = float(tokens + distinct + 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(shared.value[0], np.uint64)
        by_hash = np.argsort(frequent)
        class_tokens = np.maximum(np.array(shared.value[1], np.float64), 1)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                own = np.frombuffer(row["words"], np.uint64)
                count = np.frombuffer(b"".join(p["counts"] for p in sorted(row["parts"], key=lambda p: p["part"])), np.int64)
                at = np.minimum(np.searchsorted(frequent[by_hash], own), max(0, len(frequent) - 1))
                place = by_hash[at] if len(frequent) else np.zeros(len(own), np.int64)
                is_frequent = frequent[place] == own if len(frequent) else np.zeros(len(own), bool)
                kind = band(count) * KINDS + (own & np.uint64(3)).astype(np.int64)
                symbol = np.where(is_frequent, place, kinds_from + kind).astype(kept_as)
                inside = np.where(is_frequent | (count == 0), 0.0, np.log10(np.maximum(count, 1) / class_tokens[kind]))
                base = np.log10((count + 1) / denominator)
                ids = np.frombuffer(row["ids"], np.int32)
                lengths = np.array(row["lengths"], np.int64)
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                packed, width = symbol[ids].tobytes(), symbol.itemsize
                sums = [np.add.reduceat(x[ids], bounds[:-1]) for x in ((count > 0).astype(np.int64), base, inside)]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None if d == -(1 << 63) else d for d in row["doc_ids"]], pa.int64()), pa.array([not x for x in row["learns"]], pa.bool_()),
                        pa.array(lengths), pa.array(sums[0]), pa.array(np.full(n, tokens, np.int64)), pa.array(sums[1]), pa.array(sums[2]),
                        pa.array([packed[width * a : width * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "inside", "symbols"],
                )

    back = counts.filter("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("part", "counts")).alias("parts"))
    joined = chunks.select("chunk", "doc_ids", "learns", "lengths", "words", "ids").join(back, "chunk")
    return joined.mapInArrow(rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, inside double, symbols binary")


# ---- the network


def fresh(counts: np.ndarray, rare: np.ndarray, classes: int = WORD_CLASSES) -> dict[str, np.ndarray]:
    """Small random weights; output biases start at the unigram chances."""
    rng = np.random.default_rng(5)
    near = lambda *shape, by=0.3: (rng.standard_normal(shape) * by).astype(np.float32)
    full = np.zeros(classes * CLASS_WORDS, np.float64)
    full[: len(counts)] = counts
    grid = full.reshape(classes, CLASS_WORDS) + 0.5
    every = np.concatenate([grid.sum(1), rare + 0.5])
    return {
        "input": near(len(full) + len(rare) + 1, 3 * HIDDEN), "own": near(HIDDEN, 3 * HIDDEN, by=1 / np.sqrt(HIDDEN)), "class": near(HIDDEN, len(every), by=0.1),
        "class_bias": np.log(every / every.sum()).astype(np.float32), "word": near(classes, HIDDEN, CLASS_WORDS, by=0.1),
        "word_bias": np.log(grid / grid.sum(1, keepdims=True)).astype(np.float32),
    }


def packed(model: dict) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in sorted(model)])


def unpacked(flat: np.ndarray, classes: int = WORD_CLASSES) -> dict[str, np.ndarray]:
    shapes = {k: v.shape for k, v in fresh(np.zeros(0), np.zeros(BANDS * KINDS), classes).items()}
    out, at = {}, 0
    for k in sorted(shapes):
        size = int(np.prod(shapes[k]))
        out[k] = flat[at : at + size].reshape(shapes[k]).astype(np.float32)
        at += size
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def turned(x: np.ndarray) -> np.ndarray:
    """(T, B, H) as (T, H, B) or back, copied: the gates of all streams then lie together, and each operation is one long run."""
    return np.ascontiguousarray(x.transpose(0, 2, 1))


def gru(model: dict, symbols: np.ndarray, h: np.ndarray, keep: bool = False):
    """States after each step (T, B, H), the last state, and what the gradient needs. ``symbols`` (T, B) are consumed.

    The start symbol, the last one, empties the state.
    """
    own = model["own"].T.copy()
    begins = symbols == len(model["input"]) - 1
    some = begins.any(1)
    # Becomes the gates z and r and the new state, in place.
    gates = turned(model["input"][symbols])
    h = h.T.astype(own.dtype)
    states = np.empty((len(symbols), *h.shape), own.dtype)
    before, reset = (np.empty_like(states), np.empty_like(states)) if keep else (None, None)
    for t, x in enumerate(gates):
        if some[t]:
            h = h * ~begins[t]
        through = own @ h
        zr, n = x[: 2 * HIDDEN], x[2 * HIDDEN :]
        zr += through[: 2 * HIDDEN]
        sigmoid(zr)
        if keep:
            before[t], reset[t] = h, through[2 * HIDDEN :]
        n += zr[HIDDEN:] * through[2 * HIDDEN :]
        np.tanh(n, out=n)
        after = np.subtract(h, n, out=states[t])
        after *= zr[:HIDDEN]
        after += n
        h = after
    return turned(states), h.T, (before, gates, reset)


def occurring(numbers: np.ndarray, below: int) -> np.ndarray:
    """The distinct numbers, all less than ``below``, ascending."""
    return np.flatnonzero(np.bincount(numbers, minlength=below))


def class_of(targets: np.ndarray, classes: int) -> np.ndarray:
    frequent = classes * CLASS_WORDS
    return np.where(targets < frequent, targets // CLASS_WORDS, targets - frequent + classes)


def chosen(x: np.ndarray, at: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-softmax of each row at one place, and with ``weights`` of the rows its negative's gradient; ``x`` is used up."""
    rows = np.arange(len(x))
    # Scores near 0 need no shift, and one for all rows takes a fraction of the time of a greatest value per row, unless rows lie far apart.
    low, high = (float(x.min()), float(x.max())) if x.size else (0.0, 0.0)
    if max(-low, high) > 30:
        x -= x.max(1, keepdims=True) if high - low > 60 else x.dtype.type(high)
    out = x[rows, at]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    out = out - np.log(total)
    if weights is not None:
        x *= (weights / total)[:, None]
        x[rows, at] -= weights
    return out, x


def with_one(states: np.ndarray) -> np.ndarray:
    """A further column of ones, which meets a bias."""
    out = np.ones((len(states), HIDDEN + 1), states.dtype)
    out[:, :HIDDEN] = states
    return out


def outputs(model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the classes and of the words in each, the biases as a last row."""
    return np.vstack([model["class"], model["class_bias"]]), np.concatenate([model["word"], model["word_bias"][:, None]], 1)


def in_classes(word: np.ndarray, states: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
    """Places of the frequent words in order of their classes, their states, (class, first, end) of each run, and the scores in the class."""
    # Short numbers are sorted by their digits.
    order = np.argsort(classes.astype(np.uint16) if len(word) + BANDS * KINDS < 1 << 16 else classes, kind="stable")
    bounds = np.searchsorted(classes[order], np.arange(len(word) + 1))
    order = order[: bounds[-1]]
    runs = [(c, bounds[c], bounds[c + 1]) for c in np.flatnonzero(np.diff(bounds)).tolist()]
    own = states[order]
    x = np.empty((len(own), CLASS_WORDS), own.dtype)
    for c, a, b in runs:
        np.matmul(own[a:b], word[c], out=x[a:b])
    return order, own, runs, x


def log_chances(model: dict, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log of the chance of each target: its class, then its place in a class of frequent words."""
    classes = class_of(targets, len(model["word"]))
    of_class, word = outputs(model)
    states = with_one(states)
    # Some rows at a time, so that they stay in the cache.
    parts = [slice(a, a + ROWS_AT_ONCE) for a in range(0, len(states), ROWS_AT_ONCE)]
    out = np.concatenate([chosen(states[part] @ of_class, classes[part])[0] for part in parts]) if parts else np.zeros(0, states.dtype)
    order, _, _, x = in_classes(word, states, classes)
    out[order] += chosen(x, targets[order] % CLASS_WORDS)[0]
    return out


def gradients(model: dict, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray, float]:
    """Truncated backpropagation through one window (T, B); the state that goes on to the next window; the mean loss."""
    states, last, kept = gru(model, inputs, h, True)
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    flat, goal, counts = states.reshape(-1, HIDDEN), targets.ravel(), real.ravel()
    n = max(1, counts.sum())
    classes = class_of(goal, len(model["word"]))
    of_class, word = outputs(model)
    flat = with_one(flat)
    chances, d = chosen(flat @ of_class, classes, counts / n)
    loss = -(chances * counts).sum()
    both = flat.T @ d
    grads["class"], grads["class_bias"] = both[:HIDDEN], both[HIDDEN]
    d_flat = d @ model["class"].T
    order, own, runs, x = in_classes(word, flat, classes)
    chances, d = chosen(x, goal[order] % CLASS_WORDS, counts[order] / n)
    loss -= (chances * counts[order]).sum()
    d_own, both = np.empty((len(own), HIDDEN), own.dtype), np.zeros_like(word)
    back = model["word"].transpose(0, 2, 1).copy()
    for c, a, b in runs:
        np.matmul(own[a:b].T, d[a:b], out=both[c])
        np.matmul(d[a:b], back[c], out=d_own[a:b])
    grads["word"], grads["word_bias"] = both[:, :HIDDEN], both[:, HIDDEN]
    d_flat[order] += d_own
    d_all = turned(d_flat.reshape(states.shape))
    begins = inputs == len(model["input"]) - 1
    some = begins.any(1)
    before, gates, through = kept
    z, r, new = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
    # What the state's gradient is multiplied by, for all steps at once: through the update, the reset and the new state.
    to_new = (1 - z) * (1 - new * new)
    factors = np.stack([z * (1 - z) * (before - new), to_new * through * r * (1 - r), to_new * r], 1)
    d_through = np.empty_like(factors)
    d_h = np.zeros_like(d_all[0])
    for t in range(len(inputs) - 1, -1, -1):
        d_h = np.add(d_h, d_all[t], out=d_all[t])
        np.multiply(d_h, factors[t], out=d_through[t])
        d_h = d_h * z[t]
        d_h += model["own"] @ d_through[t].reshape(3 * HIDDEN, -1)
        if some[t]:
            d_h *= ~begins[t]
    grads["own"] += (before @ d_through.reshape(gates.shape).transpose(0, 2, 1)).sum(0)
    np.multiply(d_all, to_new, out=d_through[:, 2])
    d_given = turned(d_through.reshape(gates.shape))
    # Sums of the rows of each input that occurs, brought together.
    used = inputs.ravel()
    order = np.argsort(used, kind="stable")
    met, first = np.unique(used[order], return_index=True)
    grads["input"][met] = np.add.reduceat(d_given.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
    return grads, last, float(loss / n)


def learned(model: dict, square: dict, documents: list[np.ndarray]) -> float:
    """Adagrad in place over the documents as ``STREAMS`` parallel streams; a stream's state starts anew with each document. The mean loss."""
    start, words = len(model["input"]) - 1, len(model["word"])
    tokens = np.concatenate(documents)
    inputs = np.empty(len(tokens), tokens.dtype)
    inputs[1:] = tokens[:-1]
    inputs[np.concatenate([[0], np.cumsum([len(d) for d in documents])[:-1]])] = start
    steps = -(-len(tokens) // STREAMS)
    pad = steps * STREAMS - len(tokens)
    lay = lambda x: np.append(x, np.zeros(pad, x.dtype)).reshape(STREAMS, steps).T
    real, goal, given = lay(np.ones(len(tokens), np.float32)), lay(tokens), lay(inputs)
    h = np.zeros((STREAMS, HIDDEN), np.float32)
    total = 0.0
    for first in range(0, steps, BPTT):
        part = slice(first, first + BPTT)
        grads, h, loss = gradients(model, given[part], goal[part], real[part], h)
        total += loss * float(real[part].sum())
        met = occurring(class_of(goal[part].ravel(), words), len(model["class_bias"]))
        met = met[met < words]
        # Rows that the window doesn't meet have no gradient.
        rows = {"input": occurring(given[part].ravel(), start + 1), "word": met, "word_bias": met}
        for k, g in grads.items():
            at = rows.get(k, slice(None))
            g = g[at]
            own = square[k][at]
            own += g * g
            square[k][at] = own
            g *= RATE
            g /= np.sqrt(own)
            model[k][at] -= g
    return total / len(tokens)


def trained(rows: DataFrame, tokens: int, model: dict) -> dict:
    """Rounds of local training on shards of (doc_id, symbols), each followed by the mean of the copies by tokens.

    Each round has its own documents of every shard, so all are learned once.
    """
    spark = rows.sparkSession
    shards = max(1, -(-tokens // SHARD_TOKENS))
    dealt = materialize(rows.repartition(shards, F.xxhash64("doc_id", "symbols")).sortWithinPartitions("doc_id", "symbols"), "shards")
    size, classes = len(packed(model)), len(model["word"])
    kept_as = symbol_type(classes)

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n", "x"])
        n = group["n"].to_numpy()
        sums = sum(np.frombuffer(x, np.float32).astype(np.float64) * w for x, w in zip(group["x"], n, strict=True))
        return pd.DataFrame({"at": group["at"].iloc[:1], "x": [(sums / n.sum()).round(6).astype(np.float32).tobytes()]})

    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(packed(model))

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            own = unpacked(shared.value, classes)
            square = {k: np.full_like(v, 1e-6) for k, v in own.items()}
            held: list[np.ndarray] = []
            place, laid, weight = 0, 0, 0
            for batch in batches:
                for symbols in batch.column("symbols"):
                    place += 1
                    if place % ROUNDS == turn:
                        held.append(np.frombuffer(symbols.as_py(), kept_as))
                        laid += len(held[-1])
                        if laid >= LAID_TOKENS:
                            learned(own, square, held)
                            held, laid, weight = [], 0, weight + laid
            if held:
                learned(own, square, held)
                weight += laid
            if weight:
                flat = packed(own).astype(np.float32)
                firsts = range(0, size, SLICE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(firsts, pa.int32()), pa.array([flat[a : a + SLICE].tobytes() for a in firsts], pa.binary()), pa.array([float(weight)] * len(firsts))], names=["at", "x", "n"]
                )

        means = dealt.select("symbols").mapInArrow(learn, "at int, x binary, n double").groupBy("at").applyInPandas(mean, "at int, x binary").collect()
        flat = packed(model)
        for r in means:
            flat[r["at"] : r["at"] + SLICE] = np.frombuffer(r["x"], np.float32)
        model = unpacked(flat, classes)
    return model


def score_documents(model: dict, documents: list[np.ndarray], at_once: int = 512) -> np.ndarray:
    """Natural-log likelihood of each whole document; documents of like length go together, each leaves when it ends."""
    out = np.zeros(len(documents))
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    for first in range(0, len(order), at_once):
        batch = order[first : first + at_once]
        sizes = np.array([len(documents[i]) for i in batch])
        h = np.zeros((len(batch), HIDDEN), np.float32)
        before = np.full(len(batch), len(model["input"]) - 1)
        start = 0
        while start < sizes[0]:
            active = int(np.searchsorted(-sizes, -start, "left"))
            stop = min(start + 2 * BPTT, int(sizes[0]))
            goal = np.zeros((active, stop - start), np.int64)
            for row in range(active):
                piece = documents[batch[row]][start:stop]
                goal[row, : len(piece)] = piece
            given = np.concatenate([before[:active, None], goal[:, :-1]], 1)
            states, h, _ = gru(model, given.T, h[:active])
            real = (np.arange(start, stop)[:, None] < sizes[:active]).ravel()
            chances = np.zeros(len(real))
            chances[real] = log_chances(model, states.reshape(-1, HIDDEN)[real], goal.T.ravel()[real])
            out[batch[:active]] += chances.reshape(stop - start, active).sum(0)
            before, start = goal[:, -1], stop
    return out


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every document."""
    spark = docs.sparkSession
    chunks = materialize(chunked(docs), "chunks")
    # Ranges of hashes hold about as many bytes as a chunk's list.
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = materialize(counted(chunks, parts), "counts")
    found = statistics(counts)
    rows = materialize(sequences(chunks, counts, found), "sequences")
    tokens, distinct, _, frequent, rare = found
    classes = word_classes(distinct)
    kept_as = symbol_type(classes)
    model = trained(rows.filter(~F.col("held_out")).select("doc_id", "symbols"), tokens, fresh(frequent, rare, classes))
    shared = spark.sparkContext.broadcast(packed(model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = unpacked(shared.value, classes)
        for batch in batches:
            if batch.num_rows:
                own = score_documents(here, [np.frombuffer(s.as_py(), kept_as) for s in batch.column("symbols")])
                total = own / np.log(10) + np.asarray(batch.column("inside"))
                names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(total)], names=[*names, "score"])

    return rows.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
