"""Language ID by nearest centroid: TF-IDF vectors of byte n-grams against several centroids per language, by cosine.

Texts are lower-cased, everything but letters becomes a blank, and n-grams of two and three bytes are hashed into a fixed
number of cells. Document frequencies come from all training documents. Each language's centroids come from spherical
k-means over at most ``SAMPLE_DOCS`` of its different training texts, those with the smallest hashes, each weighted by its
copies: this is the documented bound of what the classifier is fitted on, and copies take no place from other texts. A text
is rejected if its cosine to the nearest centroid is under the lowest share of that centroid's own members, where a text
counts once.

Defined results. A null text, or one without a letter, is ``und`` with score 0 and rejected. Training rows whose language
is null are not used; without any training row everything is ``und``. Ties go to the language first in order. Repeated rows
are predicted alike. Only text, language and the fold of the id are read; source, id and language never reach a vector.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_blocks, whole_text
from tessera.sources.workspace import materialize

CELLS = 4096
CENTROIDS = 4
#: Different training texts per language that centroids are fitted on.
SAMPLE_DOCS = 600
ROUNDS = 12
#: Share of a centroid's members that lie below its limit of rejection.
REJECTED_SHARE = 0.005
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Bytes of lower-cased text to letters and blanks; bytes over 7F are parts of letters.
LETTERS = bytes(b if 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256))


@dataclass
class Model:
    weights: np.ndarray  # inverse document frequency of each cell
    labels: list[str]  # of each centroid
    centroids: np.ndarray
    limits: np.ndarray  # lowest cosine of each centroid that isn't rejected

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1) and rejection of each text."""
        lettered = np.fromiter((LETTER.search(t) is not None for t in texts), bool, len(texts))
        if not len(self.labels):
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosines = vectors(texts, self.weights) @ self.centroids.T
        best = cosines.argmax(1)
        score = np.clip(cosines[np.arange(len(texts)), best], 0.0, 1.0)
        names = [self.labels[b] if known else UNKNOWN for b, known in zip(best, lettered, strict=True)]
        return names, np.where(lettered, score, 0.0), ~lettered | (score < self.limits[best])


def counts(texts: list[str]) -> np.ndarray:
    """n-grams per text and cell."""
    parts = [b" " + b" ".join(t.lower().encode("utf-8", "replace").translate(LETTERS).split()) + b"  " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(parts), dtype=np.int64) * CELLS, np.fromiter(map(len, parts), np.int64, len(parts)))
    pairs = data[:-2] << np.uint32(8) | data[1:-1]
    triples = pairs << np.uint32(8) | data[2:]
    out = np.zeros(len(texts) * CELLS, np.int64)
    # The two blanks at the end of each text keep n-grams inside it; what starts with two blanks is none.
    real = pairs != 0x2020
    for grams, salt in ((pairs, 0x9E3779B1), (triples | np.uint32(1 << 24), 0x85EBCA6B)):
        cell = (grams * np.uint32(salt)) >> np.uint32(20)
        out += np.bincount((row[: len(cell)] + cell)[real], minlength=len(out))
    return out.reshape(len(texts), CELLS)


def vectors(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Unit vectors of weighted, damped counts."""
    found = np.log1p(counts(texts).astype(np.float32)) * weights
    norms = np.linalg.norm(found, axis=1, keepdims=True)
    return found / np.where(norms > 0, norms, 1)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text blocks whose matrix of counts is bounded too."""
    for block in text_blocks(batches, 2 << 20):
        for first in range(0, block.num_rows, 512):
            yield block.slice(first, 512)


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each cell, over all training documents, and their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(CELLS, np.int64), 0
        for block in blocks_of(batches):
            total += (counts(block.column("text").to_pylist()) > 0).sum(0)
            n += block.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([*range(CELLS), CELLS], pa.int32()), pa.array([*total.tolist(), n], pa.int64())], names=["cell", "n"])

    rows = training.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(CELLS + 1, np.int64)
    for row in rows:
        found[row["cell"]] = row["n"]
    return found[:CELLS], int(found[CELLS])


def k_means(rows: np.ndarray, copies: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first starts; unit centroids and the lowest accepted cosine of each."""
    chosen = [np.average(rows, 0, copies)]
    nearest = rows @ (chosen[0] / max(np.linalg.norm(chosen[0]), 1e-12))
    centroids = [rows[nearest.argmax()]]
    for _ in range(1, min(k, len(rows))):
        nearest = np.max(rows @ np.stack(centroids).T, axis=1)
        centroids.append(rows[nearest.argmin()])
    found = np.stack(centroids)
    for _ in range(rounds):
        member = (rows @ found.T).argmax(1)
        for c in range(len(found)):
            if (member == c).any():
                found[c] = np.average(rows[member == c], 0, copies[member == c])
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
    cosines = rows @ found.T
    member = cosines.argmax(1)
    limits = np.array([np.quantile(cosines[member == c, c], REJECTED_SHARE) if (member == c).any() else 0.0 for c in range(len(found))])
    return found, limits


def sampled(labelled: DataFrame) -> DataFrame:
    """lang, text and copies of the ``SAMPLE_DOCS`` different texts of each language with the smallest hashes, or all if there are fewer."""
    key = ["lang", "place", "other"]
    hashed = labelled.select("lang", "text", F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 62)).alias("place"), F.xxhash64("text", F.lit(11)).alias("other"))
    different = materialize(hashed.groupBy(*key).agg(F.count("*").alias("copies")), "different_texts")
    # Twice as many as wanted by a share of the hashes: no window reads a language that may hold most texts.
    share = F.least(F.lit(1.0), 2.0 * SAMPLE_DOCS / F.col("texts")) * float(1 << 62)
    near = different.join(F.broadcast(different.groupBy("lang").agg(F.count("*").alias("texts"))), "lang").filter(F.col("place") <= share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "other"))
    picked = near.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_DOCS).select(*key, "copies")
    # Copies become one before the shuffle.
    return hashed.join(F.broadcast(picked), key).groupBy(*key, "copies").agg(F.min("text").alias("text")).select("lang", "text", "copies")


def fitted(labelled: DataFrame) -> Model:
    """A model of rows (text, lang), neither null."""
    frequency, n = document_frequencies(labelled)
    weights = np.log((1 + n) / (1 + frequency)).astype(np.float32) + 1
    sample = sampled(labelled)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("text")
        texts, copies = group["text"].tolist(), group["copies"].to_numpy(np.float64)
        rows = np.concatenate([vectors(texts[i : i + 256], weights) for i in range(0, len(texts), 256)])
        found, limits = k_means(rows, copies)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "limit": limits, "centroid": [c.astype(np.float32).tobytes() for c in found]})

    rows = sorted(sample.groupBy("lang").applyInPandas(cluster, "lang string, limit double, centroid binary").collect(), key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = np.stack([np.frombuffer(r["centroid"], np.float32) for r in rows]) if rows else np.zeros((0, CELLS), np.float32)
    return Model(weights, [r["lang"] for r in rows], centroids, np.array([r["limit"] for r in rows]))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred, score and rejected to (doc_id, held_out, text)."""
    # Plain values: a broadcast does not carry this package's classes.
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.labels, model.centroids, model.limits))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Model(*shared.value)
        for block in blocks_of(batches):
            names, score, rejected = here.predict(block.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return docs.mapInArrow(rows, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def fold(doc_id: str, folds: int) -> Column:
    """The remainder of crc32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def identified(docs: DataFrame) -> DataFrame:
    """Learn from the documents of three folds, predict all."""
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", 4) == 2).alias("held_out"), whole_text().alias("text"), F.col("lang").cast("string").alias("lang")
    )
    model = fitted(named.filter(~F.col("held_out") & F.col("lang").isNotNull()).select("text", "lang"))
    return predicted(named.select("doc_id", "held_out", "text"), model)
