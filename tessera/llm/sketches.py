"""Near-duplicate documents by SetSketch registers on word shingles, links confirmed on the full sets.

A register keeps the smallest of a set's exponentially distributed hashes, truncated to powers of ``BASE`` (SetSketch, Ertl
2021): registers of a union are the larger ones of both, and equal registers tell of similar sets. Steps:

1. every document's distinct shingles become registers and a 128-bit digest of the set; equal sets become one node;
2. bands of registers deal the nodes into buckets; the similarity of a candidate is estimated by the joint likelihood of
   greater, equal and smaller registers, clear misses are dropped, the rest is confirmed on the full shingle sets;
3. the first candidate of each node is the first node of its largest bucket in the first ``FIRST_BANDS`` bands; then only
   buckets, of all bands, that still hold several components count: nodes of other components than the bucket's first node
   with that node, and all pairs of buckets of at most ``SMALL`` nodes;
4. larger buckets that still hold several components are compared block by block, the nodes outside the bucket's main
   component against all its nodes, so that no link between different texts is lost to a bucket's size.

No step emits the pairs of a group; a node that stands in thousands of copies is one row after step 1.

Defined results. Words are runs without the bytes 20 and 09-0D, A-Z lower-cased. A text of one to four words is one shingle,
a null or empty one has none and is linked with nothing: its component is its own id. A null doc_id never names a component
that holds another id. Rows that share an id and a set are equal in all results. Shingles are compared by 64-bit hashes.
What a link of similarity 0.75 can be lost by: with 40 bands of 4 registers it shares no band with a chance of 2.5e-7, and with
half of 160 registers or fewer equal its estimate is dropped with a chance of 1e-11. So the bands decide, 2.5e-7 in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import mix, text_blocks, whole_text, word_hashes
from tessera.sources.workspace import materialize

SHINGLE = 5
#: Links need PERCENT * union size of common shingles at least.
PERCENT = 75
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
BASE = 1.001
#: Bands that give each node its first candidate.
FIRST_BANDS = 8
#: Nodes of a bucket whose pairs are all candidates.
SMALL = 16
#: Estimates this far under the limit are dropped: over seven standard deviations of 160 registers.
MARGIN = 0.25
#: Nodes compared with as many at a time in larger buckets.
BLOCK = 512
#: Bytes of text a task hashes at a time; its arrays take some fifty times as much.
HASHED_BYTES = 1 << 19
#: Bits of the filter of documents whose full sets are needed; a fixed size, so the filter may only pass more than needed.
FILTER_BITS = 1 << 24

def seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2021)
    return rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64), rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, end to end; and the n + 1 bounds."""
    n = len(texts)
    words, doc, *_ = word_hashes(texts)
    counts = np.bincount(doc, minlength=n)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    multiplier = np.uint64(0xD6E8FEB86659FD93)
    parts, owners = [], []
    state = words.copy()
    for k in range(1, SHINGLE + 1):
        if k > 1:
            state = mix(state[: max(0, len(words) - k + 1)] * multiplier + words[k - 1 :])
        # Texts of fewer words have one shingle of them all.
        at = offsets[:-1][counts == k] if k < SHINGLE else np.flatnonzero(doc[: len(state)] == doc[len(words) - len(state) :])
        parts.append(state[at] + np.uint64(k))
        owners.append(doc[at])
    hashes, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(n + 1))


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers (int16) of sets that are not empty."""
    n = len(bounds) - 1
    low = np.empty((n, REGISTERS), np.uint64)
    flips, odds = seeds()
    done = 0
    while done < n:  # pieces that stay in the cache
        upto = max(done + 1, int(np.searchsorted(bounds, bounds[done] + (1 << 15), "right")) - 1)
        piece, at = hashes[bounds[done] : bounds[upto]], bounds[done:upto] - bounds[done]
        value = np.empty_like(piece)
        for i in range(REGISTERS):
            np.bitwise_xor(piece, flips[i], out=value)
            np.multiply(value, odds[i], out=value)
            low[done:upto, i] = np.minimum.reduceat(value, at)
        done = upto
    uniform = ((low >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    levels = np.floor(1 - np.log(-np.log1p(-uniform)) / np.log(BASE))
    return np.clip(levels, -32768, 32767).astype("<i2")


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs, from how many registers are greater, smaller and equal."""
    grid = np.linspace(0.0, 1.0, 201)
    greater, smaller = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = grid[None, :] * np.minimum(u / v, v / u)
    chance = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    more, less = chance(u - v * j), chance(v - u * j)
    same = np.clip(1 - more - less, 1e-9, 1)
    likelihood = greater * np.log(more) + smaller * np.log(less) + (a.shape[1] - greater - smaller) * np.log(same)
    return j[np.arange(len(j)), likelihood.argmax(1)]


def sketched(docs: DataFrame) -> DataFrame:
    """row, doc_id, hash of the text, n shingles, digest of the set (two longs) and registers of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for block in text_blocks(batches, HASHED_BYTES):
            hashes, bounds = shingle_sets(block.column("text"))
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            digests = []
            for salt in (0x632BE59BD9B4E019, 0x9FB21C651E98DF25):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64)])
                digests.append(pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)))
            found: list[bytes | None] = [None] * len(sizes)
            if len(some):
                packed = registers(hashes, np.append(bounds[some], bounds[-1]))
                for at, one in zip(some.tolist(), packed, strict=True):
                    found[at] = one.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(sizes))), block.column("doc_id"), block.column("hash"),
                    pa.array(sizes.astype(np.int64)), *digests, pa.array(found, pa.binary()),
                ],
                names=["row", "doc_id", "hash", "n", "digest1", "digest2", "registers"],
            )
            row += len(sizes)

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), whole_text().alias("text"))
    return named.mapInArrow(rows, "row long, doc_id long, hash long, n long, digest1 long, digest2 long, registers binary")


def paired(pairs: DataFrame, columns: DataFrame, names: list[str]) -> DataFrame:
    """Pairs (a, b) with columns of both nodes."""
    sides = [columns.select(F.col("node").alias(side), *[F.col(n).alias(f"{n}_{side}") for n in names]) for side in ("a", "b")]
    return pairs.join(sides[0], "a").join(sides[1], "b")


def estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidates (a, b, estimate) that may reach the limit."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sides = [np.frombuffer(b"".join(batch.column(f"registers_{s}").to_pylist()), "<i2").reshape(-1, REGISTERS) for s in "ab"]
                sizes = [np.asarray(batch.column(f"n_{s}"), np.float64) for s in "ab"]
                found = likely_similarity(*sides, *sizes)
                keep = pa.array(found >= PERCENT / 100 - MARGIN)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found)], names=["a", "b", "estimate"]).filter(keep)

    # Sets that differ too much in size cannot reach the limit.
    near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    return paired(pairs, nodes, ["n", "registers"]).filter(near).mapInArrow(rows, "a long, b long, estimate double")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the limit."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
                x, y = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(other.as_py(), np.uint64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return paired(pairs.select("a", "b"), sets, ["shingles"]).mapInArrow(rows, "a long, b long")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and its whole set of shingles, for ``wanted`` (node, doc_id, hash)."""
    bit = F.pmod(F.col("hash"), F.lit(FILTER_BITS))
    # A bitmap of fixed size, built on the executors in parts of 4 KB.
    parts = wanted.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    offset = {r["part"]: np.frombuffer(r["bits"], np.uint8) for r in parts.toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(offset)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, HASHED_BYTES):
            hashes, bounds = shingle_sets(block.column("text"))
            whole = hashes.tobytes()
            cut = [whole[8 * a : 8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("hash"), pa.array(cut, pa.binary())], names=["doc_id", "hash", "shingles"])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            place, part = np.asarray(batch.column("place"), np.int64), np.asarray(batch.column("part"), np.int64)
            keep = np.zeros(len(place), bool)
            for p in np.unique(part):
                if p in bits:
                    at = part == p
                    keep[at] = bits[p][place[at] >> 3] >> (place[at] & 7) & 1
            yield batch.select(["doc_id", "hash", "text"]).filter(pa.array(keep))

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), whole_text().alias("text"))
    placed = named.select("*", F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("place"))
    candidates = placed.mapInArrow(lambda batches: rows(passed(batches)), "doc_id long, hash long, shingles binary")
    here, there = wanted.alias("w"), candidates.alias("c")
    same = F.col("w.hash").eqNullSafe(F.col("c.hash")) & F.col("w.doc_id").eqNullSafe(F.col("c.doc_id"))
    return there.join(here, same).select("node", "shingles").dropDuplicates(["node"])


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node that it reaches) of every node of the edges (a, b).

    Alternating stars (Kiveris et al. 2014): each round hangs neighbours on the smallest one, until every tree is a star.
    """
    nothing = (0, 0)
    state = nothing
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    while True:
        both = links.union(links.select("b", "a"))
        lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        links = materialize(small.filter("a <> b").distinct(), "stars")
        now = links.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
        if (now["n"], now["s"]) == state:
            break
        state = (now["n"], now["s"])
    tops = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops)


def across_blocks(members: DataFrame, held_sets: DataFrame) -> DataFrame:
    """Links among members of larger buckets: nodes outside a bucket's main component against all nodes of the bucket.

    A pair is compared in the first band that both share, and a node is linked once with each component: what leaves a
    task is confirmed there and bounded by its nodes and components, not by its pairs.
    """
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("size"))
    ranked = sizes.groupBy("key").agg(
        F.max(F.struct("size", "component"))["component"].alias("main"), F.count("*").alias("parts"), F.sum("size").alias("size"), F.max("size").alias("most")
    ).filter("parts > 1")
    held = members.join(ranked, "key").withColumn("apart", F.col("component") != F.col("main"))
    queries, blocks = F.ceil((F.col("size") - F.col("most")) / BLOCK), F.ceil(F.col("size") / BLOCK)
    deal = lambda count, salt: F.pmod(F.xxhash64("node", F.lit(salt)), count.cast("long"))
    side = ["key", "band", "node", "component"]
    asked = held.filter("apart").select(*side, F.lit(True).alias("asks"), deal(queries, 1).alias("q"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("m"))
    against = held.select(*side, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), queries - 1)).alias("q"), deal(blocks, 2).alias("m"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ask, rest = group[group["asks"]], group[~group["asks"]]
        found = []
        if len(ask) and len(rest):
            held_registers = np.frombuffer(b"".join(rest["registers"]), "<i2").reshape(-1, REGISTERS)
            held_nodes, held_parts, held_sizes = (rest[c].to_numpy() for c in ("node", "component", "n"))
            held_sets = [np.frombuffer(s, np.uint64) for s in rest["shingles"]]
            for row in ask.itertuples():
                mine = np.frombuffer(row.registers, "<i2")
                shared = (held_registers == mine).reshape(-1, BANDS, ROWS).all(2).argmax(1) == row.band
                at = np.flatnonzero(shared & (held_parts != row.component))
                likely = likely_similarity(np.broadcast_to(mine, (len(at), REGISTERS)), held_registers[at], np.full(len(at), float(row.n)), held_sizes[at].astype(float))
                own, linked = np.frombuffer(row.shingles, np.uint64), set()
                for i in at[likely >= PERCENT / 100 - MARGIN].tolist():
                    if held_parts[i] not in linked:
                        common = len(np.intersect1d(own, held_sets[i], assume_unique=True))
                        if 100 * common >= PERCENT * (len(own) + len(held_sets[i]) - common):
                            linked.add(held_parts[i])
                            found.append((row.node, held_nodes[i]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    # Registers and sets join last, once.
    return asked.unionByName(against).join(held_sets, "node").groupBy("key", "q", "m").applyInPandas(compare, "a long, b long")


def banded(nodes: DataFrame, bands: int) -> DataFrame:
    """The node's other columns, band and bucket key, for the first ``bands`` bands of its registers."""
    key = lambda b: F.xxhash64(b, F.substring(F.col("registers"), b * (2 * ROWS) + 1, F.lit(2 * ROWS)))
    others = [c for c in nodes.columns if c != "registers"]
    return nodes.select(*others, F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)).alias("band", "key"))


def in_components(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """node, component and registers, written: one row per node, joined before bands multiply the rows."""
    found = nodes.select("node", "registers").join(parts, "node", "left")
    return materialize(found.withColumn("component", F.coalesce("component", "node")), "placed")


def with_sets(docs: DataFrame, nodes: DataFrame, needed: DataFrame, held: DataFrame | None) -> DataFrame:
    """``held`` and the full sets of the ``needed`` nodes that it lacks."""
    lacking = materialize((needed if held is None else needed.join(held, "node", "left_anti")).join(nodes.select("node", "doc_id", "hash"), "node"), "wanted")
    if held is not None and lacking.isEmpty():
        return held
    found = materialize(full_sets(docs, lacking), "shingles")
    return found if held is None else held.unionByName(found)


def clustered(docs: DataFrame) -> DataFrame:
    """row, doc_id, hash, n and component_id of every document (written tables stand between the steps)."""
    rows = materialize(sketched(docs), "sketches")
    lowest = rows.filter("n > 0").groupBy("digest1", "digest2").agg(F.min("row").alias("node"), F.min("doc_id").alias("lowest"))
    sets = materialize(lowest, "sets")
    nodes = materialize(rows.select("row", "doc_id", "hash", "n", "registers").join(sets.select("node"), F.col("row") == F.col("node")).drop("row"), "nodes")
    # One candidate per node first, the first node of its largest bucket in a few bands: that settles most components, whatever
    # their size. All other candidates are needed between components only.
    head = banded(nodes.select("node", "registers"), FIRST_BANDS)
    buckets = head.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("first")).filter("size > 1")
    best = head.join(buckets, "key").groupBy("node").agg(F.max(F.struct("size", (-F.col("first")).alias("minus")))["minus"].alias("minus"))
    begun = best.select(F.col("node").alias("a"), (-F.col("minus")).alias("b")).filter("a <> b")
    likely = materialize(estimated(begun, nodes), "candidates")
    shingles = with_sets(docs, nodes, likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), None)
    links = materialize(confirmed(likely, shingles), "links")
    placed = banded(in_components(nodes, components(links)), BANDS)
    # Buckets that hold several components; of their members only those that make a candidate leave the join.
    mixed = placed.groupBy("key").agg(
        F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y"), F.min(F.struct("node", "component")).alias("top")
    ).filter("x <> y").select(F.col("key").alias("bucket"), "size", "top")
    asks = (F.col("key") == F.col("bucket")) & ((F.col("size") <= SMALL) | (F.col("component") != F.col("top.component")))
    open_rows = materialize(placed.join(mixed, asks).select("key", "node", "size", "component", "top"), "open")
    stars = open_rows.filter(F.col("component") != F.col("top.component")).select(F.col("node").alias("a"), F.col("top.node").alias("b"))
    tight = open_rows.filter(F.col("size") <= SMALL)
    left, right = (tight.select("key", F.col("node").alias(n), F.col("component").alias(f"component_{n}")) for n in "ab")
    pairs = left.join(right, (left["key"] == right["key"]) & (F.col("a") > F.col("b")) & (F.col("component_a") != F.col("component_b"))).select("a", "b")
    likely = materialize(estimated(stars.union(pairs).distinct(), nodes), "candidates")
    shingles = with_sets(docs, nodes, likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), shingles)
    links = links.union(materialize(confirmed(likely, shingles), "links"))
    parts = components(links)
    placed = banded(in_components(nodes, parts), BANDS)
    mixed = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y"))
    members = materialize(placed.join(mixed.filter((F.col("size") > SMALL) & (F.col("x") != F.col("y"))).select("key"), "key"), "members")
    if not members.isEmpty():
        shingles = with_sets(docs, nodes, members.select("node").distinct(), shingles)
        late = materialize(across_blocks(members, nodes.select("node", "n", "registers").join(shingles, "node")), "late")
        if not late.isEmpty():
            parts = components(links.union(late))
    # The smallest id of a component: of the ids of all its sets.
    named = sets.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_set = materialize(named.join(smallest, "component").select("digest1", "digest2", "component", "component_id"), "components")
    return rows.select("row", "doc_id", "hash", "n", "digest1", "digest2").join(of_set, ["digest1", "digest2"], "left").select(
        "row", "doc_id", "hash", "n", "component", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    return clustered(docs).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns: of each component the one with the smallest id (then text hash).

    Rows that share id and text are one document; so are rows without words that share them.
    """
    found = clustered(docs)
    no_id = F.lit(-(1 << 63))
    group = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("row"))
    kept = found.groupBy(group.alias("g")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash")).alias("r")).select(
        F.coalesce("r.doc_id", no_id).alias("id"), F.col("r.hash").alias("hash")
    ).distinct()
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.coalesce(F.col("doc_id").cast("long"), no_id).alias("id"), F.xxhash64("text").alias("hash")
    )
    # Both steps use the same keys, so the documents are shuffled once.
    return named.join(kept, ["id", "hash"]).dropDuplicates(["id", "hash"]).select("document.*")


ORACLE = r"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM t WHERE len(words) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * common >= 75 * (nx.n + ny.n - common)),
both_ways AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT x, y FROM both_ways UNION SELECT r.a, w.y FROM r JOIN both_ways w ON r.b = w.x) SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(t.doc_id, coalesce(low, t.doc_id)) AS component_id, t.doc_id = least(t.doc_id, coalesce(low, t.doc_id)) AS kept
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN reach ON reach.a = t.doc_id
"""
