"""Repeated byte strings by suffix arrays: maximal repeat groups from the interval tree of common prefixes.

``maximal_repeats`` takes some strings, sorts all their suffixes (prefix doubling), computes the common prefixes of
neighbours, scans these with a stack and reports each interval whose occurrences differ in the byte before them: every
maximal repeat of a least length with all its occurrences.

``removed`` runs it over a corpus of any size; ``repeat_groups`` lists the groups found there with all occurrences. A window is a string of ``LENGTH`` bytes. Its anchor is the smallest hash among
its ``ANCHOR``-byte parts, which depends on its bytes alone, so equal windows have equal anchors wherever they stand. The
consecutive windows of a document with one anchor form a slice. Slices, not bytes, are dealt out by anchor:

1. anchors that stand once are dropped, unless their part recurs inside a slice; a slice that stands twice repeats as a whole;
2. where an anchor has several slices, their bytes (one copy of each) go to one task in groups of anchors; the interval tree of
   their suffix array gives the maximal repeat groups, left-extension tested, and the bytes of all occurrences are what goes;
3. an anchor with over ``HOT`` different slices, such as a passage that a third of all documents quote, is split by the
   windows themselves: each window is a suffix cut to ``LENGTH``, so its interval is the group of its own hash, which Spark
   counts with partial sums. No task ever holds all slices of such an anchor.

Defined results. Null and empty texts have no bytes; texts under ``LENGTH`` bytes lose none. Matches never cross documents.
Repeated rows count as further occurrences, also under one doc_id. Removal is judged on the input: the union of all
repeated windows goes. Slices and hot windows are compared by 128 bits of hash, everything else by bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Rolling, mix, text_blocks, utf8, whole_text
from tessera.sources.workspace import materialize

LENGTH = 400
ANCHOR = 160
#: Windows of a slice at most: longer runs of one anchor (periodic text) are cut.
SLICE_WINDOWS = 1024
#: Different slices of an anchor that one suffix array takes; groups of anchors are dealt out by about as many bytes.
HOT = 2000
BLOCK = 1 << 20


# ---- suffix arrays


def suffix_order(data: np.ndarray, ends: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in order, and their ranks by the first 8, 16, 32, ... bytes (suffixes stop at the end of their string).

    ``ends`` has the end of each byte's string. With ``depth``, doubling stops when that many bytes decide.
    """
    n = len(data)
    place = np.arange(n)
    # A byte counts 1 to 256 so that a string's end, 0, comes first: 7 bytes of 9 bits each.
    key = np.zeros(n, np.uint64)
    for k in range(7):
        inside = place + k < ends
        key = key << np.uint64(9) | np.where(inside, data[np.minimum(place + k, n - 1)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    order = np.argsort(key)
    ranks = [ranked(key, order)]
    width = 7
    while (depth is None or width < depth) and len(order) and ranks[-1].max() < n - 1 and width < n:
        last = ranks[-1]
        ahead = np.minimum(place + width, n - 1)
        second = np.where(place + width < ends, last[ahead] + 1, 0)
        key = last.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)
        order = np.argsort(key)
        ranks.append(ranked(key, order))
        width *= 2
    return order, ranks


def ranked(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(key), np.int64)
    sorted_key = key[order]
    rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])]) if len(key) else 0
    return rank


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in order: doubling ranks, largest first."""
    a, b = order[:-1].copy(), order[1:].copy()
    length = np.zeros(len(a), np.int64)
    room = np.minimum(ends[a], ends[b])
    for level in range(len(ranks) - 1, -1, -1):
        width = 7 << level
        again = 2 if level == len(ranks) - 1 else 1
        for _ in range(again):
            fits = (a + width <= ends[order[:-1]]) & (b + width <= ends[order[1:]])
            at_a, at_b = np.where(fits, a, 0), np.where(fits, b, 0)
            same = fits & (ranks[level][at_a] == ranks[level][at_b])
            a[same] += width
            b[same] += width
            length[same] += width
    del room
    for _ in range(7):  # the rest is shorter than the first width
        fits = (a < ends[order[:-1]]) & (b < ends[order[1:]])
        same = fits.copy()
        same[fits] = data[a[fits]] == data[b[fits]]
        a[same] += 1
        b[same] += 1
        length[same] += 1
    return length


def intervals(prefixes: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of each interval of the suffix order whose common prefix has ``least`` bytes, by a stack scan."""
    stack: list[tuple[int, int]] = []  # common length, first place
    for place in np.append(np.flatnonzero(prefixes >= least), len(prefixes)).tolist():
        # Whatever is open ends where a shorter common prefix stands.
        if stack and (place == len(prefixes) or place != scanned):
            while stack:
                length, first = stack.pop()
                yield length, first, scanned
        if place == len(prefixes):
            return
        here, first = int(prefixes[place]), place
        while stack and stack[-1][0] > here:
            length, first = stack.pop()
            yield length, first, place
        if not stack or stack[-1][0] < here:
            stack.append((here, first))
        scanned = place + 1


class Groups:
    """The maximal repeats of some strings: intervals of their suffix order whose members follow different bytes.

    ``order`` has the places of all suffixes in the joined strings; group i is ``length[i]`` bytes at the places
    ``order[first[i] : last[i] + 1]``. A repeat is left-diverse if two of its occurrences follow different bytes, or one
    starts its string; an interval is right-diverse by being one.
    """

    def __init__(self, strings: list[bytes], least: int):
        data = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.owner = np.repeat(np.arange(len(strings)), self.sizes)
        ends = np.cumsum(self.sizes)[self.owner] if len(self.owner) else np.zeros(0, np.int64)
        self.starts = ends - self.sizes[self.owner] if len(self.owner) else ends
        self.order, found = np.arange(len(data)), []
        if len(data) > 1:
            self.order, ranks = suffix_order(data, ends, int(self.sizes.max()))
            prefixes = common_prefixes(data, ends, self.order, ranks)
            del ranks
            place = np.arange(len(data))
            # The start of a string counts as a byte of its own kind, different from any other start.
            before = np.where(place > self.starts, data[np.maximum(place - 1, 0)].astype(np.int64), -1 - self.owner)[self.order]
            changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
            found = [x for x in intervals(prefixes, least) if changes[x[2]] > changes[x[1]]]
        self.length, self.first, self.last = np.array(found, np.int64).reshape(-1, 3).T

    def occurrences(self) -> Iterator[tuple[int, np.ndarray]]:
        """Length and places of each group."""
        for length, first, last in zip(self.length.tolist(), self.first.tolist(), self.last.tolist(), strict=True):
            yield length, self.order[first : last + 1]

    def covered(self) -> np.ndarray:
        """Which bytes of the joined strings lie in an occurrence of a group."""
        reach = np.zeros(len(self.order), np.int64)
        for length, first, last in zip(self.length.tolist(), self.first.tolist(), self.last.tolist(), strict=True):
            np.maximum(reach[first : last + 1], length, out=reach[first : last + 1])
        edges = np.zeros(len(self.order) + 1, np.int64)
        at = np.flatnonzero(reach)
        np.add.at(edges, self.order[at], 1)
        np.add.at(edges, self.order[at] + reach[at], -1)
        return np.cumsum(edges[:-1]) > 0


def maximal_repeats(strings: list[bytes], least: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Length and all occurrences (string, offset) of every maximal repeat of at least ``least`` bytes."""
    groups = Groups(strings, least)
    return [(n, sorted(zip(groups.owner[at].tolist(), (at - groups.starts[at]).tolist(), strict=True))) for n, at in groups.occurrences()]


# ---- slices of documents


def smallest_within(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def recurring(hashes: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places p, ascending, and the nearest end q of two equal anchoring parts that stand at p or later."""
    reach = len(hashes) - len(anchors)
    edge = np.zeros(reach, np.uint64)
    # A part anchors some window if it is the greatest of the anchors of all windows around it.
    highest = ~smallest_within(~np.concatenate([edge, anchors, edge]), reach + 1)
    at = np.flatnonzero(hashes == highest)
    order = at[np.argsort(hashes[at], kind="stable")]
    equal = hashes[order[1:]] == hashes[order[:-1]]
    p, q = order[:-1][equal], order[1:][equal]
    by_place = np.argsort(p)
    return p[by_place], np.minimum.accumulate(q[by_place][::-1])[::-1]


def slices(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, document, start in the data, windows, hash, and possible repeats inside, of the slices of some documents end to end."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64), none.astype(bool)
    rolling = Rolling(data)
    parts = rolling.windows(ANCHOR)
    anchors = smallest_within(parts, LENGTH - ANCHOR + 1)
    doc = np.searchsorted(bounds, np.arange(len(anchors)), "right") - 1
    real = np.arange(len(anchors)) + LENGTH <= bounds[doc + 1]
    new = np.ones(len(anchors), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1]) | ~real[:-1]
    new &= real
    first = np.flatnonzero(new)
    # A run ends at the next one, or with its document's last window.
    last = np.minimum(np.append(first[1:], len(anchors)), bounds[doc[first] + 1] - LENGTH + 1)
    long = last - first > SLICE_WINDOWS
    if long.any():
        cut = [np.arange(a, b, SLICE_WINDOWS) if l else np.array([a]) for a, b, l in zip(first, last, long, strict=True)]
        upto = [np.append(c[1:], b) for c, b in zip(cut, last, strict=True)]
        first, last = np.concatenate(cut), np.concatenate(upto)
    hashes = rolling.ranges(first, last + LENGTH - 1)
    # A slice that holds its anchoring part twice may repeat a window by itself.
    p, q = recurring(parts, anchors)
    later = np.append(q, len(data))[np.searchsorted(p, first)]
    return anchors[first], doc[first], first, last - first, hashes, later < last + (LENGTH - ANCHOR)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def sliced(docs: DataFrame) -> DataFrame:
    """anchor, doc_id, hash of the text, start, windows and hash of every slice."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK):
            data, bounds = utf8(block.column("text"))
            anchor, doc, start, windows, own, inside = slices(data, bounds)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    signed(anchor), block.column("doc_id").take(at), block.column("hash").take(at), pa.array((start - bounds[doc]).astype(np.int32)),
                    pa.array(windows.astype(np.int32)), signed(own), pa.array(inside),
                ],
                names=["anchor", "doc_id", "hash", "start", "windows", "slice", "inside"],
            )

    return named(docs).mapInArrow(rows, "anchor long, doc_id long, hash long, start int, windows int, slice long, inside boolean")


def named(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, text): rows that agree in id and hash agree in all that is computed here. A null id is the least one."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select(key.alias("doc_id"), F.xxhash64("text").alias("hash"), whole_text().alias("text"))


def bytes_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Adds ``bytes`` to (anchor, slice, windows, doc_id, hash, start): one place of each slice."""
    places = wanted.groupBy("doc_id", "hash").agg(F.collect_list(F.struct("anchor", "slice", "start", "windows", "hot")).alias("places"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, places in zip(batch.column("text"), batch.column("places").to_pylist(), strict=True):
                whole = memoryview(text.as_buffer())
                found += [(p["anchor"], p["slice"], p["windows"], p["hot"], whole[p["start"] : p["start"] + p["windows"] + LENGTH - 1].tobytes()) for p in places]
            columns = list(zip(*found, strict=True)) if found else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "slice", "windows", "hot", "bytes"])

    # One row per key: equal rows would cut the same bytes.
    once = named(docs).join(places, ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"]).select("text", "places")
    return once.mapInArrow(rows, "anchor long, slice long, windows int, hot boolean, bytes binary")


def runs_of(flags: np.ndarray) -> list[list[int]]:
    """[first, end) of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


def stretches(group: pd.DataFrame) -> list[tuple[int, int, int]]:
    """(row, first window, last window) of the part of each slice that can hold repeats.

    A window whose hash stands once repeats nowhere, so only the stretch between a slice's candidates is sorted.
    """
    strings = group["bytes"].tolist()
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    windows = group["windows"].to_numpy(np.int64)
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    hashes = Rolling(np.frombuffer(b"".join(strings), np.uint8)).ranges(at, at + LENGTH)
    order = np.argsort(hashes)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    candidate = np.zeros(len(hashes), bool)
    candidate[order[1:][equal]] = candidate[order[:-1][equal]] = True
    bounds = np.concatenate([[0], np.cumsum(windows)])
    return [(row, places[0], places[-1]) for row in range(len(strings)) if len(places := np.flatnonzero(candidate[bounds[row] : bounds[row + 1]]))]


def grouped(group: pd.DataFrame) -> tuple[list[tuple[int, int, int]], Groups]:
    """The maximal repeat groups of the slices of some anchors, over their stretches."""
    kept = stretches(group)
    strings = group["bytes"].tolist()
    return kept, Groups([strings[row][a : b + LENGTH] for row, a, b in kept], LENGTH)


def matched(group: pd.DataFrame) -> pd.DataFrame:
    """Runs of windows of each slice of some anchors that lie in occurrences of their maximal repeat groups."""
    kept, groups = grouped(group)
    flags = groups.covered()
    out, done = [], 0
    anchors, own = group["anchor"].to_numpy(), group["slice"].to_numpy()
    for row, a, b in kept:
        size = b - a + LENGTH
        out += [(anchors[row], own[row], a + x, a + y - LENGTH + 1) for x, y in runs_of(flags[done : done + size])]
        done += size
    return pd.DataFrame(out, columns=["anchor", "slice", "first", "last"]).astype("int64")


def listed_groups(group: pd.DataFrame) -> pd.DataFrame:
    """The same groups with each occurrence as a row: group, length, anchor, slice and the place in the slice."""
    kept, groups = grouped(group)
    anchors, own = group["anchor"].to_numpy(), group["slice"].to_numpy()
    row, shift = (np.array([k[i] for k in kept], np.int64) for i in (0, 1))
    out = []
    for length, at in groups.occurrences():
        where = groups.owner[at]
        offset = at - groups.starts[at] + shift[where]
        text = group["bytes"].iloc[row[where[0]]][offset[0] : offset[0] + length]
        name = hashlib.md5(text).hexdigest()
        out.append(pd.DataFrame({"repeat": name, "length": length, "anchor": anchors[row[where]], "slice": own[row[where]], "at": offset}))
    listed = pd.concat(out) if out else pd.DataFrame({"repeat": [], "length": [], "anchor": [], "slice": [], "at": []})
    return listed.astype({"repeat": object, "length": "int64", "anchor": "int64", "slice": "int64", "at": "int64"})


def hot_windows(held: DataFrame) -> DataFrame:
    """Repeated windows of hot anchors' slices, by counts of two hashes of each window."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                if not part.num_rows:
                    continue
                data, bounds = utf8(part.column("bytes"))
                counts = np.asarray(part.column("windows"), np.int64)
                start = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
                row = pa.array(np.repeat(np.arange(part.num_rows), counts))
                one = Rolling(data).ranges(start, start + LENGTH)
                # The same sums over mixed bytes: a second hash, independent of the first.
                other = Rolling((mix(data.astype(np.uint64)) & np.uint64(0xFF)).astype(np.uint8)).ranges(start, start + LENGTH)
                yield pa.RecordBatch.from_arrays(
                    [part.column("anchor").take(row), part.column("slice").take(row), pa.array((start - bounds[np.asarray(row)]).astype(np.int32)), signed(one), signed(other)],
                    names=["anchor", "slice", "at", "one", "other"],
                )

    windows = materialize(held.mapInArrow(rows, "anchor long, slice long, at int, one long, other long"), "hot")
    again = windows.groupBy("one", "other").agg(F.count("*").alias("n")).filter("n > 1").select("one", "other")
    return windows.join(again, ["one", "other"]).select(
        F.concat(F.lit("window:"), "one", F.lit(":"), "other").alias("repeat"), "anchor", "slice", F.col("at").cast("long").alias("first"),
        (F.col("at") + 1).cast("long").alias("last"),
    )


def dealt_slices(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    """All slices, the different ones of anchors that can repeat, the bytes of those that must be compared, and their groups."""
    spark = docs.sparkSession
    found = materialize(sliced(docs), "slices")
    per_slice = found.groupBy("anchor", "slice", "windows").agg(
        F.count("*").alias("n"), F.bool_or("inside").alias("inside"), F.min(F.struct("doc_id", "hash", "start")).alias("at")
    )
    per_anchor = per_slice.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.bool_or("inside").alias("some_inside"))
    per_anchor = per_anchor.filter("total > 1 or some_inside")
    kept = materialize(per_slice.join(per_anchor, "anchor").select("anchor", "slice", "windows", "n", "inside", "kinds", "at.*"), "anchors")
    wanted = kept.filter("kinds > 1 or (inside and n = 1)").withColumn("hot", F.col("kinds") > HOT)
    cut = materialize(bytes_of(docs, wanted), "bytes")
    # Anchors meet in groups, so that suffix arrays are long enough to be worth it; each group has about BLOCK bytes.
    size = cut.filter("not hot").agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0)).alias("n")).first()["n"]
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK))
    return found, kept, cut, F.pmod(F.xxhash64("anchor", F.lit(9)), F.lit(groups)).alias("g")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, hash and the sorted places [first, end) in bytes of all repeated strings of ``LENGTH`` bytes or more."""
    found, kept, cut, group = dealt_slices(docs)
    common = cut.filter("not hot").groupBy(group).applyInPandas(matched, "anchor long, slice long, first long, last long")
    partial = common.unionByName(hot_windows(cut.filter("hot")).select("anchor", "slice", "first", "last"))
    # A slice that stands twice repeats as a whole; of others, the runs that were found.
    whole = kept.filter("n > 1").select("anchor", "slice", F.lit(0).cast("long").alias("first"), F.col("windows").cast("long").alias("last"))
    runs = whole.unionByName(partial)
    places = found.join(runs, ["anchor", "slice"]).select(
        "doc_id", "hash", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last") + (LENGTH - 1)).alias("end")
    )
    return places.groupBy("doc_id", "hash").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("places"))


def repeat_groups(docs: DataFrame) -> DataFrame:
    """``repeat, length, doc_id, hash, offset``: every occurrence of every repeat group of ``LENGTH`` bytes or more.

    ``repeat`` names the repeated bytes. Repeats are reported per anchor: one that runs over several anchors is the
    repeats of their slices, which overlap by ``LENGTH - 1`` bytes. Slices that stand several times are groups as a whole; the
    windows of a hot anchor are groups of ``LENGTH`` bytes each.
    """
    found, kept, cut, group = dealt_slices(docs)
    own = cut.filter("not hot").groupBy(group).applyInPandas(listed_groups, "repeat string, length long, anchor long, slice long, at long")
    hot = hot_windows(cut.filter("hot")).select("repeat", F.lit(LENGTH).cast("long").alias("length"), "anchor", "slice", F.col("first").alias("at"))
    inner = found.join(own.unionByName(hot), ["anchor", "slice"]).select("repeat", "length", "doc_id", "hash", (F.col("start") + F.col("at")).alias("offset"))
    whole = found.join(kept.filter("n > 1").select("anchor", "slice"), ["anchor", "slice"])
    copies = whole.select(F.concat(F.lit("slice:"), "anchor", F.lit(":"), "slice").alias("repeat"), (F.col("windows") + (LENGTH - 1)).cast("long").alias("length"), "doc_id", "hash", F.col("start").cast("long").alias("offset"))
    return inner.unionByName(copies).withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))


def merged(places: list[dict] | None) -> list[list[int]]:
    out: list[list[int]] = []
    for p in places or ():
        if out and p["first"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], p["end"])
        else:
            out.append([p["first"], p["end"]])
    return out


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every document."""
    spans = materialize(repeated_spans(docs), "spans")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            kept, counts = [], []
            for text, places in zip(block.column("text"), block.column("places").to_pylist(), strict=True):
                whole = memoryview(text.as_buffer()) if len(text.as_py()) else memoryview(b"")
                cuts = merged(places)
                edges = [0, *[x for cut in cuts for x in cut], len(whole)]
                kept.append(b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                counts.append((len(whole), sum(b - a for a, b in cuts), len(cuts)))
            numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            digests = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *numbers, digests, pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            )

    joined = named(docs).join(spans, ["doc_id", "hash"], "left").select(F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"), "text", "places")
    return joined.mapInArrow(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
