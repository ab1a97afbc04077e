"""The WARC writer, whitening and the source audit against brute force: nulls, empty and long values, ties, repeats, clashing columns."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from tessera.llm import divergence, warc, whitening

PAGE = "<html><head><title>{}</title></head><body>" + "<p>words of the page that many pages share</p>" * 8 + "{}</body></html>"
PAGES = [
    *[(i, f"http://host/{i}", PAGE.format(i, random.Random(i).random()), "x", -1) for i in range(60)],
    *[(1000 - i, f"http://copy/{i}", PAGE.format("same", "same"), None, 3) for i in range(70)],
    (70, None, None, "x", 0), (71, "http://a/é\r\nWARC-Type: resource", "", "x", 0), (69, "u", "", "x", 0),
    (None, "u", PAGE.format(5, random.Random(5).random()), "x", 0), (None, "v", "only without ids", None, None), (None, "w", "only without ids", None, None),
    (80, "t", "tie", None, None), (80, "t", "tie", None, None), (81, "t", "tie", None, None), (90, "long", "é漢 long\r\n\r\n" * 60_000, None, None),
]
PAGE_SCHEMA = "page_id long, url string, html string, payload string, size long"


def page_rows(rows):
    smallest = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            smallest[html or ""] = min(page_id, smallest.get(html or "", page_id))
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        first = smallest.get(html or "")
        revisit = first is not None and page_id != first
        yield (page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", first if revisit else None)


def same(got, want):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("hot_part", [1, 1000])
def test_archives(spark, tmp_path, monkeypatch, hot_part):
    monkeypatch.setattr(warc, "HOT_PART", hot_part)
    monkeypatch.setattr(warc, "PACK_BYTES", 2000)
    monkeypatch.setattr(warc, "PACKS", 3)
    pages = spark.createDataFrame(PAGES, PAGE_SCHEMA).repartition(3)
    folder = warc.write_archives(pages, str(tmp_path / "archives"))
    records = warc.read_archives(spark, folder).cache()
    same(records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect(), list(page_rows(PAGES)))
    same(warc.restored(records).collect(), [(p, (html or "").encode()) for p, _, html, *_ in PAGES])
    same(warc.archived(pages).collect(), list(page_rows(PAGES)))
    found = {r["page_id"]: r for r in records.collect()}
    assert found[0]["target_uri"] == "http://host/0" and found[70]["target_uri"] is None
    assert "\r" not in found[71]["target_uri"] and found[71]["target_uri"].startswith("http://a/%C3%A9%0D%0A")
    assert found[999]["refers_to_record"] == found[931]["record_id"]

    archives = sorted((tmp_path / "archives").glob("part-*"))
    assert len(archives) > 3
    one = found[7]
    data = open(one["archive"].removeprefix("file:"), "rb").read()
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(data[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    alone = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(data[one["offset"] : one["offset"] + one["length"]])
    assert alone.startswith(b"WARC/1.1\r\n") and alone.endswith(one["payload"] + b"\r\n\r\n")
    # The whole archive is one valid Zstandard stream, and the dictionary pays.
    stream = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data, read_across_frames=True).read()
    assert stream.count(b"WARC/1.1\r\n") >= 2
    assert one["length"] < len(zstandard.compress(alone))


def test_archives_of_little(spark, tmp_path):
    nothing = spark.createDataFrame([], PAGE_SCHEMA)
    assert warc.archived(nothing).collect() == []
    one = spark.createDataFrame([(1, None, None, None, None)], PAGE_SCHEMA)
    same(warc.archived(one).collect(), list(page_rows([(1, None, None)])))


def test_damaged_archive():
    plain = zstandard.ZstdCompressor().compress(warc.record(1, "u", b"abc", 3, "A" * 32, None, warc.DATE))
    with pytest.raises(ValueError, match="digest"):
        [warc.parsed("a", f) for f in warc.frames(plain)]
    with pytest.raises(ValueError, match="ends within"):
        list(warc.frames(plain[:-3]))


def vectors(dim, n, seed):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim))
    return [[float(np.float32(v)) for v in row] for row in mixed]


def test_whitening(spark):
    good = vectors(5, 400, 1)
    rows = [(i, v, "clash", 0) for i, v in enumerate(good)]
    rows += [(1000 + i, good[0], "copy", 0) for i in range(150)] + [(None, good[1], None, None), (7, good[2], None, None)]
    wrong = [None, [], [None, 1.0, 1.0, 1.0, 1.0], [float("nan")] + [1.0] * 4, [float("inf")] + [1.0] * 4, [1.0, 2.0], [1e300] + [1.0] * 4]
    rows += [(5000 + i, v, None, None) for i, v in enumerate(wrong)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string, n long").repartition(4)
    kept = [(i, v) for i, v, *_ in rows if v and len(v) == 5 and all(c is not None and abs(c) < 1e200 for c in v)]
    x = np.floor(64 * np.array([v for _, v in kept])).astype(int) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    got = defaultdict(list)
    for r in whitening.whitened(table).collect():
        got[r["vec_id"]].append(r)
    assert sum(map(len, got.values())) == 5 * len(kept)
    want = (x - sums / n) @ axes / np.sqrt(values)
    signs = {}
    for (vec_id, _), row, whole in zip(kept, want, x, strict=True):
        close = [r for r in got[vec_id] if r["deviation"] == ((n * whole - sums) ** 2).sum()]
        assert {r["component"] for r in close} == set(range(1, 6))
        for r in close:
            k = r["component"] - 1
            sign = signs.setdefault(k, np.sign(r["whitened"] * row[k]))
            assert abs(r["whitened"] - sign * row[k]) < 1e-9
            assert abs(r["explained"] - values[k] / values.sum()) < 1e-12 and r["n"] == n and r["identity_error"] < 1e-9


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [1.0]), (3, [1.0])], schema)).collect() == []
    # A dimension that repeats another and one that never varies have no variance of their own.
    rng = np.random.default_rng(3)
    rows = [(i, [float(a), float(b), float(a), 4.0]) for i, (a, b) in enumerate(rng.normal(size=(50, 2)))]
    got = whitening.whitened(spark.createDataFrame(rows, schema)).collect()
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-9


def test_exact_deviation_at_the_edge_of_a_long():
    centre = whitening.Centre(3, [2**61, 5])
    x = np.array([[2**60, 1], [2**40, 2], [7, 2]])
    exact, fits = centre.deviations(x)
    assert list(fits) == [False] * 3
    centre = whitening.Centre(1 << 20, [(1 << 20) * 1_000_000 + 3, 0])
    exact, fits = centre.deviations(np.array([[1_000_700, 9]]))
    assert fits[0] and exact[0] == ((1 << 20) * 700 - 3) ** 2 + ((1 << 20) * 9) ** 2


@pytest.mark.parametrize("dim", [1, 2, 7, 40])
def test_spectrum(dim):
    rng = np.random.default_rng(dim)
    half = rng.normal(size=(dim, dim)) * 10.0 ** rng.integers(-3, 4, dim)
    scatter = half @ half.T
    factor, order = whitening.pivoted_cholesky(scatter)
    assert np.allclose(factor @ factor.T, scatter) and np.allclose(factor[order], np.tril(factor[order]))
    values, axes = whitening.spectrum(scatter, 1)
    assert np.allclose(values, np.linalg.eigvalsh(scatter)[::-1][: len(values)], rtol=1e-8, atol=1e-9 * values[0])
    assert np.allclose(axes.T @ axes, np.eye(len(values)))


def audit(rows, min_docs, top):
    """Both parts by the definition, over all kept terms."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(set(terms))
        count[lang, source].update(terms)
    for lang in seen:
        kept = [t for t, n in seen[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in count.items() if x == lang}
        total = sum(groups.values(), Counter())

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        of_lang, of = shares(total), {s: shares(c) for s, c in groups.items()}
        for source, p in of.items():
            pairs = [(s, sum(abs(p[t] - q[t]) for t in kept)) for s, q in of.items() if s != source]
            terms = [(t, p[t] - of_lang[t]) for t in kept if groups[source][t] > 0 and p[t] > of_lang[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                yield from ((lang, source, part, item, value, i) for i, (item, value) in enumerate(order, 1))


@pytest.fixture(scope="module")
def sourced():
    rng = random.Random(5)
    words = ["alpha", "Beta", "beta", "ÄÖ", "äö", "東京", "x", "don't", "a1b2", "", "𝒳", "zz", "yy"]
    rows = []
    for i in range(260):
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        text = " ".join(rng.choices(words, [9, 5, 5, 3, 3, 2, 2, 2, 2, 1, 1, 1, 1], k=rng.randint(0, 30)))
        rows.append((None if i % 40 == 0 else text, lang, rng.choice(["s1", "s1", "s1", "s2", "s3", None, "é"])))
    rows += [("only rare words here", "de", "a"), ("12 34", "de", "b"), (None, "it", None)] + [("beta " * 5000 + "ALPHA-beta", "en", "hot")] * 3
    return rows


@pytest.mark.parametrize("bounds", [(1 << 20, 1 << 18, 256, 4096), (3, 8, 2, 3)])
def test_divergence(spark, sourced, monkeypatch, bounds):
    for name, value in zip(("SLICE_TERMS", "BLOCK_CELLS", "TILE", "CHUNK"), bounds, strict=True):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame([(i, *r, "clash", 1, "t") for i, r in enumerate(sourced)], "doc_id long, text string, lang string, source string, words string, n long, item string")
    got = divergence.divergence(docs.repartition(3), min_docs=20, top_terms=3, slice_terms=bounds[0]).select("lang", "source", "part", "item", "value", "rank").collect()
    same(got, list(audit(sourced, 20, 3)))


def test_divergence_of_little(spark):
    schema = "text string, lang string, source string"
    assert divergence.divergence(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, None), ("a b", None, "s"), ("", "en", "t")]
    same(divergence.divergence(spark.createDataFrame(rows, schema)).select("lang", "source", "part", "item", "value", "rank").collect(), list(audit(rows, 30, 50)))
