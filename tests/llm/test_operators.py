"""Every operator against a brute-force version on hand-made rows: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import decontaminate, language, licenses, lm, pii, quality, repeats, reuse, sketches, tokens

os.environ["TOKENIZERS_PARALLELISM"] = "false"
LINE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old tree near the quiet river bank"
FRENCH = "le renard brun saute par dessus le chien paresseux pendant que sept hiboux regardent depuis un vieil arbre à côté"
PASSAGE = " ".join(f"{a}{b}" for a in "vwxyz" for b in LINE.split())
TEXTS = [
    None, "", " \n\t ", "one two", "One TWO", LINE, LINE, LINE.upper(), LINE + " and then it slept", LINE + "\n" + LINE + "\n" + LINE, FRENCH, FRENCH + " é",
    "12345 !!! ???", PASSAGE, "before " + PASSAGE + " behind", PASSAGE + PASSAGE, "word " * 3000, "x" * 5000,
    "mail me: a.b+c@host.example.com, 10.0.0.255 or 999.1.1.1, card 4111 1111 1111 1111, call +1 (555) 010-9999.",
    "Licensed under CC BY-NC 4.0. All rights reserved. GNU General Public License, version 3.", "<|endoftext|> a  b\n\n\nc d　e '́s don't",
    "### $$$ %%% &&& ***" * 10, " ".join(random.Random(1).choice("abcdefg") * 3 for _ in range(400)),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, row long, hash string"


@pytest.fixture(scope="module")
def rows():
    found = [(i, t, None if i % 9 == 4 else ("fr" if t and "renard" in t else "en"), "s", -1, 7, "clash") for i, t in enumerate(TEXTS)]
    return [*found, found[6], (None, LINE, "en", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def test_token_files(spark, docs, rows, nothing, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    encode = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
    folder = tokens.write_tokens(docs, path, str(tmp_path / "files"))
    got = tokens.read_index(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:i]) for i in range(len(got))]
    want = Counter((r[0], zlib.crc32(np.array(encode(r[1]), "<u4").tobytes())) for r in rows)
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == want
    assert {r["doc_id"]: r["ids"] for r in tokens.read_documents(spark, folder, 5, 6).collect()} == {i: encode(TEXTS[i]) for i in (5, 6)}
    assert tokens.token_table(nothing, path).count() == 0


def test_token_memory_is_bounded(monkeypatch):
    # Blocks and remembered pieces of two workers beside the JVM stay under 3000 MB by some margin.
    assert tokens.ENCODE_BYTES <= 8 << 20 and tokens.REMEMBERED <= 1_000_000
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, forgetful = tokens.Encoder(path), tokens.Encoder(path)
    texts = [[f"word{i} and other{i * 7} text{j}." for i in range(20)] for j in range(5)]
    kept = [whole.encode(block, 2) for block in texts]
    monkeypatch.setattr(tokens, "REMEMBERED", 30)
    for block, (ids, sizes) in zip(texts, kept, strict=True):
        again, lengths = forgetful.encode(block, 2)
        assert np.array_equal(ids, again) and np.array_equal(sizes, lengths)
    assert len(forgetful.known) < len(whole.known)


def test_token_pieces_at_random():
    encoder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    pick = random.Random(2)
    parts = ["a", "b.", ",", " ", "\n", "'s", "é", "1", "!", "<|endoftext|>", "\t", "　", "中", "\r\n", "́"]
    for _ in range(60):
        texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 25))) for _ in range(30)]
        ids, sizes = encoder.encode(texts, 2)
        want = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_chunk_reuse(docs, rows, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    want = []
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    same(reuse.encoded(docs, path).collect(), want)
    assert reuse.encoded(nothing, path).count() == 0
    pairs = reuse.decoded(reuse.token_rows(docs, path).withColumnRenamed("decoded", "joined"), path).collect()
    assert all(r["joined"] == r["decoded"] for r in pairs)


def test_chunks_are_shared_and_joins_repaired():
    encoder = reuse.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
    whole = PASSAGE.encode() * 4
    data = np.frombuffer(b"aa " + whole + b"bbbb " + whole, np.uint8)
    starts = reuse.cut_places(data, np.array([0, len(whole) + 3, len(data)]))
    ends = np.append(starts[1:], len(data))
    cut = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    split = int(np.searchsorted(starts, len(whole) + 3))
    got = encoder.encode([cut[:split], cut[split:]])
    assert encoder.reused > 2 and encoder.repaired > 0
    for run, text in zip(got, (b"aa " + whole, b"bbbb " + whole), strict=True):
        assert run[1] == " ".join(map(str, encoder.tokenizer.encode(text.decode(), add_special_tokens=False).ids))


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, rows, nothing):
    got = quality.judged(docs).collect()
    want = []
    for r in rows:
        n = brute_quality(r[1])
        want.append((r[0], *n, n[0] < 20 or 100 * n[4] > 30 * n[0]))
    same([tuple(r)[:-1] for r in got], want)
    assert all(not (r["kept"] and r["base_failed"]) for r in got)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if r["kept"])
    assert quality.judged(nothing).count() == 0 and quality.kept_documents(nothing).count() == 0


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_licenses(docs, rows, nothing):
    got = {(r["doc_id"], r["n_words"]): r for r in licenses.scanned(docs).collect()}
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        r = got[doc_id, len(words)]
        found = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in found]
        assert (r["n_base"], r["first_word"], r["last_word"]) == (len(found), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found})) and {x for _, x in found} <= set(r["labels"].split(","))
        # The method's labels against a scan by Python's expressions.
        joined = " ".join(words)
        hits = []
        for place, rule in enumerate(licenses.signatures()):
            if rule.keyword in joined and any(root in joined for root in licenses.ROOTS):
                for m in re.finditer(rule.pattern, joined):
                    hits.append((joined[: m.start()].count(" "), joined[: m.end()].count(" "), rule.rank, place, rule.label))
        stays = {
            h[4] for h in hits
            if not any(o != h and o[0] <= h[0] and o[1] >= h[1] and o[2] <= h[2] and ((o[0], o[1]) != (h[0], h[1]) or (o[2], o[3]) < (h[2], h[3])) for o in hits)
        }
        assert set(filter(None, r["labels"].split(","))) == stays | {x for _, x in found}
    assert licenses.scanned(nothing).count() == 0


def test_every_signature_has_a_root():
    assert len(licenses.signatures()) > 200
    for line in licenses.SIGNATURES.strip().splitlines():
        _, keyword, _, pattern = line.split("|", 3)
        plain = re.sub(r"\(\?:|\)\??|\?|#", "", (keyword + " " + pattern).replace("L", "license"))
        assert any(root in plain or root in plain.replace("|", " ") for root in licenses.ROOTS), line


def written(items):
    """Texts of all branches of a parsed expression, each repeat at its least and once."""
    parts = []
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(arg)])
        elif name == "SUBPATTERN":
            parts.append(written(arg[3]))
        elif name == "BRANCH":
            parts.append([t for branch in arg[1] for t in written(branch)])
        elif name == "IN":
            kind, first = str(arg[0][0]), arg[0][1]
            parts.append([chr(x) for _, x in arg] if kind == "LITERAL" else [chr(first[0])] if kind == "RANGE" else ["7" if "DIGIT" in str(first) else "x"])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            parts.append(([""] if arg[0] == 0 else []) + [t * max(arg[0], 1) for t in written(arg[2])])
        elif name == "ANY":
            parts.append(["x"])
        else:
            assert name == "ASSERT_NOT", name
    return ["".join(x) for x in itertools.product(*parts)]


def test_gates_hold_for_all_branches_of_a_signature(spark):
    rules = licenses.signatures()
    texts = sorted({t for rule in rules for t in written(re._parser.parse(rule.pattern))})
    for rule in rules:
        for text in texts:
            if re.search(rule.pattern, text):
                assert rule.keyword in text and any(root in text for root in licenses.ROOTS), (rule, text)
    texts = {
        "Creative Commons Attribution Non-Commercial 4.0": "cc-by-nc", "may not be copied (or distributed) without permission": "reserved",
        "Creative Commons Attribution Non-Commercial Share-Alike": "cc-by-nc-sa", "for noncommercial use only": "non-commercial",
        "for academic use only": "research-only", "for research and teaching purposes only": "research-only",
        "Open Data Commons Attribution Licence": "odc-by", "All rights are reserved.": "reserved", "CeCILL B": "cecill", "licenced under": "licensed",
    }
    found = licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in found} == dict(enumerate(texts.values()))


def base_pii(text):
    text = text or ""
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 13 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in out]


def test_personal_data(docs, rows, nothing):
    got = pii.scanned(docs).collect()
    same([(r["doc_id"], r["base_sha256"]) for r in got], [(r[0], sha(",".join(base_pii(r[1])))) for r in rows])
    by_id = {r["doc_id"]: r["spans"] for r in got}
    assert all(set(base_pii(t)) <= set(filter(None, by_id[i].split(","))) | set() for i, t in enumerate(TEXTS))
    assert by_id[5] == "" and pii.scanned(nothing).count() == 0
    masked = pii.masked_documents(docs)
    assert masked.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert texts[0] is None and texts[5] == LINE and "[EMAIL]" in texts[18] and "4111" not in texts[18]


def test_base_patterns_at_random():
    pick = random.Random(3)
    for _ in range(3000):
        text = "".join(pick.choice("1234567890.-+ ()@ab") for _ in range(pick.randint(0, 40)))
        spans = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(pii.base_spans(text))]
        assert spans == base_pii(text), text


def test_network_learns_variants_and_its_gradient_is_right():
    pick = random.Random(4)
    words = LINE.split()
    made = []
    for turn in range(500):
        lead, tail = (" ".join(pick.choice(words) for _ in range(4)) for _ in "ab")
        body = [f"{pick.choice(words)}{turn}@mail{turn % 9}.example.com", f"+1 ({pick.randint(200, 999)}) 555-{pick.randint(1000, 9999)}"][turn % 2]
        text = f"{lead} {body} {tail}"[: pii.WINDOW]
        spans = pii.base_spans(text)
        made += [(text, spans), tuple(pii.varied(text, spans, turn)), (f"{lead} {turn} {tail}"[: pii.WINDOW], [])]
    made = [(t[: pii.WINDOW], [s for s in spans if s[2] <= pii.WINDOW]) for t, spans in made]
    model = pii.trained(made[:1200], steps=120)
    held = made[1200:]
    found = pii.decoded(model, [t for t, _ in held])
    want = sum(len(s) for _, s in held)
    right = sum(len({(k, a, b) for k, a, b, _ in f} & set(s)) for f, (_, s) in zip(found, held, strict=True))
    assert right >= 0.8 * want
    small = {k: v.astype(np.float64) for k, v in pii.fresh().items()}
    chars = np.array([pii.codes("ab@c.d 12"), pii.codes("xy 1.2.3 ")])
    tags, real = np.array([[0, 1, 2, 2, 0, 0, 0, 3, 4], [0] * 9]), np.ones((2, 9), bool)
    _, grads = pii.loss_and_gradient(small, chars, tags, real)
    for name in ("own_f", "in_b", "move", "out", "embed"):
        at = tuple(np.argwhere(np.abs(grads[name]) == np.abs(grads[name]).max())[0])
        sides = []
        for by in (1e-2, -1e-2):
            moved = {k: v.copy() for k, v in small.items()}
            moved[name][at] += by
            sides.append(pii.loss_and_gradient(moved, chars, tags, real)[0])
        assert math.isclose((sides[0] - sides[1]) / 2e-2, grads[name][at], rel_tol=0.05, abs_tol=2e-3)


def test_written_out_dots_and_luhn_phones_are_valid():
    assert all(pii.valid(0, t) for t in ("john dot smith at host dot com", "john[dot]smith[at]host[dot]com", "john (dot) b.smith (at) host.com"))
    assert not any(pii.valid(0, t) for t in ("john smith at host dot com", "john dot at host dot com", "john dot smith"))
    numbers = [f"(555) 123-{n}" for n in range(4000, 4100)]
    assert {pii.luhn(pii.only_digits(n)) for n in numbers} == {True, False} and all(pii.valid(3, n) for n in numbers)


def test_spans_cut_by_a_window_are_decoded_whole(monkeypatch):
    pattern, kinds = r"[a-z().]+", [0]
    monkeypatch.setattr(pii, "decoded", lambda model, texts: [[(k, *m.span(), 9.0) for m in re.finditer(pattern, t) for k in kinds] for t in texts])
    for local in (1, 23, 24, 60, 300):
        for host in (1, 24, 90, 400):
            name = "n" * local + "(at)" + "h" * host + ".com"
            for lead in ("", "LINE\n", "UP " * 50):
                text = f"{lead}{name}{' NO' * 50}"
                assert pii.all_spans({}, [text, name]) == [([], [(0, len(lead), len(lead) + len(name))]), ([], [(0, 0, len(name))])], (local, host, lead)
    # A long run that is nothing ends, and a card wins over a telephone number in its place.
    assert pii.all_spans({}, ["(at)" * 5000]) == [([], [])]
    pattern, kinds = r"[0-9.]+", [2, 3]
    assert pii.all_spans({}, ["no 4111.1111.1111.1 no 4222.2222.2222.2"])[0][1] == [(2, 23, 39), (3, 3, 19)]


def test_decontamination(spark, docs, rows, nothing):
    items = [(1, LINE.upper()), (2, "one, two!"), (3, None), (4, ""), (5, "never seen words at all in here today okay then so"), (None, LINE), (1, LINE)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    want = []
    for doc_id, text, *_ in rows:
        own, hit, ids = words(text), set(), set()
        for item, item_text in items:
            w = words(item_text)
            for i in range(max(1, len(w) - 9) if w else 0):
                window = w[i : i + 10]
                for s in range(len(own) - len(window) + 1):
                    if own[s : s + len(window)] == window:
                        hit |= {*range(s, s + len(window))}
                        ids |= {str(item)} if item is not None else set()
        want.append((doc_id, len(own), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    same(decontaminate.contamination(docs, benchmark).collect(), want)
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(w[0] for w in want if not w[5])
    blocks = decontaminate.found_in(docs, benchmark, block_words=3).select("doc_id", decontaminate.covered("places").alias("n"))
    same(blocks.collect(), [(w[0], w[2]) for w in want])
    assert decontaminate.contamination(nothing, benchmark).count() == 0
    assert not decontaminate.contamination(docs, benchmark.limit(0)).filter("contaminated").count()
    assert decontaminate.found_in(docs, benchmark, near=8).filter("places is not null").count() >= sum(w[5] for w in want) - 2


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [sets_of(r[1]) for r in rows]
    low = list(range(len(rows)))
    top = lambda i: i if low[i] == i else top(low[i])
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low[max(top(i), top(j))] = min(top(i), top(j))
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        own = min(ids, default=None) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), own, r[0] == own))
    return out


def test_near_duplicates(docs, rows, nothing):
    same(sketches.near_duplicates(docs).collect(), brute_components(rows))
    assert sketches.near_duplicates(nothing).count() == 0 and sketches.distinct_documents(nothing).count() == 0
    kept = sketches.distinct_documents(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) >= {c for _, n, c, k in brute_components(rows) if k}


def test_large_groups_of_near_copies_lose_no_link(spark):
    """Over SMALL nodes in a bucket: chains of edits, so that far ends are linked through others only."""
    pick = random.Random(6)
    rows, at = [], 0
    for family in range(3):
        words = [f"{family}w{pick.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(60):
            rows.append((at, " ".join(words)))
            at += 1
            words = list(words)
            words[pick.randrange(len(words))] = f"e{pick.randint(0, 10**6)}"
            if pick.random() < 0.2:
                words[pick.randrange(len(words))] = f"f{pick.randint(0, 10**6)}"
    table = spark.createDataFrame(rows, "doc_id long, text string")
    same(sketches.near_duplicates(table).collect(), brute_components(rows))


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = np.sort(rng.integers(0, 1 << 63, 1500, dtype=np.uint64))
    a, b = x[:1000], x[250:]
    sketch = lambda s: sketches.registers(s, np.array([0, len(s)]))
    assert (sketches.merged(sketch(a), sketch(b)) == sketch(x)).all()
    found = sketches.likely_similarity(sketch(a), sketch(b), np.array([1000.0]), np.array([1250.0]))
    assert abs(found[0] - 0.5) < 0.15


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return out


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeated_strings(spark, docs, rows, nothing, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    got = repeats.removed(docs).drop("kept").collect()
    same(got, [(r[0], *x) for r, x in zip(rows, brute_repeats([r[1] for r in rows], repeats.LENGTH), strict=True)])
    assert repeats.removed(nothing).count() == 0


def test_maximal_repeats_at_random():
    pick = random.Random(3)
    for turn in range(80):
        strings = [bytes(pick.choice(b"ab" if turn % 2 else b"abc") for _ in range(pick.randint(0, 25))) for _ in range(pick.randint(1, 4))]
        least = pick.randint(1, 6)
        places = {}
        for i, s in enumerate(strings):
            for a in range(len(s)):
                for b in range(a + least, len(s) + 1):
                    places.setdefault(s[a:b], []).append((i, a))
        want = set()
        for w, at in places.items():
            left = {strings[i][a - 1] if a else (-1, i) for i, a in at}
            right = {strings[i][a + len(w)] if a + len(w) < len(strings[i]) else (-1, i) for i, a in at}
            if len(at) > 1 and len(left) > 1 and len(right) > 1:
                want.add((len(w), tuple(sorted(at))))
        assert {(n, tuple(at)) for n, at in repeats.maximal_repeats(strings, least)} == want


def test_language(docs, rows, nothing):
    got = language.identified(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = LINE if r["doc_id"] is None else TEXTS[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", text or ""))
    assert {r["lang_pred"] for r in got if r["doc_id"] in (10, 11)} == {"fr"}
    assert language.identified(nothing).count() == 0


def test_language_on_held_out_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identified(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_copies_take_no_place_from_other_texts_of_a_language(spark):
    few = [(f"{a}{b} {LINE}", f"few{a}") for a in "abcdefghij" for b in "xy" for _ in range(1500)]
    hot = [(LINE, "hot")] * 2000 + [(f"{LINE} {a}{b}{c}", "hot") for a in "abcde" for b in "abcde" for c in "abcd"]
    many = [(f"{FRENCH} {i}", "many") for i in range(language.SAMPLE_DOCS + 900)]
    table = spark.createDataFrame(few + hot + many, "text string, lang string").repartition(4)
    rows = language.sampled(table).collect()
    by_lang = Counter(r["lang"] for r in rows)
    assert by_lang == {**{f"few{a}": 2 for a in "abcdefghij"}, "hot": 101, "many": language.SAMPLE_DOCS}
    assert {(r["text"], r["copies"]) for r in rows if r["lang"] != "many"} == {(t, n) for (t, _), n in Counter(few + hot).items()}
    assert set(language.fitted(table).labels) == set(by_lang)


def test_language_model(docs, rows, nothing):
    got = lm.scored(docs).collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    words = [[*(r[1] or "").encode().lower().split(), b"\0end"] for r in rows]
    seen = Counter(w for r, ws in zip(rows, words, strict=True) if not held(r[0]) for w in ws)
    n, v = seen.total(), len(seen)
    want = [(r[0], held(r[0]), len(ws), sum(seen[w] > 0 for w in ws), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws), 6)) for r, ws in zip(rows, words, strict=True)]
    same([(*tuple(r)[:5], round(r["base_score"], 6)) for r in got], want)
    assert all(r["score"] < 0 for r in got) and lm.scored(nothing).count() == 0


def test_language_model_carries_its_state_and_its_gradient_is_right():
    rng = np.random.default_rng(2)
    model = lm.fresh(rng.integers(1, 100, lm.FREQUENT), np.ones(lm.BANDS * lm.KINDS))
    documents = [rng.integers(0, lm.SYMBOLS - 1, n).astype(np.int16) for n in (1, 70, 33, 32, 5)]
    alone = [lm.score_documents(model, [d])[0] for d in documents]
    assert np.allclose(lm.score_documents(model, documents), alone, rtol=1e-4)
    one = documents[1].astype(np.int64)
    states, _, _ = lm.gru(model, np.append(lm.SYMBOLS - 1, one[:-1])[:, None], np.zeros((1, lm.HIDDEN), np.float32))
    assert np.isclose(lm.log_chances(model, states[:, 0], one).sum(), alone[1], rtol=1e-4)
    # Chances of all symbols sum to one: class by class.
    every = np.arange(lm.SYMBOLS - 1)
    assert np.isclose(np.exp(lm.log_chances(model, np.repeat(states[:1, 0], len(every), 0), every)).sum(), 1, rtol=1e-3)
    small = {k: v.astype(np.float64) for k, v in model.items()}
    given, goal, real, h = one[:12].reshape(6, 2), one[12:24].reshape(6, 2), np.ones((6, 2)), np.zeros((2, lm.HIDDEN))
    grads, _, _ = lm.gradients(small, given, goal, real, h)
    for name in small:
        at = tuple(np.argwhere(np.abs(grads[name]) == np.abs(grads[name]).max())[0])
        sides = []
        for by in (1e-2, -1e-2):
            moved = {k: v.copy() for k, v in small.items()}
            moved[name][at] += by
            sides.append(lm.gradients(moved, given, goal, real, h)[2])
        assert math.isclose((sides[0] - sides[1]) / 2e-2, grads[name][at], rel_tol=0.05, abs_tol=1e-4), name


def test_language_model_beats_the_base_on_held_out_documents(spark):
    rows = lm.scored(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_language_model_learns_every_training_document(docs, rows, monkeypatch):
    found, learns = lm.statistics, []
    # As in a corpus of 64 million training tokens.
    monkeypatch.setattr(lm, "statistics", lambda counts: (64_000_000, *found(counts)[1:]))
    monkeypatch.setattr(lm, "trained", lambda rows, tokens, model: learns.append((rows.count(), tokens)) or model)
    lm.scored(docs).count()
    assert learns == [(sum(zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2 for r in rows), 64_000_000)]


def test_language_model_has_more_word_classes_for_more_words():
    assert [lm.word_classes(n) for n in (0, 262_144, 262_145, 4_000_000)] == [32, 32, 64, 128]
    assert lm.symbol_type(512) is np.int16 and lm.symbol_type(1024) is np.int32
    classes = lm.word_classes(4_000_000)
    model = lm.unpacked(lm.packed(lm.fresh(np.arange(3000, 0, -1), np.ones(lm.BANDS * lm.KINDS), classes)), classes)
    every = np.arange(classes * lm.CLASS_WORDS + lm.BANDS * lm.KINDS)
    state = np.full((1, lm.HIDDEN), 0.3, np.float32)
    assert np.isclose(np.exp(lm.log_chances(model, np.repeat(state, len(every), 0), every)).sum(), 1, rtol=1e-3)
    assert np.isfinite(lm.score_documents(model, [every[::-7].astype(np.int16)])[0])


@pytest.mark.parametrize("apart", [0.0, 500.0])
def test_log_softmax_of_rows_near_and_far_apart(apart):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((50, 7)) + apart * np.arange(50)[:, None]
    at, weights = rng.integers(0, 7, 50), rng.random(50)
    logs = x - x.max(1, keepdims=True)
    logs -= np.log(np.exp(logs).sum(1, keepdims=True))
    slope = np.exp(logs) * weights[:, None]
    slope[np.arange(50), at] -= weights
    found, gradient = lm.chosen(x.copy(), at, weights)
    assert np.allclose(found, logs[np.arange(50), at]) and np.allclose(gradient, slope)


def test_language_model_starts_anew_at_each_document_inside_a_window():
    model = lm.fresh(np.ones(lm.FREQUENT), np.ones(lm.BANDS * lm.KINDS))
    empty, first = np.zeros((1, lm.HIDDEN), np.float32), lm.SYMBOLS - 1
    both, last, _ = lm.gru(model, np.array([[first], [5], [9], [first], [7]]), empty)
    alone, own, _ = lm.gru(model, np.array([[first], [7]]), empty)
    assert np.allclose(both[3:], alone) and np.allclose(last, own)
    # The gradient stops there too: the words before do not matter to the second document's loss.
    goal, real = np.array([[5], [9], [3], [7], [2]]), np.array([[0], [0], [0], [1], [1]])
    grads, _, _ = lm.gradients(model, np.array([[first], [5], [9], [first], [7]]), goal, real, empty)
    assert not grads["input"][[5, 9]].any() and grads["input"][[first, 7]].any()


def test_language_model_layouts_agree_with_the_plain_formulas():
    rng = np.random.default_rng(8)
    model = {k: v.astype(np.float64) for k, v in lm.fresh(rng.integers(1, 100, lm.FREQUENT), np.ones(lm.BANDS * lm.KINDS)).items()}
    inputs, goal = rng.integers(0, lm.SYMBOLS - 1, (5, 3)), rng.integers(0, lm.SYMBOLS - 1, (5, 3))
    h = rng.standard_normal((3, lm.HIDDEN))
    states, last, _ = lm.gru(model, inputs, h)
    for t, symbols in enumerate(inputs):
        given, through = np.split(model["input"][symbols], 3, 1), np.split(h @ model["own"], 3, 1)
        z, r = (1 / (1 + np.exp(-given[i] - through[i])) for i in (0, 1))
        n = np.tanh(given[2] + r * through[2])
        h = (1 - z) * n + z * h
        assert np.allclose(states[t], h)
    assert np.allclose(last, h)
    of_class, word = lm.outputs(model)
    flat = lm.with_one(states.reshape(-1, lm.HIDDEN))
    assert np.allclose(flat @ of_class, states.reshape(-1, lm.HIDDEN) @ model["class"] + model["class_bias"])
    order, own, runs, x = lm.in_classes(word, flat, lm.class_of(goal.ravel(), lm.WORD_CLASSES))
    assert [b - a for _, a, b in runs] == np.unique(goal.ravel()[order] // lm.CLASS_WORDS, return_counts=True)[1].tolist()
    for c, a, b in runs:
        assert np.allclose(x[a:b], own[a:b, : lm.HIDDEN] @ model["word"][c] + model["word_bias"][c])
    # More rows than are scored together.
    many = rng.standard_normal((2 * lm.ROWS_AT_ONCE + 1, lm.HIDDEN))
    at = rng.integers(0, lm.SYMBOLS - 1, len(many))
    assert np.allclose(lm.log_chances(model, many, at)[-1:], lm.log_chances(model, many[-1:], at[-1:]))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, source).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert after.columns == docs.columns
        counts.append(after.count())
        docs = after
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0] and counts[-1] > counts[0] // 2
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "personal_data")).collect()}
    assert {r["doc_id"]: r["ids"] for r in docs.collect()} == {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    assert not any(pii.base_spans(t) for t in texts.values())
