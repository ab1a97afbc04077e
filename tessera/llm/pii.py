"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The network is trained in numpy on windows with labelled spans. Labels are the base patterns' spans in a bounded sample of
the corpus (about ``TRAIN_DOCS`` documents by hash, ``TRAIN_WINDOWS`` windows), each window also with the spans written in
ways the patterns miss ("name at host dot com", bracketed or dotted telephone numbers, spaced addresses), addresses also
with other names; plain windows stand against them, but for those that may hold such a span themselves. A proposal is a run
of tags on the best path; what it gains over the path with nothing in its place is its score. Every place where
a span of any kind could stand holds a digit or an @ or a written-out at; overlapping windows cover all of these places.
Windows are decoded by Viterbi, and what a window's edge cuts off is decoded again in wider windows until it is whole. All
proposals of a text are reconciled globally: base spans stay, the rest is the set of disjoint valid proposals with the
highest total score. Of a card and a telephone number in the same place the card stays.

Defined results. Null and empty texts hold nothing. Offsets are code points, ends exclusive. Base matches that fail their
test are dropped without a retry. Repeated rows are scanned alike; an empty table gives an empty table, and a corpus
without any base span gives a model that adds nothing. Ties between proposals go to the longer, then the earlier one.
A null doc_id stays null.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keyed, text_blocks

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

# Base patterns, in forms that take one pass over any text.
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|\bat\b|\(at\)|\[at\]")
DIGITS = re.compile(r"[0-9]")
# Windows that may hold a span in a way the base patterns miss: nothing can be learned from them.
UNSURE = re.compile(r"[(\[]at[)\]]|\bat\b.{1,40}\bdot\b|\([0-9]{3}\) ?[0-9]|\[\.\]|[0-9] \. [0-9]|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|[0-9]{4}[.][0-9]{4}")

WINDOW, STEP, REACH = 96, 48, 24
EMBEDDED, HIDDEN = 8, 16
TAGS = 1 + 2 * len(KINDS)
TRAIN_DOCS, TRAIN_WINDOWS, PLAIN_WINDOWS = 20_000, 1500, 1000
STEPS, BATCH, VARIANTS = 500, 128, 5
#: What a proposal's path must gain over the one with nothing in its place. The path is the best one, so it gains something.
LEAST_MARGIN = 0.0


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before an @ and a dotted host behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
        done = host.end() if host else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then start."""
    found: list[Span] = []
    if "@" in text:
        found += [(0, a, b) for a, b in emails(text)]
    if not DIGITS.search(text):
        return found
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m.group())) <= 15]
    return found


def valid(kind: int, text: str) -> bool:
    """Whether a proposed span can be of its kind at all."""
    if not text or text[0].isspace() or text[-1].isspace() or "\n" in text:
        return False
    digits = only_digits(text)
    if kind == 0:
        return bool(re.fullmatch(r"[\w.%+-]+(?: ?(?:\(dot\)|\[dot\]| dot ) ?[\w.%+-]+)* ?(?:@|\(at\)|\[at\]| at ) ?[\w-]+(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[\w-]+)+", text))
    if kind == 1:
        parts = DIGITS.sub("0", text)
        numbers = re.findall(r"[0-9]+", text)
        return len(numbers) == 4 and not re.search(r"[^0.\[\] ]", parts) and all(len(n) <= 3 and int(n) <= 255 for n in numbers) and "." in text
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 .-]", text)
    return 9 <= len(digits) <= 15 and len(re.findall(r"[0-9]+", text)) > 1 and not re.search(r"[^0-9+(). /-]", text)


# ---- the network


def codes(text: str) -> np.ndarray:
    """ASCII as it is; other letters, digits, white space and the rest as one class each."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = np.minimum(points, 128).astype(np.int64)
    for i in np.flatnonzero(points >= 128):
        c = text[i]
        out[i] = 128 if c.isalpha() else 129 if c.isdigit() else 130 if c.isspace() else 131
    return out


SYMBOLS = 133  # the last one pads


def fresh(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    near = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    model = {"embed": near(SYMBOLS, EMBEDDED), "out": near(2 * HIDDEN, TAGS), "out_bias": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}
    for way in ("f", "b"):
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
        model |= {f"in_{way}": near(EMBEDDED, 4 * HIDDEN), f"own_{way}": near(HIDDEN, 4 * HIDDEN), f"bias_{way}": bias}
    model["out_bias"][0] = 1
    return model


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(model: dict, x: np.ndarray, way: str, keep: bool):
    """States (T, B, H) of a pass over embedded characters (T, B, E); with ``keep`` also what the gradient needs."""
    steps, width, _ = x.shape
    pre = x.reshape(-1, EMBEDDED) @ model[f"in_{way}"] + model[f"bias_{way}"]
    pre = pre.reshape(steps, width, 4 * HIDDEN)
    h = np.zeros((width, HIDDEN), np.float32)
    c = np.zeros((width, HIDDEN), np.float32)
    states, kept = np.empty((steps, width, HIDDEN), np.float32), []
    for t in range(steps):
        z = pre[t] + h @ model[f"own_{way}"]
        gates = sigmoid(z[:, : 3 * HIDDEN])
        i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
        before, c = (h, c), f * c + i * g
        tanh_c = np.tanh(c)
        h = o * tanh_c
        states[t] = h
        if keep:
            kept.append((i, f, o, g, before, tanh_c))
    return states, kept


def lstm_gradient(model: dict, x: np.ndarray, way: str, kept: list, d_states: np.ndarray, grads: dict) -> np.ndarray:
    d_x = np.empty_like(x)
    d_h = np.zeros_like(d_states[0])
    d_c = np.zeros_like(d_h)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, (h_before, c_before), tanh_c = kept[t]
        d_h = d_h + d_states[t]
        d_c = d_c + d_h * o * (1 - tanh_c**2)
        d_z = np.concatenate([d_c * g * i * (1 - i), d_c * c_before * f * (1 - f), d_h * tanh_c * o * (1 - o), d_c * i * (1 - g**2)], 1)
        grads[f"in_{way}"] += x[t].T @ d_z
        grads[f"own_{way}"] += h_before.T @ d_z
        grads[f"bias_{way}"] += d_z.sum(0)
        d_x[t] = d_z @ model[f"in_{way}"].T
        d_h, d_c = d_z @ model[f"own_{way}"].T, d_c * f
    return d_x


def emissions(model: dict, chars: np.ndarray, keep: bool = False):
    """Tag scores (T, B, K) of windows (B, T)."""
    x = model["embed"][chars.T]
    ahead, kept_f = lstm(model, x, "f", keep)
    back, kept_b = lstm(model, x[::-1], "b", keep)
    both = np.concatenate([ahead, back[::-1]], 2)
    return both @ model["out"] + model["out_bias"], (x, both, kept_f, kept_b)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def loss_and_gradient(model: dict, chars: np.ndarray, tags: np.ndarray, real: np.ndarray) -> tuple[float, dict]:
    """CRF negative log-likelihood per character, padding left out (``real``), by forward-backward."""
    scores, (x, both, kept_f, kept_b) = emissions(model, chars, True)
    steps, width, _ = scores.shape
    scores = np.where(real.T[:, :, None], scores, np.where(np.arange(TAGS) == 0, 0, -1e4)).astype(np.float32)
    move = model["move"]
    alpha = np.empty_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        alpha[t] = log_sum(alpha[t - 1][:, :, None] + move, 1) + scores[t]
    total = log_sum(alpha[-1], 1)
    beta = np.zeros((width, TAGS), np.float32)
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    d_scores = np.empty_like(scores)
    rows = np.arange(width)
    gold = scores[0][rows, tags[:, 0]]
    for t in range(1, steps):
        gold = gold + move[tags[:, t - 1], tags[:, t]] + scores[t][rows, tags[:, t]]
    n = float(real.sum())
    for t in range(steps - 1, -1, -1):
        d_scores[t] = np.exp(alpha[t] + beta - total[:, None])
        d_scores[t][rows, tags[:, t]] -= 1
        if t:
            joint = alpha[t - 1][:, :, None] + move + (scores[t] + beta)[:, None, :] - total[:, None, None]
            grads["move"] += np.exp(joint).sum(0)
            np.add.at(grads["move"], (tags[:, t - 1], tags[:, t]), -1)
            beta = log_sum(move[None] + (scores[t] + beta)[:, None, :], 2)
    d_scores *= real.T[:, :, None] / n
    grads["move"] /= n
    flat = d_scores.reshape(-1, TAGS)
    grads["out"] += both.reshape(-1, 2 * HIDDEN).T @ flat
    grads["out_bias"] += flat.sum(0)
    d_both = d_scores @ model["out"].T
    d_x = lstm_gradient(model, x, "f", kept_f, d_both[:, :, :HIDDEN], grads)
    d_x += lstm_gradient(model, x[::-1], "b", kept_b, d_both[::-1, :, HIDDEN:], grads)[::-1]
    np.add.at(grads["embed"], chars.T.ravel(), d_x.reshape(-1, EMBEDDED))
    return float((total - gold).sum()) / n, grads


def trained(windows: list[tuple[str, list[Span]]], steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam over shuffled batches: about ``steps`` of them, so that few windows are seen as often as many."""
    model = fresh(seed)
    if not any(spans for _, spans in windows):
        model["out_bias"][0] = 1e4  # nothing to learn from: nothing is ever proposed
        return model
    chars, tags, real = (np.zeros((len(windows), WINDOW), t) for t in (np.int64, np.int64, bool))
    chars += SYMBOLS - 1
    for row, (text, spans) in enumerate(windows):
        n = min(len(text), WINDOW)
        chars[row, :n] = codes(text)[:n]
        real[row, :n] = True
        for kind, start, end in spans:
            tags[row, start:end] = 2 + 2 * kind
            if start < WINDOW:
                tags[row, start] = 1 + 2 * kind
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    for _ in range(-(-steps // -(-len(windows) // BATCH))):
        order = rng.permutation(len(windows))
        for first in range(0, len(order), BATCH):
            batch = order[first : first + BATCH]
            _, grads = loss_and_gradient(model, chars[batch], tags[batch], real[batch])
            step += 1
            for k, g in grads.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                model[k] = (model[k] - 0.02 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def decoded(model: dict, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """Spans (kind, start, end, margin) of each window by Viterbi; the margin is over the path with nothing in the span's place."""
    sizes = [len(t) for t in texts]
    width = max(WINDOW, *sizes, 0)
    chars = np.full((len(texts), width), SYMBOLS - 1, np.int64)
    for row, text in enumerate(texts):
        chars[row, : len(text)] = codes(text)
    scores, _ = emissions(model, chars)
    move = model["move"]
    best, back = scores[0], np.empty(scores.shape, np.int8)
    for t in range(1, width):
        through = best[:, :, None] + move
        back[t] = through.argmax(1)
        best = through.max(1) + scores[t]
    # Padding follows the text, so the path may be read from any end; it is cut to the text.
    path = np.empty((width, len(texts)), np.int8)
    path[-1] = best.argmax(1)
    rows = np.arange(len(texts))
    for t in range(width - 1, 0, -1):
        path[t - 1] = back[t][rows, path[t]]
    # What the path gains over the same path with nothing in a span's place: tags' scores and moves, as running sums.
    tag = path.astype(np.int64)
    gain = np.zeros((width + 1, len(texts)))
    gain[1:] = np.cumsum(np.take_along_axis(scores, tag[:, :, None], 2)[:, :, 0] - scores[:, :, 0], 0)
    moves = np.zeros((width, len(texts)))
    moves[1:] = np.cumsum(move[tag[:-1], tag[1:]], 0)

    def margin(row: int, a: int, b: int) -> float:
        with_span = gain[b, row] - gain[a, row] + moves[min(b, width - 1), row] - moves[max(a - 1, 0), row]
        nothing = [*tag[max(a - 1, 0) : a, row], *[0] * (b - a), *tag[b : b + 1, row]]
        return float(with_span - sum(move[x, y] for x, y in zip(nothing, nothing[1:], strict=False)))

    out = []
    for row, size in enumerate(sizes):
        tags, found, t = path[:size, row], [], 0
        while t < size:
            if tags[t]:
                kind, start = (tags[t] - 1) // 2, t
                t += 1
                while t < size and tags[t] == 2 + 2 * kind:
                    t += 1
                found.append((int(kind), start, t, margin(row, start, t)))
            else:
                t += 1
        out.append(found)
    return out


# ---- over documents


def window_starts(text: str) -> list[int]:
    """Overlapping windows over every place near a digit, an @ or a written-out at."""
    starts: list[int] = []
    reached = -1  # windows so far cover the text up to here
    for m in TRIGGER.finditer(text):
        if m.end() + REACH <= reached:
            continue
        start = max(0, m.start() - REACH) if m.start() - REACH > reached - (WINDOW - STEP) or not starts else starts[-1] + STEP
        starts.append(start)
        reached = start + WINDOW
        while reached < min(len(text), m.end() + REACH):
            starts.append(starts[-1] + STEP)
            reached = starts[-1] + WINDOW
    return starts


def possible(kind: int, piece: str) -> bool:
    """Whether a cut span can still become one of its kind."""
    if kind == 0:
        return not re.search(r"[^\w.%+@()\[\] -]", piece)
    return len(only_digits(piece)) <= (12, 19, 15)[kind - 1] and not re.search((r"[^0-9.\[\] ]", r"[^0-9 .-]", r"[^0-9+(). /-]")[kind - 1], piece)


def inside(text: str, starts: list[int], a: int, b: int) -> bool:
    """Whether a usual window holds a cut span with what follows on both sides, and so decides on it."""
    at = (bisect_left if a > line_start(text, a) else bisect_right)(starts, a) - 1
    return at >= 0 and (starts[at] + WINDOW > b or b == line_end(text, b) <= starts[at] + WINDOW)


def line_start(text: str, at: int) -> int:
    """No span goes beyond its line."""
    return text.rfind("\n", 0, at) + 1


def line_end(text: str, at: int) -> int:
    found = text.find("\n", at)
    return len(text) if found < 0 else found


def reconciled(base: list[Span], proposals: dict[Span, float]) -> list[Span]:
    """Base spans, and the disjoint proposals with the highest total score that touch none of them."""
    taken = sorted((a, b) for _, a, b in base)
    ends = np.array([b for _, b in taken]) if taken else np.zeros(0)
    free = []
    for (kind, a, b), score in proposals.items():
        at = int(np.searchsorted(ends, a, "right"))
        if at == len(taken) or taken[at][0] >= b:
            free.append((b, -(b - a), a, kind, score))
    free.sort()
    totals, picks, stops = [0.0], [None], [0]
    for b, _, a, kind, score in free:
        before = int(np.searchsorted(stops, a, "right")) - 1
        with_it = totals[before] + score
        if with_it > totals[-1]:
            totals.append(with_it)
            picks.append((before, (kind, a, b)))
        else:
            totals.append(totals[-1])
            picks.append((len(totals) - 2, None))
        stops.append(b)
    added, at = [], len(picks) - 1
    while at > 0:
        at, span = picks[at]
        if span:
            added.append(span)
    return sorted([*base, *added])


def all_spans(model: dict, texts: list[str], at_once: int = 512) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    usual = [window_starts(t) for t in texts]
    windows = [(row, start, min(start + WINDOW, len(t))) for row, t in enumerate(texts) for start in usual[row]]
    proposals: list[dict[Span, float]] = [{} for _ in texts]
    margin_by = STEP
    while windows:
        wider: list[tuple[int, int, int]] = []
        # Windows of like width go together, about ``at_once`` usual ones at a time.
        windows.sort(key=lambda w: w[2] - w[1])
        first = 0
        while first < len(windows):
            last = first + 1
            while last < len(windows) and (last + 1 - first) * max(WINDOW, windows[last][2] - windows[last][1]) <= at_once * WINDOW:
                last += 1
            part = windows[first:last]
            for (row, start, end), found in zip(part, decoded(model, [texts[row][start:end] for row, start, end in part]), strict=True):
                text = texts[row]
                for kind, a, b, margin in found:
                    a, b = start + a, start + b
                    left, right = a == start > line_start(text, a), b == end < line_end(text, b)
                    if left or right:
                        if possible(kind, text[a:b]) and not inside(text, usual[row], a, b):
                            wider.append((row, max(line_start(text, a), a - margin_by), min(line_end(text, b), b + margin_by)))
                    elif margin >= LEAST_MARGIN and valid(kind, text[a:b]):
                        span = (kind, a, b)
                        proposals[row][span] = proposals[row].get(span, 0.0) + margin * (b - a)
            first = last
        # Windows that meet become one and the margin doubles, so a long run costs its length a few times.
        windows = []
        for row, start, end in sorted(wider):
            if windows and windows[-1][0] == row and start <= windows[-1][2]:
                windows[-1] = (row, windows[-1][1], max(end, windows[-1][2]))
            else:
                windows.append((row, start, end))
        margin_by *= 2
    for found in proposals:
        for _, a, b in [s for s in found if s[0] == 3 and (2, *s[1:]) in found]:
            del found[3, a, b]
    return [(b, reconciled(b, p) if p else sorted(b)) for b, p in zip(base, proposals, strict=True)]


def renamed(text: str, turn: int) -> str:
    """An address made of words of the text, so that the network learns how one is written and not one host's names."""
    words = re.findall(r"[A-Za-z]{2,9}", text) or ["some", "name", "host"]
    pick = [words[(turn * 7 + i * 3) % len(words)] for i in range(4)]
    local = pick[0] if turn % 4 == 1 else f"{pick[0]}.{pick[1]}"
    return f"{local}@{pick[2]}.{('com', 'org', 'net', 'co.uk', 'de')[turn % 5]}"


def varied(text: str, spans: list[Span], turn: int) -> tuple[str, list[Span]]:
    """The window with its spans written in ways that the base patterns miss."""
    out, labels, done = [], [], 0
    size = 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < done:
            continue
        body = text[a:b]
        if kind == 0:
            if turn % 3:
                body = renamed(text[:a] + text[b:], turn)
            body = [body.replace("@", " at ").replace(".", " dot "), body.replace("@", " (at) "), body.replace("@", "[at]").replace(".", "[dot]")][turn // 2 % 3]
        elif kind == 1:
            body = [body.replace(".", "[.]"), body.replace(".", " . ")][turn % 2]
        elif kind == 2:
            digits = only_digits(body)
            body = ".".join(digits[i : i + 4] for i in range(0, len(digits), 4)) if turn % 2 else body
        elif kind == 3:
            digits = only_digits(body)
            body = [f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", "-".join((digits[-10:-7], digits[-7:-4], digits[-4:])), ".".join((digits[-10:-7], digits[-7:-4], digits[-4:]))][turn % 3]
        lead = text[done:a]
        out += [lead, body]
        labels.append((kind, size + len(lead), size + len(lead) + len(body)))
        size += len(lead) + len(body)
        done = b
    return "".join([*out, text[done:]]), labels


def training_windows(docs: DataFrame) -> list[tuple[str, list[Span]]]:
    """Windows with base spans from a share of the documents by hash, each also with its spans written in other ways, and plain ones."""
    rows = docs.count()
    share = max(1, rows // TRAIN_DOCS)

    def window(text: str, at: int) -> str:
        # The place of a span in its window must teach nothing, so the lead varies, by the text around it.
        start = max(0, at - zlib.crc32(text[at : at + WINDOW].encode("utf-8", "replace")) % (WINDOW // 2))
        return text[start : start + WINDOW]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            found: list[tuple[str, bool]] = []
            for text in block.column("text").to_pylist():
                spans = base_spans(text)
                found += [(window(text, a), True) for _, a, b in spans[:2] if b - a <= WINDOW // 2]
                plain = TRIGGER.search(text)
                if not spans and plain and not UNSURE.search(piece := window(text, plain.start())):
                    found.append((piece, False))
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), pa.array([f for _, f in found], pa.bool_())], names=["window", "labelled"])

    sample = keyed(docs).filter(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(share)) == 0).select("text")
    cuts = sample.mapInArrow(cut, "window string, labelled boolean").distinct()

    def smallest(labelled: bool, most: int) -> list[str]:
        # Bounded: the windows with the smallest hashes.
        kept = cuts.filter(F.col("labelled") == labelled).orderBy(F.xxhash64("window"), "window").limit(most)
        return [r["window"] for r in kept.collect()]

    out = []
    for turn, text in enumerate(smallest(True, TRAIN_WINDOWS)):
        spans = base_spans(text)
        out += [(text, spans), *[varied(text, spans, turn + i) for i in range(VARIANTS)]]
    out += [(text, base_spans(text)) for text in smallest(False, PLAIN_WINDOWS)]
    return [(t[:WINDOW], [s for s in spans if s[2] <= WINDOW]) for t, spans in out]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def scanned(docs: DataFrame, model: dict[str, np.ndarray] | None = None) -> DataFrame:
    """doc_id, base counts and digest, and all spans; without a model one is trained on ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model or trained(training_windows(docs)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            found = all_spans(shared.value, block.column("text").to_pylist())
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            digest = [hashlib.sha256(listed(sorted(base)).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *counts, pa.array(digest, pa.string()), pa.array([listed(every) for _, every in found], pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    counted = ", ".join(f"n_{k} long" for k in KINDS)
    return keyed(docs).mapInArrow(rows, f"doc_id long, {counted}, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap go as one."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def masked_documents(docs: DataFrame) -> DataFrame:
    """All rows and columns, personal data in ``text`` masked; a null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(training_windows(docs)))

    @F.pandas_udf("string")
    def mask(texts):
        known = texts.fillna("").tolist()
        out = [masked(t, every) for t, (_, every) in zip(known, all_spans(shared.value, known), strict=True)]
        return type(texts)(out, index=texts.index).where(texts.notna(), None)

    return docs.withColumn("text", mask(F.col("text").cast("string")))
