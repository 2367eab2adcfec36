"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF.

Four kinds are found. Base spans come from a pattern and a check for each kind. Further spans come
from a tagger that reads characters both ways and scores tags (begin and inside of each kind, or
outside) with a linear chain of learned transitions. It is trained here in numpy, by the gradient
of the chain's likelihood, on labelled spans: shapes found in a bounded sample of documents
(``sample_docs`` by a hash of doc_id), and values written in other notations into the sample's text
by rule, with version numbers, dates and digests between them as what is not personal data.

Texts are read in windows of WINDOW characters that begin every STRIDE, so that any span up to the
difference lies whole in a window. Each window is decoded by itself. Then a text's proposals are
reconciled over all of it: a proposal stands for each kind whose check it passes, and its weight is the mean, over every window that holds it whole,
of its log-odds against being no span; proposals that fail every check, touch a letter or
digit outside or overlap a base span go; and of those left the set without overlaps of the greatest
total weight stays. Every kind holds a decimal digit or an at sign. A window without one can hold no
span whole, so it is not decoded; nothing is lost by that.

Work is done where the text lies: nothing is shuffled, and a text's windows are decoded some at a
time.

Defined results: text null or empty: no spans; doc_id null: handed through; repeated rows: a result
each; equal weights: the earlier, then shorter, then first listed kind; no documents to learn from:
the written values alone train; empty table: no rows; further columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import math
import random
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import pick

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 128, 64
#: Length of the windows that train.
LEARNED = 96
#: Windows that are decoded together; rows and characters of texts with a trigger that are held at once.
TOGETHER, ROWS, CHARS = 512, 4096, 4 << 20
TAGS = 1 + 2 * len(KINDS)  # 0 outside, 1 + 2k begin, 2 + 2k inside
SYMBOLS = 128 + 5          # ASCII, then: other digit, other letter, other space, anything else, padding
PAD = SYMBOLS - 1
NEVER = -1e4

TRIGGER = re.compile(r"[\d@＠]")
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
Span = tuple[int, int, int]  # kind, start, end


def digits(text: str) -> str:
    """The decimal digits of a text, whatever their script."""
    return "".join(str(unicodedata.decimal(c)) for c in text if c.isdecimal())


def luhn(number: str) -> bool:
    doubled = "0246813579"
    return sum(int(doubled[int(c)] if i % 2 else c) for i, c in enumerate(reversed(number))) % 10 == 0


def is_card(text: str) -> bool:
    number = digits(text)
    return 12 <= len(number) <= 19 and luhn(number)


def is_phone(text: str) -> bool:
    return 9 <= len(digits(text)) <= 15


def is_ip(parts: list[str]) -> bool:
    return len(parts) == 4 and all(p and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def shapes(text: str) -> list[Span]:
    """All matches of the patterns, checked or not, leftmost and without overlaps within a kind."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start, host = at, HOST.match(text, at + 1)
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and host:
            found.append((0, start, host.end()))
            end = host.end()
        elif start < at:
            end = max(end, at)  # what is left of this sign is the local part of no later one
        at = text.find("@", at + 1)
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        found += [(kind, *m.span()) for m in pattern.finditer(text)]
    return found


def checked(text: str, span: Span) -> bool:
    kind, value = span[0], text[span[1]:span[2]]
    return kind == 0 or (is_ip(value.split(".")) if kind == 1 else is_card(value) if kind == 2 else is_phone(value))


def base_spans(text: str) -> list[Span]:
    return [s for s in shapes(text) if checked(text, s)]


ANY_EMAIL = re.compile(r"[\w.%+-]+\s?[@＠]\s?[\w-]+(?:\s?\.\s?[\w-]+)+")
ANY_IP = re.compile(r"\d+(?:\s?(?:\.|\[\.\]|\(\.\))\s?\d+){3}")
ANY_NUMBER = re.compile(r"\+?\(?\d(?:[^\w@]{0,3}\d)+")


def plausible(text: str, span: Span) -> bool:
    """Whether a proposal, in whatever notation, passes its kind's check and ends at no letter or digit."""
    kind, start, end = span
    value = text[start:end]
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
        return False
    if kind == 0:
        return bool(ANY_EMAIL.fullmatch(value))
    if kind == 1:
        return bool(ANY_IP.fullmatch(value)) and is_ip([digits(p) for p in re.split(r"\D+", value)])
    return bool(ANY_NUMBER.fullmatch(value)) and (is_card(value) if kind == 2 else is_phone(value))


def readings(text: str, start: int, end: int) -> set[Span]:
    """What a proposal may stand for: each kind whose check it passes. An address with what stands before or
    behind it is cut to the address; a number takes in its plus and the other half of its brackets."""
    address = ANY_EMAIL.search(text, start, end)
    spans = [(0, *address.span())] if address else []
    if start and (text[start - 1] == "+" or text[start - 1] == "(" and text.count(")", start, end) > text.count("(", start, end)):
        start -= 1
    return {s for s in (*spans, *((k, start, end) for k in range(1, len(KINDS)))) if plausible(text, s)}


def symbols(text: str) -> np.ndarray:
    out = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    for i in np.flatnonzero(out >= 128).tolist():
        c = text[i]
        out[i] = 128 if c.isdecimal() else 129 if c.isalpha() else 130 if c.isspace() else 131
    return out


@dataclass(frozen=True)
class Model:
    """For each direction, gates by symbol and by state; tags by both states, tag offsets, transitions (a row for
    the tag before)."""

    by_symbol: np.ndarray
    by_state: np.ndarray
    out: np.ndarray
    offset: np.ndarray
    step: np.ndarray


def allowed() -> np.ndarray:
    """0 where a tag may follow another, NEVER where not: inside only after begin or inside of its kind."""
    mask = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        mask[:, 2 + 2 * k] = NEVER
        mask[1 + 2 * k, 2 + 2 * k] = mask[2 + 2 * k, 2 + 2 * k] = 0
    return mask


ALLOWED = allowed()
FIRST = np.where(np.arange(TAGS) % 2 + (np.arange(TAGS) == 0), 0.0, NEVER)  # no text begins inside


def new_model(hidden: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    by_symbol = rng.normal(0, 0.3, (2, SYMBOLS, 4 * hidden))
    by_symbol[:, :, hidden:2 * hidden] += 1  # remember, to begin with
    return Model(by_symbol, rng.normal(0, hidden ** -0.5, (2, hidden, 4 * hidden)), rng.normal(0, 0.2, (2 * hidden, TAGS)),
                 np.zeros(TAGS), np.zeros((TAGS, TAGS)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def lstm(x: np.ndarray, by_symbol: np.ndarray, by_state: np.ndarray, kept: list | None = None) -> np.ndarray:
    """States (direction, window, place, unit), both directions in step; ``x``: direction, window, place.
    ``kept`` receives what the gradient needs."""
    (_, n, length), hidden = x.shape, by_state.shape[1]
    h, c = np.zeros((2, n, 2 * hidden), by_state.dtype).reshape(2, 2, n, hidden)
    out = np.empty((length, 2, n, hidden), by_state.dtype)
    way = np.arange(2)[:, None]
    for t in range(length):
        z = by_symbol[way, x[:, :, t]] + h @ by_state
        gate = _sigmoid(z[:, :, :3 * hidden])  # in, forget, out
        new = np.tanh(z[:, :, 3 * hidden:])
        before, c = c, gate[:, :, hidden:2 * hidden] * c + gate[:, :, :hidden] * new
        squashed = np.tanh(c)
        if kept is not None:
            kept.append((h, before, gate, new, squashed))
        h = out[t] = gate[:, :, 2 * hidden:] * squashed
    return out.transpose(1, 2, 0, 3)


def lstm_gradient(x: np.ndarray, by_state: np.ndarray, kept: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, n, length, hidden = d_out.shape
    d_z = np.empty((2, length, n, 4 * hidden), by_state.dtype)
    d_h, d_c, d_state = np.zeros((2, n, hidden), by_state.dtype), np.zeros((2, n, hidden), by_state.dtype), np.zeros_like(by_state)
    back = by_state.transpose(0, 2, 1)
    for t in range(length - 1, -1, -1):
        h, before, gate, new, squashed = kept[t]
        i, f, o = gate[:, :, :hidden], gate[:, :, hidden:2 * hidden], gate[:, :, 2 * hidden:]
        d_h = d_h + d_out[:, :, t]
        d_c = d_c + d_h * o * (1 - squashed ** 2)
        d_gate = np.concatenate([d_c * new, d_c * before, d_h * squashed], axis=2) * gate * (1 - gate)
        d_z[:, t] = np.concatenate([d_gate, d_c * i * (1 - new ** 2)], axis=2)
        d_state += h.transpose(0, 2, 1) @ d_z[:, t]
        d_h, d_c = d_z[:, t] @ back, d_c * f
    d_symbol = np.zeros((2, SYMBOLS, 4 * hidden), by_state.dtype)
    for way in range(2):
        flat = x[way].T.ravel()
        order = np.argsort(flat, kind="stable")
        there, begin = np.unique(flat[order], return_index=True)
        d_symbol[way, there] = np.add.reduceat(d_z[way].reshape(-1, 4 * hidden)[order], begin)
    return d_symbol, d_state


def emissions(model: Model, x: np.ndarray, kept: list | None = None) -> np.ndarray:
    """Score of each tag at each place of each window; padding is outside."""
    both, own = np.stack([x, x[:, ::-1]]), None if kept is None else []
    ahead, behind = lstm(both, model.by_symbol, model.by_state, own)
    states = np.concatenate([ahead, behind[:, ::-1]], axis=2)
    if kept is not None:
        kept += [both, own, states]
    out = states @ model.out + model.offset
    return np.where((x == PAD)[:, :, None], np.where(np.arange(TAGS) > 0, NEVER, 0.0).astype(out.dtype), out)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def loss_and_gradient(model: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, Model]:
    """Mean negative log-likelihood of the tags ``y`` and its gradient, by forward and backward sums."""
    kept: list = []
    e = emissions(model, x, kept)
    step, first = (model.step + ALLOWED).astype(e.dtype), FIRST.astype(e.dtype)
    n, length = x.shape
    ahead, behind = np.empty_like(e), np.zeros_like(e)
    ahead[:, 0] = e[:, 0] + first
    for t in range(1, length):
        ahead[:, t] = e[:, t] + _log_sum(ahead[:, t - 1, :, None] + step, 1)
    for t in range(length - 2, -1, -1):
        behind[:, t] = _log_sum(step + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    total = _log_sum(ahead[:, -1], 1)
    rows = np.arange(n)[:, None]
    gold = e[rows, np.arange(length), y].sum(1) + step[y[:, :-1], y[:, 1:]].sum(1) + FIRST[y[:, 0]]
    d_e = np.exp(ahead + behind - total[:, None, None])
    d_e[rows, np.arange(length), y] -= 1
    d_e[x == PAD] = 0
    d_step = np.exp(ahead[:, :-1, :, None] + step + (e[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]).sum((0, 1))
    np.subtract.at(d_step, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    d_e /= n
    both, own, states = kept
    d_states = d_e @ model.out.T
    hidden = model.out.shape[0] // 2
    d_read = lstm_gradient(both, model.by_state, own, np.stack([d_states[:, :, :hidden], d_states[:, ::-1, hidden:]]))
    d_out = states.reshape(-1, 2 * hidden).T @ d_e.reshape(-1, TAGS)
    return float((total - gold).mean()), Model(*d_read, d_out, d_e.sum((0, 1)), d_step / n)


def _arrays(model: Model) -> list[np.ndarray]:
    return [model.by_symbol, model.by_state, model.out, model.offset, model.step]


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, steps: int = 360, batch: int = 48, rate: float = 0.03,
          seed: int = 11) -> Model:
    """Adam over random batches of windows, the rate falling to a tenth."""
    arrays, rng = [a.astype(np.float32) for a in _arrays(new_model(hidden, seed))], np.random.default_rng(seed)
    first, second = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]
    for t in range(1, steps + 1):
        chosen = rng.integers(0, len(x), batch)
        _, gradient = loss_and_gradient(Model(*arrays), x[chosen], y[chosen])
        g = _arrays(gradient)
        scale = min(1.0, 5.0 / (1e-12 + sum(float((a * a).sum()) for a in g) ** 0.5))
        pace = rate * (1 - 0.9 * t / steps)
        for a, d, m, v in zip(arrays, g, first, second):
            d = d * scale
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            a -= pace * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return Model(*arrays)


# --- labelled spans -------------------------------------------------------------------------------

def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random) -> str:
    body = _number(rng, rng.choice((12, 14, 15, 15, 15, 18)))
    return next(body + c for c in "0123456789" if luhn(body + c))


def _grouped(number: str, by: str, size: int = 4) -> str:
    return by.join(number[i:i + size] for i in range(0, len(number), size))


def _name(rng: random.Random, words: list[str]) -> str:
    return "".join(c for c in rng.choice(words) if c.isalnum()) or "x"


def written(rng: random.Random, kind: int, words: list[str]) -> str:
    """A value of a kind in one of many notations."""
    if kind == 0:
        sign = rng.choice(("@", "@", "@", " @ ", "＠", "@ ", " @"))
        dot = rng.choice((".", ".", ".", " . "))
        local = rng.choice((".", "_", "-", "")).join(_name(rng, words) for _ in range(rng.randint(1, 2)))
        local += rng.choice(("", _number(rng, 2), "." + _number(rng, 2)))
        host = [_name(rng, words).lower() + rng.choice(("", _number(rng, 1))) for _ in range(rng.randint(1, 2))]
        return local + sign + dot.join([*host, rng.choice(("com", "org", "net", "de", "es", "example"))])
    if kind == 1:
        by = rng.choice((".", ".", ".", " . ", "[.]", "(.)", " .", ". "))
        return by.join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        return _grouped(_card(rng), rng.choice(("", "", " ", "-", ".", " ", "–", "/", "  ")))
    area, one, two = _number(rng, 3), _number(rng, 3), _number(rng, 4)
    return rng.choice((
        f"+{rng.randint(1, 99)} ({area}) {one}-{two}", f"({area}) {one}-{two}", f"{area}-{one}-{two}", f"{area}.{one}.{two}",
        f"00{rng.randint(1, 99)} {area} {one} {two}", f"{area} {one} {two}", f"+{rng.randint(1, 99)}/{area}/{one}{two}",
        f"+{rng.randint(1, 99)} {area} {one} {two[:2]} {two[2:]}", f"({area}){one}–{two}",
    ))


def decoy(rng: random.Random) -> str:
    """What holds digits or signs and is no personal data."""
    n = lambda a, b: str(rng.randint(a, b))
    return rng.choice((
        f"{n(1, 12)}.{n(0, 40)}", f"v{n(1, 9)}.{n(0, 9)}.{n(0, 9)}", f"{n(1900, 2099)}-{n(10, 12)}-{n(10, 28)}", f"{n(10, 23)}:{n(10, 59)}",
        f"{n(1, 28)}.{n(1, 12)}.{n(1900, 2099)}", _number(rng, rng.randint(1, 8)), f"${n(1, 999)},{n(100, 999)}.{n(10, 99)}", f"{n(1, 100)}%",
        "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((32, 40, 64)))), f"@{rng.choice('abcxyz')}{n(1, 99)}", f"#{n(1, 99999)}",
        f"{n(1, 99)}/{n(1, 99)}", f"p. {n(1, 400)}–{n(401, 900)}", f"ISO {n(1000, 9999)}-{n(1, 9)}", f"{n(1, 9)}e{n(1, 20)}",
    ))


def tags_of(length: int, spans: list[Span], start: int = 0) -> np.ndarray:
    """Tags of a window; a span that begins before it begins with it."""
    y = np.zeros(length, np.int64)
    for kind, a, b in sorted(spans, key=lambda s: (s[1] - s[2], s[1], s[0])):  # the longest first
        a, b = max(a - start, 0), min(b - start, length)
        if a < b and not y[a:b].any():
            y[a:b], y[a] = 2 + 2 * kind, 1 + 2 * kind
    return y


def labelled_windows(texts: list[str], windows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of symbols and tags: a third around shapes found in the texts (as far as there are so many), the
    rest with written values and decoys among the texts' words."""
    rng, found = random.Random(seed), []
    for text in texts:
        spans = shapes(text)
        # the same digits are an address or a phone number first, and a number of a card only where long enough
        spans = [s for s in spans if s[0] != 2 or len(digits(text[s[1]:s[2]])) >= 12]
        found += [(text, spans, s) for s in spans]
    words = [w for text in texts for w in text.split()[:40]] or ["word"]
    x, y = np.full((windows, LEARNED), PAD, np.int64), np.zeros((windows, LEARNED), np.int64)
    for row in range(windows):
        if found and row % 3 == 0:
            text, spans, (_, a, b) = found[rng.randrange(len(found))]
            start = max(0, rng.randint(*sorted((b - LEARNED, a))))  # of a longer span a stretch
            text = text[start:start + LEARNED]
        else:
            start, spans, text = 0, [], ""
            limit = rng.randint(8, LEARNED)
            while len(text) < limit:
                before, draw = len(text), rng.random()
                if draw < 0.18:
                    kind = rng.choice((0, 1, 2, 3, 3))  # telephone numbers have the most notations
                    value = written(rng, kind, words)
                    opened = rng.choice(("", "", "", "(", "<", "\"", ": "))
                    text += opened + value + rng.choice(("", "", "", ".", ",", ")", "!!", ">", "%%%"))
                    spans.append((kind, before + len(opened), before + len(opened) + len(value)))
                else:
                    text += decoy(rng) if draw < 0.28 else rng.choice(words)
                text += rng.choice((" ", " ", " ", " ", "\n", ", "))
            cut = rng.randrange(max(1, len(text) - LEARNED + 1)) if row % 4 == 1 else 0
            text, start = text[cut:cut + LEARNED], cut
        x[row, :len(text)], y[row, :len(text)] = symbols(text), tags_of(len(text), spans, start)
    return x, y


def fit(docs: DataFrame, sample_docs: int = 3000, sample_chars: int = 1 << 22, windows: int = 6000, seed: int = 11) -> Model:
    """Learn from ``sample_docs`` documents at most, of ``sample_chars`` characters together, those with a trigger, by a
    hash of doc_id. Of a longer text the windows around its shapes are the sample."""
    given = pick(docs, doc_id="long", text="string").where("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    held = F.col("text").rlike("[0-9@]")
    share = 1.25 * sample_docs / max(1, given.where(held).count())
    # so few by their hash that what the tasks send does not grow with their number
    few = given.where(F.pmod("h", F.lit(1 << 30)) < min(1 << 30, math.ceil(share * (1 << 30)))).where(held)
    around = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"(?s)(.{0,60}[0-9@].{0,120})"), F.lit(1)), 1, 16), " ")
    chosen = few.select("doc_id", "h", around.alias("text")).orderBy("h", "doc_id", "text").limit(sample_docs)
    texts, left = [], sample_chars
    for r in sorted(chosen.collect(), key=lambda r: (r.h, r.doc_id, r.text)):
        texts.append(r.text[:max(0, left)])
        left -= len(texts[-1])
    return train(*labelled_windows([t for t in texts if t], windows, seed), seed=seed)


# --- decoding -------------------------------------------------------------------------------------

def viterbi(model: Model, e: np.ndarray) -> np.ndarray:
    """The best tags of each window."""
    n, length, _ = e.shape
    step, best, back = model.step + ALLOWED, e[:, 0] + FIRST, np.empty((length, n, TAGS), np.int8)
    for t in range(1, length):
        all_ways = best[:, :, None] + step
        back[t] = all_ways.argmax(1)
        best = np.take_along_axis(all_ways, back[t][:, None, :].astype(np.int64), 1)[:, 0] + e[:, t]
    tags, rows = np.empty((n, length), np.int64), np.arange(n)
    tags[:, -1] = best.argmax(1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = back[t][rows, tags[:, t]]
    return tags


def spans_of(tags: list[int]) -> list[Span]:
    out, at = [], 0
    while at < len(tags):
        if tags[at] % 2:
            end = at + 1
            while end < len(tags) and tags[end] == tags[at] + 1:
                end += 1
            out.append((tags[at] // 2, at, end))
            at = end
        else:
            at += 1
    return out


def log_odds(model: Model, e: np.ndarray, span: Span) -> float:
    """How much better a window's scores like a span than no span in its place."""
    kind, start, end = span
    b, i, s = 1 + 2 * kind, 2 + 2 * kind, model.step
    last, more = (i, s[b, i] + s[i, i] * (end - start - 2)) if end - start > 1 else (b, 0.0)
    as_span = e[start, b] + e[start + 1:end, i].sum() + s[0, b] + more + s[last, 0]
    return float(as_span - e[start:end, 0].sum() - s[0, 0] * (end - start + 1))


def windows_of(text: str) -> list[int]:
    """Starts of the windows that hold a trigger, in order."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    held = {n for m in TRIGGER.finditer(text) for n in range(max(0, (m.start() - WINDOW) // STRIDE + 1), min(last, m.start() // STRIDE) + 1)}
    return [n * STRIDE for n in sorted(held)]


def best_set(weighed: list[tuple[float, Span]]) -> list[Span]:
    """The spans without overlaps of the greatest total weight."""
    weighed = sorted(weighed, key=lambda x: (x[1][2], x[1][1], x[1][0]))
    total, taken = [(0.0, None)], []
    ends = [s[2] for _, s in weighed]
    for i, (weight, span) in enumerate(weighed):
        before = int(np.searchsorted(ends[:i], span[1], side="right"))
        with_it = total[before][0] + weight
        total.append((with_it, before) if with_it > total[i][0] else (total[i][0], None))
    at = len(weighed)
    while at:
        before = total[at][1]
        if before is None:
            at -= 1
        else:
            taken.append(weighed[at - 1][1])
            at = before
    return taken[::-1]


class Tagger:
    """Further spans of many texts, whose windows are decoded together."""

    def __init__(self, model: Model):
        self.model = model

    def proposals(self, windows: Iterator[str]) -> Iterator[tuple[np.ndarray, list[Span]]]:
        """Scores and spans of each window."""
        while part := list(islice(windows, TOGETHER)):
            x = np.full((len(part), WINDOW), PAD, np.int64)
            for row, text in enumerate(part):
                x[row, :len(text)] = symbols(text)
            e = emissions(self.model, x)
            for row, tags in enumerate(viterbi(self.model, e).tolist()):
                yield e[row], spans_of(tags[:len(part[row])])

    def added(self, texts: list[tuple[str, list[Span]]]) -> list[list[Span]]:
        """For each text and its base spans, the spans to add."""
        stream = self.proposals(text[s:s + WINDOW] for text, _ in texts for s in windows_of(text))
        return [self._reconciled(text, base, zip(windows_of(text), stream)) for text, base in texts]

    def _reconciled(self, text: str, base: list[Span], read: Iterator[tuple[int, tuple[np.ndarray, list[Span]]]]) -> list[Span]:
        """Over the whole text; scores are kept for the windows that an open proposal can touch only."""
        weights, recent, waiting = {}, [], set()

        def settle(before: int) -> None:
            for span in [s for s in waiting if s[1] < before]:
                waiting.remove(span)
                odds = [log_odds(self.model, e, (span[0], span[1] - at, span[2] - at)) for at, e in recent
                        if at <= span[1] and span[2] <= min(at + WINDOW, len(text))]
                weights[span] = sum(odds) / len(odds)

        for start, (e, found) in read:
            settle(start)
            recent = [r for r in recent if r[0] + WINDOW > start - WINDOW] + [(start, e)]
            for _, a, b in found:
                if (a > 0 or start == 0) and (b < WINDOW or start + WINDOW >= len(text)) and TRIGGER.search(text, start + a, start + b):
                    waiting |= readings(text, start + a, start + b)
        settle(len(text))
        taken = Covered(base)
        return best_set([(w, s) for s, w in weights.items() if w > 0 and not taken.meets(s[1], s[2])])


class Covered:
    """The stretches that spans cover, merged, for lookups."""

    def __init__(self, spans: list[Span]):
        self.starts, self.ends = [], []
        for _, a, b in sorted(spans, key=lambda s: s[1]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>"


def find(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and its spans (kind, start, end, base), by start, then kind as listed: a row each."""

    def result(tagger: Tagger, ids: list, texts: list[str | None]) -> pa.RecordBatch:
        based = [(t, base_spans(t)) for t in texts if t]
        more = iter(zip(based, tagger.added(based)))
        rows = []
        for text in texts:
            (_, base), added = next(more) if text else ((text, []), [])
            stated = sorted([(a, k, b, True) for k, a, b in base] + [(a, k, b, False) for k, a, b in added])
            rows.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for a, k, b, own in stated])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.list_(SPAN))], names=["doc_id", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = value.as_py()
                ids.append(doc_id)
                texts.append(text if text and TRIGGER.search(text) else None)
                held += len(texts[-1] or "")
                if held >= CHARS or len(ids) >= ROWS:
                    yield result(tagger, ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield result(tagger, ids, texts)

    return pick(docs, doc_id="long", text="string").mapInArrow(run, SCHEMA)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of spans that overlap the first."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def put(held: Column, s: Column) -> Column:
        between = F.substring(text, held["at"].cast("int") + 1, (s["start"] - held["at"]).cast("int"))
        more = F.struct(F.concat(held["done"], between, F.lit("<"), s["kind"], F.lit(">")).alias("done"), s["end"].alias("at"))
        return F.when(s["start"] >= held["at"], more).otherwise(held)

    left = lambda held: F.concat(held["done"], F.substring(text, held["at"].cast("int") + 1, F.length(text)))
    return F.aggregate(spans, start, put, left)
