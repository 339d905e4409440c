"""Personal data by a character-level bidirectional LSTM with CRF transitions, beside the base patterns.

The net is trained in numpy: its labelled spans are the base patterns' matches in a bounded sample of documents. It sees
windows of 64 characters that overlap by half. Each window is decoded by Viterbi under the rules of begin and inside tags,
spans cut at a window's edge are joined with what the next window says, and over the whole text the set of spans with the
most weight that do not overlap is taken. The net adds spans that the patterns' fixed forms miss, such as a number that
runs into its neighbour; it must hold its kind's checks, and a span that overlaps a base span is dropped, so base spans
stay as they are.

Every kind has a digit or an ``@``, so a window without either is all outside by definition and is not put through the net.

Defined results: a null text counts as empty; an empty text has no spans; a text of any length is worked through in
pieces of about a million characters; repeated rows give equal rows; a null id keeps its row; an empty table, or one
without any base match, trains no net and adds nothing; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from beaconry.llm import pii_rules
from beaconry.llm.common import documents, sampled_texts
from beaconry.llm.pii_rules import KINDS, Span, base_spans, joined, luhn

WINDOW, STRIDE = 64, 32
#: Characters told apart: those of ASCII, line ends, other letters, other marks, and the padding.
_ALPHABET = 131
_TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
_BARRED = np.float32(-1e4)


def character_ids(points: np.ndarray) -> np.ndarray:
    """Class of each code point: ASCII as it is, then other letters and other marks; 0 is the padding."""
    return np.where(points < 128, points + 1, np.where(points < 0x2000, 129, 130)).astype(np.int16)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Penalties of transitions and starts: an inside tag only follows its kind's begin or inside tag."""
    moves, starts = np.zeros((_TAGS, _TAGS), np.float32), np.zeros(_TAGS, np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        moves[:, inside] = _BARRED
        moves[[inside - 1, inside], inside] = 0
    return moves, starts


@dataclass
class Net:
    """Weights: gates of both directions by character, recurrence and bias; emissions; CRF transitions."""

    table: list[np.ndarray]
    recur: list[np.ndarray]
    bias: list[np.ndarray]
    emit: np.ndarray
    emit_bias: np.ndarray
    moves: np.ndarray
    starts: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [*self.table, *self.recur, *self.bias, self.emit, self.emit_bias, self.moves, self.starts]

    def states(self, ids: np.ndarray, keep: bool = False):
        """Hidden states of both directions, (windows, length, 2 * hidden); with ``keep`` what the backward pass needs."""
        n, length = ids.shape
        hidden = self.recur[0].shape[0]
        out = np.empty((n, length, 2 * hidden), np.float32)
        kept = ([], [])
        for d in (0, 1):
            h = c = np.zeros((n, hidden), np.float32)
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                z = self.table[d][ids[:, t]] + h @ self.recur[d] + self.bias[d]
                gates, fresh = _sigmoid(z[:, :3 * hidden]), np.tanh(z[:, 3 * hidden:])
                new = gates[:, hidden:2 * hidden] * c + gates[:, :hidden] * fresh
                bent = np.tanh(new)
                if keep:
                    kept[d].append((t, h, c, gates, fresh, bent))
                c, h = new, gates[:, 2 * hidden:] * bent
                out[:, t, d * hidden:(d + 1) * hidden] = h
        return out, kept

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi tags of each window, and how far each tag's emission lies over that of outside."""
        barred, first = _allowed()
        e = self.states(ids)[0] @ self.emit + self.emit_bias
        n, length, _ = e.shape
        moves = self.moves + barred
        best = self.starts + first + e[:, 0]
        backs = np.empty((length, n, _TAGS), np.int8)
        for t in range(1, length):
            total = best[:, :, None] + moves
            backs[t] = total.argmax(1)
            best = np.take_along_axis(total, backs[t][:, None, :].astype(np.int64), 1)[:, 0] + e[:, t]
        tags = np.empty((n, length), np.int8)
        tags[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = backs[t][np.arange(n), tags[:, t]]
        return tags, np.take_along_axis(e, tags[:, :, None].astype(np.int64), 2)[:, :, 0] - e[:, :, 0]


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def gradients(net: Net, ids: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the tags and its gradient for each part of the net."""
    n, length = ids.shape
    hidden = net.recur[0].shape[0]
    barred, first = _allowed()
    moves = net.moves + barred
    states, kept = net.states(ids, keep=True)
    e = states @ net.emit + net.emit_bias
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = net.starts + first + e[:, 0]
    for t in range(1, length):
        alpha[:, t] = _logsumexp(alpha[:, t - 1, :, None] + moves, 1) + e[:, t]
    for t in range(length - 2, -1, -1):
        beta[:, t] = _logsumexp(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    norm = _logsumexp(alpha[:, -1], 1)
    rows = np.arange(n)
    gold = net.starts[tags[:, 0]] + np.take_along_axis(e, tags[:, :, None], 2).sum((1, 2)) + moves[tags[:, :-1], tags[:, 1:]].sum(1)
    de = np.exp(alpha + beta - norm[:, None, None])
    dstart = de[:, 0].sum(0)
    np.add.at(dstart, tags[:, 0], -1)
    dmoves = np.zeros_like(net.moves)
    for t in range(1, length):
        dmoves += np.exp(alpha[:, t - 1, :, None] + moves + (e[:, t] + beta[:, t] - norm[:, None])[:, None, :]).sum(0)
    np.add.at(dmoves, (tags[:, :-1], tags[:, 1:]), -1)
    de[rows[:, None], np.arange(length), tags] -= 1
    demit = states.reshape(-1, 2 * hidden).T @ de.reshape(-1, _TAGS)
    dstates = de @ net.emit.T
    dtable, drecur, dbias = [], [], []
    for d in (0, 1):
        table, recur, bias = np.zeros_like(net.table[d]), np.zeros_like(net.recur[d]), np.zeros_like(net.bias[d])
        dh = dc = np.zeros((n, hidden), np.float32)
        for t, h, c, gates, fresh, bent in reversed(kept[d]):
            dh = dh + dstates[:, t, d * hidden:(d + 1) * hidden]
            i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
            dc = dc + dh * o * (1 - bent * bent)
            dz = np.concatenate([dc * fresh * i * (1 - i), dc * c * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - fresh * fresh)], 1)
            np.add.at(table, ids[:, t], dz)
            recur += h.T @ dz
            bias += dz.sum(0)
            dh, dc = dz @ net.recur[d].T, dc * f
        dtable.append(table), drecur.append(recur), dbias.append(bias)
    grads = [*dtable, *drecur, *dbias, demit, de.sum((0, 1)), dmoves, dstart]
    return float((norm - gold).mean()), [g / n for g in grads]


def fit(ids: np.ndarray, tags: np.ndarray, hidden: int = 16, steps: int = 240, batch: int = 96, rate: float = 0.02, seed: int = 1) -> Net:
    """Adam on random batches of labelled windows."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
    net = Net([draw(_ALPHABET, 4 * hidden) for _ in (0, 1)], [draw(hidden, 4 * hidden) for _ in (0, 1)],
              [np.repeat(np.float32([0, 1, 0, 0]), hidden) for _ in (0, 1)], draw(2 * hidden, _TAGS),
              np.zeros(_TAGS, np.float32), np.zeros((_TAGS, _TAGS), np.float32), np.zeros(_TAGS, np.float32))
    parts = net.parts()
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        at = rng.integers(0, len(ids), batch)
        _, grads = gradients(net, ids[at], tags[at])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(parts, grads, m, v):
            g = g * min(1.0, 5.0 / (size + 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (pace * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def windows_of(text: str, rng: np.random.Generator, around: int = 2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labelled windows of one text: some around each base span, one at any other place with a digit, one anywhere.

    Windows in which a pattern matched but failed its check are left out: their form and their label contradict.
    """
    spans = base_spans(text)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ids = np.concatenate([np.zeros(WINDOW, np.int16), character_ids(points), np.zeros(WINDOW, np.int16)])
    tags = np.zeros(len(ids), np.int64)
    doubtful = np.zeros(len(ids), bool)
    for pattern in (pii_rules._IP, pii_rules._CARD, pii_rules._PHONE):
        for m in pattern.finditer(text):
            doubtful[WINDOW + m.start():WINDOW + m.end()] |= sum(c.isdigit() for c in m.group()) > 6
    for kind, a, b in spans:
        tag = 1 + 2 * KINDS.index(kind)
        tags[WINDOW + a:WINDOW + b] = tag + 1
        tags[WINDOW + a] = tag
    doubtful &= tags == 0
    places = [int(rng.integers(a - WINDOW + 4, b - 3)) for _, a, b in spans for _ in range(around)]
    digits = np.flatnonzero((points >= 48) & (points <= 57))
    if len(digits):
        places.append(int(digits[rng.integers(len(digits))]) - int(rng.integers(WINDOW)))
    if len(points):
        places.append(int(rng.integers(len(points))))
    for p in places:
        p = min(max(p, -WINDOW), len(points)) + WINDOW
        if not doubtful[p:p + WINDOW].any():
            own = tags[p:p + WINDOW].copy()
            if own[0] and own[0] % 2 == 0:  # a span cut at the window's start begins there
                own[0] -= 1
            yield ids[p:p + WINDOW], own


def train(docs: DataFrame, max_rows: int = 3000, max_bytes: int = 20_000) -> Net | None:
    """Fit on at most ``max_rows`` different texts with a digit or ``@``, of at most ``max_bytes`` bytes, by a hash of the text."""
    rng = np.random.default_rng(7)
    found = [w for t in sampled_texts(docs, "[0-9@]", max_rows, max_bytes) for w in windows_of(t, rng)]
    if not any(t.any() for _, t in found):
        return None
    return fit(np.stack([i for i, _ in found]), np.stack([t for _, t in found]))


def holds(kind: str, text: str) -> bool:
    """The checks of a kind, for a span the net proposes."""
    digits = "".join(c for c in text if c in "0123456789")
    if kind == "email":
        return [(a, b) for _, a, b in pii_rules._emails(text)] == [(0, len(text))]
    if kind == "ip":
        return [(a, b) for _, a, b in pii_rules._ips(text)] == [(0, len(text))]
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits) and text[0].isdigit() and text[-1].isdigit() and set(text) <= set("0123456789 -")
    return text[0] == "+" and 10 <= len(digits) <= 15 and text[-1].isdigit() and set(text) <= set("+0123456789 ().-")


def window_starts(points: np.ndarray) -> np.ndarray:
    """Starts of the windows with a digit or ``@``."""
    seeds = np.flatnonzero(((points >= 48) & (points <= 57)) | (points == 64)) // STRIDE
    return np.unique(np.concatenate([seeds, np.maximum(seeds - 1, 0)])) * STRIDE


def spans_in(tags: np.ndarray, margin: np.ndarray, start: int, size: int) -> Iterator[list]:
    """``[kind, start, end, weight, open at start, open at end]`` of each span of a window."""
    begins = np.flatnonzero(tags % 2 == 1)
    for a in begins.tolist():
        b = a + 1
        while b < WINDOW and tags[b] == tags[a] + 1:
            b += 1
        if start + a < size:
            yield [int(tags[a] // 2), start + a, min(start + b, size), float(margin[a:b].sum()), a == 0 and start > 0, b == WINDOW and start + b < size]


def reconcile(found: list[list]) -> list[Span]:
    """Spans of all windows of a text, joined where a window cut them, then the heaviest set that does not overlap."""
    joined_up: list[list] = []
    for s in sorted(found, key=lambda s: (s[0], s[1], -s[2])):
        last = joined_up[-1] if joined_up else None
        if last and last[0] == s[0] and s[1] <= last[2] and (last[5] or s[4] or last[1:3] == s[1:3]):
            if s[2] >= last[2]:
                last[5] = s[5]
            last[2], last[3] = max(last[2], s[2]), max(last[3], s[3])
        else:
            joined_up.append(s)
    by_end = sorted(joined_up, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in by_end]
    best: list[tuple[float, int, int]] = [(0.0, 0, -1)]  # weight so far, back pointer, span taken
    for i, s in enumerate(by_end):
        before = int(np.searchsorted(ends[:i], s[1], side="right"))
        take = best[before][0] + s[3]
        best.append((take, before, i) if take > best[i][0] else (best[i][0], i, -1))
    out, at = [], len(by_end)
    while at:
        _, back, taken = best[at]
        if taken >= 0:
            s = by_end[taken]
            out.append((KINDS[s[0]], s[1], s[2]))
        at = back
    return out[::-1]


def net_spans(net: Net, texts: list[str], block: int = 2048, piece: int = 1 << 20) -> list[list[Span]]:
    """The net's spans of each text, windows of all texts together in blocks."""
    found: list[list[list]] = [[] for _ in texts]
    queue: list[tuple[int, int, int]] = []
    held: list[np.ndarray] = []

    def flush() -> None:
        tags, margin = net.decode(np.stack(held))
        for (t, start, size), own, m in zip(queue, tags, margin):
            if own.any():
                found[t].extend(spans_in(own, m, start, size))
        queue.clear(), held.clear()

    for t, text in enumerate(texts):
        for at in range(0, len(text), piece):
            points = np.frombuffer(text[at:at + piece + STRIDE].encode("utf-32-le", "surrogatepass"), np.uint32)
            starts = window_starts(points)
            starts = starts[starts < piece]
            if not len(starts):
                continue
            ids = np.concatenate([character_ids(points), np.zeros(WINDOW, np.int16)])
            for s in starts.tolist():
                queue.append((t, at + s, len(text)))
                held.append(ids[s:s + WINDOW])
                if len(held) == block:
                    flush()
    if held:
        flush()
    return [reconcile(f) if f else [] for f in found]


def all_spans(net: Net | None, texts: list[str]) -> Iterator[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    proposed = net_spans(net, texts) if net else [[] for _ in texts]
    for text, own, more in zip(texts, base, proposed):
        extra = [s for s in more if not any(a < s[2] and s[1] < b for _, a, b in own) and holds(s[0], text[s[1]:s[2]])]
        yield own, sorted(own + extra, key=pii_rules.order)


def _slices(b: pa.RecordBatch, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for at in range(0, b.num_rows, rows):
        part = b.slice(at, rows)
        yield part, [t or "" for t in part.column(0).to_pylist()]


def find(docs: DataFrame, net: Net | None) -> DataFrame:
    """``doc_id``, counts of base spans, the hash of their list and the list of all spans; one pass, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in _slices(b):
                both = list(all_spans(net, texts))
                counts = [pa.array([sum(s[0] == k for s in own) for own, _ in both], pa.int64()) for k in KINDS]
                digest = [hashlib.sha256(joined(own).encode()).hexdigest() for own, _ in both]
                yield pa.RecordBatch.from_arrays([part.column(1), *counts, pa.array(digest), pa.array([joined(a) for _, a in both])],
                                                 ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    out = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return documents(docs).select("text", "doc_id").mapInArrow(run, out)


def personal_data(docs: DataFrame) -> DataFrame:
    """Train on a bounded sample, then find the spans of every document."""
    return find(docs, train(docs))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the union is replaced once."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, a, b = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < b:
            b = max(b, spans[i][2])
            i += 1
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, net: Net | None = None) -> DataFrame:
    """The documents with personal data masked; ``n_chars``, where there is one, follows the text. Null texts stay null."""
    net = net or train(docs)
    names = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in _slices(b):
                new = [masked(t, every) for t, (_, every) in zip(texts, all_spans(net, texts))]
                kept = [None if old is None else t for old, t in zip(part.column(0).to_pylist(), new)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(kept, pa.string())], [*names, "text"])

    schema = StructType([*docs.select(*names).schema.fields]).add("text", StringType())
    out = docs.select(F.col("text").cast("string").alias("text"), *names).mapInArrow(run, schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType if "n_chars" in names else LongType()))
    return out.select(*docs.columns)
