"""Secret scan: fixed patterns, and a linear-chain conditional random field over all tokens that adds what they miss.

Tokens are runs of letters and digits, and every other mark by itself. Each token of a text is tagged begin, inside or outside
of a secret from its shape, the tokens around it and features of the whole file; the tags of a text are decoded by Viterbi. The
field is trained in numpy. Its labels are the values of the patterns' own matches in a bounded sample of documents. In part of
the examples the key, the quotes and the value are exchanged for other ones, and look-alikes that are no secrets are
written in, so that the field has to learn from shape and place and not only from the patterns' fixed names.

By definition a secret has no white space, consists of the patterns' value characters, and has six of them or more. So the tags
couple only within a piece between white space and between neighbouring pieces, and a piece in which no span can gain over
outside, by a bound on its emissions and transitions, is outside without being decoded: the result is that of the whole chain.

Defined results: a null text counts as empty; an empty text has no spans; texts are scanned whole in linear time; repeated
rows give equal rows; a null id keeps its row; without any match in the sample no field is trained and nothing is added;
extra columns of the input are not read. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field as member

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import documents, sampled_texts

# Kinds in the order in which spans at one start are listed; the last is the field's.
KINDS = ("assign", "access", "hex", "model")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}+")
_HEX = re.compile(r"[0-9a-f]{24,}+")
#: Texts with one of these may hold a base span; for the choice of training texts only.
LIKELY = r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
_PIECES = re.compile(r"[^\W_]+|\s+|.", re.DOTALL)
_VALUE_MARKS = frozenset("+/_.=-")
LEAST_VALUE = 6
_OUT, _BEGIN, _IN = 0, 1, 2
_NEVER = -1e4

#: Neighbours that are features: so many tokens before and after.
BEFORE, AFTER = 5, 2
_PLACES = ("own", *(f"b{i}" for i in range(1, BEFORE + 1)), *(f"a{i}" for i in range(1, AFTER + 1)), "joined", "apart")  # the last two: the token before without and with a gap
#: Tokens of a training window.
WINDOW = 56

# Names that stand before secrets, and before other values, in the examples written for training.
_OWNERS = ("", "", "", "auth", "access", "client", "private", "db", "user", "session", "admin", "service", "root", "login", "my", "the")
_SECRET_NAMES = ("key", "secret", "token", "password", "passwd", "pwd", "pass", "passphrase", "credential", "credentials", "apikey", "signature")
_OTHER_NAMES = ("name", "title", "lang", "source", "date", "color", "size", "path", "host", "user", "version", "id", "note", "status", "page", "key", "author", "type")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The patterns' spans by start, then kind."""
    found = [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def base_values(text: str) -> list[tuple[int, int]]:
    """The secret values of the base spans without the key and without a full stop at the end; overlapping ones are joined."""
    found = [(a, b) for kind, a, b in base_spans(text) if kind != "assign"]
    found += [m.span(2) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        while b > a and text[b - 1] in ".-":
            b -= 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        elif b > a:
            out.append((a, b))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _size(n: float) -> int:
    return int(n).bit_length()


def _classes(token: str) -> str:
    return "".join("0" if c in "0123456789" else "a" if c.islower() else "A" if c.isupper() else "x" for c in token)


def own_features(token: str) -> list[str]:
    """Features of a token by itself."""
    if not token:
        return []
    if not token[0].isalnum():
        return ["mark", f"mark={token}"]
    classes = _classes(token)
    letters = {c for c in token if c.isalpha()}
    kind = ("digits" if not letters else "hex" if letters <= set("abcdef") and "0" in classes else "HEX" if letters <= set("ABCDEF") and "0" in classes else
            "+".join(sorted(set(classes))))
    changes = sum(x != y for x, y in zip(classes, classes[1:])) - (classes[:1] == "A" and classes[1:2] == "a")
    shape = re.sub(r"(.)\1+", r"\1", classes)[:6]
    size = min(_size(len(token)), 7)
    vowels = sum(c in "aeiouyAEIOUY" for c in token)
    mixing = "none" if changes <= 0 else "once" if changes == 1 else "some" if changes * 5 < len(token) else "much"
    return ["word", f"size={size}", f"length={min(len(token), 48)}", f"kind={kind}", f"kind,size={kind},{size}", f"shape={shape}", f"mixing,size={mixing},{size}",
            f"vowels={vowels * 6 // len(token)}", f"variety={len(set(token)) * 4 // min(len(token), 32)},{size}", *([f"head={token[:4].lower()}"] if "0" in classes else [])]


def place_features(token: str) -> list[str]:
    """Features of a token for its neighbours."""
    if not token:
        return ["edge"]
    if not token[0].isalnum():
        return ["mark", f"is={token}"]
    kinds = "+".join(sorted(set(_classes(token))))
    return [f"kind={kinds}", f"kind,size={kinds},{min(_size(len(token)), 6)}", *([f"is={token.lower()}"] if len(token) <= 20 else [])]


def type_features(token: str, place: str) -> list[str]:
    """Names of the features a token gives at a place; ``joined`` and ``apart`` are the token before, without and with a gap."""
    return [f"{place}:{f}" for f in (own_features(token) if place == "own" else place_features(token))]


def file_features(text: str, tokens: int) -> list[str]:
    return [f"file:tokens={_size(tokens) // 2}", f"file:assigns={min(_size(text.count('=') + text.count(':')), 6)}", f"file:lines={min(_size(text.count(chr(10))), 6)}"]


def split(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Tokens, their starts, and whether white space stands before each; the first counts as apart."""
    pieces = _PIECES.findall(text)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts = np.cumsum(sizes) - sizes
    blank = np.fromiter(map(str.isspace, pieces), bool, len(pieces))
    apart = np.ones(len(pieces), bool)
    apart[1:] = blank[:-1]
    return [p for p, b in zip(pieces, blank.tolist()) if not b], starts[~blank], apart[~blank]


def may_be(token: str) -> tuple[bool, bool]:
    """Whether a token may begin a secret, and be inside one."""
    word = token[:1].isalnum() and token.isascii()
    return word, word or token in _VALUE_MARKS


def gathered(scores: np.ndarray, ids: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Emissions of tokens in a row (``ids``, edges as type 0) from the scores by place and type."""
    at = dict(zip(_PLACES, scores))
    out = at["own"][ids]
    n = len(ids)
    for i in range(1, BEFORE + 1):
        out[i:] += at[f"b{i}"][ids[:n - i]]
    for i in range(1, AFTER + 1):
        out[:n - i] += at[f"a{i}"][ids[i:]]
    out[1:] += scores[-2:][apart[1:].astype(np.int8), ids[:-1]]
    return out


class _Types(dict):
    """Row of scores of each token; words with the same features share a row, which is what makes most tokens cheap.

    ``scores`` has by place and row how far begin (real part) and inside (imaginary part) lie over outside; row 0 is an edge,
    row 1 white space.
    """

    def __init__(self, weights: dict[str, np.ndarray]):
        super().__init__()
        self.own, self.around, self.rows = {}, {}, {}
        for name, w in weights.items():
            place, _, f = name.partition(":")
            gain = complex(w[_BEGIN] - w[_OUT], w[_IN] - w[_OUT])
            if place == "own":
                self.own[f] = gain
            elif place in _PLACES:
                self.around.setdefault(f, np.zeros(len(_PLACES), np.complex64))[_PLACES.index(place)] = gain
        self.scores = np.zeros((len(_PLACES), 1024), np.complex64)
        self.used = 0
        self[""] = self.row("")
        self.used = 2

    def row(self, token: str) -> int:
        number, self.used = self.used, self.used + 1
        if number == self.scores.shape[1]:
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)], 1)
        around = self.around
        score = sum((around[f] for f in place_features(token) if f in around), np.zeros(len(_PLACES), np.complex64))
        begins, inside = may_be(token)
        score[0] = sum((self.own[f] for f in own_features(token) if f in self.own), complex(0 if begins else _NEVER, 0 if inside else _NEVER))
        self.scores[:, number] = score
        return number

    def __missing__(self, token: str) -> int:
        if token.isspace():
            number = 1
        elif token.isalpha() and token[1:].islower() and (token[0].islower() or token[0].isupper()):
            n, lower = len(token), token.lower()
            same = (min(n, 48), min(n.bit_length(), 7), token[0].islower(), n > 1, token.isascii(), sum(map(token.count, "aeiouyAEIOUY")) * 6 // n, len(set(token)) * 4 // min(n, 32),
                    lower if n <= 20 and f"is={lower}" in self.around else "")
            number = self.rows.get(same)
            if number is None:
                number = self.rows[same] = self.row(token)
        else:
            number = self.row(token)
        self[token] = number
        return number


@dataclass
class Field:
    """Weights of the features for each tag, and of the transitions (rows: tag before)."""

    weights: dict[str, np.ndarray]
    moves: np.ndarray
    types: _Types | None = member(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "moves": self.moves, "types": None}

    def gains(self, text: str, keep: int = 1_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and gaps before the tokens, and how far begin and inside lie over outside, as complex numbers.

        Inside is barred after white space. Scores of types are kept between texts.
        """
        if self.types is None or len(self.types) > keep:
            self.types = _Types(self.weights)
        pieces = _PIECES.findall(text)
        rows = np.fromiter(map(self.types.__getitem__, pieces), np.int32, len(pieces))
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        token = rows != 1
        apart = np.ones(len(pieces), bool)
        apart[1:] = ~token[:-1]
        ends, apart, sizes = ends[token], apart[token], np.diff(ends, prepend=0)[token]
        edge, gap = np.zeros(BEFORE, np.int32), np.ones(BEFORE, bool)
        out = gathered(self.types.scores, np.concatenate([edge, rows[token], edge]), np.concatenate([gap, apart, gap]))[BEFORE:BEFORE + len(ends)]
        for f in file_features(text, len(ends)):
            w = self.weights.get(f)
            if w is not None:
                out += np.complex64(complex(w[_BEGIN] - w[_OUT], w[_IN] - w[_OUT]))
        out[apart] += np.complex64(complex(0, _NEVER))
        return ends - sizes, ends, apart, out

    def live(self, gains: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """For each piece between white space whether a span in it can gain over outside.

        A span's gain is at most that of its first token with the best transitions in and out, and the gains above zero of those
        that follow with the best transition to inside.
        """
        m = self.moves
        enter = (m[:, _BEGIN] - m[:, _OUT]).max()
        leave = (m[1:, :2] - m[_OUT, :2]).max()
        stay = m[1:, _IN].max() - m[_OUT, _OUT]
        at = np.flatnonzero(apart)
        return np.maximum.reduceat(gains.real + (enter + leave), at) + np.add.reduceat(np.maximum(gains.imag + stay, 0), at) > 0

    def tags(self, gains: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Viterbi tags of all tokens of a text."""
        out = np.zeros(len(gains), np.int8)
        if len(gains):
            bounds = np.append(np.flatnonzero(apart), len(gains))
            live = np.concatenate([[False], self.live(gains, apart), [False]])
            moves = self.moves.tolist()
            for first, last in zip(np.flatnonzero(live[1:] & ~live[:-1]), np.flatnonzero(live[:-1] & ~live[1:])):
                a, b = bounds[first], bounds[last]
                out[a:b] = viterbi([[0.0, g.real, g.imag] for g in gains[a:b].tolist()], moves)
        return out

    def spans(self, text: str) -> list[Span]:
        starts, ends, apart, gains = self.gains(text)
        tags = self.tags(gains, apart)
        out: list[list[int]] = []
        for i in np.flatnonzero(tags).tolist():
            if tags[i] == _BEGIN:
                out.append([int(starts[i]), int(ends[i])])
            else:
                out[-1][1] = int(ends[i])
        return [("model", a, b) for a, b in out if b - a >= LEAST_VALUE]


def viterbi(e: list[list[float]], moves: list[list[float]]) -> list[int]:
    """The best tags of a chain that lies between two outside tags."""
    best, backs = [moves[_OUT][t] + e[0][t] for t in range(3)], []
    for row in e[1:]:
        back = [max(range(3), key=lambda p: best[p] + moves[p][t]) for t in range(3)]
        best = [best[back[t]] + moves[back[t]][t] + row[t] for t in range(3)]
        backs.append(back)
    tag = max(range(3), key=lambda t: best[t] + moves[t][_OUT])
    out = [tag]
    for back in reversed(backs):
        tag = back[tag]
        out.append(tag)
    return out[::-1]


def _barred() -> np.ndarray:
    moves = np.zeros((3, 3))
    moves[_OUT, _IN] = _NEVER
    return moves


def labelled(text: str, values: list[tuple[int, int]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Tokens, gaps and tags of a text whose secret values are given; the first token in a value begins it."""
    tokens, starts, apart = split(text)
    tags = np.zeros(len(tokens), np.int64)
    for a, b in values:
        i, j = np.searchsorted(starts, a), np.searchsorted(starts, b)
        tags[i:j] = _IN
        tags[i:i + 1] = _BEGIN
    return tokens, apart, tags


def _drawn(rng: np.random.Generator, letters: str, size: int) -> str:
    return "".join(letters[i] for i in rng.integers(0, len(letters), size))


_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_MIXED = _LOWER + _LOWER.upper() + _DIGITS


def written_secret(rng: np.random.Generator, words: list[str]) -> tuple[str, str, str]:
    """A secret as text before, value and text after: named with any value, or bare with one that only chance makes."""
    style = rng.random()
    size = int(rng.integers(6, 41))
    word = words[int(rng.integers(len(words)))]
    value = [lambda: _drawn(rng, _MIXED, size), lambda: _drawn(rng, _MIXED, size), lambda: _drawn(rng, _LOWER + _DIGITS, size),
             lambda: _drawn(rng, _LOWER + _LOWER.upper(), size), lambda: _drawn(rng, "0123456789abcdef", size), lambda: _drawn(rng, "0123456789ABCDEF", size),
             lambda: "".join(words[int(i)].lower() for i in rng.integers(0, len(words), 3)), lambda: word + _drawn(rng, _DIGITS, 4),
             lambda: "-".join(_drawn(rng, _MIXED, 6) for _ in range(int(rng.integers(2, 6)))), lambda: "_".join([_drawn(rng, _LOWER, 2), _drawn(rng, _LOWER, 4), _drawn(rng, _MIXED, size)]),
             lambda: _drawn(rng, _MIXED + "+/", size + 6) + "=" * int(rng.integers(3))][int(rng.integers(11))]()
    value = re.sub(r"[^A-Za-z0-9+/_.=-]|^[^A-Za-z0-9]+", "", value)
    while len(value) < LEAST_VALUE:
        value += _drawn(rng, _MIXED, 3)
    if style < 0.12:
        return ("Authorization: " if rng.random() < 0.3 else "") + ("Bearer " if rng.random() < 0.8 else "bearer "), _drawn(rng, _MIXED, size + 10), ""
    if style < 0.27:
        return "", _drawn(rng, ("0123456789abcdef", "0123456789ABCDEF", _MIXED)[int(rng.integers(3))], size + 20), ""
    owner, name = (x[int(rng.integers(len(x)))] for x in (_OWNERS, _SECRET_NAMES))
    key = (owner + ("_", "-", " ", "")[int(rng.integers(4))] if owner else "") + name
    key = (key, key, key.upper(), key.title())[int(rng.integers(4))]
    sign = ("=", " = ", ": ", ":", " : ", "= ")[int(rng.integers(6))]
    quote = ("", '"', '"', "'")[int(rng.integers(4))]
    return key + ('"' if quote == '"' and rng.random() < 0.2 else "") + sign + quote, value, quote


def written_other(rng: np.random.Generator, words: list[str]) -> str:
    """What looks like a secret and is none: named plain values, names in prose, numbers, addresses, versions."""
    word, more = (words[int(i)] for i in rng.integers(0, len(words), 2))
    number = lambda n: _drawn(rng, _DIGITS, n)
    name, key = (x[int(rng.integers(len(x)))] for x in (_OTHER_NAMES, _SECRET_NAMES))
    sign, quote = (" = ", "=", ": ")[int(rng.integers(3))], ("", '"', "'")[int(rng.integers(3))]
    return [lambda: f"{name}{sign}{quote}{word}{quote}", lambda: f"{name}{sign}{quote}{word} {more}{quote}", lambda: f"{name}{sign}{number(int(rng.integers(1, 9)))}",
            lambda: f"{key} {word} {more}", lambda: f"the {key} of {word}", lambda: f"{word}: {more}", lambda: number(16), lambda: f"+{number(1)} ({number(3)}) 555-{number(4)}",
            lambda: f"{_drawn(rng, _LOWER, 2).upper()}-20{number(2)}-{number(6)}", lambda: f"v{number(1)}.{number(1)}.{number(1)}-20{number(6)}",
            lambda: f"{word}.{number(2)}@{more}.example.com", lambda: f"https://www.{word}.com/{more}/{number(5)}?{name}={more}", lambda: f"{number(3)}.{number(2)}.{number(3)}.{number(1)}",
            lambda: f"20{number(2)}-0{number(1)}-1{number(1)} 1{number(1)}:{number(2)}", lambda: f"{word}-{more}_{word}", lambda: f"{word.title()}{more.title()}({number(1)})",
            lambda: f"{_drawn(rng, _LOWER, 3)}{number(3)}", lambda: number(int(rng.integers(6, 14))), lambda: f"{word}{more}{word}"][int(rng.integers(19))]()


def windows_of(text: str, rng: np.random.Generator, rewritten: int = 3) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, list[str]]]:
    """Labelled windows of one text: around each base value as it stands, with written secrets and look-alikes, and anywhere."""
    values = base_values(text)
    words = re.findall(r"[A-Za-z]{2,12}", text)[:2000] or ["word"]
    tokens, starts, apart = split(text)
    file = file_features(text, len(tokens))

    def window(at: int, tokens: list[str], apart: np.ndarray, tags: np.ndarray):
        a = max(0, at - int(rng.integers(8, WINDOW - 8)))
        while a and tags[a] == _IN:
            a -= 1
        return tokens[a:a + WINDOW], apart[a:a + WINDOW], tags[a:a + WINDOW], file

    def rewritten_at(a: int, b: int):
        """A written secret and a look-alike in place of the characters from ``a`` to ``b``."""
        head, tail = text[max(0, a - 240):a], text[b:b + 240]
        head = re.sub(r"""[\w-]*["']?\s*[:=]\s*["']?$""", "", head).rstrip("\"'") + " "
        tail = " " + tail.lstrip("\"'")
        before, value, after = written_secret(rng, words)
        other = written_other(rng, words)
        new, more = (head + other + " " + before, "") if rng.random() < 0.5 else (head + before, " " + other)
        made = new + value + after + more + tail
        behind = len(made) - len(tail)
        known = base_values(head) + [(len(new), len(new) + len(value))] + [(behind + x, behind + y) for x, y in base_values(tail)]
        return window(int(np.searchsorted(split(made)[1], len(new))), *labelled(made, known))

    whole = labelled(text, values)
    for a, b in values:
        yield window(int(np.searchsorted(starts, a)), *whole)
        for _ in range(rewritten):
            yield rewritten_at(a, b)
    if len(tokens) > 1:
        i, j = (int(starts[int(x)]) for x in rng.integers(0, len(starts), 2))
        yield rewritten_at(i, i)
        head, tail = text[max(0, j - 200):j], text[j:j + 200]
        made = f"{head.rsplit(' ', 1)[0]} {written_other(rng, words)} {written_other(rng, words)} {tail.split(' ', 1)[-1]}"
        yield window(len(split(head)[0]), *labelled(made, base_values(made)))
        yield window(int(rng.integers(len(tokens))), *whole)


class _Sparse:
    """Features of the types at one place as pairs of type and feature."""

    def __init__(self, names: list[str], place: str, index: dict[str, int]):
        pairs = [(t, index[f]) for t, name in enumerate(names) for f in type_features(name, place) if f in index]
        self.type, self.feature = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.types = len(names)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(self.type, w[self.feature, t], self.types) for t in range(3)], 1)

    def add(self, g: np.ndarray, by_type: np.ndarray) -> None:
        for t in range(3):
            g[:, t] += np.bincount(self.feature, by_type[self.type, t], len(g))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def likelihood(e: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood of the tags of equally long chains, and its gradients by emission and by transition."""
    n, length, _ = e.shape
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[:, 0] = moves[_OUT] + e[:, 0]
    for t in range(1, length):
        alpha[:, t] = _logsum(alpha[:, t - 1, :, None] + moves, 1) + e[:, t]
    beta[:, -1] = moves[:, _OUT]
    for t in range(length - 2, -1, -1):
        beta[:, t] = _logsum(moves + (e[:, t + 1] + beta[:, t + 1])[:, None], 2)
    norm = _logsum(alpha[:, -1] + beta[:, -1], 1)
    padded = np.pad(tags, ((0, 0), (1, 1)))
    gold = np.take_along_axis(e, tags[:, :, None], 2).sum((1, 2)) + moves[padded[:, :-1], padded[:, 1:]].sum(1)
    de = np.exp(alpha + beta - norm[:, None, None])
    dmoves = np.zeros((3, 3))
    dmoves[_OUT] += de[:, 0].sum(0)
    dmoves[:, _OUT] += de[:, -1].sum(0)
    for t in range(1, length):
        dmoves += np.exp(alpha[:, t - 1, :, None] + moves + (e[:, t] + beta[:, t] - norm[:, None])[:, None]).sum(0)
    np.add.at(dmoves, (padded[:, :-1], padded[:, 1:]), -1)
    de[np.arange(n)[:, None], np.arange(length), tags] -= 1
    return float((norm - gold).sum()), de, dmoves


def fit(texts: list[str], rounds: int = 50, rate: float = 0.2, l2: float = 0.1, least: int = 3, most_windows: int = 2500, seed: int = 5) -> Field | None:
    """Maximise the conditional likelihood of the windows' tags by Adam; without a base value there is nothing to learn from."""
    rng = np.random.default_rng(seed)
    found = [w for text in texts for w in windows_of(text, rng)]
    if not any(w[2].any() for w in found):
        return None
    found = [found[i] for i in rng.permutation(len(found))[:most_windows]]
    number: dict[str, int] = {"": 0}
    step_size = WINDOW + 2 * BEFORE  # windows in one row, with edges between them
    ids, apart = np.zeros((len(found), step_size), np.int64), np.ones((len(found), step_size), bool)
    tags = np.zeros((len(found), WINDOW), np.int64)
    for k, (tokens, gaps, own, _) in enumerate(found):
        ids[k, BEFORE:BEFORE + len(tokens)] = [number.setdefault(t, len(number)) for t in tokens]
        apart[k, BEFORE:BEFORE + len(tokens)], tags[k, :len(own)] = gaps, own
    names = list(number)
    used = np.bincount(ids.ravel(), minlength=len(names))
    counts = Counter()
    for t, name in enumerate(names):
        for p in _PLACES:
            for f in type_features(name, p):
                counts[f] += int(used[t])
    files = Counter(f for w in found for f in w[3])
    index = {f: i for i, f in enumerate(sorted(f for f, c in (counts + files).items() if c >= least))}
    parts_at = {p: _Sparse(names, p, index) for p in _PLACES}
    file_row, file_column = (np.array(x, np.int64) for x in zip(*[(k, index[f]) for k, w in enumerate(found) for f in w[3] if f in index]))
    flat, gaps = ids.ravel(), apart.ravel()
    bars = np.zeros((len(names), 3))
    for t, name in enumerate(names):
        begins, inside = may_be(name)
        bars[t] = 0, 0 if begins else _NEVER, 0 if inside else _NEVER
    inner = slice(BEFORE, BEFORE + WINDOW)
    tags[bars[ids[:, inner], tags] < 0] = _OUT
    before = np.pad(tags, ((0, 0), (1, 0)))[:, :-1]
    tags[(tags == _IN) & ((before == _OUT) | apart[:, inner])] = _BEGIN  # a value that other marks cut begins anew
    tags[bars[ids[:, inner], tags] < 0] = _OUT
    before = np.pad(tags, ((0, 0), (1, 0)))[:, :-1]
    tags[(tags == _IN) & (before == _OUT)] = _OUT
    parts = [np.zeros((len(index), 3)), np.zeros((3, 3))]
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, rounds + 1):
        scores = np.stack([s.scores(parts[0]) for s in parts_at.values()])
        scores[0] += bars
        e = gathered(scores, flat, gaps).reshape(len(found), step_size, 3)[:, inner].copy()
        e += np.stack([np.bincount(file_row, parts[0][file_column, t], len(found)) for t in range(3)], 1)[:, None]
        e[:, :, _IN] += np.where(apart[:, inner], _NEVER, 0)
        _, de, dmoves = likelihood(e, parts[1] + _barred(), tags)
        wide = np.zeros((len(found), step_size, 3))
        wide[:, inner] = de
        wide = wide.reshape(-1, 3)
        grad = np.zeros_like(parts[0])
        total = lambda at, values: np.stack([np.bincount(at, values[:, t], len(names)) for t in range(3)], 1)
        parts_at["own"].add(grad, total(flat, wide))
        for i in range(1, BEFORE + 1):
            parts_at[f"b{i}"].add(grad, total(flat[:-i], wide[i:]))
        for i in range(1, AFTER + 1):
            parts_at[f"a{i}"].add(grad, total(flat[i:], wide[:-i]))
        parts_at["apart"].add(grad, total(flat[:-1][gaps[1:]], wide[1:][gaps[1:]]))
        parts_at["joined"].add(grad, total(flat[:-1][~gaps[1:]], wide[1:][~gaps[1:]]))
        for t in range(3):
            grad[:, t] += np.bincount(file_column, de.sum(1)[file_row, t], len(index))
        for p, g, a, b in zip(parts, (grad + l2 * parts[0], dmoves + l2 * parts[1]), m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return Field({f: parts[0][i].astype(np.float32) for f, i in index.items()}, parts[1] + _barred())


def train(docs: DataFrame, max_rows: int = 1500, max_others: int = 1000, max_bytes: int = 20_000) -> Field | None:
    """Fit on at most ``max_rows`` different texts that may hold a base span and ``max_others`` others, chosen by a hash of the text.

    Texts of more than ``max_bytes`` bytes are not trained on; they are scanned like all others.
    """
    return fit(sampled_texts(docs, LIKELY, max_rows, max_bytes) + sampled_texts(docs, LIKELY, max_others, max_bytes, without=True))


def all_spans(field: Field | None, text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the field's spans that touch none of them; both lists are in order, so one pass tells."""
    base = base_spans(text)
    more, at, reach = [], 0, 0
    for s in field.spans(text) if field else []:
        while at < len(base) and base[at][1] < s[2]:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= s[1]:
            more.append(s)
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id``, counts of base spans, the hash of their list and the list of all spans; one pass, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [all_spans(field, t or "") for t in b.column(0).to_pylist()]
            counts = [pa.array([sum(s[0] == k for s in own) for own, _ in both], pa.int64()) for k in KINDS[:3]]
            digest = [hashlib.sha256(joined(own).encode()).hexdigest() for own, _ in both]
            yield pa.RecordBatch.from_arrays([b.column(1), *counts, pa.array(digest, pa.string()), pa.array([joined(a) for _, a in both], pa.string())],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return documents(docs).select("text", "doc_id").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def secrets(docs: DataFrame) -> DataFrame:
    """Train on a bounded sample, then find the spans of every document."""
    return find(docs, train(docs))
