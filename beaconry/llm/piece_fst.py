"""SentencePiece encoding and decoding as shortest paths through weighted finite-state transducers.

Three machines are compiled from a model file: the normaliser (a space becomes the space mark, with one before the text, as
the model's own settings say), the pieces, and the byte fallback for characters outside the alphabet. Composed with an input
they give a lattice of pieces between the positions of the text, and the encoding is its shortest path in the tropical
semiring.

For a unigram model an arc weighs minus the piece's score. In a byte-pair model the scores are merge ranks, and the path with
the best sum of scores is not its encoding. There a fourth machine over pairs of neighbouring pieces is composed in: a pair
weighs nothing if merging the two pieces' text gives back these two, otherwise infinity. Exactly one path is then finite, the
one that merging gives, and it is found by depth-first search, longest pieces first, over states (position, last piece).

The lattice falls apart wherever no piece crosses from one character to the next, at least before every word, so words are
encoded once and remembered by the worker process, up to a fixed number. So are the arcs that start with the same four
characters and the weights of pairs of pieces, as most words of a corpus are rare but made of the same pieces.

Defined results: a null text counts as empty and gives no pieces; every other text is encoded whole; characters outside the
alphabet become byte pieces and decode to themselves; a literal space mark decodes to a space, as the model defines;
``round_trip`` compares the decoding with that; repeated rows give equal rows; a null id keeps its row; an empty table gives
no rows; extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from beaconry.llm.common import documents

MARK = "▁"
#: Characters by which the arcs from a position are looked up.
HEAD = 4
#: Most heads, and most pairs of pieces, that a machine remembers before it starts anew.
MOST = 200_000


class Memory:
    """Remembers what was asked for lately: at most ``most`` entries in each of two generations, none longer than 64."""

    def __init__(self, most: int = 250_000) -> None:
        self.most, self.young, self.old = most, {}, {}

    def get(self, key: str):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value) -> None:
        if len(key) <= 64:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[key] = value


#: Memories of this worker process by model, and the machine with what it remembers itself, so that its tasks share them.
_MEMORIES: dict[str, tuple[Memory, Memory]] = {}
_MACHINES: dict[str, Machine] = {}


def merge(symbols: list[str], rank: dict[str, float]) -> list[str]:
    """Byte-pair merging: again and again the adjacent pair whose text has the best rank, the leftmost of equals."""
    left, right = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
    text: list[str | None] = list(symbols)
    heap = [(rank[a + b], i, len(a + b)) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in rank]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = right[i] if text[i] is not None else len(text)
        if j >= len(text) or len(text[i]) + len(text[j]) != size:
            continue
        text[i], text[j] = text[i] + text[j], None
        right[i] = right[j]
        if right[i] < len(text):
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b < len(text) and text[a] + text[b] in rank:
                heapq.heappush(heap, (rank[text[a] + text[b]], a, len(text[a]) + len(text[b])))
    return [t for t in text if t is not None]


@dataclass
class Machine:
    """The compiled transducers. Pieces are numbered by rank, single characters first; ``ids`` are the model's numbers."""

    number: dict[str, int]
    ids: list[int]
    cost: list[float] | None
    split: list[tuple[int, int]]
    merged: dict[int, int]
    longest: dict[str, int]
    run_rank: dict[str, float]
    run_ids: dict[str, int]
    byte_ids: list[int]
    decoded: dict[int, bytes]
    prefix: bool
    words: re.Pattern
    crossed: frozenset[str]
    name: str

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the text of pieces ``a`` and ``b`` gives back just these two.

        Their merges are undone from the latest to the earliest; no pair across the border may have come before them.
        """
        merged, split, n = self.merged, self.split, len(self.ids)
        limit = n + 1
        while True:
            c = merged.get(a * n + b)
            if c is not None and c < limit:
                return False
            if a > b:
                limit, a2 = a, split[a][1]
                if a2 != a:
                    a = a2
                    continue
            else:
                limit, b2 = b + 1, split[b][0]
                if b2 != b:
                    b = b2
                    continue
            # the later one is a single character: undo the other
            if a > b:
                limit, b2 = b + 1, split[b][0]
                if b2 == b:
                    return True
                b = b2
            else:
                limit, a2 = a, split[a][1]
                if a2 == a:
                    return True
                a = a2

    def head(self, first: str) -> tuple[Sequence[int], list[int]]:
        """Lengths over :data:`HEAD` of the pieces that start so, longest first, and the pieces among the prefixes of ``first`` itself."""
        if len(self.heads) >= MOST:
            self.heads.clear()
        short = [p for n in range(len(first), 0, -1) if (p := self.number.get(first[:n])) is not None]
        found = self.heads[first] = self.lengths.get(first, ()), short
        return found

    def arcs(self, text: str, at: int) -> Sequence[int]:
        """Pieces that start at a position, longest first."""
        first = text[at:at + HEAD]
        long, short = self.heads.get(first) or self.head(first)
        if not long:
            return short
        get, left = self.number.get, len(text) - at
        return [p for n in long if n <= left and (p := get(text[at:at + n])) is not None] + short

    def path(self, text: str) -> list[int]:
        """Shortest path over a text of known characters, as piece numbers."""
        return self._lightest(text) if self.cost is not None else self._only(text)

    def _lightest(self, text: str) -> list[int]:
        best, back = [0.0] + [float("inf")] * len(text), [(0, -1)] * (len(text) + 1)
        for at in range(len(text)):
            for p in self.arcs(text, at):
                end = at + self.width[p]
                if best[at] + self.cost[p] < best[end]:
                    best[end], back[end] = best[at] + self.cost[p], (at, p)
        out, at = [], len(text)
        while at:
            at, p = back[at]
            out.append(p)
        return out[::-1]

    def _only(self, text: str) -> list[int]:
        """The one path of finite weight. A state that led nowhere is never entered again."""
        whole = self.number.get(text)
        if whole is not None:
            return [whole]
        dead: set[tuple[int, int]] = set()
        path: list[int] = []
        open_ = [iter(self.arcs(text, 0))]
        at, last, n, width, pairs = 0, -1, len(self.ids), self.width, self.pairs
        if len(pairs) >= MOST:
            pairs.clear()
        while at < len(text):
            for p in open_[-1]:
                if dead and (at + width[p], p) in dead:
                    continue
                if last >= 0:
                    fits = pairs.get(last * n + p)
                    if fits is None:
                        fits = pairs[last * n + p] = self.fits(last, p)
                    if not fits:
                        continue
                path.append(p)
                at += width[p]
                open_.append(iter(self.arcs(text, at)))
                last = p
                break
            else:
                if not path:
                    raise ValueError("no path through a text of known characters")
                dead.add((at, last))
                path.pop(), open_.pop()
                at -= width[last]
                last = path[-1] if path else -1
        return path

    def __post_init__(self) -> None:
        self.width = [0] * len(self.ids)
        lengths: dict[str, set[int]] = {}
        for piece, n in self.number.items():
            self.width[n] = len(piece)
            if len(piece) > HEAD:
                lengths.setdefault(piece[:HEAD], set()).add(len(piece))
        self.lengths = {first: sorted(found, reverse=True) for first, found in lengths.items()}
        self.known = frozenset(c for c in self.longest if len(c) == 1)
        self.heads: dict[str, tuple[Sequence[int], list[int]]] = {}
        self.pairs: dict[int, bool] = {}

    def chunk(self, text: str, memory: Memory) -> list[int]:
        """Model ids of a normalised chunk: perhaps a run of marks, then a word without marks inside."""
        out: list[int] = []
        word = text.lstrip(MARK)
        run = len(text) - len(word)
        if self.cost is None and run > 1:
            # runs of marks rank last: the word takes its mark first, and what is left merges by itself
            ids = self.chunk(MARK + word, memory) if word else []
            if ids and ids[0] != self.run_ids[MARK]:
                run -= 1
            else:
                ids = ids[1:]
            return [self.run_ids[p] for p in merge([MARK] * run, self.run_rank)] + ids
        start = 0
        if self.known.issuperset(text):
            for i, pair in enumerate(map(add, text, text[1:]), 1):
                if pair not in self.crossed:
                    out += self.segment(text[start:i], memory)
                    start = i
            out += self.segment(text[start:], memory)
            return out
        for i, c in enumerate(text):
            if c not in self.known:
                if start < i:
                    out += self.segment(text[start:i], memory)
                out += [self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")]
                start = i + 1
            elif start < i and text[i - 1:i + 1] not in self.crossed:
                out += self.segment(text[start:i], memory)
                start = i
        if start < len(text):
            out += self.segment(text[start:], memory)
        return out

    def segment(self, text: str, memory: Memory) -> tuple[int, ...]:
        """Model ids of a text of known characters that no border of the lattice cuts."""
        ids = memory.get(text)
        if ids is None:
            ids = tuple(map(self.ids.__getitem__, self.path(text)))
            memory.put(text, ids)
        return ids

    def normalised(self, text: str) -> str:
        return (MARK if self.prefix else "") + text.replace(" ", MARK) if text else ""

    def encode(self, text: str, words: Memory, segments: Memory) -> np.ndarray:
        """Model ids of a whole text; the memories keep the encodings of words and of segments of words."""
        found = self.words.findall(self.normalised(text))
        parts = list(map(words.young.get, found))
        for i in [i for i, ids in enumerate(parts) if ids is None]:
            ids = words.get(found[i])
            if ids is None:
                ids = array("i", self.chunk(found[i], segments)).tobytes()
                words.put(found[i], ids)
            parts[i] = ids
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, byte pieces as bytes, marks as spaces, the mark before the text taken off."""
        text = b"".join(map(self.decoded.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def compile_model(path: str) -> Machine:
    """Read a model file and compile its machines."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    settings = model.normalizer_spec
    if settings.precompiled_charsmap or settings.remove_extra_whitespaces or not settings.escape_whitespaces:
        raise ValueError("only the identity normaliser with escaped white space is compiled")
    tables = SentencePieceProcessor(model_file=path)
    every = range(tables.get_piece_size())
    byte_ids = [tables.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    plain = [i for i in every if not (tables.is_control(i) or tables.is_unknown(i) or tables.is_byte(i) or tables.is_unused(i))]
    score = {tables.id_to_piece(i): tables.get_score(i) for i in plain}
    own = {tables.id_to_piece(i): i for i in plain}
    unigram = model.trainer_spec.model_type == proto.TrainerSpec.UNIGRAM
    runs = [p for p in score if set(p) == {MARK}]
    pieces = [p for p in score if p not in runs or p == MARK or unigram]
    chars = sorted(p for p in pieces if len(p) == 1)
    if missing := {c for p in pieces for c in p} - set(chars):
        raise ValueError(f"characters of pieces that are no pieces themselves: {sorted(missing)[:5]}")
    order = chars + sorted((p for p in pieces if len(p) > 1), key=lambda p: (-score[p], p))
    rank = {p: float(i) for i, p in enumerate(order) if len(p) > 1}
    number = {p: i for i, p in enumerate(order)}
    split, merged = [(i, i) for i in range(len(order))], {}
    if not unigram:
        for p in order[len(chars):]:
            # the last merge that makes the piece: merge as if the piece itself were not there
            parts = merge(list(p), {k: v for k, v in _inside(p, rank).items() if k != p})
            if len(parts) == 2:
                split[number[p]] = (number[parts[0]], number[parts[1]])
                merged[number[parts[0]] * len(order) + number[parts[1]]] = number[p]
            else:
                del number[p]  # merging never makes it
    longest: dict[str, int] = {}
    for p in number:
        longest[p[:2]] = max(longest.get(p[:2], 0), len(p))
    for c in chars:
        longest.setdefault(c, 1)
    decoded = {i: p.replace(MARK, " ").encode() for p, i in own.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
    cuts = "".join(c for c in "\n\r\t" if c not in longest)
    words = re.compile(f"{MARK}*[^{MARK}{cuts}]+|{MARK}+" + (f"|[{cuts}]" if cuts else ""))
    best = max(score.values())
    return Machine(number, [own[p] for p in order], [best - score[p] for p in order] if unigram else None, split, merged, longest,
                   {p: -score[p] for p in runs}, {p: own[p] for p in runs}, byte_ids, decoded, settings.add_dummy_prefix, words,
                   frozenset(p[i:i + 2] for p in number for i in range(len(p) - 1)), path)


def _inside(piece: str, rank: dict[str, float]) -> dict[str, float]:
    """Ranks of the texts inside a piece."""
    return {s: rank[s] for i in range(len(piece)) for j in range(i + 2, len(piece) + 1) if (s := piece[i:j]) in rank}


def encode(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, ids, n_pieces, n_bytes, round_trip`` of every document; one pass, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _MACHINES.setdefault(machine.name, machine)
        words, segments = _MEMORIES.setdefault(machine.name, (Memory(), Memory()))
        fallback = np.isin(np.arange(max(own.decoded) + 1), own.byte_ids)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [own.encode(t, words, segments) for t in texts]
                offsets = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
                same = [own.decode(x) == t.replace(MARK, " ") for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))),
                    pa.array([len(x) for x in ids], pa.int32()), pa.array([int(fallback[x].sum()) for x in ids], pa.int32()), pa.array(same, pa.bool_())],
                    ["doc_id", "ids", "n_pieces", "n_bytes", "round_trip"])

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>, n_pieces int, n_bytes int, round_trip boolean")


def decode(encoded: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, text`` of the rows ``doc_id, ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [machine.decode(np.array(x or [], np.int32)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
