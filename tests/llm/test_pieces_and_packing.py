"""Transducer encoding against the installed library, and length buckets against exhaustive search."""

import random
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
import sentencepiece

from beaconry.llm import length_buckets as B
from beaconry.llm import piece_fst as M
from tests.llm.cases import docs_frame

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
FOLDER = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(MODEL).exists(), reason="vocabulary file not installed")


@pytest.fixture(scope="module")
def machine():
    return M.compile_model(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_random_texts_equal_the_library(machine, library):
    random.seed(3)
    parts = ["a", "b", "the", "ing", " ", "  ", "▁", "\n", "é", "☃", "😀", "###", "12", ".", "!!", "@", "x y", "\t", "ung", "の", "日本", "'s", "</s>", "<0x41>", "\r", "qzx"]
    words, segments = M.Memory(50), M.Memory(50)
    for _ in range(4000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        ids = machine.encode(text, words, segments)
        assert ids.tolist() == library.encode(text)
        assert machine.decode(ids) == text.replace("▁", " ")
    for n in range(1, 80):
        assert machine.encode("a" + " " * n + "b", words, segments).tolist() == library.encode("a" + " " * n + "b")


def test_pairs_of_pieces_are_weighed_once(machine, library, monkeypatch):
    """Rare words are made of the same pieces: what two of them weigh, and which start at a head, is remembered up to a bound."""
    asked = []
    fits = M.Machine.fits
    monkeypatch.setattr(M.Machine, "fits", lambda self, a, b: asked.append((a, b)) or fits(self, a, b))
    rng = random.Random(6)
    texts = ["".join(rng.choice(["th", "er", "on", "ing", "a", "tion", "qu", "zz", "é"]) for _ in range(rng.randint(3, 14))) for _ in range(3000)]
    machine.pairs.clear()
    for t in texts:
        assert machine.encode(t, M.Memory(), M.Memory()).tolist() == library.encode(t)
    assert len(asked) == len(set(asked)) < M.MOST
    monkeypatch.setattr(M, "MOST", 20)
    machine.heads.clear()
    for t in texts[:500]:
        assert machine.encode(t, M.Memory(), M.Memory()).tolist() == library.encode(t)
        assert len(machine.heads) <= 20


def test_arcs_are_all_pieces_longest_first(machine):
    rng = random.Random(7)
    pieces = sorted(machine.number)
    for _ in range(500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4)))
        for at in range(len(text)):
            every = [machine.number[text[at:end]] for end in range(len(text), at, -1) if text[at:end] in machine.number]
            assert list(machine.arcs(text, at)) == every


def test_documents_equal_the_library_and_come_back(spark, machine, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    encoded = M.encode(docs, machine)
    rows = encoded.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids) and r.round_trip
    assert {r.doc_id: r.text for r in M.decode(encoded, machine).collect()} == texts


def test_unigram_path_is_the_lightest():
    pieces = ["a", "b", "c", "ab", "bc", "abc"]
    costs = [3.0, 3.0, 3.0, 4.0, 3.5, 7.5]
    m = M.Machine({p: i for i, p in enumerate(pieces)}, list(range(6)), costs, [], {}, {p[:2]: 3 for p in pieces} | {c: 1 for c in "abc"}, {}, {}, [], {}, False, None, frozenset(), "x")
    assert [pieces[i] for i in m.path("abc")] == ["a", "bc"]


def test_odd_rows_pieces(spark, machine):
    docs = docs_frame(spark)
    rows = M.encode(docs, machine).collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    assert all(r.ids == [] for r in rows if r.doc_id in (2, 3))
    assert M.encode(docs.limit(0), machine).count() == 0


def test_boundaries_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(30):
        cells = np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 9), replace=False)) * 8.0
        counts = rng.integers(1, 50, len(cells)).astype(float)
        tokens = counts * (cells - rng.integers(0, 8, len(cells)))
        k = int(rng.integers(1, 5))
        padding = lambda ends: sum(c * min(e for e in ends if e >= x) - t for x, c, t in zip(cells, counts, tokens))
        best = min(padding((*pick, cells[-1])) for n in range(min(k, len(cells))) for pick in combinations(cells[:-1], n))
        ends = B.boundaries(cells, counts, tokens, k)
        assert len(ends) <= k and padding(ends) == best
    assert B.boundaries(np.zeros(0), np.zeros(0), np.zeros(0), 3) == []


@pytest.mark.parametrize("odd", [False, True])
def test_every_byte_is_packed(spark, odd):
    docs = docs_frame(spark) if odd else spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = B.pack(docs, budget=20_000).collect()
    sizes = sorted((r.doc_id is not None, r.doc_id, len((r.text or "").encode()) + 1) for r in docs.collect())
    by_doc = {}
    for r in rows:
        assert 0 < r.length <= r.boundary <= B.LONGEST and r.padding == r.boundary - r.length and r.start == r.piece * B.LONGEST
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.length
    want = {}
    for _, i, n in sizes:
        want[i] = want.get(i, 0) + n
    assert by_doc == want
    batches = {}
    for r in rows:
        batches.setdefault((r.bucket, r.boundary, r.batch), []).append(r.row)
    assert all(sorted(v) == list(range(len(v))) and len(v) * b <= 20_000 for (_, b, _), v in batches.items())
    last = {}
    for (bucket, _, batch) in batches:
        last.setdefault(bucket, []).append(batch)
    assert all(sorted(v) == list(range(len(v))) for v in last.values())
    assert B.pack(docs.limit(0)).count() == 0
