"""Spelling variants: counting, k-d search and forms against plain versions, and the query against SQL."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from beaconry.llm import spelling as S
from beaconry.llm.queries import ORACLE, QUERIES
from tests.compare import connect, difference
from tests.llm.cases import docs_frame

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(words, ratio=5):
    out, forms = {}, {}
    for w, n in words.items():
        found = [x for x in words if x != w and is_near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= ratio * n else None
        out[w] = (n, len(found))
    rows = set()
    for w, (n, near) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, near, words[forms[w]] if forms[w] else None))
    return rows


def crowd(seed, size, alphabet="abcdeéÿ"):
    rng = random.Random(seed)
    words = {"".join(rng.choices(alphabet, k=rng.choice([6, 6, 6, 7, 7, 8, 12]))) for _ in range(size)}
    for w in list(words)[:size // 2]:
        i = rng.randrange(len(w))
        words |= {w[:i] + rng.choice(alphabet) + w[i + 1:], w[:i] + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i:]}
    return {w: rng.choice([5, 5, 6, 30, 31, 160, 900]) for w in words if len(w) >= 6}


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES["op12_spelling"](spark, folder), connect(folder), ORACLE["op12_spelling"]) is None


def test_counts_equal_a_plain_count(spark):
    rng = random.Random(5)
    docs = [(i if i % 9 else None, " ".join(rng.choices(["Éclairs", "éclairs", "Straßen", "short", "×÷×÷×÷", "abcdefg", "ABCDEFG", "a1bcdefg", "ﬁfteenth", "日abcdef本"], k=30))) for i in range(300)] + [(1, None), (2, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for held in (1, 200_000):
        assert {r.word: r.n for r in S.vocabulary(frame, held).collect()} == plain_words(docs)


def test_search_equals_brute_force_on_a_block():
    words = list(crowd(1, 400))
    for size, other, up, down in ((6, 6, 1, 1), (7, 7, 1, 1), (6, 7, 1, 0), (7, 8, 1, 0), (12, 12, 1, 1)):
        asked, held = [w for w in words if len(w) == size], [w for w in words if len(w) == other]
        a, b = S.near(S.tree(held, [1] * len(held)), *S.letters(asked), up, down)
        got = [(asked[i], held[k]) for i, k in zip(a.tolist(), b.tolist())]
        assert sorted(got) == sorted((x, y) for x in asked for y in held if x != y and is_near(x, y))


@pytest.mark.parametrize("leaves", [1, 5, 40])
def test_the_top_loses_no_near_word(leaves):
    words = list(crowd(2, 400))
    for size, other, up, down in ((6, 6, 1, 1), (7, 8, 1, 0)):
        asked, held = [w for w in words if len(w) == size], [w for w in words if len(w) == other]
        t = S.top(S.letters(held)[1][::3], leaves)
        assert t.leaves <= leaves
        where = t.leaf_of(S.letters(held)[1])
        rows, to = t.reached(S.letters(asked)[1], up, down)
        reached = set(zip(rows.tolist(), to.tolist()))
        assert len(reached) == len(rows) and set(where.tolist()) <= set(range(t.leaves))
        assert all((i, int(where[k])) in reached for i, x in enumerate(asked) for k, y in enumerate(held) if is_near(x, y))
        if leaves == 40:
            assert len(rows) < 0.7 * len(asked) * t.leaves


@pytest.mark.parametrize("leaf_rows, block_rows, sample", [(16_384, 65_536, 100_000), (40, 25, 300)])
def test_variants_equal_brute_force(spark, leaf_rows, block_rows, sample):
    words = crowd(3, 500)
    rows = [(i, " ".join([w] * n), "x", 1) for i, (w, n) in enumerate(words.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(6)
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(docs, sample=sample, leaf_rows=leaf_rows, block_rows=block_rows).collect()}
    want = plain_variants(plain_words([r[:2] for r in rows]))
    assert got == want and any(r[1] and r[1] != r[2] for r in want)


def test_odd_rows(spark):
    docs = docs_frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(docs).collect()}
    assert got == plain_variants(plain_words(rows)) and got
    assert S.variants(docs.limit(0)).count() == 0


def test_equal_letters_need_no_split():
    t = S.top(S.letters(["abcdef", "fedcba", "badcfe"])[1], 8)
    assert t.leaves == 1 and S.top(np.zeros((0, S.DIMENSIONS), np.uint16), 4).leaves == 1
