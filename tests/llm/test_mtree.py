"""M-tree search against brute force over all vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconry.llm import mtree as M
from beaconry.llm.queries import ORACLE, QUERIES
from tests.compare import connect, difference


def brute(rows, k):
    out = []
    whole = sorted({(i, tuple(int(np.floor(1024 * float(x))) for x in v)) for i, v in rows
                    if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    for q, qv in whole:
        if q % 3 == 0:
            scores = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in whole if i != q]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, score double, rank int")


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    df = QUERIES["op1_mtree_top_k"](spark, folder)
    assert difference(df, connect(folder), ORACLE["op1_mtree_top_k"]) is None


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    same = [(100 + i, [0.5, 0.5, 0.1]) for i in range(40)]
    rows = [(0, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, None), (3, [nan, 1.0, 1.0]), (4, [inf, 0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [0.0, 0.0, 0.0]),
            (None, [1.0, 1.0, 1.0]), (9, [-1.0, -2.0, -3.0]), (9, [-1.0, -2.0, -3.0]), (12, [2.0, 1.0]), (13, [0.5]), *same]
    got = sorted(map(tuple, M.top_k(frame(spark, rows), F.col("vec_id") % 3 == 0, k=4).collect()))
    assert got == brute(rows, 4)
    few = rows[:2]
    assert sorted(map(tuple, M.top_k(frame(spark, few), F.col("vec_id") % 3 == 0).collect())) == brute(few, 10)
    assert M.top_k(frame(spark, rows).limit(0), F.col("vec_id") % 3 == 0).count() == 0


def test_many_small_pages(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (12, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + rng.normal(0, 0.1, 8)]) for i in range(900)]
    rows += [(2000 + i, rows[0][1]) for i in range(300)]
    small = M.index
    monkeypatch.setattr(M, "index", lambda v, k: small(v, k, pivots=5, page_rows=60, fanout=4))
    got = sorted(map(tuple, M.top_k(frame(spark, rows), F.col("vec_id") % 3 == 0, k=5, query_rows=50).collect()))
    assert got == brute(rows, 5)


def test_bounds_save_distances():
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 400, (40, 16))
    exact = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 10, (4000, 16))).astype(np.int64)
    norm = float((exact ** 2).sum(1).max())
    points = M._augmented(exact, norm)
    page = M.Page(points, exact, [[i] for i in range(len(exact))], M.build(points, np.arange(len(points)), 0, 32, np.random.default_rng(0)))
    seen = 0
    for q in exact[:50]:
        counts = [0]
        got = M.search(page, M._plain(q[None])[0], q, -1, 10, norm, None, counts)
        want = sorted((-(exact @ q))[i] for i in range(len(exact)))[:10]
        assert sorted(-s for s, _ in got) == want
        seen += counts[0]
    assert seen < 0.6 * 50 * len(exact)


@pytest.mark.parametrize("size", [1, 5, 33])
def test_alike_points_build(size):
    points = np.ones((size, 4))
    tree = M.build(points, np.arange(size), 0, 4, np.random.default_rng(0))
    assert tree.radius == 0


def plain_best(exact, ids, queries, own, k):
    """``(query, score, id)`` of each query's best by comparing all."""
    found = []
    for n, (q, me) in enumerate(zip(queries.tolist(), own)):
        scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for v, held in zip(exact.tolist(), ids) for i in held if i != me)
        found += [(n, -s, i) for s, i in scores[:k]]
    return found


@pytest.mark.parametrize("size, kind", [(300, np.float32), (10 ** 5, np.float64), (10 ** 8, np.int64)])
@pytest.mark.parametrize("centres", [1, 12])
def test_blocks_of_queries_equal_brute_force(size, kind, centres):
    """Ties, ids of equal vectors, a query that is zero, and numbers beyond what floats hold exactly."""
    rng = np.random.default_rng(9)
    middle = rng.integers(-size, size, (centres, 6))
    exact = np.unique(middle[rng.integers(0, centres, 700)] + rng.integers(-size // 20, size // 20, (700, 6)), axis=0)
    exact = np.concatenate([exact, np.zeros((1, 6), np.int64), exact[:40] * [1, 1, 1, 1, 1, 0]])
    exact = np.unique(exact, axis=0)
    ids = [[i, i + 5000] if i % 9 == 0 else [i] for i in range(len(exact))]
    norm = float((exact ** 2).sum(1).max())
    assert M.exact_kind(norm) is kind
    points = M._augmented(exact, norm)
    page = M.Page(None, exact, ids, M.build(points, np.arange(len(points)), 0, 4, np.random.default_rng(0)))
    at = np.append(rng.permutation(len(exact))[:60], np.flatnonzero(~exact.any(1)))
    queries, own = exact[at], at.astype(np.int64)
    square = (queries.astype(float) ** 2).sum(1)
    none = np.full(len(at), M.NONE)
    want = plain_best(exact, ids, queries, own, 4)
    got = list(zip(*(x.tolist() for x in M.search_block(page, queries, square, own, 4, norm, none, none))))
    assert got == want
    # with the k-th best known, nothing of a lower score is returned, and nothing ahead of it is lost
    least = {n: (s, i) for n, s, i in want}
    floor, last = (np.array([least[n][c] for n in range(len(at))]) for c in (0, 1))
    got = list(zip(*(x.tolist() for x in M.search_block(page, queries, square, own, 4, norm, floor, last))))
    assert {(n, s, i) for n, s, i in want if (s, i) != least[n]} <= set(got) and all(s >= least[n][0] for n, s, _ in got)


def test_a_page_is_searched_for_a_block_at_once(monkeypatch):
    """Without clusters every query has to look at all vectors: steps go by the page and not by the queries."""
    rng = np.random.default_rng(10)
    exact = rng.normal(0, 120, (3000, 64)).round().astype(np.int64)
    norm = float((exact ** 2).sum(1).max())
    points = M._augmented(exact, norm)
    page = M.Page(None, exact, [[i] for i in range(3000)], M.build(points, np.arange(3000), 0, 32, np.random.default_rng(0)))
    scores = exact[:800] @ exact.T
    scores[np.arange(800), np.arange(800)] = -2 ** 40
    order = np.argsort(-scores, 1, kind="stable")[:, :10]
    steps, add = [], M.Found.add
    monkeypatch.setattr(M.Found, "add", lambda self, *a: steps.append(1) or add(self, *a))
    floor = np.take_along_axis(scores, order[:, 9:], 1)[:, 0] - 500
    query, score, ids = M.search_block(page, exact[:800], (exact[:800].astype(float) ** 2).sum(1), np.arange(800), 10, norm, floor, np.full(800, M.NONE))
    assert len(steps) <= 3000 // M.SCAN + 1
    assert (ids.reshape(800, 10) == order).all() and (score.reshape(800, 10) == np.take_along_axis(scores, order, 1)).all()


def test_an_id_with_several_vectors_is_several_queries(spark):
    rows = [(3, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 0.5]), (5, [0.0, 0.0]), (6, [0.0, 0.0]), *[(10 + i, [0.01 * i, 0.3]) for i in range(60)]]
    got = sorted(map(tuple, M.top_k(frame(spark, rows), F.col("vec_id") % 3 == 0, k=3).collect()))
    assert got == brute(rows, 3)


def test_pages_are_bounded_by_width():
    assert M.page_size(64) == M.PAGE and M.page_size(2) == M.PAGE
    assert M.page_size(4096) * 4096 <= M.NUMBERS and M.page_size(1 << 30) == M.FANOUT
