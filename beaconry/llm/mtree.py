"""Exact top-k search by inner product in a paged M-tree.

Components become integers, ``floor(scale * x)``. Inner products are turned into distances by one more coordinate that
brings every vector to the same norm: with ``norm`` the largest squared norm, ``|q - x|^2 = |q|^2 + norm - 2 <q, x>``, so
the nearest vectors are those with the highest score, and the triangle inequality holds.

The tree has three kinds of nodes. At the top are routing pivots, a bounded sample, each with the covering radius of the
vectors nearest to it. Every pivot's vectors lie in pages of bounded size, one row of a stored table each. A page holds inner
nodes and leaves, with the covering radius of each node and the distance of every entry to its parent. A page is searched for
a block of queries at once, best-first: nodes wait in a heap, each with the queries that may need it, by their mean lower
bound; an entry's distance is only computed if the stored bound ``|d(q, parent) - d(entry, parent)|`` does not rule it out for
all; and a query leaves a node once its bound is beyond the query's k-th best. Where the bounds rule out little, as among vectors
without clusters, the node is scanned whole. Vectors are scored by matrix products, in pieces that fit into a core's
cache. A query first searches the pages of its nearest pivot, then, with that k-th distance, only the pivots it still reaches.
Scores are exact integers: a product of floats of 24 or 53 bits is used where no sum of terms can leave these, as the largest
squared norm tells, and of 64-bit integers else. Distances only ever exclude, with a margin for rounding.

Equal vectors are kept once with their ``k + 1`` smallest ids: more can be in nobody's top k. Nothing else is left out.

Defined results: vectors that are null or have a null or non-finite component take no part, nor do rows without an id; a
shorter vector counts as followed by zeros; rows equal in id and vector count once; rows with the query's own id are never
its answers; with fewer than k candidates all are returned; ties go to the smaller id; an empty table gives no rows; extra
columns are not read. Integer scores must fit a long.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import store
from beaconry.session import shuffles_deleted, small_batches

SCALE = 1024
PIVOTS = 64
#: Vectors of a page, and numbers in them, at most.
PAGE, NUMBERS = 16_384, 1 << 20
FANOUT = 32
#: Queries that meet a page in one row.
BLOCK = 4096
#: Queries and vectors that are scored at once.
TILE, SCAN = 1024, 256
#: Stands for the score and id of a k-th best that there is not yet.
NONE = np.iinfo(np.int64).min
#: A node is scanned whole if more than this share of its children and queries is left.
WHOLE = 0.7


@dataclass
class Node:
    """Entries with their distance to the node's centre; an inner node's entries are nodes, a leaf's are vectors; ``rows``: all vectors below."""

    centre: int
    radius: float
    entries: np.ndarray
    to_parent: np.ndarray
    radii: np.ndarray
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)


@dataclass
class Page:
    """A piece of the tree: augmented points (not kept once it is built), exact integers, ids of each in order, and the root node."""

    points: np.ndarray | None
    exact: np.ndarray
    ids: list[list[int]]
    root: Node


@dataclass
class Found:
    """The best ``score, id`` of each query of a block so far, and what its next one has to beat."""

    k: int
    own: np.ndarray
    floor: np.ndarray
    last: np.ndarray
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    size: int = 0

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.own[query]
        self.held.append((query[other], score[other], ids[other]))
        self.size += int(other.sum())

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``query, score, id`` of the ``k`` best of each; the k-th is the new floor."""
        query, score, ids = (np.concatenate([h[i] for h in self.held]) for i in range(3)) if self.held else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(starts, append=len(query)))
        full = rank == self.k - 1
        self.floor[query[full]], self.last[query[full]] = score[full], ids[full]
        kept = rank < self.k
        self.held, self.size = [(query[kept], score[kept], ids[kept])], int(kept.sum())
        return self.held[0]


def _distances(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - at) ** 2).sum(1))


def _nearest(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Which of the heads is the nearest; of two at all but the same distance either."""
    return ((heads ** 2).sum(1) - 2 * (points @ heads.T)).argmin(1)


def build(points: np.ndarray, rows: np.ndarray, centre: int, fanout: int, rng: np.random.Generator) -> Node:
    """Bulk-load a node over ``rows``: at most as many pivots as the fan-out, each row to its nearest, and so on downwards; leaves have four times that."""
    to_centre = _distances(points[rows], points[centre])
    if len(rows) <= 4 * fanout:
        return Node(centre, float(to_centre.max(initial=0)), rows, to_centre, np.zeros(len(rows)), rows)
    seeds = rng.choice(rows, max(2, min(fanout, -(-len(rows) // (4 * fanout)))), replace=False)
    nearest = _nearest(points[rows], points[seeds])
    parts = [(int(s), rows[nearest == i]) for i, s in enumerate(seeds)]
    if max(len(p) for _, p in parts) == len(rows):  # all alike: cut evenly
        parts = [(int(p[0]), p) for p in np.array_split(rows, len(seeds))]
    children = [build(points, p, s, fanout, rng) for s, p in parts if len(p)]
    heads = np.array([c.centre for c in children])
    return Node(centre, float(to_centre.max(initial=0)), heads, _distances(points[heads], points[centre]), np.array([c.radius for c in children]), rows, children)


def exact_kind(norm: float) -> type:
    """What the products of vectors of at most this squared norm, and all sums of their terms, are exact in."""
    return np.float32 if norm < 1 << 24 else np.float64 if norm < 1 << 53 else np.int64


def search_block(page: Page, queries: np.ndarray, square: np.ndarray, own: np.ndarray, k: int, norm: float, floor: np.ndarray, last: np.ndarray,
                 counts: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The page's best ``query, score, id`` for each query of a block, as far as they can still be among its k best.

    ``queries``: exact integers, ``square`` their squared norms; ``floor, last``: score and id of the k-th best so far, :data:`NONE` if
    there are fewer. ``counts`` collects how many distances and scores were computed.
    """
    kind = exact_kind(max(norm, square.max(initial=0)))
    vectors, asked = page.exact.astype(kind), queries.astype(kind)
    many = np.array([len(i) for i in page.ids])
    ids, starts = np.concatenate([np.asarray(i, np.int64) for i in page.ids]), np.cumsum(many) - many
    square = square + norm
    slack, margin = 1e-6 * (square + norm + 1), 1e-6 + 1e-9 * np.sqrt(square)
    found, most = Found(k, own, floor.copy(), last.copy()), max(1 << 18, 4 * k * len(queries))

    def reach(at: np.ndarray) -> np.ndarray:
        """Farthest a vector with a score of the floor can be."""
        far = np.sqrt(np.maximum(0.0, square[at] - 2 * found.floor[at].astype(float) + slack[at])) + margin[at]
        return np.where(found.floor[at] == NONE, np.inf, far)

    def distances(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if counts is not None:
            counts[0] += len(at) * len(rows)
        return np.sqrt(np.maximum(0.0, square[at][:, None] - 2 * (asked[at] @ vectors[rows].T).astype(float)))

    def scan(rows: np.ndarray, at: np.ndarray) -> None:
        if counts is not None:
            counts[0] += len(at) * len(rows)
        for x in (rows[i:i + SCAN] for i in range(0, len(rows), SCAN)):
            some = vectors[x]
            for q in (at[i:i + TILE] for i in range(0, len(at), TILE)):
                scores, least = asked[q] @ some.T, found.floor[q]
                new = np.flatnonzero(least == NONE)
                if len(new) and len(x) > k + 1:  # of the k + 1 best vectors, one at most has the query's own id alone
                    least[new] = np.partition(scores[new], -k - 1, 1)[:, -k - 1]
                hit = np.flatnonzero(scores.max(1) >= least)
                i, j = np.nonzero(scores[hit] >= least[hit, None])
                i = hit[i]
                score, row, query = scores[i, j].astype(np.int64), x[j], q[i]
                ahead = (score > found.floor[query]) | (ids[starts[row]] < found.last[query])
                score, row, query = score[ahead], row[ahead], query[ahead]
                each = many[row]
                at_id = np.repeat(starts[row] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                found.add(np.repeat(query, each), np.repeat(score, each), ids[at_id])
            if found.size > most:
                found.best()
        if (found.floor[at] == NONE).any():
            found.best()

    every = np.arange(len(queries))
    heap, n = [(0, 0.0, 0, page.root, every, distances(every, np.array([page.root.centre]))[:, 0])], 0
    while heap:
        *_, node, at, dist = heapq.heappop(heap)
        near = dist - node.radius <= reach(at)  # floors have risen since
        at, dist = at[near], dist[near]
        if not len(at):
            continue
        far = reach(at)
        if not node.children:
            scan(node.rows[(node.to_parent >= (dist - far).min()) & (node.to_parent <= (dist + far).max())], at)
            continue
        left = np.abs(dist[:, None] - node.to_parent) - node.radii <= far[:, None]
        column = np.flatnonzero(left.any(0))
        if not len(column):
            continue
        d = distances(at, node.entries[column])
        low = d - node.radii[column]
        left = left[:, column] & (low <= far[:, None])
        lost = found.floor[at] == NONE
        if not lost.any() and left.sum() > WHOLE * len(at) * len(node.entries):
            scan(node.rows, at)
            continue
        first = np.where(lost, low.argmin(1), -1)  # without a floor, the nearest child goes ahead
        for c, i in enumerate(column.tolist()):
            for later in (0, 1):
                to = np.flatnonzero(left[:, c] & ((first != c) == later))
                if len(to):
                    n += 1
                    heapq.heappush(heap, (later, float(low[to, c].mean()), n, node.children[i], at[to], d[to, c]))
    return found.best()


def search(page: Page, query: np.ndarray, exact: np.ndarray, own: int, k: int, norm: float, floor: int | None,
           counts: list[int] | None = None) -> list[tuple[int, int]]:
    """:func:`search_block` for one query, in floats and exact integers: ``(score, id)``; ``floor``: its k-th best score so far."""
    so_far = np.array([NONE if floor is None else floor]), np.array([np.iinfo(np.int64).max])
    _, score, ids = search_block(page, exact[None], np.array([(query ** 2).sum()]), np.array([own]), k, norm, *so_far, counts)
    return list(zip(score.tolist(), ids.tolist()))


def integers(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``vec_id, v`` of the vectors that take part; v: integers."""
    raw = F.col("raw")
    whole = raw.isNotNull() & ~F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("raw"))
            .where(F.col("vec_id").isNotNull() & whole)
            .select("vec_id", F.transform(raw, lambda x: F.floor(x * scale).cast("long")).alias("v")).distinct())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    flat, sizes = np.asarray(column.flatten()).astype(np.int64), np.asarray(pc.list_value_length(column))
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes]) if len(flat) else np.zeros(0, int)] = flat
    return out


def _augmented(v: np.ndarray, norm: float) -> np.ndarray:
    v = v.astype(float)
    return np.concatenate([v, np.sqrt(np.maximum(0, norm - (v ** 2).sum(1)))[:, None]], 1)


def _plain(v: np.ndarray) -> np.ndarray:
    return np.concatenate([v.astype(float), np.zeros((len(v), 1))], 1)


@dataclass(frozen=True)
class Index:
    """The stored pages ``pivot, page, tree`` and what routes to them; the arrays have at most :data:`PIVOTS` rows. ``parts``: pages by pivot."""

    pages: DataFrame
    pivots: np.ndarray
    radii: np.ndarray
    parts: list[int]
    norm: float
    width: int

    @property
    def small(self) -> type:
        """The integers that vectors are moved as: no component exceeds the root of the largest squared norm."""
        return np.int16 if self.norm < 1 << 29 else np.int32 if self.norm < 1 << 61 else np.int64

    def parts_of(self, pivot: Column) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in self.parts]), pivot + 1)


def page_size(width: int) -> int:
    """Vectors of this width that a page, or queries that a block, has at most."""
    return max(FANOUT, min(PAGE, NUMBERS // max(1, width)))


def index(vectors: DataFrame, k: int, pivots: int = PIVOTS, page_rows: int | None = None, fanout: int = FANOUT) -> Index | None:
    """Build the tree over ``vec_id, v``; None if there are no vectors."""
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = vectors.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)  # cut before the shuffle, too
    distinct = store(kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "mtree-vectors")  # k + 1 ids at most
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    norm, width = distinct.agg(F.max(square), F.max(F.size("v"))).first()
    if norm is None:
        return None
    sample = distinct.orderBy(F.xxhash64("v"), "v").select("v").limit(pivots).toArrow()
    heads = _augmented(_matrix(sample.column(0).combine_chunks(), width), norm)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _augmented(_matrix(b.column(0), width), norm)
            near = _nearest(at, heads)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int32)), pa.array(_distances(at, heads[near]))],
                                             ["v", "ids", "pivot", "d"])

    routed = store(distinct.mapInArrow(route, "v array<long>, ids array<long>, pivot int, d double"), "mtree-routed")
    stats = {r[0]: (r[1], r[2]) for r in routed.groupBy("pivot").agg(F.max("d"), F.count("*")).collect()}  # a row for each pivot
    radii = np.array([stats.get(i, (-1.0, 0))[0] for i in range(len(heads))])
    each = page_rows or page_size(width)
    empty = Index(routed, heads, radii, [-(-stats.get(i, (0, 1))[1] // each) for i in range(len(heads))], float(norm), int(width))
    paged = routed.withColumn("page", F.pmod(F.xxhash64("v"), empty.parts_of(F.col("pivot"))).cast("int"))
    small = empty.small

    def load(key, table):
        exact = _matrix(table.column("v").combine_chunks(), width)
        order = np.lexsort(exact.T[::-1])
        held = table.column("ids").to_pylist()
        exact, ids = exact[order], [held[i] for i in order.tolist()]
        points = _augmented(exact, norm)
        middle = int(_distances(points, points.mean(0)).argmin())
        tree = build(points, np.arange(len(points)), middle, fanout, np.random.default_rng(len(points)))
        return pa.table({"pivot": [key[0].as_py()], "page": [key[1].as_py()], "tree": [pickle.dumps(Page(None, exact.astype(small), ids, tree))]},
                        pa.schema([("pivot", pa.int32()), ("page", pa.int32()), ("tree", pa.binary())]))

    pages = paged.groupBy("pivot", "page").applyInArrow(load, "pivot int, page int, tree binary")
    return replace(empty, pages=store(pages, "mtree-pages"))


def _visit(ix: Index, asked: DataFrame, k: int, blocks: int) -> DataFrame:
    """``q, query_id, vec_id, score`` of the rows ``q, query_id, qv, floor, last, pivot`` in the pages of their pivot.

    The queries of a pivot are packed into blocks; each meets each page of the pivot in one row.
    """
    width, norm, small = ix.width, ix.norm, ix.small

    def pack(key, table):
        columns = [np.asarray(table.column(c).fill_null(NONE)) for c in ("q", "query_id", "floor", "last")]
        queries = np.frombuffer(b"".join(table.column("qv").to_pylist()), small).reshape(-1, width)
        return pa.table({"pivot": [key[0].as_py()], "queries": [pickle.dumps((queries, *columns))]}, pa.schema([("pivot", pa.int32()), ("queries", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, page = None, None
        for b in batches:
            for at, number, tree, packed in zip(*(b.column(i) for i in range(4))):
                if last != (at, number):  # the blocks of a page come together
                    last, page = (at, number), pickle.loads(tree.as_py())
                queries, q, own, floor, held = pickle.loads(packed.as_py())
                of, score, ids = search_block(page, queries, (queries.astype(float) ** 2).sum(1), own, k, norm, floor, held)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q[of], own[of], ids, score)], ["q", "query_id", "vec_id", "score"])

    packed = asked.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int")).groupBy("pivot", "block").applyInArrow(pack, "pivot int, queries binary")
    met = packed.withColumn("page", F.explode(F.sequence(F.lit(0), ix.parts_of(F.col("pivot")) - 1)))
    return (ix.pages.join(met, ["pivot", "page"]).select("pivot", "page", "tree", "queries")
            .mapInArrow(run, "q long, query_id long, vec_id long, score long"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
          scale: int = SCALE, query_rows: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of each query over all other vectors."""
    spark = vectors.sparkSession
    with small_batches(spark), shuffles_deleted(spark):
        whole = store(integers(vectors, id_column, vector_column, scale), "mtree-integers")
        ix = index(whole, k)
        if ix is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        return _searched(ix, whole.where(is_query).select("vec_id", "v"), k, min(query_rows, page_size(ix.width)))


def _searched(ix: Index, asked: DataFrame, k: int, query_rows: int) -> DataFrame:
    """The ranked answers to the queries ``vec_id, v``; every step but the last is stored."""
    heads, radii, norm, width, small = ix.pivots, ix.radii, ix.norm, ix.width, ix.small

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = _matrix(b.column(1), width)
            q = _plain(own)
            pivot = np.stack([np.where(r < 0, np.inf, _distances(q, h)) for h, r in zip(heads, radii)]).argmin(0) if len(q) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.tobytes() for v in own.astype(small)], pa.binary()), pa.array(pivot.astype(np.int32))],
                                             ["query_id", "qv", "pivot"])

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every further pivot whose ball the query's k-th distance reaches."""
        for b in batches:
            q = _plain(np.frombuffer(b"".join(b.column(2).to_pylist()), small).reshape(-1, width))
            floor = np.array([np.nan if x is None else x for x in b.column(3).to_pylist()], float)
            square = (q ** 2).sum(1) + norm
            far = np.where(np.isnan(floor), np.inf, np.sqrt(np.maximum(0, square - 2 * floor + 1e-6 * (square + norm + 1))))
            used = np.asarray(b.column(5))
            for i, (h, r) in enumerate(zip(heads, radii)):
                hit = np.flatnonzero((r >= 0) & (_distances(q, h) - r <= far + 1e-6) & (used != i))
                if len(hit):
                    part = b.take(pa.array(hit))
                    yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(np.full(len(hit), i, np.int32))], part.schema.names)

    names = ["q", "query_id", "qv", "floor", "last", "pivot"]
    none = F.lit(None).cast("long")
    # rows with one id may hold different vectors, so queries get numbers of their own
    start = asked.mapInArrow(nearest, "query_id long, qv binary, pivot int").withColumn("q", F.monotonically_increasing_id())
    start = store(start, "mtree-queries")
    most, every = start.groupBy("pivot").count().agg(F.max("count"), F.sum("count")).first()
    blocks = lambda n: max(1, -(-(n or 0) // query_rows))
    first = start.withColumn("floor", none).withColumn("last", none).select(*names)
    near = store(_ranked(_visit(ix, first, k, blocks(most)), k), "mtree-near")
    floors = near.where(F.col("rank") == k).select("q", F.col("score").alias("floor"), F.col("vec_id").alias("last"))
    onward = start.join(floors, "q", "left").select(*names).mapInArrow(reached, "q long, query_id long, qv binary, floor long, last long, pivot int")
    rest = store(_visit(ix, onward, k, blocks(every)), "mtree-rest")
    return _ranked(near.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


#: The same by comparing every query with every vector.
SQL = f"""
WITH x AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id AS vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i]))::BIGINT AS score
      FROM x AS q JOIN x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
