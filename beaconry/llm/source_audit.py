"""How far the sources of a language differ in their use of terms.

A term is a run of ASCII letters and non-ASCII characters, with A-Z lower-cased. Texts are taken as bytes in blocks: a table
of 256 entries marks the bytes of terms, and the runs are packed by length. Up to eight bytes become one unsigned 64-bit
word, up to sixteen two words, with the first byte on top, so that words sort like bytes. A radix sort, one stable
counting pass for every 16 bits that differ, brings equal terms together, and runs of equal ones are counted. Longer terms lie in buckets
of one length each, sorted as bytes. What leaves a task is one row per language, source and term of a block; Spark adds them up.

A term is kept if at least ``least_docs`` documents of its language have it. Shares are integers,
``1 + scale * (count + 1) // (total + terms)``, in exact decimals. Every pair of a language's sources is compared over all
kept terms: terms are dealt out by a hash into groups of bounded size, and each adds up a matrix of its sources.

Defined results: null text, language or source count as empty; null ids are not read; repeated rows are documents of their
own; texts of any length are counted whole; every language and source that occurs has its rows, without kept terms with
value 0; ties go by the bytes of the item; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import store

LEAST_DOCS = 3
SCALE = 1_000_000_000
#: Ranks of the terms that a source is reported with.
TOP_TERMS = 200
#: Bytes of text that are sorted at once.
BLOCK = 8 << 20
#: Rows of kept terms that one task compares between sources.
PAIR_ROWS = 400_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[97:123] = _TERM[128:] = True  # after lower-casing


class Runs(NamedTuple):
    """Counted terms of one kind: the unit (a document's number in the block) of each, its key, and how often it occurs."""

    unit: np.ndarray
    key: np.ndarray
    n: np.ndarray


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by unsigned words, the first the most significant: 16 bits a pass, least significant first."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        word = word.astype(np.uint64, copy=False)
        spread = int(np.bitwise_or.reduce(word ^ word[:1])) if len(word) else 0  # bits that differ somewhere
        for shift in (0, 16, 32, 48):
            if spread >> shift & 0xFFFF:
                digit = (word[order] >> np.uint64(shift)).astype(np.uint16)
                order = order[np.argsort(digit, kind="stable")]  # a counting sort for 16-bit digits
    return order


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where a new run of equal rows begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _packed(data: np.ndarray, start: np.ndarray, size: np.ndarray, words: int) -> np.ndarray:
    """The runs as rows of big-endian words, zeros behind the end. ``data`` goes on for 16 bytes after the last run."""
    at = np.arange(8 * words)
    taken = data[start[:, None] + at]
    taken[at >= size[:, None]] = 0
    return taken.view(">u8").astype(np.uint64)


def count_terms(data: np.ndarray, unit_starts: np.ndarray) -> dict[int, Runs]:
    """Counted terms of every unit, by kind: 1 and 2 for packed words, the length for longer ones.

    ``data`` holds lower-cased bytes, with a byte that is in no term between units; a unit's bytes begin at ``unit_starts``.
    """
    inside = np.concatenate([[False], _TERM[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    unit = np.searchsorted(unit_starts, start, side="right") - 1
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    found = {}
    kinds = np.where(size <= 8, 1, np.where(size <= 16, 2, size))
    for kind in np.unique(kinds).tolist():
        these = np.flatnonzero(kinds == kind)
        if kind <= 2:
            key = _packed(padded, start[these], size[these], kind)
            order = radix_order([unit[these].astype(np.uint64), *key.T])
        else:
            key = np.frombuffer(b"".join([data[a:a + kind].tobytes() for a in start[these].tolist()]), f"S{kind}")[:, None]
            order = np.lexsort((key[:, 0], unit[these]))
        found[kind] = _counted(unit[these][order], key[order], np.ones(len(these), np.int64))
    return found


def _counted(unit: np.ndarray, key: np.ndarray, n: np.ndarray) -> Runs:
    first = run_starts([unit, *key.T])
    return Runs(unit[first], key[first], np.add.reduceat(n, first) if len(first) else n)


def by_group(runs: Runs, group_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``group, key, occurrences, units`` of each term of each group of units."""
    group = group_of[runs.unit]
    order = radix_order([group.astype(np.uint64), *runs.key.T]) if runs.key.dtype == np.uint64 else np.lexsort((runs.key[:, 0], group))
    group, key, n = group[order], runs.key[order], runs.n[order]
    first = run_starts([group, *key.T])
    return group[first], key[first], np.add.reduceat(n, first), np.diff(np.append(first, len(group)))


def terms_of(key: np.ndarray) -> list[bytes]:
    """Packed keys back as bytes; no term holds a zero byte, so the zeros at the end are padding."""
    if key.dtype == np.uint64:
        return key.astype(">u8").view(f"S{8 * key.shape[1]}")[:, 0].tolist()
    return key[:, 0].tolist()


def _long_text(data: np.ndarray, block: int) -> dict[int, Runs]:
    """One unit of any length: pieces cut outside terms, their counts folded together, so that only terms are held."""
    found: dict[int, Runs] = {}
    at = 0
    while at < len(data):
        end = min(at + block, len(data))
        while end < len(data) and _TERM[data[end]]:  # at the longest to the end of a term
            end += 1
        for kind, r in count_terms(data[at:end], np.zeros(1, np.int64)).items():
            if kind in found:
                key, n = np.concatenate([found[kind].key, r.key]), np.concatenate([found[kind].n, r.n])
                order = radix_order([*key.T]) if key.dtype == np.uint64 else np.argsort(key[:, 0], kind="stable")
                r = _counted(np.zeros(len(key), np.int64), key[order], n[order])
            found[kind] = r
        at = end
    return found


def counted(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``lang, source, term, n, docs`` per block of texts: occurrences, and documents that have the term."""
    out = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def emit(found: dict[int, Runs], group_of: np.ndarray, groups: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        for runs in found.values():
            group, key, n, units = by_group(runs, group_of)
            for a in range(0, len(group), 100_000):
                names = [groups[g] for g in group[a:a + 100_000].tolist()]
                terms = pa.array(terms_of(key[a:a + 100_000]), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.string()), terms,
                                                  pa.array(n[a:a + 100_000]), pa.array(units[a:a + 100_000])], schema=out)

    def finish(held: list[tuple[tuple[str, str], np.ndarray]]) -> Iterator[pa.RecordBatch]:
        groups = sorted({g for g, _ in held})
        place = {g: i for i, g in enumerate(groups)}
        gap = np.zeros(1, np.uint8)
        data = np.concatenate([x for _, text in held for x in (text, gap)])
        starts = np.cumsum([0, *(len(text) + 1 for _, text in held[:-1])])
        yield from emit(count_terms(data, starts), np.array([place[g] for g, _ in held]), groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                data = _LOWER[np.frombuffer(text.as_buffer(), np.uint8)]
                if len(data) > block:
                    yield from emit(_long_text(data, block), np.zeros(1, np.int64), [(lang, source)])
                    continue
                held.append(((lang, source), data))
                size += len(data) + 1
                if size > block:
                    yield from finish(held)
                    held, size = [], 0
        if held:
            yield from finish(held)

    some = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*some).where("text <> ''").mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: str, total: str, terms: str) -> Column:
    """``1 + scale * (count + 1) // (total + terms)`` in exact decimals; without terms nothing is divided."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10, 0)) * (CAST({count} AS DECIMAL(19, 0)) + 1) div greatest(1, CAST({total} AS DECIMAL(19, 0)) + CAST({terms} AS DECIMAL(12, 0)))")


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, term, n, lang_n, head``: the kept terms with a source's and the language's count.

    ``head`` is 1 on one row of each term of a language, so that its terms can be counted without a distinct.
    """
    once = counted(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")  # one row per source at most
    whole = once.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term), "first": F.min("source").over(term)})
    return whole.where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", (F.col("source") == F.col("first")).cast("int").alias("head"))


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, place, total, lang_total, terms, sources, rows`` of every group that occurs."""
    some = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("head").alias("heads"), F.count("*").alias("own_rows"))
    lang = Window.partitionBy("lang")  # sources of a language
    zero = lambda c: F.coalesce(F.sum(c).over(lang), F.lit(0)).alias(c)
    return (some.join(own, ["lang", "source"], "left")
            .select("lang", "source", (F.row_number().over(lang.orderBy("source")) - 1).cast("int").alias("place"), F.coalesce("total", F.lit(0)).alias("total"),
                    zero("total").alias("lang_total"), zero("heads").alias("terms"), zero("own_rows").alias("rows")))


def pair_values(shares: DataFrame, sources: DataFrame, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """``lang, a, b, value`` by place of the sources: the sum over all kept terms of ``(p - q) ** 2 // q``.

    ``shares`` has ``lang, term, place, p`` where a source has the term; elsewhere it has the share ``p0`` of ``sources``.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("rows") / pair_rows)).cast("int")
    dealt = shares.withColumn("part", F.pmod(F.xxhash64("term"), F.ceil(F.col("rows") / pair_rows)).cast("int")).select("lang", "part", "term", F.col("place").alias("a"), "p").toDF("lang", "part", "term", "a", "p")
    frames = sources.select("lang", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("place").alias("b"), "p0").toDF("lang", "part", "b", "p0")

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        place, base = np.asarray(right["b"]), np.asarray(right["p0"])
        base = base[np.argsort(place)]
        size = len(base)
        total = np.zeros((size, size), np.int64)
        if left.num_rows:
            _, row = np.unique(left["term"].to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
            order = np.argsort(row, kind="stable")
            row, at, p = row[order], np.asarray(left["a"])[order], np.asarray(left["p"])[order]
            step = max(1, (1 << 20) // size)  # terms of a dense block of a million shares
            for first in range(0, int(row[-1]) + 1, step):
                lo, hi = np.searchsorted(row, [first, first + step])
                block = np.tile(base, (min(step, int(row[-1]) + 1 - first), 1))
                block[row[lo:hi] - first, at[lo:hi]] = p[lo:hi]
                for a in range(size):
                    apart = block[:, a:a + 1] - block
                    total[a] += (apart * apart // block).sum(0)
        a, b = np.nonzero(~np.eye(size, dtype=bool))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "value": pa.array(total[a, b])})

    sums = dealt.groupBy("lang", "part").cogroup(frames.groupBy("lang", "part")).applyInArrow(compare, "lang string, a int, b int, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """``lang, source, part, item, value, rank``: each source against the others of its language, and its own terms."""
    kept = store(kept_terms(docs, least_docs), "audit-kept")
    known = store(groups(docs, kept), "audit-groups")
    known = known.withColumn("p0", share("0", "total", "terms"))
    shares = (kept.join(known, ["lang", "source"])
              .select("lang", "source", "place", "term", "rows", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q")))
    own = (shares.where("p > q").withColumn("value", F.expr("(p - q) * (p - q) div q"))
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))).where(F.col("rank") <= top_terms)
           .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))
    name = known.select("lang", "source", "place")
    values = (pair_values(shares, known.select("lang", "place", "rows", "p0"), pair_rows)
              .join(name.withColumnRenamed("place", "a"), ["lang", "a"]).join(name.select("lang", F.col("source").alias("item"), F.col("place").alias("b")), ["lang", "b"]))
    pairs = values.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                          F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank"))
    return pairs.unionByName(own)


#: The same in SQL, with every kept term against every pair of sources.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
t AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
             (1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (t.total + v.v))::BIGINT AS p,
             (1 + {SCALE}::HUGEINT * (k.n + 1) // (v.total + v.v))::BIGINT AS q
      FROM t JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
