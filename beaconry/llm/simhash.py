"""SimHash near-duplicates, linked through segment popcounts.

A fingerprint of 64 bits is cut into 32 segments of two bits, and each segment is mapped to the number of its set bits.
The Manhattan distance of two such count vectors never exceeds the Hamming distance of the fingerprints, so pairs within
distance ``d`` of each other lie within Manhattan distance ``d``. Those are found by a grid join: the vector is divided
into six bands of segments, and a difference of 3 can touch at most three bands, so the two vectors fall into the same
grid cell of at least one choice of three bands. Rows meet by cell (20 cells for each distinct fingerprint), candidates are
tested by Manhattan distance first and by Hamming distance last. No link is lost and none is approximate.

Exact copies share one fingerprint and take part once. A cell with many fingerprints is dealt out as pairs of blocks, so
no task ever holds more than two blocks of a cell, and each task reports a spanning forest of the links it found instead
of all pairs. Components come from alternating large-star and small-star rounds on the stored links.

The filter :func:`one_of_each` of the pipeline has a rule of its own, see :mod:`beaconry.llm.alike`.

Defined results: a null or empty text, or one of separators only, has fingerprint zero and links like any other; a text of
one or two words has one shingle, the whole sequence; a null id keeps its row and never names a component unless the whole
component has none (then ``component_id`` is null); repeated rows give repeated rows; an empty table gives no rows; extra
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from beaconry.llm.common import documents, store, word_blocks

SEED = 42
DISTANCE = 3
BANDS = 6
#: Fingerprints of a cell that one task compares at once; larger cells are dealt out as pairs of blocks.
BLOCK = 1024

_EVEN = np.uint64(0x5555555555555555)
#: Bits of each band: whole two-bit segments, as even as 32 segments allow.
_BAND_BITS = [np.uint64(sum(3 << (2 * s) for s in range(32) if s * BANDS // 32 == b)) for b in range(BANDS)]
_CELLS = [np.bitwise_or.reduce([_BAND_BITS[b] for b in kept]) for kept in combinations(range(BANDS), BANDS - DISTANCE)]


def shingles(data: bytes, width: int) -> Iterator[np.ndarray]:
    """64-bit hashes of the runs of ``width`` words, block by block; a shorter text has one, the whole sequence."""
    carry: list[bytes] = []
    some = False
    for block in word_blocks(data):
        words = carry + block
        if len(words) < width:
            carry = words
            continue
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda a, b: a + 1 + b))
        starts = [0, *(e + 1 for e in ends[:-1])]
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:])], np.uint64)
        some = True
        carry = words[len(words) - width + 1:] if width > 1 else []
    if not some and carry:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(text: str | bytes | None, width: int = 3) -> int:
    """The 64-bit fingerprint of one whole text as an unsigned integer."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingles(data.lower(), width):
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big") if n else 0


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``) and ``fp`` (signed long) of every row; one pass, no shuffle."""
    keep = keep or ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.array([fingerprint(t) for t in b.column(0).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(values)], [*keep, "fp"])

    out = StructType([*docs.select(*keep).schema.fields]).add("fp", LongType())
    return docs.select(F.col("text").cast("string").alias("_t"), *keep).mapInArrow(run, out)


def popcounts(fp: np.ndarray) -> np.ndarray:
    """The counts of the two-bit segments, packed in place: each two-bit field holds 0, 1 or 2."""
    return (fp & _EVEN) + ((fp >> np.uint64(1)) & _EVEN)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed count vectors. Under xor, counts 0 and 1 give 01, 1 and 2 give 11, 0 and 2 give 10."""
    low, high = (a ^ b) & _EVEN, ((a ^ b) >> np.uint64(1)) & _EVEN
    return np.bitwise_count(low).astype(np.int64) + 2 * np.bitwise_count(high & ~low)


def cells(fps: DataFrame) -> DataFrame:
    """``cell, fp``: each distinct fingerprint in the grid cells of its packed counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0)).view(np.uint64)
            counts = popcounts(fp)
            for i, mask in enumerate(_CELLS):
                # if two cells ever share a key, their rows are merely compared once more
                key = ((counts & mask) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(i * 0xBF58476D1CE4E5B9 % 2 ** 64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), b.column(0)], ["cell", "fp"])

    return fps.mapInArrow(run, "cell long, fp long")


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links ``a, b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_of(part: np.ndarray, block: np.ndarray, cross: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within runs of equal ``part``: pairs (fingerprint, smaller one it reaches).

    Where ``cross`` is set only rows of different ``block`` are compared; others were compared in a part of their own.
    Rows are compared with those 1, 2, 3, ... places further on, as long as any part is that long.
    """
    counts = popcounts(fp)
    found_a, found_b, kept = [], [], 0
    at = np.arange(len(fp))
    nodes, index = np.unique(fp, return_inverse=True)

    def forest(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        x, y = index[np.concatenate(a)], index[np.concatenate(b)]
        root = roots(x, y, len(nodes))
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return moved, root[moved]

    first_of = {}
    step = 0
    while len(at):
        step += 1
        at = at[at + step < len(fp)]
        at = at[part[at] == part[at + step]]
        far = at + step
        near = ~cross[at] | (block[at] != block[far])
        x, y = at[near], far[near]
        ok = manhattan(counts[x], counts[y]) <= DISTANCE
        x, y = x[ok], y[ok]
        ok = np.bitwise_count(fp[x] ^ fp[y]) <= DISTANCE
        if ok.any():
            found_a.append(x[ok])
            found_b.append(y[ok])
            kept += int(ok.sum())
            if kept > 1_000_000:  # many links: fold them into a forest, keep one row index per node
                moved, root = forest(found_a, found_b)
                if not first_of:
                    _, first = np.unique(fp, return_index=True)
                    first_of = dict(enumerate(first.tolist()))
                found_a = [np.array([first_of[i] for i in moved.tolist()], np.int64)]
                found_b = [np.array([first_of[i] for i in root.tolist()], np.int64)]
                kept = len(moved)
    if not found_a:
        return fp[:0], fp[:0]
    moved, root = forest(found_a, found_b)
    return nodes[moved], nodes[root]


def candidates(grid: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """``cell, low, high, block, fp``: cells with at least two fingerprints; large ones as pairs of blocks."""
    sized = grid.withColumn("n", F.count("*").over(Window.partitionBy("cell"))).where("n > 1")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(other, F.col("block")).alias("low"), F.greatest(other, F.col("block")).alias("high")))
    return (sized.withColumn("blocks", blocks).withColumn("block", own)
            .select("cell", "fp", "block", F.explode(pairs).alias("pair"))
            .select("cell", F.col("pair.low").alias("low"), F.col("pair.high").alias("high"), "block", "fp"))


def links(fps: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """``a, b``: links whose components are those of all fingerprints within :data:`DISTANCE` bits."""
    met = candidates(cells(fps), block_rows).repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def find(rows: np.ndarray) -> pa.RecordBatch:
            cell, low, high, block, fp = rows
            new = np.append(True, (cell[1:] != cell[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
            a, b = links_of(np.cumsum(new), block, low != high, fp.view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([np.asarray(c).astype(np.int64) for c in batch.columns]))
            rows = np.concatenate(held, 1)
            if rows.shape[1] < 50_000:
                held = [rows]
                continue
            last = rows[:3, -1:]
            cut = rows.shape[1] - int((rows[:3] == last).all(0)[::-1].cumprod().sum())  # the last part may go on
            if cut:
                yield find(rows[:, :cut])
            held = [rows[:, cut:]]
        if held and held[0].shape[1]:
            yield find(np.concatenate(held, 1))

    return met.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, parts: int = 8, label: str = "simhash", most_rounds: int = 60) -> DataFrame:
    """``fp, root``: the smallest node each linked node reaches, by large-star and small-star rounds.

    Every round stores its links in the shared folder, in ``parts`` files. A hub's links are only ever aggregated by ``min``
    and joined row by row, so a star with millions of leaves is split like any skewed join.
    """
    edges = store(edges.distinct().coalesce(parts), f"{label}-links")
    for _ in range(most_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a != b").distinct())
        edges = store(small.coalesce(parts), f"{label}-round")
        # a star forest is reached when every node starts one link at most, and none that ends a link starts one
        ends = edges.select("a", F.lit(1).alias("out"), F.lit(0).alias("in")).union(edges.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("a").agg(F.sum("out").alias("out"), F.max("in").alias("in")).where("out > 1 or (out > 0 and in > 0)").isEmpty():
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    raise RuntimeError("components did not settle")


def grouped(docs: DataFrame, block_rows: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp`` of every document, stored, and ``fp, root, component_id`` of every fingerprint.

    ``root`` is the fingerprint that stands for the component.
    """
    marked = store(fingerprints(documents(docs)), "fingerprints")
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    linked = components(links(first.select("fp"), block_rows), max(1, -(-marked.count() // 500_000)))
    rooted = first.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "doc_id")
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return marked, rooted.select("fp", "root").join(ids, "root").select("fp", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of texts that share most runs of five words, see :func:`beaconry.llm.alike.one_of_each`."""
    from beaconry.llm import alike
    return alike.one_of_each(docs)


def near_duplicates(docs: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document."""
    marked, groups = grouped(docs, block_rows)
    return marked.join(groups, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
