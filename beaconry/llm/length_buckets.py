"""Packing into optimal length buckets.

The length of a document is its UTF-8 bytes plus one for the end mark, the token count of a byte-level vocabulary. A
document longer than ``longest`` is cut into pieces of that length and a rest, so every byte is packed. The global
histogram of piece lengths has at most ``longest / align`` cells whatever the input, and dynamic programming over it
chooses the bucket boundaries with the least padding. Inside a bucket pieces are numbered without gaps and fill batches of
``budget // boundary`` rows, so that a batch padded to its boundary never exceeds the token budget.

Defined results: a null text counts as empty and is one piece of one token; a null id keeps its row; repeated rows are
packed each; ties in length are ordered by id and piece; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import documents, numbered, store

LONGEST = 8192
ALIGN = 8
BUCKETS = 12
BUDGET = 65_536


def boundaries(cells: np.ndarray, counts: np.ndarray, tokens: np.ndarray, buckets: int) -> list[int]:
    """Ends of at most ``buckets`` buckets over ascending ``cells`` (padded lengths) with the least padding in all.

    ``counts`` and ``tokens`` are pieces and tokens of each cell. A bucket over cells i..j pads its pieces to cell j.
    """
    n = len(cells)
    if not n:
        return []
    pieces, used = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(tokens))
    best = np.full(n + 1, np.inf)
    best[0] = 0
    backs = []
    for _ in range(min(buckets, n)):
        cost, back = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        cost[0] = 0
        for j in range(1, n + 1):
            total = best[:j] + cells[j - 1] * (pieces[j] - pieces[:j]) - (used[j] - used[:j])
            back[j] = total.argmin()
            cost[j] = total[back[j]]
        best = cost
        backs.append(back)
    ends, j = [], n
    for back in reversed(backs):
        if j:
            ends.append(int(cells[j - 1]))
            j = int(back[j])
    return sorted(ends)


def pieces(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``doc_id, piece, start, length``: every document in pieces of at most ``longest`` tokens; positions in tokens."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1
    numbers = F.sequence(F.lit(0), F.floor((F.col("size") - 1) / longest).cast("int"))
    return (documents(docs).select("doc_id", size.alias("size")).select("doc_id", "size", F.explode(numbers).alias("piece"))
            .select("doc_id", "piece", (F.col("piece").cast("long") * longest).alias("start"),
                    F.least(F.lit(longest), F.col("size") - F.col("piece").cast("long") * longest).cast("int").alias("length")))


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, longest: int = LONGEST, align: int = ALIGN,
         chunk_rows: int = 100_000) -> DataFrame:
    """``doc_id, piece, start, length, bucket, boundary, batch, row, padding`` for every piece."""
    cut = store(pieces(docs, longest), "pieces")
    cell = (F.ceil(F.col("length") / align) * align).cast("int")
    histogram = sorted(tuple(r) for r in cut.groupBy(cell.alias("cell")).agg(F.count("*"), F.sum("length")).collect())  # longest / align rows
    cells, counts, tokens = (np.array([h[k] for h in histogram], float) for k in range(3))
    ends = boundaries(cells, counts, tokens, buckets)
    bucket = F.lit(len(ends) - 1)
    for i in reversed(range(len(ends) - 1)):
        bucket = F.when(F.col("length") <= ends[i], i).otherwise(bucket)
    ended = F.element_at(F.array(*[F.lit(e) for e in ends or [longest]]), F.col("bucket") + 1)
    placed = cut.withColumn("bucket", bucket.cast("int")).withColumn("boundary", ended)
    chunks = max(1, -(-int(counts.sum()) // chunk_rows)) if len(counts) else 1
    slots = numbered(placed, "bucket", ["length", "doc_id", "piece"], "slot", chunks)
    rows = F.floor(F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("boundary"))))
    return slots.select("doc_id", "piece", "start", "length", "bucket", "boundary", F.floor(F.col("slot") / rows).alias("batch"),
                        (F.col("slot") % rows).cast("int").alias("row"), (F.col("boundary") - F.col("length")).alias("padding"))
