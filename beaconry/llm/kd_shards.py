"""Sharding by a k-d tree over document metadata.

A node is cut at the weighted median (weight: bytes) along its widest dimension, until there are as many leaves as shards
or leaves reach the target bytes. Dimensions are source, language and the logarithm of the size, each scaled to its global
range; texts that tie on a dimension are ordered by the crc32 of the text.

Medians are found on the cluster: the 63-bit order key is narrowed 13 bits at a time by grouped sums of bytes for all
nodes of a level together, so the driver sees at most 8192 sums for each node and pass, whatever the input.

Equal texts share their coordinates (the least of their sources and languages) and so stay in one shard, except a group of
copies heavier than a whole shard: its rows are ordered by a hash of the id instead and may be cut.

Defined results: a null text has size 1 and crc32 0, like an empty one; null metadata sorts first; a null id keeps its row;
repeated rows are placed each; an empty table gives no rows; columns other than those named are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import numbered, store

DIMENSIONS = ("source", "lang", "size")
_DIGIT, _KEY_BITS = 13, 63
_SCALE = 2 ** 31 - 1


@dataclass(frozen=True)
class Node:
    """A leaf has a shard number; another node a dimension, the last order key of its left side, and two children."""

    shard: int = -1
    dimension: int = -1
    cut: int = -1
    left: Node | None = None
    right: Node | None = None


def placed_rows(docs: DataFrame, shards: int | None, target_bytes: int | None) -> tuple[DataFrame, int]:
    """``doc_id, size, text_crc32, tie, d0, d1, ...`` of every row, stored, and the number of shards."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def code(c: str) -> Column:
        if c not in docs.columns:
            return F.lit(0).cast("long")
        return F.when(F.col(c).isNull(), 0).otherwise(F.shiftrightunsigned(F.xxhash64(F.col(c).cast("string")), 33))

    marked = store(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"),
        *[code(c).alias(c) for c in DIMENSIONS if c != "size"]), "kd-rows")
    group = ["size", "text_crc32", "h"]
    groups = marked.groupBy(*group).agg(F.sum("size").alias("bytes"), *[F.min(c).alias(f"g_{c}") for c in DIMENSIONS if c != "size"])
    groups = store(groups.withColumn("g_size", F.log("size")), "kd-groups")
    total = groups.agg(F.sum("bytes"), *[f(f"g_{c}").cast("double") for c in DIMENSIONS for f in (F.min, F.max)]).first()
    n = shards or max(1, math.ceil((total[0] or 0) / target_bytes))
    heavy = [tuple(r) for r in groups.where(F.col("bytes") * n > (total[0] or 0)).select(*group).collect()] if n > 1 else []  # fewer than n
    is_heavy = F.lit(False)
    for key in heavy:
        is_heavy = is_heavy | ((F.col("size") == key[0]) & (F.col("text_crc32") == key[1]) & (F.col("h") == key[2]))
    scaled = []
    for i, c in enumerate(DIMENSIONS):
        low, high = total[1 + 2 * i], total[2 + 2 * i]
        share = (F.col(f"g_{c}") - low) / (high - low) if low is not None and high > low else F.lit(0.0)
        scaled.append(F.floor(share * _SCALE).cast("long").alias(f"d{i}"))
    tie = F.when(is_heavy, F.pmod(F.xxhash64("doc_id"), F.lit(2 ** 32))).otherwise(F.col("text_crc32"))
    rows = marked.join(groups, group).select("doc_id", "size", "text_crc32", tie.alias("tie"), *scaled)
    return store(rows, "kd-placed"), n


def _key(dimension: int) -> Column:
    return F.shiftleft(F.col(f"d{dimension}"), 32) + F.col("tie")


def build(rows: DataFrame, shards: int, tolerance: float) -> tuple[Node, Column]:
    """The tree, and the shard of a row as an expression over its coordinates.

    A cut is settled once the sum it could still move is no more than ``tolerance`` of the node's bytes.
    """
    open_: dict[int, int] = {1: shards}  # heap number of a node and the leaves below it
    cuts: dict[int, tuple[int, int]] = {}
    where = F.lit(1).cast("long")
    while any(m > 1 for m in open_.values()):
        many = [k for k, m in open_.items() if m > 1]
        at = rows.withColumn("node", where).where(F.col("node").isin(many))
        spans = [(F.max(f"d{i}") - F.min(f"d{i}")).alias(f"w{i}") for i in range(len(DIMENSIONS))]
        stats = {r["node"]: r for r in at.groupBy("node").agg(F.sum("size").alias("bytes"), *spans).collect()}  # one row a node
        dimension = {k: max(range(len(DIMENSIONS)), key=lambda i: (stats[k][f"w{i}"], -i)) if k in stats else 0 for k in many}
        goal = {k: (stats[k]["bytes"] if k in stats else 0) * (open_[k] // 2) / open_[k] for k in many}
        prefix, before, settled = {k: 0 for k in many}, {k: 0 for k in many}, {k: -1 for k in many if k not in stats}
        shift = _KEY_BITS
        while len(settled) < len(many):
            last, shift = shift, max(0, shift - _DIGIT)
            key = F.lit(None).cast("long")
            mine = F.lit(False)
            for k in many:
                if k not in settled:
                    key = F.when(F.col("node") == k, _key(dimension[k])).otherwise(key)
                    mine = mine | ((F.col("node") == k) & (F.shiftright(_key(dimension[k]), last) == prefix[k]))
            sums = at.where(mine).groupBy("node", F.shiftright(key, shift).alias("digit")).agg(F.sum("size").alias("bytes")).collect()  # 8192 rows a node at most
            for k in [k for k in many if k not in settled]:
                own = sorted((r["digit"], r["bytes"]) for r in sums if r["node"] == k)
                ends = before[k] + np.cumsum([b for _, b in own])
                i = min(int(np.searchsorted(ends, goal[k])), len(own) - 1)
                start = int(ends[i] - own[i][1])
                if shift == 0 or own[i][1] <= tolerance * stats[k]["bytes"]:
                    # the end of this part or of the one before it, whichever is nearer to the goal
                    through = own[i][0] if ends[i] - goal[k] <= goal[k] - start else own[i][0] - 1
                    settled[k] = ((through + 1) << shift) - 1
                else:
                    prefix[k], before[k] = own[i][0], start
        for k in many:
            cuts[k] = (dimension[k], settled[k])
            where = F.when(where == k, F.when(_key(dimension[k]) <= settled[k], 2 * k).otherwise(2 * k + 1)).otherwise(where)
        open_ = {c: n for k, m in open_.items() for c, n in (((2 * k, m // 2), (2 * k + 1, m - m // 2)) if m > 1 else ((k, m),))}

    counter = iter(range(shards))

    def tree(k: int) -> Node:
        return Node(dimension=cuts[k][0], cut=cuts[k][1], left=tree(2 * k), right=tree(2 * k + 1)) if k in cuts else Node(shard=next(counter))

    root = tree(1)

    def placed(n: Node) -> Column:
        return F.lit(n.shard) if n.left is None else F.when(_key(n.dimension) <= n.cut, placed(n.left)).otherwise(placed(n.right))

    return root, placed(root)


def shard(docs: DataFrame, shards: int | None = 8, target_bytes: int | None = None, tolerance: float = 0.001,
          chunk_rows: int = 100_000) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; shards hold nearly equal bytes."""
    rows, n = placed_rows(docs, shards, target_bytes)
    total = rows.count()
    _, where = build(rows, n, tolerance)
    at = rows.withColumn("shard", where.cast("int"))
    out = numbered(at, "shard", ["doc_id", "size", "text_crc32"], "slot", max(1, math.ceil(total / n / chunk_rows)))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
