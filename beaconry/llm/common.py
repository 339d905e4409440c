"""Shared pieces: tables, folds, bounded labelled samples, word blocks, distributed numbering."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beaconry.session import pin

#: The six ASCII separators of a word; ``bytes.split()`` splits on the same set.
SEPARATORS = r"\x20\x09-\x0D"
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that further columns, whatever their names, cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in blocks of about ``size`` bytes, cut at separators, so that a huge text needs no huge list."""
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        gap = _GAP.search(data, min(at + size, len(data)))
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end + 1


def labelled_ids(labels: DataFrame, column: str, parts: int, held_out: int, limit: int, only: int | None = None) -> DataFrame:
    """At most ``limit`` training ids with their label, chosen by a hash of the id; of one label with ``only``.

    Rows of the held-out fold, null ids and labels other than 0 and 1 take no part; an id labelled both ways counts as 1.
    """
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)))
    known = near_hash(rows.where(fold(F.col("doc_id"), parts) != held_out), "doc_id", limit, labels.count(), 50)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return (known.where(F.col("label") == only if only is not None else F.lit(True))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def near_hash(rows: DataFrame, key: str, limit: int, total: int, spread: int) -> DataFrame:
    """The rows whose hash of ``key`` lies in the first ``spread * limit / total`` of all hashes.

    A sample of ``limit`` rows in the order of the hash is taken from these, so that at any size tasks send the driver about
    ``spread * limit`` rows in all, and not ``limit`` rows each.
    """
    share = min(1.0, spread * limit / max(1, total))
    return rows.where(F.pmod(F.xxhash64(key), F.lit(2 ** 40)) < int(share * 2 ** 40))


def sampled_texts(docs: DataFrame, pattern: str, max_rows: int, max_bytes: int, spread: int = 8, without: bool = False) -> list[str]:
    """At most ``max_rows`` different texts of at most ``max_bytes`` bytes with (or without) a match of ``pattern``, by a hash of the text.

    For training only. The rows that fit are counted first, so that rare ones fill the bound as well; the sample is taken from
    the first ``spread * max_rows`` of them or so in the order of the hash.
    """
    match = F.coalesce(F.col("text").rlike(pattern), F.lit(False))
    rows = documents(docs).select("text").where((F.octet_length("text") <= max_bytes) & (~match if without else match))
    near = near_hash(rows, "text", max_rows, rows.count(), spread).distinct()
    return [r.text for r in near.orderBy(F.xxhash64("text"), "text").limit(max_rows).collect()]


def numbered(df: DataFrame, group: str, order: list[str], name: str, chunks: int) -> DataFrame:
    """Gapless numbers from 0 in each ``group`` without sorting a group in one task.

    Rows are dealt by a hash of the ``order`` columns into ``chunks`` parts of each group; a part is numbered by itself
    and starts where the parts before it end. The starts are one row per group and chunk, so their size is fixed.
    """
    part = "_chunk"
    dealt = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    sizes = dealt.groupBy(group, part).agg(F.count("*").alias("_n"))
    starts = sizes.select(group, part, (F.sum("_n").over(Window.partitionBy(group).orderBy(part)) - F.col("_n")).alias("_start"))
    own = F.row_number().over(Window.partitionBy(group, part).orderBy(*order))
    return (dealt.withColumn(name, own).join(starts, [group, part])
            .withColumn(name, (F.col("_start") + F.col(name) - 1).cast("long")).drop(part, "_start"))


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: the lineage ends there and survives lost executors."""
    return pin(df, f"llm-{label}")
