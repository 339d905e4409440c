"""Percentiles from value histograms: exact ranks over value ranges, and digests that add up.

No function here keeps the values of a group in a buffer.  Rows are counted by
value first, a plain hash aggregation with partial states; all that follows works
on the counted values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.session import pin

#: Cells of a digest: a rank read from it is off by at most one part in so many.
DIGEST_CELLS = 256


def histogram(df: DataFrame, group, value: str, n: str = "n") -> DataFrame:
    """Rows per group and value that is not null."""
    return df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias(n))


def rank_of(p: float, total: Column) -> Column:
    """The first rank, from 1, that covers the share ``p`` of ``total`` rows; in whole numbers, with six digits of ``p``."""
    share = F.lit(round(p * 10**6)).cast("decimal(7,0)") * total.cast("decimal(19,0)")
    return F.greatest(F.lit(1), F.ceil(share / F.lit(10**6).cast("decimal(7,0)"))).cast("long")


def rank_percentiles(hist: DataFrame, group, value: str, ps: dict[str, float], n: str = "n", interpolate: bool = True) -> DataFrame:
    """Percentiles of every group of a histogram by distributed rank.

    The counted values are dealt by range over the tasks and stored with the
    number of their range.  Sizes of the ranges, one row per group and range,
    give the rank at which each begins and thereby the ranges that hold a wanted
    rank; only these are read again and summed up inside.  So a group of any
    size is spread over all tasks.  ``interpolate`` takes the value between the
    two ranks around ``p * (n - 1)``, else the first value that covers ``p``.
    """
    group = list(group)
    tasks = max(1, int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cells = pin(hist.select(*group, F.col(value).cast("double").alias("_v"), F.col(n).alias("_n")).repartitionByRange(tasks, *group, "_v")
                .withColumn("_range", F.spark_partition_id()), "value-ranges")
    one = Window.partitionBy(*group)
    sizes = cells.groupBy(*group, "_range").agg(F.sum("_n").alias("_size"))
    starts = sizes.withColumns({"_start": F.sum("_size").over(one.orderBy("_range")) - F.col("_size"), "_total": F.sum("_size").over(one)})
    wanted = []
    for i, p in enumerate(ps.values()):
        if interpolate:
            at = F.col("_total").cast("double") * p - p
            low, part = F.floor(at), at - F.floor(at)
            wanted += [(i, low, 1 - part), (i, low + 1, part)]
        else:
            wanted.append((i, rank_of(p, F.col("_total")) - 1, F.lit(1.0)))
    ranks = F.array(*[F.struct(F.lit(i).alias("_p"), F.least(r, F.col("_total") - 1).cast("long").alias("_rank"), w.cast("double").alias("_weight")) for i, r, w in wanted])
    keys = [*group, "_range"]
    ranks = (starts.select(*keys, "_start", "_size", F.inline(ranks))
             .filter((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_size"))).withColumnsRenamed({c: f"r_{c}" for c in keys}))
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in keys]  # any group column may be null
    held = cells.join(ranks.select(*[f"r_{c}" for c in keys]).distinct(), same, "left_semi")
    held = held.withColumn("_end", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_v")))
    last = F.col("_start") + F.col("_end")
    met = held.join(ranks, [*same, F.col("_rank") < last, F.col("_rank") >= last - F.col("_n")])
    return met.groupBy(*group).agg(*[F.sum(F.when(F.col("_p") == i, F.col("_v") * F.col("_weight"))).alias(name) for i, name in enumerate(ps)])


def percentiles(df: DataFrame, group, value: str, ps: dict[str, float], interpolate: bool = True) -> DataFrame:
    """Exact percentiles of rows: :func:`rank_percentiles` of their histogram."""
    return rank_percentiles(histogram(df, group, value), group, value, ps, interpolate=interpolate)


def digests(hist: DataFrame, group, value: str, n: str = "n", cells: int = DIGEST_CELLS, name: str = "digest") -> DataFrame:
    """One digest per group: at most about ``2 * cells`` values, each with the number of rows that it stands for.

    The ranks of a group are cut into ``cells`` parts; of the values whose last
    rank lies in one part the largest stays, with all their rows.  A group with
    few values keeps each of them, and the digest is exact.
    """
    one = Window.partitionBy(*group)
    end = F.sum(n).over(one.orderBy(value))
    cut = hist.withColumns({"_end": end, "_total": F.sum(n).over(one)})
    cut = cut.withColumn("_cell", F.expr(f"CAST((CAST(_end AS DECIMAL(19, 0)) - 1) * {cells} div _total AS INT)"))
    kept = cut.groupBy(*group, "_cell").agg(F.max(value).cast("double").alias("value"), F.sum(n).alias("n"))
    return kept.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias(name))


def digest_rows(df: DataFrame, group, name: str = "digest") -> DataFrame:
    """The histogram that the digests of each group add up to.

    Digests of disjoint rows add up by value; what is off in the sum stays within
    the same share of its rows, and one row for each digest.
    """
    return df.select(*group, F.inline(name)).groupBy(*group, "value").agg(F.sum("n").alias("n"))


def digest_percentiles(df: DataFrame, group, ps: dict[str, float], name: str = "digest") -> DataFrame:
    """Percentiles of larger groups from stored digests, without the rows."""
    return rank_percentiles(digest_rows(df, group, name), group, "value", ps, interpolate=False)
