"""Reusable query shapes over grouped rows: shares, ranks, change, transitions,
pooled statistics and high-demand rules.

Every function that ranks or totals does so after aggregation, when the rows
are members of a dimension and no longer incidents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.functions import exprs as X


def counts(df: DataFrame, group, n: str = "total_incidents") -> DataFrame:
    return df.groupBy(*group).agg(F.count("*").alias(n))


def share_pct(n, total) -> Column:
    """Percentage of a total in double arithmetic; null on a zero total."""
    return X.quotient(n, total, 100)


def share_of(grouped: DataFrame, n: str = "total_incidents", within=(), name: str = "incident_percentage",
             total: str | None = None) -> DataFrame:
    """Share of each row in the total of its parent group, or of everything.

    The total is a window over the aggregated rows.  A self join or a scalar
    sub-query would state the same, but Spark then plans the scan and the
    aggregation under it a second time.
    """
    t = F.sum(n).over(Window.partitionBy(*within))
    out = grouped.withColumn(name, F.try_divide(F.col(n) * 100.0, t))
    return out.withColumn(total, t) if total else out


def role_counts(df: DataFrame, roles: dict[str, str], code: str) -> DataFrame:
    """Rows per code in each of several roles, from one scan.

    Equals a full outer join of one count per role, codes missing in a role
    counting zero, without reading the rows once per role.
    """
    pairs = F.array(*[F.struct(F.col(c).alias(code), F.lit(r).alias("_role")) for r, c in roles.items()])
    return df.select(F.inline(pairs)).groupBy(code).agg(*[F.count_if(F.col("_role") == r).alias(r) for r in roles])


def rank_within(df: DataFrame, by, within=(), name: str = "rank", dense: bool = False) -> DataFrame:
    """Rank with gaps, or dense, over rows that are already aggregated."""
    order = [b if isinstance(b, Column) else F.col(b).desc() for b in ([by] if isinstance(by, (str, Column)) else by)]
    w = Window.partitionBy(*within).orderBy(*order)
    return df.withColumn(name, (F.dense_rank() if dense else F.rank()).over(w))


def rank_visible(df: DataFrame, by: str, member: str, visible: Column | None = None, blank: str | None = X.UNKNOWN, name: str = "visible_rank") -> DataFrame:
    """Dense rank among the members that a report shows; all other rows stay, without a rank.

    ``visible`` is the condition of the shown set.  A row whose member is null or
    ``blank``, or whose value is null, is suppressed.
    """
    shown = F.col(member).isNotNull() & F.col(by).isNotNull() & (F.lit(True) if visible is None else F.coalesce(visible, F.lit(False)))
    if blank is not None:
        shown = shown & (F.col(member) != blank)
    ranked = df.withColumn("_shown", shown)
    return ranked.withColumn(name, F.when(F.col("_shown"), F.dense_rank().over(Window.partitionBy("_shown").orderBy(F.col(by).desc())))).drop("_shown")


def prev_change(df: DataFrame, order: str, value: str, within=(), prev: str = "previous", change: str = "change",
                change_pct: str | None = None) -> DataFrame:
    """Previous row's value, the difference and the difference in percent."""
    p = F.lag(value).over(Window.partitionBy(*within).orderBy(order))
    out = df.withColumn(prev, p).withColumn(change, F.col(value) - F.col(prev))
    if change_pct:
        out = out.withColumn(change_pct, F.try_divide(F.col(change) * 100.0, F.col(prev)))
    return out


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    """The first n rows of an ordered report (each task keeps only n)."""
    return df.orderBy(*order).limit(n)


def transition_matrix(df: DataFrame, a: str, b: str, changed: str, top: int | None = None) -> DataFrame:
    """From/to counts of changed rows: share within the origin, share of all, rank.

    ``top`` keeps the largest transitions, ties broken by the two codes.
    """
    n = "transition_incidents"
    out = df.filter(F.col(changed)).groupBy(a, b).agg(F.count("*").alias(n))
    out = share_of(out, n, [a], "percentage_within_initial_changes", total="initial_changed_incidents")
    out = share_of(out, n, name="percentage_of_all_changes")
    out = rank_within(out, n, [a], "transition_rank_within_initial")
    return top_n(out, [F.col(n).desc(), a, b], top) if top else out


def change_rate(df: DataFrame, group: str, changed: str, min_n: int = 0, name: str = "change_percentage") -> DataFrame:
    """Changed and unchanged rows per group, rate in percent, rank by rate."""
    g = df.groupBy(group).agg(F.count("*").alias("total_incidents"), X.n_if(F.col(changed)).alias("changed_incidents"))
    g = g.filter(F.col("total_incidents") >= min_n).withColumn(
        "unchanged_incidents", F.col("total_incidents") - F.col("changed_incidents"))
    g = g.withColumn(name, F.round(share_pct("changed_incidents", "total_incidents"), 6))
    return rank_within(g, name, name="change_rate_rank")


# Display order of the change groups.
CHANGE_ORDER = ["Both call type and severity changed", "Call type changed only", "Severity changed only", "Neither classification changed", "Unknown change status"]


def change_group_sort(group) -> Column:
    """Place of a change group in its display order."""
    return F.array_position(F.array(*[F.lit(g) for g in CHANGE_ORDER]), F.col(group)).cast("int")


def change_group(a: str = "call_type_changed", b: str = "severity_changed") -> Column:
    """Which of two change flags are set; any unknown flag is its own group."""
    a, b = F.col(a), F.col(b)
    return X.first_match([
        (a.isNull() | b.isNull(), "Unknown change status"),
        (a & b, "Both call type and severity changed"),
        (a, "Call type changed only"),
        (b, "Severity changed only")], "Neither classification changed")


def pooled_stats(daily: DataFrame, group, min_n: int = 0) -> DataFrame:
    """Weighted mean and pooled population sd from daily n, mean and sd.

    Second moments are additive: ``var = sum(n*(sd^2+mean^2))/N - mean^2``,
    clamped at zero.  Groups with fewer than ``min_n`` valid rows are dropped.
    """
    n, m, s = (F.col(c) for c in ("valid_incident_response_count", "average_incident_response_seconds", "population_stddev_response_seconds"))
    g = daily.groupBy(*group).agg(
        F.sum("total_incidents").alias("total_incidents"), F.sum(n).alias("valid_response_count"),
        F.sum("total_incident_response_seconds").alias("_sum"), F.sum(n * (s * s + m * m)).alias("_m2"))
    g = g.filter(F.col("valid_response_count") >= min_n)
    mean = F.try_divide(F.col("_sum"), F.col("valid_response_count"))
    g = g.withColumn("average_response_seconds", mean)
    var = F.try_divide(F.col("_m2"), F.col("valid_response_count")) - F.col("average_response_seconds") ** 2
    g = g.withColumn("pooled_stddev_seconds", F.sqrt(X.at_least_zero(var)))
    return g.drop("_sum", "_m2").withColumns({
        "valid_response_percentage": share_pct("valid_response_count", "total_incidents"),
        "weighted_average_response_minutes": X.sec_to_min("average_response_seconds"),
        "pooled_population_stddev_minutes": X.sec_to_min("pooled_stddev_seconds"),
        "response_cv_percentage": F.try_divide(F.col("pooled_stddev_seconds") * 100.0, F.col("average_response_seconds")),
    })


def response_by(df: DataFrame, group, value: str = "valid_incident_response_seconds") -> DataFrame:
    """Incidents, valid responses and mean response per group."""
    return df.groupBy(*group).agg(F.count("*").alias("total_incidents"), F.count(value).alias("valid_response_count"),
                                  F.avg(value).alias("average_response_seconds"))


def high_demand_slow(g: DataFrame, flag: str, rule: str = "mean", demand: str = "total_incidents",
                     response: str = "average_response_seconds") -> DataFrame:
    """Flag groups that are both busy and slow against the mean of the groups.

    ``mean``: demand above the mean demand.  ``p75``: demand at or above its
    interpolated 75th percentile.  The benchmarks are windows over the grouped
    rows (months, days or hours), so the incidents are read once.
    """
    all_groups = Window.partitionBy()
    level = F.avg(demand) if rule == "mean" else F.percentile(demand, 0.75)
    out = g.withColumns({"demand_benchmark": level.over(all_groups), "response_benchmark": F.avg(response).over(all_groups)})
    d, r = F.col(demand), F.col(response)
    busy = d > F.col("demand_benchmark") if rule == "mean" else d >= F.col("demand_benchmark")
    return out.withColumn(flag, F.when(busy & (r > F.col("response_benchmark")), 1).otherwise(0))


def pivot_matrix(df: DataFrame, row: str, column: str, values, prefix: str = "h") -> DataFrame:
    """Counts as a row x column matrix; the column values are fixed up front."""
    labelled = df.withColumn("_c", F.concat(F.lit(prefix), F.lpad(F.col(column).cast("string"), 2, "0")))
    return labelled.groupBy(row).pivot("_c", [f"{prefix}{v:02d}" for v in values]).agg(F.count(F.lit(1))).fillna(0)
