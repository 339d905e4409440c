"""Named measures: aggregates re-evaluated per group and per row filter.

``measure(df, names, group, filters)`` is filter, then group, then one
aggregation holding every requested measure but percentiles, so any slice of
them is a single pass over the incidents.  The measures expect the analysis view
with one row per incident and a ``disposition_category`` where transport is
asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import quantiles as QT

RESP, DISP, TRAV = "valid_incident_response_seconds", "valid_dispatch_response_seconds", "valid_travel_time_seconds"


def total() -> Column:
    return F.count("*")


def filtered(cond: Column) -> Column:
    """Incidents for which the condition is true."""
    return X.n_if(cond)


def mean_minutes(seconds: str, where: Column | None = None) -> Column:
    """Sum of valid seconds over the number of non-null ones, in minutes."""
    v = F.col(seconds) if where is None else F.when(where, F.col(seconds))
    return F.try_divide(F.sum(v), F.count(v) * 60.0)


def sd_minutes(seconds: str, where: Column | None = None) -> Column:
    v = F.col(seconds) / 60.0
    return F.stddev_pop(v if where is None else F.when(where, v))


def per(n: Column, d: Column) -> Column:
    return X.quotient(n, d)


def complete() -> Column:
    """All three response components are present."""
    return F.col(DISP).isNotNull() & F.col(TRAV).isNotNull() & F.col(RESP).isNotNull()


def complete_sum(c: str) -> Column:
    return F.sum(F.when(complete(), F.col(c)))


def catalogue() -> dict[str, Column]:
    held, not_held = F.col("is_held"), ~F.col("is_held")
    cat = F.col("disposition_category")
    held_mean, free_mean = mean_minutes(RESP, held), mean_minutes(RESP, not_held)
    resp_all = complete_sum(RESP)
    span = F.date_diff(F.max("incident_date"), F.min("incident_date")) + 1
    return {
        "total_incidents": total(),
        "valid_incident_flag_count": filtered(F.col("is_valid_incident_response")),
        "valid_dispatch_flag_count": filtered(F.col("is_valid_dispatch_response")),
        "valid_response_count": F.count(RESP),
        "valid_travel_count": F.count(TRAV),
        "total_response_seconds": F.sum(RESP),
        "total_dispatch_seconds": F.sum(DISP),
        "total_travel_seconds": F.sum(TRAV),
        "valid_response_percentage": per(filtered(F.col("is_valid_incident_response")), total()),
        "average_response_minutes": mean_minutes(RESP),
        "average_dispatch_minutes": mean_minutes(DISP),
        "average_travel_minutes": mean_minutes(TRAV),
        "stddev_response_minutes": sd_minutes(RESP),
        "response_cv": per(sd_minutes(RESP), mean_minutes(RESP)),
        "held_incidents": filtered(held),
        "held_percentage": per(filtered(held), total()),
        "average_held_minutes": held_mean,
        "average_non_held_minutes": free_mean,
        "held_difference_minutes": held_mean - free_mean,
        "held_difference_percentage": per(held_mean - free_mean, free_mean),
        "stddev_held_minutes": sd_minutes(RESP, held),
        "stddev_non_held_minutes": sd_minutes(RESP, not_held),
        "transported_incidents": filtered(cat == "Transported"),
        "transported_percentage": per(filtered(cat == "Transported"), total()),
        "not_transported_incidents": filtered(cat == "Not Transported"),
        "not_transported_percentage": per(filtered(cat == "Not Transported"), total()),
        "call_type_changed_incidents": filtered(F.col("call_type_changed")),
        "call_type_change_percentage": per(filtered(F.col("call_type_changed")), total()),
        "severity_changed_incidents": filtered(F.col("severity_changed")),
        "severity_change_percentage": per(filtered(F.col("severity_changed")), total()),
        "complete_incidents": filtered(complete()),
        "complete_response_seconds": resp_all,
        "complete_dispatch_seconds": complete_sum(DISP),
        "complete_travel_seconds": complete_sum(TRAV),
        "calendar_days": span,
        "average_daily_incidents": per(total(), span),
        "dispatch_share": per(complete_sum(DISP), resp_all),
        "travel_share": per(complete_sum(TRAV), resp_all),
        "component_difference_seconds": resp_all - complete_sum(DISP) - complete_sum(TRAV),
        "component_share_total": per(complete_sum(DISP), resp_all) + per(complete_sum(TRAV), resp_all),
    }


#: Measures that are ranks of the valid response seconds, in minutes.
PERCENTILES = {"p90_response_minutes": 0.9, "p95_response_minutes": 0.95}


def measure(df: DataFrame, names, group=(), filters: Column | None = None) -> DataFrame:
    """The named measures per group over the filtered rows.

    Percentiles come from a stored histogram by distributed rank, as no
    aggregate finds them without a buffer of the group's values; it reads the
    group columns and the seconds alone.
    """
    names, group = list(names), list(group)
    c = catalogue()
    rows = df if filters is None else df.filter(filters)
    ranks = {n: PERCENTILES[n] for n in names if n in PERCENTILES}
    plain = rows.groupBy(*group).agg(*[c[n].alias(n) for n in names if n not in ranks] or [F.count("*").alias("_rows")])
    if not ranks:
        return plain
    found = QT.percentiles(rows, group, RESP, ranks).withColumns({n: F.col(n) / 60.0 for n in ranks})
    if group:
        found = plain.alias("m").join(found.alias("r"), [F.col(f"m.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group], "left")
        return found.select(*[F.col(f"m.{g}").alias(g) for g in group], *names)
    return plain.withColumns({n: found.select(n).scalar() for n in ranks}).select(*names)


def daily_peaks(df: DataFrame, group=()) -> DataFrame:
    """Most incidents of a day, incidents a calendar day, and calendar days, per group; rows are counted by day first."""
    days = df.groupBy(*group, "incident_date").agg(F.count("*").alias("n"))
    span = F.date_diff(F.max("incident_date"), F.min("incident_date")) + 1
    return days.groupBy(*group).agg(F.max("n").alias("peak_daily_incidents"), per(F.sum("n"), span).alias("average_daily_incidents"),
                                    span.alias("calendar_days"))


def share_removing(df: DataFrame, member: str, others=(), name: str = "incident_share") -> DataFrame:
    """Share of a member when only its own filter is removed.

    The denominator is the total over the other grouping columns.
    """
    g = df.groupBy(*others, member).agg(F.count("*").alias("total_incidents"))
    return g.withColumn(name, F.try_divide(F.col("total_incidents").cast("double"),
                                           F.sum("total_incidents").over(Window.partitionBy(*others))))


def member_shares(df: DataFrame, members: dict[str, str], others=()) -> DataFrame:
    """Incidents of every member of several dimensions and their share when only the own filter is removed.

    ``members`` maps a dimension to its column; two roles of one dimension are two
    entries.  Incidents are counted once, by the combinations of all the columns;
    GROUPING SETS over these rows give each dimension its members, and the
    denominators are their sums within ``others``.
    """
    columns, others = list(dict.fromkeys(members.values())), list(others)
    combos = df.groupBy(*others, *columns).agg(F.count("*").alias("_n"))
    sets = [[F.col(x) for x in (*others, c)] for c in columns]
    g = combos.groupingSets(sets, *[F.col(x) for x in (*others, *columns)]).agg(
        F.sum("_n").alias("total_incidents"), *[F.grouping(c).alias(f"_out_{c}") for c in columns])
    names = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(c).cast("string").alias("member"), (F.col(f"_out_{c}") == 0).alias("_in")) for d, c in members.items()])
    rows = g.select(*others, "total_incidents", F.inline(F.filter(names, lambda x: x["_in"]))).drop("_in")
    return rows.withColumn("incident_share", F.try_divide(F.col("total_incidents").cast("double"), F.sum("total_incidents").over(Window.partitionBy("dimension", *others))))


def previous_year(df: DataFrame, year: str, value: str = "total_incidents") -> DataFrame:
    """Value of exactly the year before; a missing year stays blank.

    Unlike a plain lag, a gap in the years is not bridged.
    """
    w = Window.orderBy(year)
    prev = F.when(F.lag(year).over(w) == F.col(year) - 1, F.lag(value).over(w))
    out = df.withColumn("previous_year", prev).withColumn("yoy_change", F.col(value) - F.col("previous_year"))
    return out.withColumn("yoy_percentage", F.try_divide(F.col("yoy_change").cast("double"), F.col("previous_year").cast("double")))


def daily_groups(daily: DataFrame, group=()) -> DataFrame:
    """Analyzable, reportable, above and below daily groups, and the anomaly share."""
    rep = F.col("is_reportable_response_anomaly")
    analyzable = X.n_if(F.col("has_sufficient_sample") & F.col("has_sufficient_baseline"))
    return daily.groupBy(*group).agg(
        analyzable.alias("analyzable_groups"), X.n_if(rep).alias("reportable_groups"),
        X.n_if(rep & F.col("is_above_upper_control_limit")).alias("above_groups"),
        X.n_if(rep & F.col("is_below_lower_control_limit")).alias("below_groups"),
        per(X.n_if(rep), analyzable).alias("anomaly_share"))
