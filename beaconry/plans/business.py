"""Business queries (B01-B42): demand, response, outcomes, measures, forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import analysis as AN
from beaconry.operators import daily as DY
from beaconry.operators import dims as D
from beaconry.operators import forecast as FO
from beaconry.operators import measures as M
from beaconry.plans import analogs as A
from beaconry.plans import oracle as O
from beaconry.plans.aggregates import DAYS, daily, daily_base, day_means
from beaconry.plans.registry import query
from beaconry.session import pin

V = "valid_incident_response_seconds"


# --- demand -------------------------------------------------------------------

@query("b01_annual_volume", "incident_year:i total_incidents:i previous_year_incidents:i year_over_year_change:i year_over_year_change_percentage:f6",
       f"""WITH {O.OD}, g AS (SELECT incident_year, COUNT(*) AS total_incidents FROM od GROUP BY 1),
       p AS (SELECT *, LAG(total_incidents) OVER (ORDER BY incident_year) AS previous_year_incidents FROM g)
       SELECT *, total_incidents - previous_year_incidents AS year_over_year_change,
       (total_incidents - previous_year_incidents) * 100.0 / NULLIF(previous_year_incidents, 0) AS year_over_year_change_percentage FROM p""")
def annual_volume(spark, folder):
    g = AN.counts(A.orders(spark, folder), ["incident_year"])
    return AN.prev_change(g, "incident_year", "total_incidents", prev="previous_year_incidents", change="year_over_year_change",
                          change_pct="year_over_year_change_percentage").orderBy("incident_year")


@query("b02_monthly_volume", "year:i month_number:i month_name:s year_month:s year_month_label:s year_month_sort:i total_incidents:i previous_month_incidents:i "
       "month_over_month_change:i month_over_month_change_percentage:f6",
       f"""WITH {O.OD}, g AS (SELECT incident_year AS year, incident_month AS month_number, strftime(incident_date, '%B') AS month_name, incident_year_month AS year_month,
       strftime(incident_date, '%b %Y') AS year_month_label, incident_year * 100 + incident_month AS year_month_sort, COUNT(*) AS total_incidents FROM od GROUP BY ALL),
       p AS (SELECT *, LAG(total_incidents) OVER (ORDER BY year_month_sort) AS previous_month_incidents FROM g)
       SELECT *, total_incidents - previous_month_incidents AS month_over_month_change,
       (total_incidents - previous_month_incidents) * 100.0 / NULLIF(previous_month_incidents, 0) AS month_over_month_change_percentage FROM p""")
def monthly_volume(spark, folder):
    g = A.orders(spark, folder).groupBy(F.trunc("incident_date", "month").alias("m")).agg(F.count("*").alias("total_incidents"))
    out = AN.prev_change(g, "m", "total_incidents", prev="previous_month_incidents", change="month_over_month_change", change_pct="month_over_month_change_percentage")
    return out.withColumns({
        "year": F.year("m"), "month_number": F.month("m"), "month_name": F.date_format("m", "MMMM"), "year_month": X.year_month("m"),
        "year_month_label": F.date_format("m", "MMM yyyy"), "year_month_sort": F.year("m") * 100 + F.month("m")}).orderBy("m")


@query("b03_demand_by_weekday", "day_of_week_number:i day_of_week_name:s day_of_week_short_name:s is_weekend:b days_observed:i total_incidents:i average_daily_incidents:f2",
       f"""WITH {O.EV}, d AS (SELECT incident_date, dow, day_name, COUNT(*) AS n FROM ev GROUP BY ALL)
       SELECT dow AS day_of_week_number, day_name AS day_of_week_name, SUBSTRING(day_name, 1, 3) AS day_of_week_short_name, dow IN (1, 7) AS is_weekend, COUNT(*) AS days_observed, SUM(n) AS total_incidents,
       CAST((2 * SUM(n) * 100 + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 AS average_daily_incidents FROM d GROUP BY ALL""")
def demand_by_weekday(spark, folder):
    d = AN.counts(A.event_view(spark, folder, area=False), ["incident_date"], "n")
    g = d.groupBy(F.dayofweek("incident_date").alias("day_of_week_number"), F.date_format("incident_date", "EEEE").alias("day_of_week_name"),
                  F.date_format("incident_date", "EEE").alias("day_of_week_short_name"),
                  X.is_weekend("incident_date").alias("is_weekend")).agg(F.count("*").alias("days_observed"), F.sum("n").alias("total_incidents"))
    mean = F.round(F.col("total_incidents").cast("decimal(20,4)") / F.col("days_observed"), 2)
    return g.withColumn("average_daily_incidents", mean).orderBy("day_of_week_number")


def _ranked(df, group, rank):
    g = AN.share_of(AN.counts(df, group))
    return AN.rank_within(g, "total_incidents", name=rank).orderBy(F.desc("total_incidents"), *group)


def _ranked_sql(cols: str, rank: str, cte: str = O.EV, fact: str = "ev") -> str:
    return f"""WITH {cte}, g AS (SELECT {cols}, COUNT(*) AS total_incidents FROM {fact} GROUP BY ALL)
       SELECT *, total_incidents * 100.0 / SUM(total_incidents) OVER () AS incident_percentage, RANK() OVER (ORDER BY total_incidents DESC) AS {rank} FROM g"""


@query("b04_demand_by_hour", "hour_number:i hour_label:s total_incidents:i incident_percentage:f6 demand_rank:i",
       _ranked_sql("incident_hour AS hour_number, lpad(CAST(incident_hour AS VARCHAR), 2, '0') || ':00' AS hour_label", "demand_rank"))
def demand_by_hour(spark, folder):
    out = _ranked(A.event_view(spark, folder, area=False), ["incident_hour"], "demand_rank")
    return out.select(F.col("incident_hour").alias("hour_number"), X.hour_label("incident_hour").alias("hour_label"), "total_incidents", "incident_percentage", "demand_rank")


@query("b05_demand_by_time_of_day", "time_of_day:s time_of_day_sort:i total_incidents:i incident_percentage:f2 demand_rank:i",
       _ranked_sql("time_of_day, incident_hour // 6 + 1 AS time_of_day_sort", "demand_rank"))
def demand_by_time_of_day(spark, folder):
    ev = A.event_view(spark, folder, area=False).withColumn("time_of_day_sort", X.time_bucket_sort("incident_hour"))
    return _ranked(ev, ["time_of_day", "time_of_day_sort"], "demand_rank").orderBy("time_of_day_sort")


@query("b06_volume_by_area", "borough:s total_incidents:i incident_percentage:f6 incident_volume_rank:i", _ranked_sql("borough", "incident_volume_rank"))
def volume_by_area(spark, folder):
    return _ranked(A.event_view(spark, folder), ["borough"], "incident_volume_rank")


@query("b07_common_initial_class", "call_type:s call_type_description:s total_incidents:i incident_percentage:f6 call_type_rank:i",
       f"""WITH {O.EV}, {O.CT}, g AS (SELECT initial_call_type AS call_type, COUNT(*) AS total_incidents FROM ev GROUP BY 1)
       SELECT *, COALESCE(description, 'UNDOCUMENTED CALL TYPE') AS call_type_description, total_incidents * 100.0 / SUM(total_incidents) OVER () AS incident_percentage,
       RANK() OVER (ORDER BY total_incidents DESC) AS call_type_rank FROM g LEFT JOIN ct ON call_type = code""")
def common_initial_class(spark, folder):
    fact, dims = A.star(spark, folder)
    g = _ranked(fact, ["initial_call_type_key"], "call_type_rank")
    return g.join(dims["call_type"].withColumnRenamed("call_type_key", "initial_call_type_key"), "initial_call_type_key")


@query("b08_initial_final_volume", "call_type:s call_type_description:s initial_incident_count:i final_incident_count:i final_minus_initial_difference:i",
       f"""WITH {O.EV}, {O.CT}, i AS (SELECT initial_call_type AS c, COUNT(*) AS n FROM ev GROUP BY 1), f AS (SELECT final_call_type AS c, COUNT(*) AS n FROM ev GROUP BY 1)
       SELECT COALESCE(i.c, f.c) AS call_type, COALESCE(i.n, 0) AS initial_incident_count, COALESCE(f.n, 0) AS final_incident_count,
       COALESCE(f.n, 0) - COALESCE(i.n, 0) AS final_minus_initial_difference,
       CASE WHEN COALESCE(i.c, f.c) = 'UNKNOWN' THEN 'UNKNOWN CALL TYPE' ELSE COALESCE(description, 'UNDOCUMENTED CALL TYPE') END AS call_type_description
       FROM i FULL JOIN f ON i.c = f.c LEFT JOIN ct ON COALESCE(i.c, f.c) = code""")
def initial_final_volume(spark, folder):
    out = AN.role_counts(A.event_view(spark, folder, area=False), {"initial": "initial_call_type", "final": "final_call_type"}, "call_type")
    out = out.withColumnsRenamed({"initial": "initial_incident_count", "final": "final_incident_count"})
    out = out.withColumn("final_minus_initial_difference", F.col("final_incident_count") - F.col("initial_incident_count"))
    return D.describe_codes(out, A.call_type_mapping(spark), "call_type", "call_type_description")


# --- response -----------------------------------------------------------------

_POOL = "total_incidents:i valid_response_count:i valid_response_percentage:f6 weighted_average_response_minutes:f2 pooled_population_stddev_minutes:f2 response_cv_percentage:f4"
_POOL_SQL = f"""SELECT *, valid_response_count * 100.0 / total_incidents AS valid_response_percentage, {O.minutes('avg_s')} AS weighted_average_response_minutes,
  {O.minutes('sd_s')} AS pooled_population_stddev_minutes, sd_s * 100.0 / avg_s AS response_cv_percentage"""


_LABEL = "CASE WHEN initial_severity_level_code = -1 THEN 'Unknown' ELSE 'Severity Level ' || initial_severity_level_code END AS initial_severity_label"


def labelled(df):
    return df.withColumn("initial_severity_label", X.severity_label("initial_severity_level_code"))


@query("b09_response_by_severity", f"initial_severity_level_code:i initial_severity_label:s {_POOL}",
       f"WITH {O.EV}, {O.daily(O.GRAIN)}, {O.pooled('initial_severity_level_code')} {_POOL_SQL}, {_LABEL} FROM p1")
def response_by_severity(spark, folder):
    return labelled(AN.pooled_stats(daily_base(spark, folder), ["initial_severity_level_code"]))


@query("b10_response_by_area", f"borough:s {_POOL} slowest_response_rank:i",
       f"WITH {O.EV}, {O.daily(O.GRAIN)}, {O.pooled('borough')} {_POOL_SQL}, RANK() OVER (ORDER BY avg_s DESC) AS slowest_response_rank FROM p1")
def response_by_area(spark, folder):
    return AN.rank_within(AN.pooled_stats(daily_base(spark, folder), ["borough"]), "average_response_seconds", name="slowest_response_rank")


@query("b11_variability", f"borough:s initial_severity_level_code:i initial_severity_label:s {_POOL} variability_rank:i",
       f"WITH {O.EV}, {O.daily(O.GRAIN)}, {O.pooled('borough, initial_severity_level_code', 1000)} {_POOL_SQL}, RANK() OVER (ORDER BY sd_s DESC) AS variability_rank, {_LABEL} FROM p1")
def variability(spark, folder):
    g = AN.pooled_stats(daily_base(spark, folder), DY.LIMIT_GROUP, min_n=1000)
    return labelled(AN.rank_within(g, "pooled_stddev_seconds", name="variability_rank"))


@query("b12_held_vs_not_held", "held_status:s total_incidents:i valid_response_count:i valid_response_percentage:f6 average_response_minutes:f2 "
       "population_stddev_minutes:f2 response_cv_percentage:f4",
       f"""WITH {O.EV}, g AS (SELECT CASE WHEN is_held THEN 'Held' ELSE 'Not Held' END AS held_status, COUNT(*) AS total_incidents, COUNT({V}) AS valid_response_count,
       AVG({V}) AS m, stddev_pop({V}) AS sd FROM ev GROUP BY 1)
       SELECT *, valid_response_count * 100.0 / total_incidents AS valid_response_percentage, {O.minutes('m')} AS average_response_minutes,
       {O.minutes('sd')} AS population_stddev_minutes, sd * 100.0 / m AS response_cv_percentage FROM g""")
def held_vs_not_held(spark, folder):
    status = F.when(F.col("is_held"), "Held").otherwise("Not Held")
    g = A.event_view(spark, folder, area=False).groupBy(status.alias("held_status")).agg(
        F.count("*").alias("total_incidents"), F.count(V).alias("valid_response_count"), F.avg(V).alias("m"), F.stddev_pop(V).alias("sd"))
    return g.withColumns({"valid_response_percentage": AN.share_pct("valid_response_count", "total_incidents"), "average_response_minutes": X.sec_to_min("m"),
                          "population_stddev_minutes": X.sec_to_min("sd"), "response_cv_percentage": F.try_divide(F.col("sd") * 100.0, F.col("m"))})


_COMPLETE = f"WHERE valid_dispatch_response_seconds IS NOT NULL AND valid_travel_time_seconds IS NOT NULL AND {V} IS NOT NULL"


@query("b13_component_share", "valid_component_records:i average_dispatch_minutes:f2 average_travel_minutes:f2 average_incident_response_minutes:f2 "
       "dispatch_share_percentage:f6 travel_share_percentage:f6 component_reconciliation_difference_minutes:f2",
       f"""WITH {O.EV}, g AS (SELECT COUNT(*) AS valid_component_records, AVG(valid_dispatch_response_seconds) AS d, AVG(valid_travel_time_seconds) AS t, AVG({V}) AS r FROM ev {_COMPLETE})
       SELECT *, {O.minutes('d')} AS average_dispatch_minutes, {O.minutes('t')} AS average_travel_minutes, {O.minutes('r')} AS average_incident_response_minutes,
       d * 100.0 / r AS dispatch_share_percentage, t * 100.0 / r AS travel_share_percentage, ROUND(ROUND(r - d - t, 6) / 60, 2) AS component_reconciliation_difference_minutes FROM g""")
def component_share(spark, folder):
    g = A.event_view(spark, folder, area=False).filter(M.complete()).agg(
        F.count("*").alias("valid_component_records"), F.avg(M.DISP).alias("d"), F.avg(M.TRAV).alias("t"), F.avg(M.RESP).alias("r"))
    d, t, r = F.col("d"), F.col("t"), F.col("r")
    return g.withColumns({
        "average_dispatch_minutes": X.sec_to_min(d), "average_travel_minutes": X.sec_to_min(t), "average_incident_response_minutes": X.sec_to_min(r),
        "dispatch_share_percentage": F.try_divide(d * 100.0, r), "travel_share_percentage": F.try_divide(t * 100.0, r),
        "component_reconciliation_difference_minutes": X.sec_to_min(r - d - t)})


@query("b14_component_additivity", "compared_records:i component_mismatch_records:i minimum_difference_seconds:f6 maximum_difference_seconds:f6 average_difference_seconds:f6",
       f"""WITH {O.EV}, g AS (SELECT {V} - valid_dispatch_response_seconds - valid_travel_time_seconds AS x FROM ev {_COMPLETE})
       SELECT COUNT(*) AS compared_records, COUNT(*) FILTER (WHERE abs(x) > 0.000001) AS component_mismatch_records, MIN(x) AS minimum_difference_seconds,
       MAX(x) AS maximum_difference_seconds, AVG(x) AS average_difference_seconds FROM g""")
def component_additivity(spark, folder):
    x = F.col(M.RESP) - F.col(M.DISP) - F.col(M.TRAV)
    return A.event_view(spark, folder, area=False).filter(M.complete()).agg(
        F.count("*").alias("compared_records"), X.n_if(~X.near(x, F.lit(0.0), 1e-6)).alias("component_mismatch_records"),
        F.min(x).alias("minimum_difference_seconds"), F.max(x).alias("maximum_difference_seconds"), F.avg(x).alias("average_difference_seconds"))


def _slow_sql(flag: str) -> str:
    return f"""b AS (SELECT AVG(total_incidents) AS demand_benchmark, AVG(average_response_seconds) AS response_benchmark FROM g),
       h AS (SELECT g.*, b.*, CASE WHEN total_incidents > demand_benchmark AND average_response_seconds > response_benchmark THEN 1 ELSE 0 END AS {flag} FROM g, b)"""


@query("b15_busy_slow_months", "incident_year:i month_number:i year_month:s total_incidents:i valid_response_count:i weighted_average_response_minutes:f2 monthly_incident_benchmark:f2 "
       "response_time_benchmark_minutes:f2 is_high_demand_slow_response_month:i",
       f"""WITH {O.LN}, g AS (SELECT incident_year, incident_month AS month_number, incident_year_month AS year_month, COUNT(*) AS total_incidents, COUNT({V}) AS valid_response_count,
       AVG({V}) AS average_response_seconds FROM ln GROUP BY ALL),
       {_slow_sql('is_high_demand_slow_response_month')} SELECT *, {O.minutes('average_response_seconds')} AS weighted_average_response_minutes,
       {O.minutes('response_benchmark')} AS response_time_benchmark_minutes, demand_benchmark AS monthly_incident_benchmark FROM h""")
def busy_slow_months(spark, folder):
    g = AN.response_by(A.lines(spark, folder, supplier=False, customer=False), ["incident_year", "incident_month", "incident_year_month"])
    out = AN.high_demand_slow(g, "is_high_demand_slow_response_month").withColumnsRenamed(
        {"incident_month": "month_number", "incident_year_month": "year_month", "demand_benchmark": "monthly_incident_benchmark"})
    return out.withColumns({"weighted_average_response_minutes": X.sec_to_min("average_response_seconds"),
                            "response_time_benchmark_minutes": X.sec_to_min("response_benchmark")}).orderBy(F.desc("is_high_demand_slow_response_month"), "year_month")


@query("b16_busy_slow_hours", "hour_number:i hour_label:s total_incidents:i valid_response_count:i average_response_minutes:f2 is_high_demand_slow_response_hour:i combined_demand_rank:i",
       f"""WITH {O.EV}, g AS (SELECT incident_hour AS hour_number, lpad(CAST(incident_hour AS VARCHAR), 2, '0') || ':00' AS hour_label, COUNT(*) AS total_incidents, COUNT({V}) AS valid_response_count, AVG({V}) AS average_response_seconds FROM ev GROUP BY ALL),
       {_slow_sql('is_high_demand_slow_response_hour')} SELECT *, {O.minutes('average_response_seconds')} AS average_response_minutes,
       RANK() OVER (ORDER BY total_incidents DESC, average_response_seconds DESC) AS combined_demand_rank FROM h""")
def busy_slow_hours(spark, folder):
    g = AN.high_demand_slow(AN.response_by(A.event_view(spark, folder, area=False), ["incident_hour"]), "is_high_demand_slow_response_hour")
    g = AN.rank_within(g, ["total_incidents", "average_response_seconds"], name="combined_demand_rank")
    return g.withColumns({"hour_number": F.col("incident_hour"), "hour_label": X.hour_label("incident_hour"),
                          "average_response_minutes": X.sec_to_min("average_response_seconds")}).orderBy("hour_number")


@query("b17_reportable_anomalies", "borough:s initial_severity_level_code:i eligible_daily_groups:i reportable_anomaly_days:i above_ucl_days:i below_lcl_days:i anomaly_rate_percentage:f6",
       f"""WITH {O.DAILY} SELECT borough, initial_severity_level_code, COUNT(*) AS eligible_daily_groups, COUNT(*) FILTER (WHERE is_reportable_response_anomaly) AS reportable_anomaly_days,
       COUNT(*) FILTER (WHERE response_anomaly_direction = 'Above UCL') AS above_ucl_days, COUNT(*) FILTER (WHERE response_anomaly_direction = 'Below LCL') AS below_lcl_days,
       COUNT(*) FILTER (WHERE is_reportable_response_anomaly) * 100.0 / COUNT(*) AS anomaly_rate_percentage
       FROM dy WHERE has_sufficient_sample AND has_sufficient_baseline GROUP BY ALL""")
def reportable_anomalies(spark, folder):
    d = daily(spark, folder).filter(F.col("has_sufficient_sample") & F.col("has_sufficient_baseline"))
    way = F.col("response_anomaly_direction")
    g = d.groupBy(*DY.LIMIT_GROUP).agg(
        F.count("*").alias("eligible_daily_groups"), X.n_if(F.col("is_reportable_response_anomaly")).alias("reportable_anomaly_days"),
        X.n_if(way == "Above UCL").alias("above_ucl_days"), X.n_if(way == "Below LCL").alias("below_lcl_days"))
    return g.withColumn("anomaly_rate_percentage", AN.share_pct("reportable_anomaly_days", "eligible_daily_groups"))


# --- outcomes -----------------------------------------------------------------

def outcome_counts(spark, df, *group):
    """Incidents per group and disposition category.

    Codes are counted first; the mapping joins the few counted rows.
    """
    g = df.groupBy(*group, "incident_disposition_code").agg(F.count("*").alias("n"))
    return A.with_disposition(spark, g).groupBy(*group, "disposition_category").agg(F.sum("n").alias("total_incidents"))


@query("b18_outcome_distribution", "disposition_category:s total_incidents:i incident_percentage:f6",
       f"WITH {O.EVD} SELECT disposition_category, COUNT(*) AS total_incidents, COUNT(*) * 100.0 / SUM(COUNT(*)) OVER () AS incident_percentage FROM evd GROUP BY 1")
def outcome_distribution(spark, folder):
    return AN.share_of(outcome_counts(spark, A.event_view(spark, folder, area=False)))


@query("b19_outcome_codes", "incident_disposition_code:s disposition_description:s disposition_category:s mapping_status:s is_documented_code:b is_unknown:b total_incidents:i incident_percentage:f6",
       f"""WITH {O.EVD}, g AS (SELECT incident_disposition_code, disposition_description, disposition_category, mapping_status, COUNT(*) AS total_incidents FROM evd GROUP BY ALL)
       SELECT *, mapping_status = 'Documented' AS is_documented_code, mapping_status = 'Unknown' AS is_unknown,
       total_incidents * 100.0 / SUM(total_incidents) OVER () AS incident_percentage FROM g""")
def outcome_codes(spark, folder):
    g = AN.share_of(AN.counts(A.event_view(spark, folder, area=False), ["incident_disposition_code"]))
    return A.with_disposition(spark, g).orderBy("disposition_category_sort", F.desc("total_incidents"), "incident_disposition_code")


def _within_sql(cte, fact, group, total, share, rank=None):
    r = f", RANK() OVER (PARTITION BY {group} ORDER BY total_incidents DESC) AS {rank}" if rank else ""
    return f"""WITH {cte}, g AS (SELECT {group}, disposition_category, COUNT(*) AS total_incidents FROM {fact} GROUP BY ALL)
       SELECT *, SUM(total_incidents) OVER (PARTITION BY {group}) AS {total}, total_incidents * 100.0 / SUM(total_incidents) OVER (PARTITION BY {group}) AS {share}{r} FROM g"""


@query("b20_outcome_by_area", "borough:s disposition_category:s total_incidents:i borough_incidents:i borough_percentage:f6",
       _within_sql(O.EVD, "evd", "borough", "borough_incidents", "borough_percentage"))
def outcome_by_area(spark, folder):
    g = outcome_counts(spark, A.event_view(spark, folder), "borough")
    return AN.share_of(g, within=["borough"], total="borough_incidents", name="borough_percentage")


def _change_sql(cte, fact, group, flag, min_n, name):
    return f"""WITH {cte}, g AS (SELECT {group}, COUNT(*) AS total_incidents, COUNT(*) FILTER (WHERE {flag}) AS changed_incidents FROM {fact} GROUP BY 1 HAVING COUNT(*) >= {min_n}),
       r AS (SELECT *, total_incidents - changed_incidents AS unchanged_incidents, ROUND(changed_incidents * 100.0 / total_incidents, 6) AS {name} FROM g)
       SELECT *, RANK() OVER (ORDER BY {name} DESC) AS change_rate_rank FROM r"""


_CHANGE = "total_incidents:i changed_incidents:i unchanged_incidents:i change_rate_rank:i"


@query("b21_class_change_rate", f"initial_call_type:s call_type_change_percentage:f6 {_CHANGE}",
       _change_sql(O.EV, "ev", "initial_call_type", "call_type_changed", 1000, "call_type_change_percentage"))
def class_change_rate(spark, folder):
    return AN.change_rate(A.event_view(spark, folder, area=False), "initial_call_type", "call_type_changed", 1000, "call_type_change_percentage")


def _transition_sql(cte, fact, a, b, flag, top=None):
    limit = f" ORDER BY transition_incidents DESC, {a}, {b} LIMIT {top}" if top else ""
    return f"""WITH {cte}, g AS (SELECT {a}, {b}, COUNT(*) AS transition_incidents FROM {fact} WHERE {flag} GROUP BY ALL)
       SELECT *, SUM(transition_incidents) OVER (PARTITION BY {a}) AS initial_changed_incidents,
       transition_incidents * 100.0 / SUM(transition_incidents) OVER (PARTITION BY {a}) AS percentage_within_initial_changes,
       transition_incidents * 100.0 / SUM(transition_incidents) OVER () AS percentage_of_all_changes,
       RANK() OVER (PARTITION BY {a} ORDER BY transition_incidents DESC) AS transition_rank_within_initial FROM g{limit}"""


_TRANS = "transition_incidents:i initial_changed_incidents:i percentage_within_initial_changes:f6 percentage_of_all_changes:f6 transition_rank_within_initial:i"


_NATION = "'nation of ' || upper(left({n}, 1)) || lower(substr({n}, 2))"
_BOTH = "SELECT *, " + ", ".join(f"{_NATION.format(n=f'{r}_call_type')} AS {r}_call_type_description" for r in ("initial", "final"))


@query("b22_class_transitions", f"initial_call_type:s initial_call_type_description:s final_call_type:s final_call_type_description:s {_TRANS}",
       f"{_BOTH} FROM ({_transition_sql(O.LN, 'ln', 'initial_call_type', 'final_call_type', 'call_type_changed', 100)}) AS t")
def class_transitions(spark, folder):
    """Keys are compared and counted; names and descriptions go to the counted pairs."""
    a, b, changed = "initial_call_type_key", "final_call_type_key", "call_type_changed"
    lines = A.lines(spark, folder, names=False)
    pairs = AN.transition_matrix(lines, a, b, changed)
    pairs = pairs.join(A.nation_names(spark, folder, "initial"), a).join(A.nation_names(spark, folder, "final"), b)
    return AN.top_n(pairs, [F.col("transition_incidents").desc(), "initial_call_type", "final_call_type"], 100)


@query("b23_severity_change_rate", f"initial_severity_level_code:i severity_change_percentage:f6 {_CHANGE}",
       _change_sql(O.EV, "ev", "initial_severity_level_code", "severity_changed", 0, "severity_change_percentage"))
def severity_change_rate(spark, folder):
    return AN.change_rate(A.event_view(spark, folder, area=False), "initial_severity_level_code", "severity_changed", name="severity_change_percentage")


@query("b24_severity_transitions", f"initial_severity_level_code:i final_severity_level_code:i {_TRANS}",
       _transition_sql(O.EV, "ev", "initial_severity_level_code", "final_severity_level_code", "severity_changed"))
def severity_transitions(spark, folder):
    return AN.transition_matrix(A.event_view(spark, folder, area=False), "initial_severity_level_code", "final_severity_level_code", "severity_changed")


@query("b25_change_overlap", "classification_change_group:s classification_change_group_sort:i total_incidents:i percentage_of_all_incidents:f6 percentage_of_changed_incidents:f6",
       f"""WITH {O.EV}, g AS (SELECT {O.CHANGE_GROUP} AS classification_change_group, COUNT(*) AS total_incidents FROM ev GROUP BY 1)
       SELECT *, CASE LEFT(classification_change_group, 4) WHEN 'Both' THEN 1 WHEN 'Call' THEN 2 WHEN 'Seve' THEN 3 WHEN 'Neit' THEN 4 ELSE 5 END AS classification_change_group_sort,
       total_incidents * 100.0 / (SELECT SUM(total_incidents) FROM g) AS percentage_of_all_incidents,
       CASE WHEN classification_change_group NOT LIKE 'Unknown%' AND classification_change_group NOT LIKE 'Neither%' THEN total_incidents * 100.0 /
       (SELECT SUM(total_incidents) FROM g WHERE classification_change_group NOT LIKE 'Unknown%' AND classification_change_group NOT LIKE 'Neither%') END AS percentage_of_changed_incidents FROM g""")
def change_overlap(spark, folder):
    g = A.event_view(spark, folder, area=False).groupBy(AN.change_group().alias("classification_change_group")).agg(F.count("*").alias("total_incidents"))
    some = ~F.col("classification_change_group").rlike("^(Unknown|Neither)")
    n_some = F.sum(F.when(some, F.col("total_incidents"))).over(AN.Window.partitionBy())
    return AN.share_of(g, name="percentage_of_all_incidents").withColumn(
        "classification_change_group_sort", AN.change_group_sort("classification_change_group")).withColumn(
        "percentage_of_changed_incidents", F.when(some, F.try_divide(F.col("total_incidents") * 100.0, n_some)))


@query("b26_annual_change_rates", "incident_year:i total_incidents:i call_type_changed_incidents:i severity_changed_incidents:i both_changed_incidents:i any_classification_changed_incidents:i "
       "unknown_change_status_incidents:i call_type_change_percentage:f6 severity_change_percentage:f6 both_changed_percentage:f6 any_classification_change_percentage:f6",
       f"""WITH {O.LN}, g AS (SELECT incident_year, COUNT(*) AS total_incidents, COUNT(*) FILTER (WHERE call_type_changed) AS call_type_changed_incidents,
       COUNT(*) FILTER (WHERE severity_changed) AS severity_changed_incidents, COUNT(*) FILTER (WHERE call_type_changed AND severity_changed) AS both_changed_incidents,
       COUNT(*) FILTER (WHERE call_type_changed OR severity_changed) AS any_classification_changed_incidents,
       COUNT(*) FILTER (WHERE call_type_changed IS NULL OR severity_changed IS NULL) AS unknown_change_status_incidents FROM ln GROUP BY 1)
       SELECT *, call_type_changed_incidents * 100.0 / total_incidents AS call_type_change_percentage, severity_changed_incidents * 100.0 / total_incidents AS severity_change_percentage,
       both_changed_incidents * 100.0 / total_incidents AS both_changed_percentage, any_classification_changed_incidents * 100.0 / total_incidents AS any_classification_change_percentage FROM g""")
def annual_change_rates(spark, folder):
    a, b = F.col("call_type_changed"), F.col("severity_changed")
    g = A.lines(spark, folder, names=False).groupBy("incident_year").agg(
        F.count("*").alias("total_incidents"), X.n_if(a).alias("call_type_changed_incidents"), X.n_if(b).alias("severity_changed_incidents"),
        X.n_if(a & b).alias("both_changed_incidents"), X.n_if(a | b).alias("any_classification_changed_incidents"), X.n_if(a.isNull() | b.isNull()).alias("unknown_change_status_incidents"))
    names = {"call_type_changed": "call_type_change", "severity_changed": "severity_change", "both_changed": "both_changed", "any_classification_changed": "any_classification_change"}
    return g.withColumns({f"{p}_percentage": AN.share_pct(f"{n}_incidents", "total_incidents") for n, p in names.items()})


@query("b27_outcome_by_severity", "initial_severity_level_code:i disposition_category:s total_incidents:i initial_severity_incidents:i percentage_within_initial_severity:f6 disposition_rank_within_severity:i",
       _within_sql(O.EVD, "evd", "initial_severity_level_code", "initial_severity_incidents", "percentage_within_initial_severity", "disposition_rank_within_severity"))
def outcome_by_severity(spark, folder):
    g = outcome_counts(spark, A.event_view(spark, folder, area=False), "initial_severity_level_code")
    g = AN.share_of(g, within=["initial_severity_level_code"], total="initial_severity_incidents", name="percentage_within_initial_severity")
    return AN.rank_within(g, "total_incidents", ["initial_severity_level_code"], "disposition_rank_within_severity")


@query("b28_annual_outcome_share", "incident_year:i disposition_category:s total_incidents:i annual_incidents:i annual_disposition_percentage:f6 previous_year_percentage:f6 year_over_year_percentage_point_change:f6",
       f"""WITH {O.LND}, g AS (SELECT incident_year, disposition_category, COUNT(*) AS total_incidents FROM lnd GROUP BY ALL),
       p AS (SELECT *, SUM(total_incidents) OVER (PARTITION BY incident_year) AS annual_incidents,
       ROUND(total_incidents * 100.0 / SUM(total_incidents) OVER (PARTITION BY incident_year), 6) AS annual_disposition_percentage FROM g)
       SELECT *, LAG(annual_disposition_percentage) OVER w AS previous_year_percentage, annual_disposition_percentage - LAG(annual_disposition_percentage) OVER w AS year_over_year_percentage_point_change
       FROM p WINDOW w AS (PARTITION BY disposition_category ORDER BY incident_year)""")
def annual_outcome_share(spark, folder):
    g = outcome_counts(spark, A.lines(spark, folder, supplier=False, customer=False), "incident_year")
    g = AN.share_of(g, within=["incident_year"], total="annual_incidents", name="annual_disposition_percentage")
    g = g.withColumn("annual_disposition_percentage", F.round("annual_disposition_percentage", 6))
    return AN.prev_change(g, "incident_year", "annual_disposition_percentage", ["disposition_category"], "previous_year_percentage", "year_over_year_percentage_point_change")


@query("b29_outcome_by_change_group", "classification_change_group:s disposition_category:s total_incidents:i classification_group_incidents:i "
       "percentage_within_change_group:f6 disposition_rank_within_change_group:i",
       _within_sql(O.EVD + f", evg AS (SELECT *, {O.CHANGE_GROUP} AS classification_change_group FROM evd)", "evg", "classification_change_group", "classification_group_incidents",
                   "percentage_within_change_group", "disposition_rank_within_change_group"))
def outcome_by_change_group(spark, folder):
    g = outcome_counts(spark, A.event_view(spark, folder, area=False).withColumn("classification_change_group", AN.change_group()), "classification_change_group")
    g = AN.share_of(g, within=["classification_change_group"], total="classification_group_incidents", name="percentage_within_change_group")
    return AN.rank_within(g, "total_incidents", ["classification_change_group"], "disposition_rank_within_change_group")


# --- measures -----------------------------------------------------------------

@query("b30_previous_year_blank", "incident_year:i total_incidents:i previous_year:i yoy_change:i yoy_percentage:f6",
       f"""WITH {O.OD}, g AS (SELECT incident_year, COUNT(*) AS total_incidents FROM od GROUP BY 1)
       SELECT g.*, p.total_incidents AS previous_year, g.total_incidents - p.total_incidents AS yoy_change,
       (g.total_incidents - p.total_incidents) * 1.0 / p.total_incidents AS yoy_percentage FROM g LEFT JOIN g p ON g.incident_year = p.incident_year + 1""")
def previous_year_blank(spark, folder):
    return M.previous_year(AN.counts(A.orders(spark, folder), ["incident_year"]), "incident_year")


_P75 = f"""{DAYS}, b AS (SELECT quantile_cont(total_incidents, 0.75) AS demand_benchmark, AVG(average_response_minutes) AS response_benchmark FROM days),
       h AS (SELECT *, CASE WHEN total_incidents >= demand_benchmark AND average_response_minutes > response_benchmark THEN 1 ELSE 0 END AS flag FROM days, b)"""


@query("b31_busy_slow_days", "flagged_days:i calendar_days:i day_share:f6",
       f"WITH {_P75} SELECT SUM(flag) AS flagged_days, date_diff('day', MIN(incident_date), MAX(incident_date)) + 1 AS calendar_days, SUM(flag) * 1.0 / (date_diff('day', MIN(incident_date), MAX(incident_date)) + 1) AS day_share FROM h")
def busy_slow_days(spark, folder):
    d = AN.high_demand_slow(day_means(spark, folder), "flag", "p75", response="average_response_minutes")
    days = F.date_diff(F.max("incident_date"), F.min("incident_date")) + 1
    return d.agg(F.sum("flag").alias("flagged_days"), days.alias("calendar_days"), M.per(F.sum("flag"), days).alias("day_share"))


@query("b31_busy_slow_day_flags", "incident_date:d total_incidents:i average_response_minutes:f6 flag:i", f"WITH {_P75} SELECT * FROM h")
def busy_slow_day_flags(spark, folder):
    return AN.high_demand_slow(day_means(spark, folder), "flag", "p75", response="average_response_minutes")


_HELD = "average_held_minutes average_non_held_minutes held_difference_minutes held_difference_percentage stddev_held_minutes stddev_non_held_minutes".split()


@query("b32_held_difference", "borough:s " + " ".join(f"{n}:f6" for n in _HELD),
       f"""WITH {O.EV}, g AS (SELECT borough, AVG({V}) FILTER (WHERE is_held) / 60 AS h, AVG({V}) FILTER (WHERE is_held = FALSE) / 60 AS f,
       stddev_pop({V} / 60) FILTER (WHERE is_held) AS stddev_held_minutes, stddev_pop({V} / 60) FILTER (WHERE is_held = FALSE) AS stddev_non_held_minutes FROM ev GROUP BY 1)
       SELECT *, h AS average_held_minutes, f AS average_non_held_minutes, h - f AS held_difference_minutes, (h - f) / f AS held_difference_percentage FROM g""")
def held_difference(spark, folder):
    return M.measure(A.event_view(spark, folder), _HELD, ["borough"])


@query("b33_component_measures", "complete_incidents:i dispatch_share:f6 travel_share:f6 component_difference_seconds:f2 component_share_total:f6",
       f"""WITH {O.EV}, g AS (SELECT COUNT(*) AS complete_incidents, SUM(valid_dispatch_response_seconds) AS d, SUM(valid_travel_time_seconds) AS t, SUM({V}) AS r FROM ev {_COMPLETE})
       SELECT *, d / r AS dispatch_share, t / r AS travel_share, r - d - t AS component_difference_seconds, d / r + t / r AS component_share_total FROM g""")
def component_measures(spark, folder):
    return M.measure(A.event_view(spark, folder, area=False), ["complete_incidents", "dispatch_share", "travel_share", "component_difference_seconds", "component_share_total"])


@query("b34_final_role", "call_type:s final_incidents:i final_share:f6 final_rank:i",
       f"""WITH {O.EV}, g AS (SELECT final_call_type AS call_type, COUNT(*) AS final_incidents FROM ev GROUP BY 1)
       SELECT *, final_incidents * 1.0 / SUM(final_incidents) OVER () AS final_share, DENSE_RANK() OVER (ORDER BY final_incidents DESC) AS final_rank FROM g""")
def final_role(spark, folder):
    fact, dims = A.star(spark, folder)
    g = M.share_removing(fact.withColumnRenamed("final_call_type_key", "call_type_key"), "call_type_key", name="final_share")
    g = AN.rank_within(g, "total_incidents", name="final_rank", dense=True).withColumnRenamed("total_incidents", "final_incidents")
    return g.join(dims["call_type"], "call_type_key")


@query("b34_final_severity_role", "severity_level_code:i final_incidents:i final_share:f6 final_rank:i",
       f"""WITH {O.EV}, g AS (SELECT final_severity_level_code AS severity_level_code, COUNT(*) AS final_incidents FROM ev GROUP BY 1)
       SELECT *, final_incidents * 1.0 / SUM(final_incidents) OVER () AS final_share, DENSE_RANK() OVER (ORDER BY final_incidents DESC) AS final_rank FROM g""")
def final_severity_role(spark, folder):
    fact, dims = A.star(spark, folder)
    g = M.share_removing(fact.withColumnRenamed("final_severity_key", "severity_key"), "severity_key", name="final_share")
    g = AN.rank_within(g, "total_incidents", name="final_rank", dense=True).withColumnRenamed("total_incidents", "final_incidents")
    return g.join(dims["severity"], "severity_key")


@query("b35_anomaly_groups", "borough:s analyzable_groups:i reportable_groups:i above_groups:i below_groups:i anomaly_share:f6",
       f"""WITH {O.DAILY}, g AS (SELECT borough, COUNT(*) FILTER (WHERE has_sufficient_sample AND has_sufficient_baseline) AS analyzable_groups,
       COUNT(*) FILTER (WHERE is_reportable_response_anomaly) AS reportable_groups, COUNT(*) FILTER (WHERE is_reportable_response_anomaly AND is_above_upper_control_limit) AS above_groups,
       COUNT(*) FILTER (WHERE is_reportable_response_anomaly AND is_below_lower_control_limit) AS below_groups FROM dy GROUP BY 1)
       SELECT *, reportable_groups * 1.0 / NULLIF(analyzable_groups, 0) AS anomaly_share FROM g""")
def anomaly_groups(spark, folder):
    return M.daily_groups(daily(spark, folder), ["borough"])


_EXEC = "valid_response_percentage average_response_minutes stddev_response_minutes response_cv p90_response_minutes p95_response_minutes held_percentage transported_percentage".split()
_EXEC_SQL = f"""COUNT(*) AS total_incidents, COUNT(*) FILTER (WHERE is_valid_incident_response) / COUNT(*) AS valid_response_percentage,
  SUM({V}) / COUNT({V}) / 60 AS average_response_minutes, stddev_pop({V} / 60) AS stddev_response_minutes,
  stddev_pop({V} / 60) / (AVG({V}) / 60) AS response_cv, quantile_cont({V} / 60, 0.9) AS p90_response_minutes, quantile_cont({V} / 60, 0.95) AS p95_response_minutes,
  COUNT(*) FILTER (WHERE is_held) / COUNT(*) AS held_percentage, COUNT(*) FILTER (WHERE disposition_category = 'Transported') / COUNT(*) AS transported_percentage"""


@query("b36_executive_summary", "total_incidents:i " + " ".join(f"{n}:f6" for n in _EXEC), f"WITH {O.EVD} SELECT {_EXEC_SQL} FROM evd")
def executive_summary(spark, folder):
    return M.measure(A.with_disposition(spark, A.event_view(spark, folder, area=False)), ["total_incidents", *_EXEC])


@query("b37_daily_demand_response", "incident_date:d total_incidents:i average_response_minutes:f6", f"WITH {DAYS} SELECT * FROM days")
def daily_demand_response(spark, folder):
    return day_means(spark, folder)


@query("b38_control_chart_series", "incident_date:d average_response_minutes:f6 center_line:f6 upper_control_limit:f6 lower_control_limit:f6",
       f"""WITH {DAYS}, s AS (SELECT AVG(average_response_minutes) AS center_line, stddev_pop(average_response_minutes) AS sd FROM days)
       SELECT *, center_line + 3 * sd AS upper_control_limit, GREATEST(0, center_line - 3 * sd) AS lower_control_limit FROM days, s""")
def control_chart_series(spark, folder):
    return DY.control_chart(day_means(spark, folder), "average_response_minutes").orderBy("incident_date")


@query("b39_sliced_measures", "initial_call_type:s total_incidents:i " + " ".join(f"{n}:f6" for n in _EXEC),
       f"WITH {O.EVD} SELECT initial_call_type, {_EXEC_SQL} FROM evd WHERE incident_year = 2024 AND borough IN ('ASIA', 'EUROPE') AND initial_severity_level_code = 1 GROUP BY 1")
def sliced_measures(spark, folder):
    slice_ = (F.col("incident_year") == 2024) & F.col("borough").isin("ASIA", "EUROPE") & (F.col("initial_severity_level_code") == 1)
    return M.measure(A.with_disposition(spark, A.event_view(spark, folder)), ["total_incidents", *_EXEC], ["initial_call_type"], slice_)


_ALL = [
    ("total_incidents", "i", "COUNT(*)"), ("valid_incident_flag_count", "i", "COUNT(*) FILTER (WHERE is_valid_incident_response)"),
    ("valid_dispatch_flag_count", "i", "COUNT(*) FILTER (WHERE is_valid_dispatch_response)"), ("valid_response_count", "i", f"COUNT({V})"),
    ("valid_travel_count", "i", "COUNT(valid_travel_time_seconds)"), ("total_response_seconds", "f1", f"SUM({V})"),
    ("total_dispatch_seconds", "f1", "SUM(valid_dispatch_response_seconds)"), ("total_travel_seconds", "f1", "SUM(valid_travel_time_seconds)"),
    ("valid_response_percentage", "f6", "COUNT(*) FILTER (WHERE is_valid_incident_response) / COUNT(*)"),
    ("average_response_minutes", "f6", f"AVG({V}) / 60"), ("average_dispatch_minutes", "f6", "AVG(valid_dispatch_response_seconds) / 60"),
    ("average_travel_minutes", "f6", "AVG(valid_travel_time_seconds) / 60"), ("stddev_response_minutes", "f6", f"stddev_pop({V}) / 60"),
    ("response_cv", "f6", f"stddev_pop({V}) / AVG({V})"), ("p90_response_minutes", "f6", f"quantile_cont({V}, 0.9) / 60"),
    ("p95_response_minutes", "f6", f"quantile_cont({V}, 0.95) / 60"), ("held_incidents", "i", "COUNT(*) FILTER (WHERE is_held)"),
    ("held_percentage", "f6", "COUNT(*) FILTER (WHERE is_held) / COUNT(*)"),
    ("transported_incidents", "i", "COUNT(*) FILTER (WHERE disposition_category = 'Transported')"),
    ("transported_percentage", "f6", "COUNT(*) FILTER (WHERE disposition_category = 'Transported') / COUNT(*)"),
    ("not_transported_incidents", "i", "COUNT(*) FILTER (WHERE disposition_category = 'Not Transported')"),
    ("not_transported_percentage", "f6", "COUNT(*) FILTER (WHERE disposition_category = 'Not Transported') / COUNT(*)"),
    ("call_type_changed_incidents", "i", "COUNT(*) FILTER (WHERE call_type_changed)"),
    ("call_type_change_percentage", "f6", "COUNT(*) FILTER (WHERE call_type_changed) / COUNT(*)"),
    ("severity_changed_incidents", "i", "COUNT(*) FILTER (WHERE severity_changed)"),
    ("severity_change_percentage", "f6", "COUNT(*) FILTER (WHERE severity_changed) / COUNT(*)"),
]


@query("b39_measure_catalogue", "borough:s " + " ".join(f"{n}:{t}" for n, t, _ in _ALL),
       f"WITH {O.EVD} SELECT borough, {', '.join(f'{e} AS {n}' for n, _, e in _ALL)} FROM evd GROUP BY 1")
def measure_catalogue(spark, folder):
    return M.measure(A.with_disposition(spark, A.event_view(spark, folder)), [n for n, _, _ in _ALL], ["borough"])


# Removing one dimension's filter leaves the others: each member's share in its year.
_MEMBERS = {"weekday": ("incident_day_of_week_number", "dow"), "hour": ("incident_hour", "incident_hour"), "time_of_day": ("time_of_day", "time_of_day"),
            "area": ("borough", "borough"), "call_type": ("initial_call_type", "initial_call_type"), "disposition": ("disposition_category", "disposition_category")}


@query("b39_member_shares", "dimension:s incident_year:i member:s total_incidents:i incident_share:f6",
       f"WITH {O.EVD}, m AS (" + " UNION ALL ".join(f"SELECT '{d}' AS dimension, incident_year, CAST({c} AS VARCHAR) AS member FROM evd" for d, (_, c) in _MEMBERS.items())
       + "), g AS (SELECT dimension, incident_year, member, COUNT(*) AS total_incidents FROM m GROUP BY ALL) "
       "SELECT *, total_incidents * 1.0 / SUM(total_incidents) OVER (PARTITION BY dimension, incident_year) AS incident_share FROM g")
def member_shares(spark, folder):
    ev = A.with_disposition(spark, A.event_view(spark, folder))
    return M.member_shares(ev, {d: c for d, (c, _) in _MEMBERS.items()}, ["incident_year"])


_ROLES = {"initial class": "initial_call_type", "final class": "final_call_type", "initial severity": "initial_severity_level_code", "final severity": "final_severity_level_code"}


@query("b34_both_roles", "dimension:s member:s total_incidents:i incident_share:f6",
       f"WITH {O.EV}, m AS (" + " UNION ALL ".join(f"SELECT '{d}' AS dimension, CAST({c} AS VARCHAR) AS member FROM ev" for d, c in _ROLES.items())
       + "), g AS (SELECT dimension, member, COUNT(*) AS total_incidents FROM m GROUP BY ALL) "
       "SELECT *, total_incidents * 1.0 / SUM(total_incidents) OVER (PARTITION BY dimension) AS incident_share FROM g")
def both_roles(spark, folder):
    """Both roles of two dimensions from one counted table."""
    return M.member_shares(A.event_view(spark, folder, area=False), _ROLES)


# --- forecast -----------------------------------------------------------------

def _last_complete(fact: str) -> str:
    """The last month that the data cover to its end, as a month index."""
    return f"(SELECT year(d) * 12 + month(d) - 1 - CASE WHEN d = last_day(d) THEN 0 ELSE 1 END FROM (SELECT MAX(incident_date) AS d FROM {fact}))"


HELD_OUT = 12


def forecast_sql(monthly: str, seg: str = "", horizon: int = 12) -> str:
    """CTEs for the forecast over ``mon(seg, m, y)`` given as SQL."""
    s, by, on = (f"{seg}, ", f"GROUP BY {seg}", f"USING ({seg})") if seg else ("", "", "ON TRUE")
    on2 = f"USING ({seg}, phase)" if seg else "USING (phase)"
    return f"""{monthly},
  tr AS (SELECT {s}regr_slope(y, m) AS slope, regr_intercept(y, m) AS icpt, COUNT(*) AS n, MAX(m) AS last_m FROM mon {by}),
  rs AS (SELECT {s}m % 12 AS phase, y - (icpt + slope * m) AS e FROM mon JOIN tr {on}),
  se AS (SELECT {s}phase, AVG(e) AS sea FROM rs GROUP BY ALL),
  sp AS (SELECT {s}sqrt(AVG((e - sea) ** 2)) AS sd FROM rs JOIN se {on2} {by}),
  ah AS (SELECT tr.*, r.range AS h, last_m + r.range AS m, (last_m + r.range) % 12 AS phase FROM tr, range(1, {horizon + 1}) r),
  fc AS (SELECT {s}h, m, m // 12 AS year, m % 12 + 1 AS month, icpt + slope * m + COALESCE(sea, 0) AS forecast,
    icpt + slope * m + COALESCE(sea, 0) - 1.959964 * sd * sqrt(1 + h / n) AS lower,
    icpt + slope * m + COALESCE(sea, 0) + 1.959964 * sd * sqrt(1 + h / n) AS upper
    FROM ah LEFT JOIN se {on2} JOIN sp {on})"""


_MI = "incident_year * 12 + incident_month - 1"


def _counts_sql(seg: str = "", held_out: int = 0) -> str:
    s = f"{seg}, " if seg else ""
    frame = f"(SELECT DISTINCT {seg} FROM od) CROSS JOIN " if seg else ""
    on = f"g.{seg} = f.{seg} AND " if seg else ""
    return f"""{O.OD}, g AS (SELECT {s}{_MI} AS m, COUNT(*) AS y FROM od WHERE {_MI} <= {_last_complete('od')} - {held_out} GROUP BY ALL),
  f AS (SELECT {s}m FROM {frame}(SELECT unnest(range(MIN(m), MAX(m) + 1)) AS m FROM g)),
  mon AS (SELECT {('f.' + seg + ', ') if seg else ''}f.m, COALESCE(y, 0) AS y FROM f LEFT JOIN g ON {on}g.m = f.m)"""


_FC = "h:i year:i month:i forecast:f4 lower:f4 upper:f4"


@query("b40_demand_forecast", _FC, f"WITH {forecast_sql(_counts_sql())} SELECT * FROM fc")
def demand_forecast(spark, folder):
    return FO.forecast(FO.monthly_counts(A.orders(spark, folder), "incident_date", complete=True))


@query("b40_segment_forecast", "initial_severity_level_code:i " + _FC,
       f"WITH {forecast_sql(_counts_sql('initial_severity_level_code'), 'initial_severity_level_code')} SELECT * FROM fc")
def segment_forecast(spark, folder):
    seg = ["initial_severity_level_code"]
    return FO.forecast(FO.monthly_counts(A.orders(spark, folder), "incident_date", seg, True), seg)


_W = ", ".join(map(str, FO.WEIGHTS))
_STEP = """SELECT {key}, i + 1 AS i, {l} AS level, beta * ({l} - level) + (1 - beta) * trend AS trend,
         list_transform(range(0, 12), lambda j: CASE WHEN j = i % 12 THEN gamma * (y[i + 1] - ({l})) + (1 - gamma) * season[j + 1] ELSE season[j + 1] END) AS season
         FROM {t} JOIN {s} USING (initial_severity_level_code{more}) WHERE i < n{cut}"""
_LEVEL = "(alpha * (y[i + 1] - season[i % 12 + 1]) + (1 - alpha) * (level + trend))"


def _fold_sql(name: str, source: str, key: str, more: str, cut: str) -> str:
    """A recursive walk over the months; ``source`` has the series ``y``, its length ``n`` and the weights."""
    return f"""{name} AS (SELECT {key}, 12 AS i, list_avg(y[1:12]) AS level, (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 AS trend,
         list_transform(y[1:12], lambda v: v - list_avg(y[1:12])) AS season FROM {source}
         UNION ALL {_STEP.format(key=key, l=_LEVEL, t=name, s=source, more=more, cut=cut)})"""


_KEY3 = "initial_severity_level_code, alpha, beta, gamma"


@query("b40_smoothing_forecast", "initial_severity_level_code:i alpha:f1 beta:f1 gamma:f1 held_out_rmse:f4 h:i year:i month:i forecast:f4",
       f"""WITH RECURSIVE {_counts_sql('initial_severity_level_code')},
       sr AS (SELECT initial_severity_level_code, list(y::DOUBLE ORDER BY m) AS y, COUNT(*) AS n, MAX(m) AS last_m FROM mon GROUP BY 1),
       gr AS (SELECT sr.*, alpha, beta, gamma FROM sr, (SELECT unnest([{_W}])::DOUBLE AS alpha), (SELECT unnest([{_W}])::DOUBLE AS beta), (SELECT unnest([{_W}])::DOUBLE AS gamma)),
       {_fold_sql('f1', 'gr', _KEY3, ', alpha, beta, gamma', ' - 12')},
       er AS (SELECT {_KEY3}, sqrt(list_avg(list_transform(range(1, 13), lambda h: (y[n - 12 + h] - (level + trend * h + season[(i + h - 1) % 12 + 1])) ** 2))) AS e
              FROM f1 JOIN gr USING (initial_severity_level_code, alpha, beta, gamma) WHERE i = n - 12),
       bw AS (SELECT * FROM er QUALIFY row_number() OVER (PARTITION BY initial_severity_level_code ORDER BY round(e, 6), alpha, beta, gamma) = 1),
       ch AS (SELECT sr.*, alpha, beta, gamma, e FROM sr JOIN bw USING (initial_severity_level_code)),
       {_fold_sql('f2', 'ch', _KEY3, ', alpha, beta, gamma', '')}
       SELECT {_KEY3}, e AS held_out_rmse, h.range AS h, (last_m + h.range) // 12 AS year, (last_m + h.range) % 12 + 1 AS month,
       level + trend * h.range + season[(i + h.range - 1) % 12 + 1] AS forecast FROM f2 JOIN ch USING (initial_severity_level_code, alpha, beta, gamma), range(1, 13) h WHERE i = n""")
def smoothing_forecast(spark, folder):
    seg = ["initial_severity_level_code"]
    return FO.smoothing_forecast(FO.monthly_counts(A.orders(spark, folder), "incident_date", seg, True), seg)


@query("b41_forecast_error", "initial_severity_level_code:i months:i mae:f4 rmse:f4 mape:f4",
       f"""WITH {forecast_sql(_counts_sql('initial_severity_level_code', HELD_OUT), 'initial_severity_level_code')},
       act AS (SELECT initial_severity_level_code, {_MI} AS m, COUNT(*) AS y FROM od WHERE {_MI} <= {_last_complete('od')} GROUP BY ALL),
       e AS (SELECT initial_severity_level_code, COALESCE(y, 0) AS y, COALESCE(y, 0) - forecast AS e
       FROM fc LEFT JOIN act USING (initial_severity_level_code, m))
       SELECT initial_severity_level_code, COUNT(*) AS months, AVG(abs(e)) AS mae, sqrt(AVG(e * e)) AS rmse, AVG(abs(e / NULLIF(y, 0))) * 100 AS mape FROM e GROUP BY 1""")
def forecast_error(spark, folder):
    seg = ["initial_severity_level_code"]
    actual = pin(FO.monthly_counts(A.orders(spark, folder), "incident_date", seg, True), "monthly")
    trained = FO.forecast(FO.without_last(actual, HELD_OUT), seg, HELD_OUT)
    return FO.forecast_error(actual, trained, seg)


@query("b42_response_forecast", _FC,
       f"WITH {forecast_sql(f'{O.LN}, mon AS (SELECT {_MI} AS m, AVG({V}) AS y FROM ln WHERE {_MI} <= {_last_complete("ln")} GROUP BY 1 HAVING COUNT({V}) > 0)')} SELECT * FROM fc")
def response_forecast(spark, folder):
    return FO.forecast(FO.monthly_means(A.lines(spark, folder, supplier=False, customer=False), "incident_date", V, complete=True))
