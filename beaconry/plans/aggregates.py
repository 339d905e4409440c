"""Aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import analysis as AN
from beaconry.operators import daily as DY
from beaconry.operators import quality as QC
from beaconry.operators import quantiles as QT
from beaconry.operators import measures as M
from beaconry.plans import analogs as A
from beaconry.plans import oracle as O
from beaconry.plans.registry import query
from beaconry.session import pin
from beaconry.sources.tables import table

V = "valid_incident_response_seconds"


def daily(spark, folder):
    """The daily table of the event incidents with limits and flags."""
    return DY.daily_table(A.event_view(spark, folder))


def daily_base(spark, folder):
    return DY.daily_performance(A.event_view(spark, folder))


@query("a01_grouped_count", "initial_call_type:s total_incidents:i",
       f"WITH {O.EV} SELECT initial_call_type, COUNT(*) AS total_incidents FROM ev GROUP BY 1")
def grouped_count(spark, folder):
    return AN.counts(A.event_view(spark, folder, area=False), ["initial_call_type"]).orderBy(F.col("total_incidents").desc())


@query("a02_global_audit", "total_rows:i null_severity:i negative_dispatch:i missing_travel:i first_time:d last_time:d",
       f"""WITH {O.EV} SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE initial_severity_level_code IS NULL) AS null_severity,
       COUNT(*) FILTER (WHERE dispatch_response_seconds_qy < 0) AS negative_dispatch, COUNT(*) FILTER (WHERE incident_travel_tm_seconds_qy IS NULL) AS missing_travel,
       MIN(incident_date) AS first_time, MAX(incident_date) AS last_time FROM et""")
def global_audit(spark, folder):
    return A.events(spark, folder, area=False).agg(
        F.count("*").alias("total_rows"), X.n_if(F.col("initial_severity_level_code").isNull()).alias("null_severity"),
        X.n_if(F.col("dispatch_response_seconds_qy") < 0).alias("negative_dispatch"),
        X.n_if(F.col("incident_travel_tm_seconds_qy").isNull()).alias("missing_travel"),
        F.min("incident_date").alias("first_time"), F.max("incident_date").alias("last_time"))


@query("a03_conditional_count", "borough:s held:i special:i transfer:i",
       f"""WITH {O.EV} SELECT borough, COUNT(*) FILTER (WHERE is_held) AS held, COUNT(*) FILTER (WHERE is_special_event) AS special,
       COUNT(*) FILTER (WHERE is_transfer) AS transfer FROM ev GROUP BY 1""")
def conditional_count(spark, folder):
    return A.event_view(spark, folder).groupBy("borough").agg(
        X.n_if(F.col("is_held")).alias("held"), X.n_if(F.col("is_special_event")).alias("special"), X.n_if(F.col("is_transfer")).alias("transfer"))


@query("a04_exact_distinct", "line_keys:i", "SELECT COUNT(*) AS line_keys FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def exact_distinct(spark, folder):
    return table(spark, folder, "lineitem").agg(F.countDistinct(F.struct("l_orderkey", "l_linenumber")).alias("line_keys"))


_PROFILED = ["borough", "zipcode", "initial_call_type", "final_call_type", "incident_disposition_code", "valid_incident_response_seconds", "incident_date"]


@query("a05_distinct_null_profile", "column_name:s row_count:i null_rows:i distinct_within_bound:b",
       f"WITH {O.EV} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_rows, TRUE AS distinct_within_bound FROM et" for c in _PROFILED))
def distinct_null_profile(spark, folder):
    # The exact counts, each from its column's own values, stand beside the approximate ones; the bound is three standard errors.
    ev = A.events(spark, folder)
    exact = reduce(lambda a, b: a.unionByName(b), [
        A.events(spark, folder, area=c == "borough").filter(F.col(c).isNotNull()).groupBy(c).agg(F.lit(1).alias("one")).agg(F.count("*").alias("exact")).select(F.lit(c).alias("column_name"), "exact")
        for c in _PROFILED])
    p = QC.column_profile(ev, _PROFILED, rsd=0.02).join(exact, "column_name")
    off = F.abs(F.col("approx_distinct") - F.col("exact"))
    return p.withColumn("distinct_within_bound", off <= F.greatest(F.lit(1.0), 0.06 * F.col("exact")))


_SKETCHED = ["o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"]


@query("a05_profile_from_sketches", "column_name:s row_count:i null_rows:i exact_distinct:i off_by_less_than_six_percent:b equals_one_sketch:b",
       " UNION ALL ".join(f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_rows, COUNT(DISTINCT {c}) AS exact_distinct,
       COUNT(*) > 0 AS off_by_less_than_six_percent, COUNT(*) > 0 AS equals_one_sketch FROM orders""" for c in _SKETCHED))
def profile_from_sketches(spark, folder):
    """The profile of all orders from the stored sketches of their years, beside exact counts and one sketch of all rows."""
    o = table(spark, folder, "orders").select(*_SKETCHED, F.year("o_orderdate").alias("y"))
    years = pin(QC.distinct_sketches(o, "y", _SKETCHED), "sketches")
    rolled = QC.profile_of_sketches(years, _SKETCHED)
    whole = QC.profile_of_sketches(QC.distinct_sketches(o.withColumn("y", F.lit(0)), "y", _SKETCHED), _SKETCHED).select("column_name", F.col("approx_distinct").alias("one_sketch"))
    exact = reduce(lambda a, b: a.unionByName(b), [
        o.filter(F.col(c).isNotNull()).groupBy(c).agg(F.lit(1).alias("one")).agg(F.count("*").alias("exact_distinct")).withColumn("column_name", F.lit(c)) for c in _SKETCHED])
    off = F.abs(F.col("approx_distinct") - F.col("exact_distinct")) <= F.greatest(F.lit(1.0), 0.06 * F.col("exact_distinct"))
    met = rolled.join(whole, "column_name").join(exact, "column_name")
    # sketches of parts may keep their entries in another form, so that equal means equal but for rounding
    return met.withColumns({"off_by_less_than_six_percent": off, "equals_one_sketch": F.abs(F.col("approx_distinct") - F.col("one_sketch")) <= F.greatest(F.lit(1.0), 0.02 * F.col("one_sketch"))})


@query("a06_basic_aggregates", "borough:s lo:f2 hi:f2 total:f2 mean:f6 n:i",
       f"WITH {O.EV} SELECT borough, MIN({V}) AS lo, MAX({V}) AS hi, SUM({V}) AS total, AVG({V}) AS mean, COUNT({V}) AS n FROM ev GROUP BY 1")
def basic_aggregates(spark, folder):
    return A.event_view(spark, folder).groupBy("borough").agg(F.min(V).alias("lo"), F.max(V).alias("hi"), F.sum(V).alias("total"), F.avg(V).alias("mean"), F.count(V).alias("n"))


@query("a07_population_stddev", "initial_call_type:s sd:f6", f"WITH {O.EV} SELECT initial_call_type, stddev_pop({V}) AS sd FROM ev GROUP BY 1")
def population_stddev(spark, folder):
    return A.event_view(spark, folder, area=False).groupBy("initial_call_type").agg(F.stddev_pop(V).alias("sd"))


@query("a08_discrete_percentiles", "initial_call_type:s p50:f2 p75:f2 p90:f2 p95:f2",
       f"""WITH {O.EV} SELECT initial_call_type, quantile_disc({V}, 0.5) AS p50, quantile_disc({V}, 0.75) AS p75, quantile_disc({V}, 0.9) AS p90,
       quantile_disc({V}, 0.95) AS p95 FROM ev GROUP BY 1""")
def discrete_percentiles(spark, folder):
    return QT.percentiles(A.event_view(spark, folder, area=False), ["initial_call_type"], V, DY.PERCENTILES, interpolate=False)


#: Cells of the digests below: few, so that they are cut at the smallest size already.
_CELLS = 4


def _digest_sql(source: str, group: str) -> str:
    """Digests of the response seconds of ``source`` as rows ``group, value, n``."""
    return f"""h0 AS (SELECT {group}, {V} AS v, COUNT(*) AS n FROM {source} WHERE {V} IS NOT NULL GROUP BY ALL),
  h1 AS (SELECT *, SUM(n) OVER (PARTITION BY {group} ORDER BY v) AS e, SUM(n) OVER (PARTITION BY {group}) AS t FROM h0),
  dg AS (SELECT {group}, ((e - 1) * {_CELLS}) // t AS cell, MAX(v) AS value, SUM(n) AS n FROM h1 GROUP BY ALL)"""


_RANKS = {"p50": 500, "p75": 750, "p90": 900, "p95": 950}
_ROLLED = f"""WITH {O.EV}, {_digest_sql('ev', 'incident_date, borough')},
  m0 AS (SELECT borough, value, SUM(n) AS n FROM dg GROUP BY ALL),
  m1 AS (SELECT *, SUM(n) OVER (PARTITION BY borough ORDER BY value) AS e, SUM(n) OVER (PARTITION BY borough) AS t FROM m0),
  r AS (SELECT borough, MAX(t) AS valid_responses, {', '.join(f'MIN(value) FILTER (e * 1000 >= t * {k}) AS {p}' for p, k in _RANKS.items())} FROM m1 GROUP BY 1)"""


@query("a08_rolled_up_percentiles", "borough:s valid_responses:i p50:f1 p75:f1 p90:f1 p95:f1 p50_rank_off:f6 p75_rank_off:f6 p90_rank_off:f6 p95_rank_off:f6 within_bound:b",
       f"""{_ROLLED}, x AS (SELECT r.borough, {', '.join(f"GREATEST(0, COUNT(*) FILTER (v < {p}) - (ANY_VALUE(valid_responses) * {k} + 999) // 1000 + 1) * 1.0 / ANY_VALUE(valid_responses) AS {p}_rank_off" for p, k in _RANKS.items())}
       FROM r JOIN (SELECT borough, {V} AS v FROM ev WHERE {V} IS NOT NULL) USING (borough) GROUP BY 1)
       SELECT *, GREATEST(p50_rank_off, p75_rank_off, p90_rank_off, p95_rank_off) < 1.0 / {_CELLS} AS within_bound FROM r JOIN x USING (borough)""")
def rolled_up_percentiles(spark, folder):
    """Percentiles of areas from the stored digests of their days, and how many ranks each is off, counted in the rows."""
    ev = A.event_view(spark, folder)
    days = pin(DY.daily_performance(ev, ["incident_date", "borough"], _CELLS).select("incident_date", "borough", "response_digest"), "digests")
    rolled = QT.digest_percentiles(days, ["borough"], DY.PERCENTILES, "response_digest").withColumnRenamed("borough", "area")
    hist = QT.histogram(ev, ["borough"], V)
    below = [F.sum(F.when(F.col(V) < F.col(p), F.col("n")).otherwise(0)).alias(f"_{p}") for p in _RANKS]
    met = hist.join(rolled, hist["borough"] == rolled["area"]).groupBy("borough", *_RANKS).agg(F.sum("n").alias("valid_responses"), *below)
    off = {f"{p}_rank_off": F.greatest(F.lit(0), F.col(f"_{p}") - QT.rank_of(k / 1000, F.col("valid_responses")) + 1) / F.col("valid_responses") for p, k in _RANKS.items()}
    return met.withColumns(off).withColumn("within_bound", F.greatest(*off) < 1 / _CELLS)


@query("a09_exact_percentiles", "initial_call_type:s p90:f4 p95:f4",
       f"WITH {O.EV} SELECT initial_call_type, quantile_cont({V}, 0.9) AS p90, quantile_cont({V}, 0.95) AS p95 FROM ev GROUP BY 1")
def exact_percentiles(spark, folder):
    return QT.percentiles(A.event_view(spark, folder, area=False), ["initial_call_type"], V, {"p90": 0.9, "p95": 0.95})


_DAY = "incident_date:d borough:s initial_severity_level_code:i"


@query("a10_daily_performance", _DAY + " total_incidents:i valid_dispatch_response_count:i valid_incident_response_count:i valid_travel_time_count:i "
       "total_dispatch_response_seconds:f1 total_incident_response_seconds:f1 total_travel_time_seconds:f1 average_dispatch_response_seconds:f6 "
       "average_incident_response_seconds:f6 average_travel_time_seconds:f6 population_stddev_response_seconds:f4 minimum_response_seconds:f1 "
       "maximum_response_seconds:f1 p50_response_seconds:f1 p75_response_seconds:f1 p90_response_seconds:f1 p95_response_seconds:f1 "
       "held_incident_count:i special_event_count:i transfer_incident_count:i initial_severity_label:s",
       f"""WITH {O.EV}, {O.daily(O.GRAIN)} SELECT *, CASE WHEN initial_severity_level_code = -1 THEN 'Unknown' ELSE 'Severity Level ' || initial_severity_level_code END
       AS initial_severity_label FROM d0""")
def daily_performance(spark, folder):
    return daily_base(spark, folder)


@query("a11_valid_response_rate", _DAY + " valid_response_rate:f6 valid_response_percentage:f2",
       f"""WITH {O.EV}, {O.daily(O.GRAIN)} SELECT *, valid_incident_response_count / total_incidents AS valid_response_rate,
       ROUND(valid_incident_response_count / total_incidents * 100.0, 2) AS valid_response_percentage FROM d0""")
def valid_response_rate(spark, folder):
    return DY.response_rate(daily_base(spark, folder))


@query("a12_coefficient_of_variation", _DAY + " response_coefficient_of_variation:f6 response_cv_percentage:f2",
       f"""WITH {O.EV}, {O.daily(O.GRAIN)}, c AS (SELECT *, CASE WHEN average_incident_response_seconds > 0
       THEN population_stddev_response_seconds / average_incident_response_seconds END AS response_coefficient_of_variation FROM d0)
       SELECT *, ROUND(ROUND(response_coefficient_of_variation, 10) * 100, 2) AS response_cv_percentage FROM c""")
def coefficient_of_variation(spark, folder):
    return DY.derived_metrics(daily_base(spark, folder))


@query("a13_operational_rates", _DAY + " held_incident_rate:f6 special_event_rate:f6 transfer_incident_rate:f6 held_incident_percentage:f2 "
       "special_event_percentage:f2 transfer_incident_percentage:f2",
       f"""WITH {O.EV}, {O.daily(O.GRAIN)} SELECT *, held_incident_count / total_incidents AS held_incident_rate, special_event_count / total_incidents AS special_event_rate,
       transfer_incident_count / total_incidents AS transfer_incident_rate, {O.pct2('held_incident_count', 'total_incidents')} AS held_incident_percentage,
       {O.pct2('special_event_count', 'total_incidents')} AS special_event_percentage, {O.pct2('transfer_incident_count', 'total_incidents')} AS transfer_incident_percentage FROM d0""")
def operational_rates(spark, folder):
    return DY.derived_metrics(daily_base(spark, folder))


@query("a14_weighted_average", "borough:s mean_seconds:f6", f"WITH {O.EV} SELECT borough, AVG({V}) AS mean_seconds FROM ev GROUP BY 1")
def weighted_average(spark, folder):
    return daily_base(spark, folder).groupBy("borough").agg(
        F.try_divide(F.sum("total_incident_response_seconds"), F.sum("valid_incident_response_count")).alias("mean_seconds"))


@query("a15_pooled_stddev", "initial_severity_level_code:i average_response_seconds:f6 pooled_stddev_seconds:f6",
       f"""WITH {O.EV} SELECT initial_severity_level_code, AVG({V}) AS average_response_seconds, stddev_pop({V}) AS pooled_stddev_seconds FROM ev GROUP BY 1""")
def pooled_stddev(spark, folder):
    return AN.pooled_stats(daily_base(spark, folder), ["initial_severity_level_code"])


@query("a16_having", "zipcode:s total_incidents:i", f"WITH {O.EV} SELECT zipcode, COUNT(*) AS total_incidents FROM ev GROUP BY 1 HAVING COUNT(*) >= 250")
def having(spark, folder):
    return AN.counts(A.event_view(spark, folder, area=False), ["zipcode"]).filter(F.col("total_incidents") >= 250)


@query("a17_two_level_aggregate", "dow:i days_observed:i total_incidents:i average_daily_incidents:f2",
       f"""WITH {O.OD}, d AS (SELECT incident_date, dayofweek(incident_date) + 1 AS dow, COUNT(*) AS n FROM od GROUP BY ALL)
       SELECT dow, COUNT(*) AS days_observed, SUM(n) AS total_incidents, AVG(n) AS average_daily_incidents FROM d GROUP BY 1""")
def two_level_aggregate(spark, folder):
    d = AN.counts(A.orders(spark, folder), ["incident_date"], "n")
    return d.groupBy(F.dayofweek("incident_date").alias("dow")).agg(
        F.count("*").alias("days_observed"), F.sum("n").alias("total_incidents"), F.avg("n").alias("average_daily_incidents"))


@query("a18_boolean_any", "l_suppkey:i any_return:b", "SELECT l_suppkey, bool_or(l_returnflag = 'R') AS any_return FROM lineitem GROUP BY 1")
def boolean_any(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_return"))


_H = [f"h{i:02d}" for i in range(24)]


@query("a19_weekday_hour_matrix", "dow:i " + " ".join(f"{h}:i" for h in _H),
       f"WITH {O.EV} SELECT dow, " + ", ".join(f"COUNT(*) FILTER (WHERE incident_hour = {i}) AS {h}" for i, h in enumerate(_H)) + " FROM ev GROUP BY 1")
def weekday_hour_matrix(spark, folder):
    ev = A.event_view(spark, folder, area=False).withColumn("dow", F.col("incident_day_of_week_number"))
    return AN.pivot_matrix(ev, "dow", "incident_hour", range(24))


@query("a20_year_category_series", "incident_year:i o_orderstatus:s total_incidents:i",
       f"WITH {O.OD} SELECT incident_year, o_orderstatus, COUNT(*) AS total_incidents FROM od GROUP BY ALL")
def year_category_series(spark, folder):
    return AN.counts(A.orders(spark, folder), ["incident_year", "o_orderstatus"])


@query("a21_share_filter_removed", "borough:s incident_hour:i total_incidents:i incident_share:f6",
       f"""WITH {O.EV}, g AS (SELECT borough, incident_hour, COUNT(*) AS total_incidents FROM ev GROUP BY ALL)
       SELECT *, total_incidents * 1.0 / SUM(total_incidents) OVER (PARTITION BY borough) AS incident_share FROM g""")
def share_filter_removed(spark, folder):
    return M.share_removing(A.event_view(spark, folder), "incident_hour", ["borough"])


_MEASURE_SQL = """COUNT(*) AS total_incidents, COUNT(*) FILTER (WHERE is_held) AS held_incidents,
  COUNT(*) FILTER (WHERE disposition_category = 'Transported') AS transported_incidents,
  COUNT(*) FILTER (WHERE disposition_category = 'Not Transported') AS not_transported_incidents,
  COUNT(*) FILTER (WHERE call_type_changed) AS call_type_changed_incidents, COUNT(*) FILTER (WHERE severity_changed) AS severity_changed_incidents,
  COUNT(*) FILTER (WHERE is_held) / COUNT(*) AS held_percentage,
  COUNT(*) FILTER (WHERE disposition_category = 'Transported') / COUNT(*) AS transported_percentage,
  COUNT(*) FILTER (WHERE call_type_changed) / COUNT(*) AS call_type_change_percentage"""


@query("a22_filtered_measures", "borough:s total_incidents:i held_incidents:i transported_incidents:i not_transported_incidents:i "
       "call_type_changed_incidents:i severity_changed_incidents:i held_percentage:f6 transported_percentage:f6 call_type_change_percentage:f6",
       f"WITH {O.EVD} SELECT borough, {_MEASURE_SQL} FROM evd GROUP BY 1")
def filtered_measures(spark, folder):
    names = "total_incidents held_incidents transported_incidents not_transported_incidents call_type_changed_incidents " \
            "severity_changed_incidents held_percentage transported_percentage call_type_change_percentage".split()
    return M.measure(A.with_disposition(spark, A.event_view(spark, folder)), names, ["borough"])


def day_means(spark, folder):
    """Demand and weighted mean response per calendar day."""
    d = daily_base(spark, folder).groupBy("incident_date").agg(
        F.sum("total_incidents").alias("total_incidents"),
        F.try_divide(F.sum("total_incident_response_seconds"), F.sum("valid_incident_response_count") * 60.0).alias("average_response_minutes"))
    return d


DAYS = f"{O.EV}, days AS (SELECT incident_date, COUNT(*) AS total_incidents, SUM({V}) / (COUNT({V}) * 60.0) AS average_response_minutes FROM ev GROUP BY 1)"
_PL = "days:i center_line:f6 sd:f6 upper_control_limit:f6 lower_control_limit:f6"


@query("a23_period_control_limits", _PL,
       f"""WITH {DAYS}, s AS (SELECT COUNT(average_response_minutes) AS days, AVG(average_response_minutes) AS center_line, stddev_pop(average_response_minutes) AS sd FROM days)
       SELECT *, CASE WHEN days >= 2 THEN center_line + 3 * sd END AS upper_control_limit, CASE WHEN days >= 2 THEN GREATEST(0, center_line - 3 * sd) END AS lower_control_limit FROM s""")
def period_control_limits(spark, folder):
    return DY.period_limits(day_means(spark, folder), "average_response_minutes")


@query("a24_warning_status", "incident_date:d borough:s initial_severity_level_code:i kpi_status:s",
       f"""WITH {O.DAILY} SELECT incident_date, borough, initial_severity_level_code, CASE WHEN average_incident_response_seconds > upper_control_limit_seconds
       OR average_incident_response_seconds < lower_control_limit_seconds THEN 'Out of Control'
       WHEN average_incident_response_seconds > upper_warning_limit_seconds OR average_incident_response_seconds < lower_warning_limit_seconds THEN 'Warning'
       WHEN average_incident_response_seconds IS NOT NULL AND has_sufficient_baseline THEN 'Normal' END AS kpi_status FROM dy""")
def warning_status(spark, folder):
    d = daily(spark, folder)
    lim = [F.col(f"{a}_{b}_limit_seconds") for a, b in (("lower", "control"), ("upper", "control"), ("lower", "warning"), ("upper", "warning"))]
    return d.withColumn("kpi_status", DY.kpi_status("average_incident_response_seconds", *lim))


@query("a25_peak_and_average_day", "peak_daily_incidents:i average_daily_incidents:f6 calendar_days:i",
       f"""WITH {O.OD}, d AS (SELECT incident_date, COUNT(*) AS n FROM od GROUP BY 1)
       SELECT MAX(n) AS peak_daily_incidents, SUM(n) * 1.0 / (date_diff('day', MIN(incident_date), MAX(incident_date)) + 1) AS average_daily_incidents,
       date_diff('day', MIN(incident_date), MAX(incident_date)) + 1 AS calendar_days FROM d""")
def peak_and_average_day(spark, folder):
    return M.daily_peaks(A.orders(spark, folder))


@query("a26_p75_demand", "p75_daily_demand:f4", f"WITH {DAYS} SELECT quantile_cont(total_incidents, 0.75) AS p75_daily_demand FROM days")
def p75_demand(spark, folder):
    return day_means(spark, folder).agg(F.percentile("total_incidents", 0.75).alias("p75_daily_demand"))


@query("a27_min_label", "p_type:s first_name:s", "SELECT p_type, MIN(p_name) AS first_name FROM part GROUP BY 1")
def min_label(spark, folder):
    return table(spark, folder, "part").groupBy("p_type").agg(F.min("p_name").alias("first_name"))
