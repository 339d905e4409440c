"""Windows, ordering, limits and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from beaconry.operators import analysis as AN
from beaconry.operators import daily as DY
from beaconry.operators import dims as D
from beaconry.operators import incremental as INC
from beaconry.plans import analogs as A
from beaconry.plans import oracle as O
from beaconry.plans.aggregates import daily, daily_base
from beaconry.plans.registry import query
from beaconry.session import pin
from beaconry.sources.tables import latest, table


@query("w01_lag_global", "incident_year:i total_incidents:i previous:i change:i",
       f"""WITH {O.OD}, g AS (SELECT incident_year, COUNT(*) AS total_incidents FROM od GROUP BY 1)
       SELECT *, LAG(total_incidents) OVER (ORDER BY incident_year) AS previous, total_incidents - LAG(total_incidents) OVER (ORDER BY incident_year) AS change FROM g""")
def lag_global(spark, folder):
    return AN.prev_change(AN.counts(A.orders(spark, folder), ["incident_year"]), "incident_year", "total_incidents")


@query("w02_lag_partition", "o_orderstatus:s incident_year:i year_share:f6 previous:f6 change:f6",
       f"""WITH {O.OD}, g AS (SELECT incident_year, o_orderstatus, COUNT(*) AS n FROM od GROUP BY ALL),
       p AS (SELECT *, n * 100.0 / SUM(n) OVER (PARTITION BY incident_year) AS year_share FROM g)
       SELECT *, LAG(year_share) OVER w AS previous, year_share - LAG(year_share) OVER w AS change FROM p WINDOW w AS (PARTITION BY o_orderstatus ORDER BY incident_year)""")
def lag_partition(spark, folder):
    g = AN.share_of(AN.counts(A.orders(spark, folder), ["incident_year", "o_orderstatus"]), within=["incident_year"], name="year_share")
    return AN.prev_change(g, "incident_year", "year_share", within=["o_orderstatus"])


@query("w03_rank_global", "zipcode:s total_incidents:i demand_rank:i",
       f"WITH {O.EV} SELECT zipcode, COUNT(*) AS total_incidents, RANK() OVER (ORDER BY COUNT(*) DESC) AS demand_rank FROM ev GROUP BY 1")
def rank_global(spark, folder):
    return AN.rank_within(AN.counts(A.event_view(spark, folder, area=False), ["zipcode"]), "total_incidents", name="demand_rank")


@query("w04_rank_partition", "borough:s zipcode:s total_incidents:i area_rank:i",
       f"""WITH {O.EV}, g AS (SELECT borough, zipcode, COUNT(*) AS total_incidents FROM ev GROUP BY ALL)
       SELECT *, RANK() OVER (PARTITION BY borough ORDER BY total_incidents DESC) AS area_rank FROM g""")
def rank_partition(spark, folder):
    return AN.rank_within(AN.counts(A.event_view(spark, folder), ["borough", "zipcode"]), "total_incidents", ["borough"], "area_rank")


_DAY = "incident_date:d borough:s initial_severity_level_code:i"


@query("w05_trailing_baseline", _DAY + " historical_baseline_day_count:i response_center_line_seconds:f4 daily_average_stddev_seconds:f4", f"WITH {O.DAILY} SELECT * FROM dy")
def trailing_baseline(spark, folder):
    d = DY.sample_quality(daily_base(spark, folder))
    return DY.trailing_baseline(d, DY.LIMIT_GROUP, "incident_date", "average_incident_response_seconds")


_LATE = "incident_date >= (SELECT MIN(incident_date) + INTERVAL 20 DAY FROM ev)"


@query("w05_incremental_baseline", _DAY + " historical_baseline_day_count:i response_center_line_seconds:f4 daily_average_stddev_seconds:f4", f"WITH {O.DAILY} SELECT * FROM dy WHERE {_LATE}")
def incremental_baseline(spark, folder):
    """Baselines of the days of a second load, from the carried tail of the first 20 days and the new days alone."""
    d = pin(DY.sample_quality(daily_base(spark, folder)), "daily-base")
    start = d.agg(F.date_add(F.min("incident_date"), 20)).scalar()
    tail = pin(INC.tail_state(d, DY.LIMIT_GROUP, "incident_date", before=F.col("incident_date") < start), "baseline-tail")
    return INC.trailing_baseline(tail, d.filter(F.col("incident_date") >= start), DY.LIMIT_GROUP, "incident_date", "average_incident_response_seconds")


@query("w06_control_limits", _DAY + " has_sufficient_baseline:b upper_control_limit_seconds:f4 lower_control_limit_seconds:f4 "
       "upper_warning_limit_seconds:f4 lower_warning_limit_seconds:f4", f"WITH {O.DAILY} SELECT * FROM dy")
def control_limits(spark, folder):
    return daily(spark, folder)


@query("w07_anomaly_flags", _DAY + " is_above_upper_control_limit:b is_below_lower_control_limit:b is_response_anomaly:b response_anomaly_direction:s is_reportable_response_anomaly:b",
       f"WITH {O.DAILY} SELECT * FROM dy")
def anomaly_flags(spark, folder):
    return daily(spark, folder)


@query("w08_sample_quality", _DAY + " has_sufficient_sample:b analytics_quality_status:s", f"WITH {O.DAILY} SELECT * FROM dy")
def sample_quality(spark, folder):
    return DY.sample_quality(daily_base(spark, folder))


@query("w09_share_by_window", "time_of_day:s total_incidents:i incident_percentage:f6",
       f"WITH {O.EV} SELECT time_of_day, COUNT(*) AS total_incidents, COUNT(*) * 100.0 / SUM(COUNT(*)) OVER () AS incident_percentage FROM ev GROUP BY 1")
def share_by_window(spark, folder):
    return AN.share_of(AN.counts(A.event_view(spark, folder, area=False), ["time_of_day"]))


@query("w10_dense_numbering", "key:i borough:s zipcode:s", f"""WITH {O.EV} SELECT row_number() OVER (ORDER BY borough, zipcode) AS key, *
       FROM (SELECT DISTINCT borough, zipcode FROM ev)""")
def dense_numbering(spark, folder):
    return D.dense_key_at_scale(D.distinct_members(A.events(spark, folder), ["borough", "zipcode"]), ["borough", "zipcode"], "key")


@query("w11_dense_rank_visible", "zipcode:s total_incidents:i visible_rank:i",
       f"""WITH {O.EV}, g AS (SELECT zipcode, COUNT(*) AS total_incidents, zipcode <> 'UNKNOWN' AND zipcode < '10030' AS shown FROM ev GROUP BY 1)
       SELECT zipcode, total_incidents, CASE WHEN shown THEN DENSE_RANK() OVER (PARTITION BY shown ORDER BY total_incidents DESC) END AS visible_rank FROM g""")
def dense_rank_visible(spark, folder):
    """All areas; a rank for those a report shows, none for the others and for the unknown one."""
    g = AN.counts(A.event_view(spark, folder, area=False), ["zipcode"])
    return AN.rank_visible(g, "total_incidents", "zipcode", F.col("zipcode") < "10030")


@query("w12_rank_two_measures", "incident_hour:i total_incidents:i average_response_seconds:f6 combined_rank:i",
       f"""WITH {O.EV}, g AS (SELECT incident_hour, COUNT(*) AS total_incidents, AVG(valid_incident_response_seconds) AS average_response_seconds FROM ev GROUP BY 1)
       SELECT *, RANK() OVER (ORDER BY total_incidents DESC, average_response_seconds DESC) AS combined_rank FROM g""")
def rank_two_measures(spark, folder):
    g = AN.response_by(A.event_view(spark, folder, area=False), ["incident_hour"])
    return AN.rank_within(g, ["total_incidents", "average_response_seconds"], name="combined_rank")


@query("o01_mixed_sort", "pos:i borough:s total_incidents:i zipcode:s",
       f"""WITH {O.EV}, g AS (SELECT borough, zipcode, COUNT(*) AS total_incidents FROM ev GROUP BY ALL)
       SELECT *, row_number() OVER (ORDER BY borough, total_incidents DESC, zipcode) AS pos FROM g""")
def mixed_sort(spark, folder):
    order = ["borough", F.col("total_incidents").desc(), "zipcode"]
    return D.dense_key_at_scale(AN.counts(A.event_view(spark, folder), ["borough", "zipcode"]), order, "pos")


@query("o02_top_n", "l_partkey:i n:i", "SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 20")
def top_n(spark, folder):
    return AN.top_n(AN.counts(table(spark, folder, "lineitem"), ["l_partkey"], "n"), [F.col("n").desc(), "l_partkey"], 20)


@query("o03_top_n_excluding", "final_call_type:s total_incidents:i",
       f"""WITH {O.EV} SELECT final_call_type, COUNT(*) AS total_incidents FROM ev WHERE final_call_type NOT IN ('UNKNOWN', 'REVIEW')
       GROUP BY 1 ORDER BY total_incidents DESC, final_call_type LIMIT 3""")
def top_n_excluding(spark, folder):
    kept = A.event_view(spark, folder, area=False).filter(~F.col("final_call_type").isin("UNKNOWN", "REVIEW"))
    return AN.top_n(AN.counts(kept, ["final_call_type"]), [F.col("total_incidents").desc(), "final_call_type"], 3)


@query("o04_latest_record", "event_id:i ts:d", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 1")
def latest_record(spark, folder):
    return latest(table(spark, folder, "events"), "ts", ties=["event_id"])


@query("u01_union_by_name", "nationkey:i side:s acctbal:f2",
       "SELECT c_nationkey AS nationkey, 'customer' AS side, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_nationkey, 'supplier', s_acctbal FROM supplier")
def union_by_name(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("side"), F.col("c_acctbal").alias("acctbal"))
    s = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("side"), F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s)


_SUMMARY = {"orders": "o_totalprice", "lineitem": "l_extendedprice", "customer": "c_acctbal", "supplier": "s_acctbal"}


@query("u02_union_of_summaries", "table_name:s row_count:i largest:f2",
       " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, MAX({c}) AS largest FROM {t}" for t, c in _SUMMARY.items()))
def union_of_summaries(spark, folder):
    parts = [table(spark, folder, t).agg(F.count("*").alias("row_count"), F.max(c).alias("largest")).withColumn("table_name", F.lit(t)) for t, c in _SUMMARY.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("u03_distinct_rows", "l_returnflag:s l_linestatus:s", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus").distinct()
