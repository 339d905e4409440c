"""Projection, cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import silver as S
from beaconry.plans import analogs as A
from beaconry.plans import oracle as O
from beaconry.plans.registry import query
from beaconry.sources.tables import table



@query("c01_trim_blank_null", "incident_id:s initial_call_type:s final_call_type:s borough:s initial_severity_level_code:s",
       f"""WITH {O.RAW} SELECT incident_id, NULLIF(TRIM(initial_call_type), '') AS initial_call_type, NULLIF(TRIM(final_call_type), '') AS final_call_type,
       NULLIF(TRIM(borough), '') AS borough, NULLIF(TRIM(initial_severity_level_code), '') AS initial_severity_level_code FROM raw""")
def trim_blank_null(spark, folder):
    return S.clean_strings(A.bronze_events(spark, folder))


@query("c02_upper_indicators", "incident_id:s valid_incident_rspns_time_indc:s held_indicator:s",
       f"""WITH {O.RAW} SELECT incident_id, UPPER(TRIM(valid_incident_rspns_time_indc)) AS valid_incident_rspns_time_indc,
       UPPER(TRIM(held_indicator)) AS held_indicator FROM raw""")
def upper_indicators(spark, folder):
    return S.clean_strings(A.bronze_events(spark, folder), upper=S.INDICATORS)


@query("c03_text_to_timestamp", "incident_id:s incident_datetime:d incident_close_datetime:d",
       f"""WITH {O.RAW} SELECT incident_id, TRY_CAST(incident_datetime AS TIMESTAMP) AS incident_datetime,
       TRY_CAST(incident_close_datetime AS TIMESTAMP) AS incident_close_datetime FROM raw""")
def text_to_timestamp(spark, folder):
    return A.bronze_events(spark, folder).select("incident_id", X.to_ts("incident_datetime").alias("incident_datetime"),
                                                X.to_ts("incident_close_datetime").alias("incident_close_datetime"))


@query("c04_text_to_number", "incident_id:s severity:i dispatch:f2 travel:f2",
       f"""WITH {O.RAW} SELECT incident_id, TRY_CAST(NULLIF(TRIM(initial_severity_level_code), '') AS INTEGER) AS severity,
       TRY_CAST(dispatch_response_seconds_qy AS DOUBLE) AS dispatch, TRY_CAST(incident_travel_tm_seconds_qy AS DOUBLE) AS travel FROM raw""")
def text_to_number(spark, folder):
    return A.bronze_events(spark, folder).select(
        "incident_id", X.to_int(X.blank_to_null("initial_severity_level_code")).alias("severity"),
        X.to_double("dispatch_response_seconds_qy").alias("dispatch"), X.to_double("incident_travel_tm_seconds_qy").alias("travel"))


@query("c05_yn_to_boolean", "incident_id:s is_held:b is_valid:b",
       f"""WITH {O.RAW} SELECT incident_id, CASE UPPER(TRIM(held_indicator)) WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS is_held,
       CASE UPPER(TRIM(valid_dispatch_rspns_time_indc)) WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS is_valid FROM raw""")
def yn_to_boolean(spark, folder):
    df = S.clean_strings(A.bronze_events(spark, folder), upper=S.INDICATORS)
    return df.select("incident_id", X.yn_to_bool("held_indicator").alias("is_held"), X.yn_to_bool("valid_dispatch_rspns_time_indc").alias("is_valid"))


@query("c06_valid_measures", "incident_id:s valid_dispatch_response_seconds:f1 valid_incident_response_seconds:f1 valid_travel_time_seconds:f1",
       f"WITH {O.EV} SELECT * FROM et")
def valid_measures(spark, folder):
    return A.events(spark, folder, area=False)


@query("c07_date_parts", "incident_id:s incident_date:d incident_year:i incident_quarter:i incident_month:i incident_month_name:s "
       "incident_year_month:s incident_day_of_week_number:i incident_day_of_week_name:s incident_hour:i",
       f"""WITH {O.EV} SELECT *, quarter(incident_datetime) AS incident_quarter, strftime(incident_datetime, '%B') AS incident_month_name,
       dow AS incident_day_of_week_number, day_name AS incident_day_of_week_name FROM et""")
def date_parts(spark, folder):
    return A.events(spark, folder, area=False)


@query("c08_weekend_flag", "incident_id:s is_weekend:b", f"WITH {O.EV} SELECT incident_id, dayofweek(incident_datetime) IN (0, 6) AS is_weekend FROM et")
def weekend_flag(spark, folder):
    return A.events(spark, folder, area=False).select("incident_id", "is_weekend")


@query("c09_time_of_day", "incident_id:s incident_hour:i time_of_day:s", f"WITH {O.EV} SELECT * FROM et")
def time_of_day(spark, folder):
    return A.events(spark, folder, area=False)


@query("c10_minutes_double", "incident_id:s dispatch_response_minutes:f2 incident_response_minutes:f2 travel_time_minutes:f2",
       f"""WITH {O.EV} SELECT incident_id, ROUND(valid_dispatch_response_seconds / 60.0, 2) AS dispatch_response_minutes,
       ROUND(valid_incident_response_seconds / 60.0, 2) AS incident_response_minutes,
       ROUND(valid_travel_time_seconds / 60.0, 2) AS travel_time_minutes FROM et""")
def minutes_double(spark, folder):
    return A.events(spark, folder, area=False)


@query("c11_minutes_decimal", "event_id:i value_minutes:f2", f"SELECT event_id, {O.minutes('value')} AS value_minutes FROM events")
def minutes_decimal(spark, folder):
    return table(spark, folder, "events").select("event_id", X.sec_to_min("value").alias("value_minutes"))


@query("c12_count_percentage", "borough:s held_percentage:f2 k99_percentage:f2",
       f"""WITH {O.EV}, g AS (SELECT borough, COUNT(*) AS n, COUNT(*) FILTER (WHERE is_held) AS h, COUNT(*) FILTER (WHERE incident_hour > 99) AS z FROM ev GROUP BY 1)
       SELECT borough, {O.pct2('h', 'n')} AS held_percentage, {O.pct2('h', 'z')} AS k99_percentage FROM g""")
def count_percentage(spark, folder):
    g = A.event_view(spark, folder).groupBy("borough").agg(
        F.count("*").alias("n"), X.n_if(F.col("is_held")).alias("h"), X.n_if(F.col("incident_hour") > 99).alias("z"))
    return g.select("borough", X.pct("h", "n").alias("held_percentage"), X.pct("h", "z").alias("k99_percentage"))


@query("c13_change_flags", "incident_id:s call_type_changed:b severity_changed:b", f"WITH {O.EV} SELECT * FROM et")
def change_flags(spark, folder):
    return A.events(spark, folder, area=False)


@query("c14_elapsed_seconds", "incident_id:s incident_duration_seconds:f1 hospital_travel_seconds:f1",
       f"""WITH {O.RAW}, t AS (SELECT incident_id, TRY_CAST(incident_datetime AS TIMESTAMP) a, TRY_CAST(incident_close_datetime AS TIMESTAMP) b,
       TRY_CAST(first_to_hosp_datetime AS TIMESTAMP) c, TRY_CAST(first_hosp_arrival_datetime AS TIMESTAMP) d FROM raw)
       SELECT incident_id, CASE WHEN b >= a THEN epoch(b) - epoch(a) END AS incident_duration_seconds,
       CASE WHEN d >= c THEN epoch(d) - epoch(c) END AS hospital_travel_seconds FROM t""")
def elapsed_seconds(spark, folder):
    return S.to_silver(A.bronze_events(spark, folder))


@query("c15_record_status", "record_quality_status:s n:i",
       f"""WITH {O.RAW} SELECT CASE WHEN NULLIF(TRIM(incident_id), '') IS NULL THEN 'MISSING_INCIDENT_ID'
       WHEN TRY_CAST(incident_datetime AS TIMESTAMP) IS NULL THEN 'INVALID_INCIDENT_DATETIME'
       WHEN year(TRY_CAST(incident_datetime AS TIMESTAMP)) <> year THEN 'SOURCE_YEAR_MISMATCH' ELSE 'VALID' END AS record_quality_status,
       COUNT(*) AS n FROM raw GROUP BY 1""")
def record_status(spark, folder):
    return S.to_silver(A.bronze_events(spark, folder)).groupBy("record_quality_status").agg(F.count("*").alias("n"))


@query("c16_normalise_code", "code:s n:i",
       f"WITH {O.RAW} SELECT COALESCE(NULLIF(UPPER(TRIM(final_call_type)), ''), 'UNKNOWN') AS code, COUNT(*) AS n FROM raw GROUP BY 1")
def normalise_code(spark, folder):
    return A.bronze_events(spark, folder).groupBy(X.norm_code("final_call_type").alias("code")).agg(F.count("*").alias("n"))


@query("c17_null_sentinels", "borough:s severity:i n:i",
       f"WITH {O.EV} SELECT borough, initial_severity_level_code AS severity, COUNT(*) AS n FROM ev GROUP BY ALL")
def null_sentinels(spark, folder):
    return A.events(spark, folder).groupBy(X.or_unknown("borough").alias("borough"), X.or_unknown("initial_severity_level_code", -1).alias("severity")).agg(
        F.count("*").alias("n"))


@query("c18_date_key", "o_orderkey:i date_key:i back:d",
       "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(o_orderdate AS DATE) AS back FROM orders")
def date_key(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", X.date_key("o_orderdate").alias("date_key"))
    return o.withColumn("back", X.date_of_key("date_key"))


@query("c19_labels", "quarter_label:s year_quarter:s hour_label:s place:s severity_label:s n:i",
       f"""WITH {O.EV} SELECT 'Q' || quarter(incident_datetime) AS quarter_label, incident_year || '-Q' || quarter(incident_datetime) AS year_quarter,
       lpad(CAST(incident_hour AS VARCHAR), 2, '0') || ':00' AS hour_label, borough || ' | ' || zipcode AS place,
       CASE WHEN initial_severity_level_code = -1 THEN 'Unknown' ELSE 'Severity Level ' || initial_severity_level_code END AS severity_label,
       COUNT(*) AS n FROM ev GROUP BY ALL""")
def labels(spark, folder):
    q = F.concat(F.lit("Q"), F.quarter("incident_date").cast("string"))
    return A.event_view(spark, folder).groupBy(
        q.alias("quarter_label"), F.concat_ws("-", F.col("incident_year").cast("string"), q).alias("year_quarter"),
        X.hour_label("incident_hour").alias("hour_label"), F.concat_ws(" | ", "borough", "zipcode").alias("place"),
        X.severity_label("initial_severity_level_code").alias("severity_label")).agg(F.count("*").alias("n"))


@query("c20_sort_columns", "year_quarter_sort:i year_month_sort:i monday_first:i n:i",
       f"""WITH {O.OD} SELECT incident_year * 10 + quarter(incident_date) AS year_quarter_sort, incident_year * 100 + incident_month AS year_month_sort,
       isodow(incident_date) AS monday_first, COUNT(*) AS n FROM od GROUP BY ALL""")
def sort_columns(spark, folder):
    y = F.col("incident_year")
    return A.orders(spark, folder).groupBy(
        (y * 10 + F.quarter("incident_date")).alias("year_quarter_sort"), (y * 100 + F.col("incident_month")).alias("year_month_sort"),
        X.monday_first("incident_date").alias("monday_first")).agg(F.count("*").alias("n"))


@query("c21_month_bounds", "o_orderkey:i month_start:d month_end:d is_month_start:b is_month_end:b",
       """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, last_day(o_orderdate) AS month_end,
       day(o_orderdate) = 1 AS is_month_start, CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS is_month_end FROM orders""")
def month_bounds(spark, folder):
    d = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", X.month_start(d).alias("month_start"), F.last_day(d).alias("month_end"),
        (d == F.trunc(d, "month")).alias("is_month_start"), (d == F.last_day(d)).alias("is_month_end"))


@query("c22_calendar_parts", "o_orderkey:i week:i day:i day_of_year:i month_short:s day_short:s",
       """SELECT o_orderkey, weekofyear(o_orderdate) AS week, day(o_orderdate) AS day, dayofyear(o_orderdate) AS day_of_year,
       strftime(o_orderdate, '%b') AS month_short, strftime(o_orderdate, '%a') AS day_short FROM orders""")
def calendar_parts(spark, folder):
    d = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.weekofyear(d).alias("week"), F.dayofmonth(d).alias("day"), F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "MMM").alias("month_short"), F.date_format(d, "EEE").alias("day_short"))


@query("c23_null_safe_equality", "is_same:b n:i",
       f"WITH {O.EV} SELECT initial_severity_level_code IS NOT DISTINCT FROM final_severity_level_code AS is_same, COUNT(*) AS n FROM et GROUP BY 1")
def null_safe_equality(spark, folder):
    return A.events(spark, folder, area=False).groupBy(X.same("initial_severity_level_code", "final_severity_level_code").alias("is_same")).agg(F.count("*").alias("n"))


@query("c24_clamp_at_zero", "event_id:i clamped:f2", "SELECT event_id, GREATEST(0.0, value - 50) AS clamped FROM events")
def clamp_at_zero(spark, folder):
    return table(spark, folder, "events").select("event_id", X.at_least_zero(F.col("value") - 50).alias("clamped"))


@query("c25_safe_division", "event_id:i share:f8",
       """SELECT event_id, value / NULLIF(CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER), 0) AS share FROM events""")
def safe_division(spark, folder):
    return A.event_base(spark, folder, area=False).select("event_id", X.ratio("value", "k").alias("share"))


@query("c26_predicates", "incident_id:s initial_call_type:s incident_hour:i final_severity_level_code:i",
       f"""WITH {O.EV} SELECT * FROM et WHERE (initial_call_type IN ('VIEW', 'CLICK') AND incident_hour BETWEEN 6 AND 11)
       OR (initial_call_type NOT IN ('VIEW', 'CLICK') AND final_severity_level_code IS NULL) OR (borough IS NULL AND incident_hour > 20)""")
def predicates(spark, folder):
    c = F.col
    quick = c("initial_call_type").isin("VIEW", "CLICK")
    return A.events(spark, folder).filter((quick & c("incident_hour").between(6, 11)) | (~quick & c("final_severity_level_code").isNull())
                                          | (c("borough").isNull() & (c("incident_hour") > 20)))


@query("c27_code_labels", "label:s n:i",
       f"""WITH {O.EV} SELECT CASE WHEN initial_severity_level_code BETWEEN 1 AND 9 THEN 'Severity Level ' || initial_severity_level_code END AS label,
       COUNT(*) AS n FROM ev GROUP BY 1""")
def code_labels(spark, folder):
    label = X.mapped_label("initial_severity_level_code", X.SEVERITY_DISPLAY)
    return A.event_view(spark, folder, area=False).groupBy(label.alias("label")).agg(F.count("*").alias("n"))


@query("c28_project_reorder", "incident_count:i is_held:b borough:s incident_id:s", f"WITH {O.EV} SELECT 1 AS incident_count, * FROM ev")
def project_reorder(spark, folder):
    return A.event_view(spark, folder).select(F.lit(1).alias("incident_count"), "is_held", "borough", "incident_id")


@query("c29_math", "event_id:i gap:f4 near_fifty:b squared:f4 root:f6",
       "SELECT event_id, abs(value - 50) AS gap, abs(value - 50) <= 5 AS near_fifty, pow(value, 2) AS squared, sqrt(value) AS root FROM events")
def math_functions(spark, folder):
    v = F.col("value")
    return table(spark, folder, "events").select("event_id", F.abs(v - 50).alias("gap"), X.near(v, F.lit(50.0), 5).alias("near_fifty"),
                                                 F.pow(v, F.lit(2)).alias("squared"), F.sqrt(v).alias("root"))


@query("c30_recomputed_keys", "date_key:i month_label:s n:i",
       f"""WITH {O.OD} SELECT incident_year * 10000 + incident_month * 100 + day(incident_date) AS date_key, incident_year_month AS month_label,
       COUNT(*) AS n FROM od GROUP BY ALL""")
def recomputed_keys(spark, folder):
    return A.orders(spark, folder).groupBy(X.date_key("incident_date").alias("date_key"), X.year_month("incident_date").alias("month_label")).agg(F.count("*").alias("n"))


@query("c31_regex_group", "host:s n:i", "SELECT NULLIF(regexp_extract(url, 'https?://([^/]+)', 1), '') AS host, COUNT(*) AS n FROM pages GROUP BY 1")
def regex_group(spark, folder):
    return table(spark, folder, "pages").groupBy(X.group_of("url", r"https?://([^/]+)").alias("host")).agg(F.count("*").alias("n"))
