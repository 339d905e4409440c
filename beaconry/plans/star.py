"""Dimensions and fact construction."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import dims as D
from beaconry.operators import fact as FC
from beaconry.plans import analogs as A
from beaconry.plans import oracle as O
from beaconry.plans.registry import query
from beaconry.session import pin

_CAL = "date_key:i full_date:d year:i quarter_number:i quarter_name:s year_quarter:s year_quarter_sort:i month_number:i month_name:s " \
       "month_short_name:s year_month:s year_month_label:s year_month_sort:i week_of_year:i day_of_month:i day_of_year:i " \
       "day_of_week_number:i day_of_week_name:s day_of_week_short_name:s is_weekend:b is_month_start:b is_month_end:b"


@query("d01_calendar_dimension", _CAL, """WITH r AS (SELECT min(o_orderdate) a, max(o_orderdate) b FROM orders),
  d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS f FROM r)
  SELECT CAST(strftime(f, '%Y%m%d') AS INTEGER) AS date_key, f AS full_date, year(f) AS year, quarter(f) AS quarter_number,
  'Q' || quarter(f) AS quarter_name, year(f) || '-Q' || quarter(f) AS year_quarter, year(f) * 10 + quarter(f) AS year_quarter_sort,
  month(f) AS month_number, strftime(f, '%B') AS month_name, strftime(f, '%b') AS month_short_name, strftime(f, '%Y-%m') AS year_month,
  strftime(f, '%b %Y') AS year_month_label, CAST(strftime(f, '%Y%m') AS INTEGER) AS year_month_sort, weekofyear(f) AS week_of_year,
  day(f) AS day_of_month, dayofyear(f) AS day_of_year, dayofweek(f) + 1 AS day_of_week_number, strftime(f, '%A') AS day_of_week_name,
  strftime(f, '%a') AS day_of_week_short_name, dayofweek(f) IN (0, 6) AS is_weekend, day(f) = 1 AS is_month_start, f = last_day(f) AS is_month_end FROM d""")
def calendar_dimension(spark, folder):
    return D.calendar_of(A.orders(spark, folder), "incident_date")


@query("d02_time_dimension", "time_key:i hour_label:s time_of_day:s time_of_day_sort:i total_incidents:i",
       f"""WITH {O.EV} SELECT r.range AS time_key, lpad(CAST(r.range AS VARCHAR), 2, '0') || ':00' AS hour_label,
       ['Overnight', 'Morning', 'Afternoon', 'Evening'][r.range // 6 + 1] AS time_of_day, r.range // 6 + 1 AS time_of_day_sort,
       COUNT(incident_id) AS total_incidents FROM range(24) r LEFT JOIN ev ON incident_hour = r.range GROUP BY r.range""")
def time_dimension(spark, folder):
    n = A.event_view(spark, folder).groupBy(F.col("incident_hour").alias("time_key")).agg(F.count("*").alias("n"))
    return D.hours(spark).join(n, "time_key", "left").withColumn("total_incidents", F.coalesce("n", F.lit(0)))


_GEO = ", ".join(FC.GEOGRAPHY)


@query("d03_geography_dimension", "borough:s zipcode:s policeprecinct:s citycouncildistrict:s communitydistrict:s",
       f"WITH {O.EV} SELECT DISTINCT {_GEO} FROM ev")
def geography_dimension(spark, folder):
    return D.distinct_members(A.events(spark, folder), FC.GEOGRAPHY)


@query("d04_surrogate_key", "geography_key:i borough:s zipcode:s policeprecinct:s citycouncildistrict:s communitydistrict:s geography_label:s",
       f"""WITH {O.EV} SELECT row_number() OVER (ORDER BY {_GEO}) AS geography_key, *, borough || ' | ' || zipcode AS geography_label
       FROM (SELECT DISTINCT {_GEO} FROM ev)""")
def surrogate_key(spark, folder):
    return A.star(spark, folder)[1]["geography"]


_EARLY = "incident_date < (SELECT MIN(incident_date) + INTERVAL 2 DAY FROM ev)"
_OLD_GEO = f"SELECT DISTINCT {_GEO} FROM ev WHERE {_EARLY}"


@query("d04_stable_keys", "load:i geography_key:i borough:s zipcode:s policeprecinct:s citycouncildistrict:s communitydistrict:s",
       f"""WITH {O.EV}, first AS (SELECT row_number() OVER (ORDER BY {_GEO}) AS geography_key, * FROM ({_OLD_GEO})),
       later AS (SELECT (SELECT COUNT(*) FROM first) + row_number() OVER (ORDER BY {_GEO}) AS geography_key, *
                 FROM (SELECT DISTINCT {_GEO} FROM ev EXCEPT {_OLD_GEO}))
       SELECT 1 AS load, * FROM first UNION ALL SELECT 2, * FROM first UNION ALL SELECT 2, * FROM later""")
def stable_keys(spark, folder):
    """Keys after a first load of two days and after one of everything: the first ones stay."""
    ev = A.event_view(spark, folder)
    start = ev.agg(F.date_add(F.min("incident_date"), 2)).scalar()
    first = pin(D.extend_keys(None, ev.filter(F.col("incident_date") < start), FC.GEOGRAPHY, "geography_key"), "first-keys")
    later = D.extend_keys(first, ev, FC.GEOGRAPHY, "geography_key")
    return first.withColumn("load", F.lit(1)).unionByName(later.withColumn("load", F.lit(2)))


_ROLE_SQL = """SELECT code AS {k}, bool_or(r = 1) AS appears_as_initial, bool_or(r = 2) AS appears_as_final FROM
  (SELECT {a} AS code, 1 AS r FROM {t} UNION ALL SELECT {b}, 2 FROM {t}) GROUP BY 1"""


@query("d05_role_union_dimension", "nation:s appears_as_initial:b appears_as_final:b",
       "SELECT n_name AS nation, bool_or(r = 1) AS appears_as_initial, bool_or(r = 2) AS appears_as_final FROM "
       "(SELECT c_nationkey AS k, 1 AS r FROM customer UNION ALL SELECT s_nationkey, 2 FROM supplier) JOIN nation ON k = n_nationkey GROUP BY 1")
def role_union_dimension(spark, folder):
    n = A.table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    c = A.table(spark, folder, "customer").select(F.col("c_nationkey").alias("n_nationkey"))
    s = A.table(spark, folder, "supplier").select(F.col("s_nationkey").alias("n_nationkey"))
    return D.union_roles({"initial": c, "final": s}, "n_nationkey").join(n, "n_nationkey")


_CT_SQL = f"""WITH {O.EV}, {O.CT}, m AS ({_ROLE_SQL.format(k='call_type', a='initial_call_type', b='final_call_type', t='ev')}),
  dim AS (SELECT m.*, CASE WHEN call_type = 'UNKNOWN' THEN 'UNKNOWN CALL TYPE' ELSE COALESCE(description, 'UNDOCUMENTED CALL TYPE') END AS call_type_description,
  row_number() OVER (ORDER BY call_type) AS call_type_key FROM m LEFT JOIN ct ON call_type = code)"""


@query("d06_code_enrichment", "call_type_key:i call_type:s call_type_description:s appears_as_initial:b appears_as_final:b", _CT_SQL + " SELECT * FROM dim")
def code_enrichment(spark, folder):
    return A.star(spark, folder)[1]["call_type"]


_DISP_SQL = f"""WITH {O.EV}, {O.DM}, m AS (SELECT DISTINCT incident_disposition_code FROM ev),
  dim0 AS (SELECT incident_disposition_code AS disposition_code, {O.CATEGORY} AS disposition_category,
  CASE WHEN incident_disposition_code = 'UNKNOWN' THEN 'unknown' ELSE COALESCE(description, 'undocumented code') END AS disposition_description,
  CASE WHEN incident_disposition_code = 'UNKNOWN' THEN 'Unknown' WHEN code IS NULL THEN 'Undocumented' ELSE 'Documented' END AS mapping_status,
  code IS NOT NULL AS is_documented_code, incident_disposition_code = 'UNKNOWN' AS is_unknown,
  row_number() OVER (ORDER BY incident_disposition_code) AS disposition_key FROM m LEFT JOIN dm ON incident_disposition_code = code),
  dim AS (SELECT *, {O.CAT_SORT} AS disposition_category_sort FROM dim0)"""


@query("d07_mapping_status", "disposition_key:i disposition_code:s disposition_description:s disposition_category:s disposition_category_sort:i "
       "mapping_status:s is_documented_code:b is_unknown:b", _DISP_SQL + " SELECT * FROM dim")
def mapping_status(spark, folder):
    return A.star(spark, folder)[1]["disposition"]


@query("d08_undocumented_codes", "dimension:s code:s",
       f"""WITH {O.EV}, {O.CT}, {O.DM}, c AS (SELECT initial_call_type AS x FROM ev UNION SELECT final_call_type FROM ev)
       SELECT 'call_type' AS dimension, x AS code FROM c WHERE x <> 'UNKNOWN' AND x NOT IN (SELECT code FROM ct)
       UNION ALL SELECT DISTINCT 'disposition', incident_disposition_code FROM ev
       WHERE incident_disposition_code <> 'UNKNOWN' AND incident_disposition_code NOT IN (SELECT code FROM dm)""")
def undocumented_codes(spark, folder):
    dims = A.star(spark, folder)[1]
    known = A.call_type_mapping(spark).select("call_type")
    ct = dims["call_type"].filter(F.col("call_type") != X.UNKNOWN).join(known, "call_type", "left_anti").select(F.lit("call_type").alias("dimension"), F.col("call_type").alias("code"))
    dp = dims["disposition"].filter(~F.col("is_documented_code") & ~F.col("is_unknown")).select(
        F.lit("disposition").alias("dimension"), F.col("disposition_code").alias("code"))
    return ct.unionByName(dp)


@query("d09_mapping_coverage", "dimension_rows:i documented_rows:i undocumented_rows:i unknown_rows:i reconciles:b",
       _CT_SQL + """ SELECT COUNT(*) AS dimension_rows, COUNT(*) FILTER (WHERE call_type_description = 'UNDOCUMENTED CALL TYPE') AS undocumented_rows,
       COUNT(*) FILTER (WHERE call_type = 'UNKNOWN') AS unknown_rows,
       COUNT(*) FILTER (WHERE call_type_description NOT IN ('UNDOCUMENTED CALL TYPE', 'UNKNOWN CALL TYPE')) AS documented_rows, TRUE AS reconciles FROM dim""")
def mapping_coverage(spark, folder):
    return D.mapping_coverage(A.star(spark, folder)[1]["call_type"], "call_type_description")


@query("d10_role_distribution", "appears_as_initial:b appears_as_final:b severity_codes:i",
       f"WITH {O.EV}, m AS ({_ROLE_SQL.format(k='c', a='initial_severity_level_code', b='final_severity_level_code', t='ev')}) "
       "SELECT appears_as_initial, appears_as_final, COUNT(*) AS severity_codes FROM m GROUP BY ALL")
def role_distribution(spark, folder):
    return A.star(spark, folder)[1]["severity"].groupBy("appears_as_initial", "appears_as_final").agg(F.count("*").alias("severity_codes"))


_SV = f"""sv AS (SELECT c, row_number() OVER (ORDER BY c) AS severity_key FROM
  (SELECT initial_severity_level_code AS c FROM ev UNION SELECT final_severity_level_code FROM ev))"""
_CTK = """ctk AS (SELECT c, row_number() OVER (ORDER BY c) AS call_type_key FROM
  (SELECT initial_call_type AS c FROM ev UNION SELECT final_call_type FROM ev))"""
_GK = f"gk AS (SELECT *, row_number() OVER (ORDER BY {_GEO}) AS geography_key FROM (SELECT DISTINCT {_GEO} FROM ev))"
_DK = "dk AS (SELECT c, row_number() OVER (ORDER BY c) AS disposition_key FROM (SELECT DISTINCT incident_disposition_code AS c FROM ev))"
_KEYED = f"""WITH {O.EV}, {_SV}, {_CTK}, {_GK}, {_DK},
  fact AS (SELECT ev.*, geography_key, i.call_type_key AS initial_call_type_key, f.call_type_key AS final_call_type_key,
  si.severity_key AS initial_severity_key, sf.severity_key AS final_severity_key, disposition_key,
  ROUND(valid_incident_response_seconds / 60.0, 2) AS incident_response_minutes
  FROM ev LEFT JOIN gk USING ({_GEO}) LEFT JOIN ctk i ON initial_call_type = i.c LEFT JOIN ctk f ON final_call_type = f.c
  LEFT JOIN sv si ON initial_severity_level_code = si.c LEFT JOIN sv sf ON final_severity_level_code = sf.c
  LEFT JOIN dk ON incident_disposition_code = dk.c)"""


def _lookup(spark, folder, *names):
    """Event incidents with the keys of the named lookups only."""
    dims = A.star(spark, folder)[1]
    ct, sv = dims["call_type"], dims["severity"]
    all_ = {
        "disposition": FC.Lookup(dims["disposition"], ["incident_disposition_code"], ["disposition_code"], "disposition_key", "disposition_key"),
        "geography": FC.Lookup(dims["geography"], FC.GEOGRAPHY, FC.GEOGRAPHY, "geography_key", "geography_key"),
        "initial": FC.Lookup(ct, ["initial_call_type"], ["call_type"], "call_type_key", "initial_call_type_key"),
        "final": FC.Lookup(ct, ["final_call_type"], ["call_type"], "call_type_key", "final_call_type_key"),
        "severity": FC.Lookup(sv, ["initial_severity_level_code"], ["severity_level_code"], "severity_key", "initial_severity_key"),
    }
    return FC.resolve_keys(A.event_view(spark, folder), [all_[n] for n in names])


@query("f01_single_key_lookup", "incident_id:s disposition_key:i", _KEYED + " SELECT * FROM fact")
def single_key_lookup(spark, folder):
    return _lookup(spark, folder, "disposition")


@query("f02_composite_key_lookup", "incident_id:s geography_key:i", _KEYED + " SELECT * FROM fact")
def composite_key_lookup(spark, folder):
    return _lookup(spark, folder, "geography")


@query("f03_role_playing_lookup", "incident_id:s initial_call_type_key:i final_call_type_key:i", _KEYED + " SELECT * FROM fact")
def role_playing_lookup(spark, folder):
    return _lookup(spark, folder, "initial", "final")


_FACT = {c: "i" for c in FC.FACT_COLUMNS} | {c: "b" for c in FC.FACT_COLUMNS if c.startswith("is_") or c.endswith("_changed")} | {
    c: "f2" for c in FC.FACT_COLUMNS if c.endswith(("_seconds", "_minutes"))} | {"incident_id": "s", "incident_datetime": "d"}


@query("f04_star_fact", " ".join(f"{c}:{t}" for c, t in _FACT.items()), _KEYED + """ SELECT *, incident_hour AS time_key, 1 AS incident_count,
       ROUND(valid_dispatch_response_seconds / 60.0, 2) AS dispatch_response_minutes, ROUND(valid_travel_time_seconds / 60.0, 2) AS travel_time_minutes FROM fact""")
def star_fact(spark, folder):
    """All 29 columns of the fact."""
    return A.star(spark, folder)[0]


@query("f05_enriched_fact", "borough:s severity_label:s total_incidents:i valid_responses:i",
       f"""WITH {O.EV} SELECT borough, CASE WHEN initial_severity_level_code = -1 THEN 'Unknown' ELSE 'Severity Level ' || initial_severity_level_code END AS severity_label,
       COUNT(*) AS total_incidents, COUNT(valid_incident_response_seconds) AS valid_responses FROM ev GROUP BY ALL""")
def enriched_fact(spark, folder):
    fact, dims = A.star(spark, folder)
    g = fact.groupBy("geography_key", "initial_severity_key").agg(F.count("*").alias("n"), F.count("valid_incident_response_seconds").alias("v"))
    sev = dims["severity"].select(F.col("severity_key").alias("initial_severity_key"), "severity_label")
    return (g.join(dims["geography"].select("geography_key", "borough"), "geography_key", "left").join(sev, "initial_severity_key", "left")
            .groupBy("borough", "severity_label").agg(F.sum("n").alias("total_incidents"), F.sum("v").alias("valid_responses")))
