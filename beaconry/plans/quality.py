"""Data-quality checks (Q01-Q36).

Checks of derived columns run on a daily table into which faults are planted
for known rows, so that each must report the number of planted rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import dims as D
from beaconry.operators import fact as FC
from beaconry.operators import quality as QC
from beaconry.operators import silver as S
from beaconry.plans import analogs as A
from beaconry.plans import oracle as O
from beaconry.plans.aggregates import daily, daily_base
from beaconry.plans.registry import query
from beaconry.plans.star import _CT_SQL, _DISP_SQL
from beaconry.session import new_folder, pin
from beaconry.sources import raw as R
from beaconry.sources import versions as V
from beaconry.sources.tables import latest, table

CHECK = "table_name:s check_name:s issues:i status:s"


def expect(cte: str, table_name: str, counts: dict[str, str]) -> str:
    """Expected check rows: a count expression per check name."""
    rows = " UNION ALL ".join(f"SELECT '{table_name}' AS table_name, '{n}' AS check_name, ({c}) AS issues" for n, c in counts.items())
    return f"WITH {cte}, chk AS ({rows}) SELECT *, CASE WHEN issues = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM chk"


def rows_where(cond: str, t: str = "dy") -> str:
    return f"SELECT COUNT(*) FROM {t} WHERE {cond}"


@query("q01_yearly_expectation", "year:i expected_rows:i actual_rows:i row_difference:i missing_ids:i status:s",
       f"""WITH {O.RAW}, e AS (SELECT year(ts) AS year, COUNT(*) AS expected_rows FROM events GROUP BY 1),
       a AS (SELECT year, COUNT(*) AS actual_rows, COUNT(*) FILTER (WHERE TRIM(incident_id) = '') AS missing_ids FROM raw GROUP BY 1),
       x AS (SELECT * FROM e UNION ALL SELECT 1990, 500),
       j AS (SELECT year, COALESCE(expected_rows, 0) AS expected_rows, COALESCE(actual_rows, 0) AS actual_rows, COALESCE(missing_ids, 0) AS missing_ids FROM a FULL JOIN x USING (year))
       SELECT *, actual_rows - expected_rows AS row_difference, CASE WHEN actual_rows = expected_rows AND missing_ids = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM j""")
def yearly_expectation(spark, folder):
    expected = table(spark, folder, "events").groupBy(F.year("ts").alias("year")).agg(F.count("*").alias("expected_rows"))
    lost = spark.range(1).select(F.lit(1990).alias("year"), F.lit(500).cast("long").alias("expected_rows"))  # planted: a year without rows
    return R.yearly_expectation(A.bronze_events(spark, folder), expected.unionByName(lost), "_source_year", "incident_id")


_KP = "table_name:s total_rows:i distinct_keys:i missing_keys:i duplicate_rows:i status:s"


def _kp_sql(t, key, name=None):
    return f"""SELECT '{name or t}' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT {key}) AS distinct_keys, COUNT(*) - COUNT({key}) AS missing_keys,
       COUNT({key}) - COUNT(DISTINCT {key}) AS duplicate_rows, CASE WHEN COUNT(*) > 0 AND COUNT(*) = COUNT(DISTINCT {key}) THEN 'PASS' ELSE 'FAIL' END AS status FROM {t}"""


@query("q02_key_complete_unique", _KP, _kp_sql("orders", "o_orderkey") + " UNION ALL " + _kp_sql("(SELECT l_orderkey * 10 + l_linenumber AS k FROM lineitem)", "k", "lineitem")
       + " UNION ALL " + _kp_sql("events", "event_id"))
def key_complete_unique(spark, folder):
    li = table(spark, folder, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"))
    return QC.all_checks([QC.key_profile(table(spark, folder, "orders"), "o_orderkey", "orders"), QC.key_profile(li, "k", "lineitem"),
                          QC.key_profile(table(spark, folder, "events"), "event_id", "events")])


@query("q03_duplicate_keys", "l_orderkey:i l_linenumber:i row_count:i", "SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1")
def duplicate_keys(spark, folder):
    return QC.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


_Q04 = {c: "TIMESTAMP" for c in S.TIMESTAMPS} | {c: "INTEGER" for c in S.INTEGERS} | {c: "DOUBLE" for c in S.DOUBLES}


@query("q04_conversion_failures", CHECK, expect(O.RAW, "bronze", {
    f"{c}_invalid": f"SELECT COUNT(*) FROM raw WHERE NULLIF(TRIM({c}), '') IS NOT NULL AND TRY_CAST(TRIM({c}) AS {t}) IS NULL" for c, t in _Q04.items()}))
def conversion_failures(spark, folder):
    types = S.raw_types()
    one = S.conversion_failures(S.clean_strings(A.bronze_events(spark, folder)), types)
    return QC.as_rows(one, "bronze", [f"{c}_invalid" for c in types])


@query("q05_indicator_profile", "indicator:s value:s n:i",
       f"WITH {O.RAW} " + " UNION ALL ".join(f"SELECT '{c}' AS indicator, {c} AS value, COUNT(*) AS n FROM raw GROUP BY 2" for c in S.INDICATORS))
def indicator_profile(spark, folder):
    pairs = F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(c).alias("value")) for c in S.INDICATORS])
    return A.bronze_events(spark, folder).select(F.inline(pairs)).groupBy("indicator", "value").agg(F.count("*").alias("n"))


@query("q06_silver_audit", "total_rows:i distinct_incident_ids:i missing_incident_ids:i duplicate_incident_ids:i invalid_records:i source_year_mismatches:i "
       "negative_dispatch_times:i negative_incident_times:i negative_travel_times:i minimum_incident_datetime:d maximum_incident_datetime:d validation_status:s",
       f"""WITH {O.RAW} SELECT COUNT(*) AS total_rows, COUNT(DISTINCT incident_id) AS distinct_incident_ids, 0 AS missing_incident_ids,
       COUNT(*) - COUNT(DISTINCT incident_id) AS duplicate_incident_ids, COUNT(*) FILTER (WHERE year(CAST(incident_datetime AS TIMESTAMP)) <> year) AS invalid_records,
       COUNT(*) FILTER (WHERE year(CAST(incident_datetime AS TIMESTAMP)) <> year) AS source_year_mismatches,
       COUNT(*) FILTER (WHERE TRY_CAST(dispatch_response_seconds_qy AS DOUBLE) < 0) AS negative_dispatch_times,
       COUNT(*) FILTER (WHERE TRY_CAST(incident_response_seconds_qy AS DOUBLE) < 0) AS negative_incident_times,
       COUNT(*) FILTER (WHERE TRY_CAST(incident_travel_tm_seconds_qy AS DOUBLE) < 0) AS negative_travel_times,
       MIN(incident_datetime) AS minimum_incident_datetime, MAX(incident_datetime) AS maximum_incident_datetime, 'FAIL' AS validation_status FROM raw""")
def silver_audit(spark, folder):
    return S.silver_audit(S.to_silver(A.bronze_events(spark, folder)))


@query("q07_required_columns", "column_name:s is_present:b filled_rows:i status:s",
       f"""WITH {O.EV} SELECT 'incident_id' AS column_name, TRUE AS is_present, COUNT(incident_id) AS filled_rows, 'PASS' AS status FROM et
       UNION ALL SELECT 'borough', TRUE, COUNT(borough), 'PASS' FROM et UNION ALL SELECT 'final_call_type', TRUE, COUNT(final_call_type), 'PASS' FROM et
       UNION ALL SELECT 'citizen_id', FALSE, NULL, 'FAIL'""")
def required_columns(spark, folder):
    return QC.columns_report(A.events(spark, folder), ["incident_id", "borough", "final_call_type", "citizen_id"])


_ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()


@query("q07_exact_columns", "column_name:s filled_rows:i status:s", """WITH n AS (SELECT COUNT(o_orderkey) AS a, COUNT(o_custkey) AS b, COUNT(o_orderstatus) AS c, COUNT(o_totalprice) AS d, COUNT(o_orderdate) AS e,
       COUNT(o_orderpriority) AS f FROM orders)
       SELECT 'o_custkey' AS column_name, b AS filled_rows, 'MISPLACED' AS status FROM n UNION ALL SELECT 'o_orderkey', a, 'MISPLACED' FROM n UNION ALL SELECT 'o_totalprice', d, 'PASS' FROM n
       UNION ALL SELECT 'o_orderdate', e, 'PASS' FROM n UNION ALL SELECT 'o_citizen', NULL, 'MISSING' FROM n UNION ALL SELECT 'o_orderstatus', c, 'EXTRA' FROM n UNION ALL SELECT 'o_orderpriority', f, 'EXTRA' FROM n""")
def exact_columns(spark, folder):
    """Against a list with one column that is not there, without two that are, and with two exchanged."""
    return QC.exact_report(table(spark, folder, "orders").select(*_ORDERS), ["o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_citizen"])


_GEO = ", ".join(FC.GEOGRAPHY)


@query("q08_dimension_keys", _KP, f"""WITH {O.EV}, c AS (
       SELECT 'call_type' AS t, COUNT(*) AS n FROM (SELECT initial_call_type FROM ev UNION SELECT final_call_type FROM ev)
       UNION ALL SELECT 'severity', COUNT(*) FROM (SELECT initial_severity_level_code FROM ev UNION SELECT final_severity_level_code FROM ev)
       UNION ALL SELECT 'disposition', COUNT(DISTINCT incident_disposition_code) FROM ev UNION ALL SELECT 'geography', COUNT(*) FROM (SELECT DISTINCT {_GEO} FROM ev)
       UNION ALL SELECT 'date', date_diff('day', MIN(incident_date), MAX(incident_date)) + 1 FROM ev UNION ALL SELECT 'time', 24)
       SELECT t AS table_name, n AS total_rows, n AS distinct_keys, 0 AS missing_keys, 0 AS duplicate_rows, 'PASS' AS status FROM c
       UNION ALL SELECT t || ', a key twice, one missing', n + 2, n, 1, 1, 'FAIL' FROM c WHERE t IN ('call_type', 'severity')""")
def dimension_keys(spark, folder):
    dims = A.star(spark, folder)[1]
    parts = [QC.key_profile(d, f"{n}_key", n) for n, d in dims.items()]
    for n in ("call_type", "severity"):
        again = dims[n].filter(F.col(f"{n}_key") == 1)
        faulty = dims[n].unionByName(again).unionByName(again.withColumn(f"{n}_key", F.lit(None).cast("long")))
        parts.append(QC.key_profile(faulty, f"{n}_key", f"{n}, a key twice, one missing"))
    return QC.all_checks(parts)


def incomplete_dims(spark, folder):
    """The dimensions with code and key of a few members changed, to make lookups fail."""
    dims = dict(A.star(spark, folder)[1])
    spoilt = {"call_type": ("call_type", "call_type = 'REVIEW'"), "disposition": ("disposition_code", "disposition_code IN ('X99', 'ZZZZZZ')"),
              "severity": ("severity_level_code", "severity_level_code = 3")}
    for name, (code, which) in spoilt.items():
        key = f"{name}_key"
        other = F.concat(F.lit("renamed "), code) if name != "severity" else F.col(code) + 90
        hit = F.expr(which)
        dims[name] = dims[name].withColumns({key: F.when(hit, -F.col(key)).otherwise(F.col(key)), code: F.when(hit, other).otherwise(F.col(code))})
    return dims


_BAD = {"initial_call_type_key": "initial_call_type = 'REVIEW'", "final_call_type_key": "final_call_type = 'REVIEW'",
        "initial_severity_key": "initial_severity_level_code = 3", "final_severity_key": "final_severity_level_code = 3",
        "disposition_key": "incident_disposition_code IN ('X99', 'ZZZZZZ')"}
_KEYS = ["date_key", "time_key", "geography_key", "initial_call_type_key", "final_call_type_key", "initial_severity_key", "final_severity_key", "disposition_key"]


@query("q09_null_foreign_keys", CHECK, expect(O.EV, "fact", {k: rows_where(_BAD.get(k, "incident_id IS NULL"), "ev") for k in _KEYS}))
def null_foreign_keys(spark, folder):
    fact = FC.build_fact(A.events(spark, folder), incomplete_dims(spark, folder))
    return QC.run_checks(fact, "fact", {k: F.col(k).isNull() for k in _KEYS})


def _lookups(dims):
    return [("geography_key", dims["geography"], "geography_key"), ("initial_call_type_key", dims["call_type"], "call_type_key"),
            ("final_call_type_key", dims["call_type"], "call_type_key"), ("initial_severity_key", dims["severity"], "severity_key"),
            ("final_severity_key", dims["severity"], "severity_key"), ("disposition_key", dims["disposition"], "disposition_key")]


_CODE = {"initial_call_type_key": "initial_call_type", "final_call_type_key": "final_call_type", "initial_severity_key": "initial_severity_level_code",
         "final_severity_key": "final_severity_level_code", "disposition_key": "incident_disposition_code"}


@query("q10_orphans_anti_join", CHECK, expect(O.EV, "fact", {"geography_key": "SELECT 0"} | {
    k: f"SELECT COUNT(DISTINCT {_CODE[k]}) FROM ev WHERE {c}" for k, c in _BAD.items()}))
def orphans_anti_join(spark, folder):
    return QC.count_orphaned_keys(A.star(spark, folder)[0], _lookups(incomplete_dims(spark, folder)))


@query("q11_orphans_one_pass", CHECK, expect(O.EV, "fact", {"geography_key": "SELECT 0"} | {k: rows_where(c, "ev") for k, c in _BAD.items()}))
def orphans_one_pass(spark, folder):
    return QC.orphans_in_one_pass(A.star(spark, folder)[0], _lookups(incomplete_dims(spark, folder)))


_LAYERS = ["incident_id", "incident_datetime", "valid_dispatch_response_seconds", "valid_incident_response_seconds", "valid_travel_time_seconds", "is_held",
           "call_type_changed", "severity_changed"]


@query("q12_layer_reconciliation", "incident_date:d left_rows:i right_rows:i same_values:b status:s",
       f"""WITH {O.EV}, x AS (SELECT MIN(incident_id) AS lost, MAX(incident_id) AS changed FROM ev),
       g AS (SELECT incident_date, COUNT(*) AS left_rows, COUNT(*) FILTER (WHERE incident_id <> lost) AS right_rows, COUNT(*) FILTER (WHERE incident_id = changed) AS touched FROM ev, x GROUP BY 1)
       SELECT *, left_rows = right_rows AND touched = 0 AS same_values,
       CASE WHEN left_rows <> right_rows THEN 'ROWS DIFFER' WHEN touched > 0 THEN 'VALUES DIFFER' ELSE 'PASS' END AS status FROM g""")
def layer_reconciliation(spark, folder):
    """Silver against a stored fact, day by day; of the fact one row is lost and one value changed."""
    silver, fact = A.events(spark, folder, area=False), A.star(spark, folder)[0]
    ends = silver.agg(F.min("incident_id").alias("lost"), F.max("incident_id").alias("changed"))
    lost, changed = (ends.select(c).scalar() for c in ("lost", "changed"))
    seconds = "valid_travel_time_seconds"
    stored = fact.filter(F.col("incident_id") != lost).withColumn(seconds, F.when(F.col("incident_id") == changed, -1.0).otherwise(F.col(seconds)))
    stored = pin(stored.withColumn("incident_date", F.to_date("incident_datetime")).select("incident_date", *_LAYERS), "fact")
    return QC.reconcile_content(silver, stored, _LAYERS, "incident_date")


_NEG = ["dispatch_response_seconds_qy", "incident_response_seconds_qy", "incident_travel_tm_seconds_qy", "valid_dispatch_response_seconds"]


@query("q13_non_negative_measures", CHECK, expect(O.EV, "silver", {c: rows_where(f"{c} < 0", "et") for c in _NEG}))
def non_negative_measures(spark, folder):
    return QC.run_checks(A.events(spark, folder, area=False), "silver", {c: F.col(c) < 0 for c in _NEG})


@query("q14_calendar_complete", "calendar:s calendar_days:i span_days:i distinct_days:i status:s",
       f"""WITH {O.OD}, c AS (SELECT date_diff('day', MIN(incident_date), MAX(incident_date)) + 1 AS n FROM od)
       SELECT 'whole' AS calendar, n AS calendar_days, n AS span_days, n AS distinct_days, 'PASS' AS status FROM c
       UNION ALL SELECT 'a day missing', n - 1, n, n - 1, 'FAIL' FROM c UNION ALL SELECT 'a day twice', n + 1, n, n, 'FAIL' FROM c""")
def calendar_complete(spark, folder):
    days = D.calendar_of(A.orders(spark, folder), "incident_date").select("full_date")
    tenth = F.col("full_date") == F.lit("1999-03-10").cast("date")
    faulty = {"whole": days, "a day missing": days.filter(~tenth), "a day twice": days.unionByName(days.filter(tenth))}
    return QC.all_checks([QC.calendar_complete(d).withColumn("calendar", F.lit(name)) for name, d in faulty.items()])


@query("q15_hours_per_bucket", "time_of_day:s hours_in_bucket:i status:s",
       f"""WITH {O.EV} SELECT time_of_day, COUNT(DISTINCT incident_hour) AS hours_in_bucket, CASE WHEN COUNT(DISTINCT incident_hour) = 6 THEN 'PASS' ELSE 'FAIL' END AS status FROM ev GROUP BY 1""")
def hours_per_bucket(spark, folder):
    return QC.hours_per_bucket(A.event_view(spark, folder, area=False), "time_of_day", "incident_hour")


_PARTS = """SELECT COUNT(*) AS mapping_rows, COUNT(DISTINCT UPPER(TRIM(p_name))) AS distinct_codes, COUNT(*) FILTER (WHERE COALESCE(TRIM(p_name), '') = '') AS missing_codes,
       COUNT(*) FILTER (WHERE COALESCE(TRIM(p_brand), '') = '') AS missing_texts FROM (SELECT DISTINCT UPPER(TRIM(p_name)) AS p_name, 'text' AS p_brand FROM part)"""


@query("q16_mapping_integrity", "mapping:s mapping_rows:i distinct_codes:i missing_codes:i missing_texts:i status:s",
       f"""WITH p AS ({_PARTS}) SELECT 'whole' AS mapping, *, 'PASS' AS status FROM p
       UNION ALL SELECT 'an entry short', mapping_rows, distinct_codes, missing_codes, missing_texts, 'FAIL' FROM p
       UNION ALL SELECT 'a code twice', mapping_rows + 1, distinct_codes, 0, 0, 'FAIL' FROM p
       UNION ALL SELECT 'a blank code and a blank text', mapping_rows + 2, distinct_codes + 1, 1, 1, 'FAIL' FROM p""")
def mapping_integrity(spark, folder):
    """Against the number of entries there should be, and with faults planted as further entries."""
    m = table(spark, folder, "part").select(F.upper(F.trim("p_name")).alias("code")).distinct().withColumn("text", F.lit("text"))
    rows = m.count()
    one = m.agg(F.min("code").alias("code"), F.min("text").alias("text"))
    blank = one.select(F.lit("  ").alias("code"), "text").unionByName(one.select(F.concat("code", F.lit(" 2")).alias("code"), F.lit(" ").alias("text")))
    cases = {"whole": (m, rows), "an entry short": (m, rows + 1), "a code twice": (m.unionByName(one), rows), "a blank code and a blank text": (m.unionByName(blank), rows + 2)}
    return QC.all_checks([QC.mapping_integrity(df, "code", "text", n).withColumn("mapping", F.lit(name)) for name, (df, n) in cases.items()])


_RECONCILED = """SELECT '{name}' AS dimension, COUNT(*) AS dimension_rows, COUNT(*) FILTER (WHERE d = 'UNDOCUMENTED CALL TYPE') AS undocumented_rows,
       COUNT(*) FILTER (WHERE d = 'UNKNOWN CALL TYPE') AS unknown_rows, COUNT(*) FILTER (WHERE d NOT IN ('UNDOCUMENTED CALL TYPE', 'UNKNOWN CALL TYPE')) AS documented_rows,
       COUNT(*) FILTER (WHERE TRIM(d) = '') AS missing_descriptions, COUNT(*) FILTER (WHERE (call_type = 'UNKNOWN') <> (d = 'UNKNOWN CALL TYPE')) AS invalid_unknown
       FROM (SELECT call_type, {text} AS d FROM dim)"""
_TEXTS = {"as built": "call_type_description",
          "wrong for unknown": "CASE WHEN call_type = 'UNKNOWN' THEN 'something else' ELSE call_type_description END",
          "blank": "CASE WHEN call_type = 'VIEW' THEN ' ' ELSE call_type_description END"}


@query("q17_description_reconciliation", "dimension:s dimension_rows:i documented_rows:i undocumented_rows:i unknown_rows:i missing_descriptions:i invalid_unknown:i status:s",
       _CT_SQL + ", r AS (" + " UNION ALL ".join(_RECONCILED.format(name=n, text=t) for n, t in _TEXTS.items())
       + ") SELECT *, CASE WHEN missing_descriptions + invalid_unknown = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM r")
def description_reconciliation(spark, folder):
    dim = A.star(spark, folder)[1]["call_type"]
    return QC.all_checks([QC.description_reconciliation(dim.withColumn("call_type_description", F.expr(t)), "call_type", "call_type_description").withColumn("dimension", F.lit(n))
                          for n, t in _TEXTS.items()])


@query("q18_category_sort_one_to_one", "disposition_category:s value_count:i status:s",
       f"""WITH {O.EVD}, c AS (SELECT disposition_category, COUNT(DISTINCT CASE WHEN incident_disposition_code = '91' THEN 99 ELSE {O.CAT_SORT} END) AS value_count FROM evd GROUP BY 1)
       SELECT *, CASE WHEN value_count = 1 THEN 'PASS' ELSE 'FAIL' END AS status FROM c""")
def category_sort_one_to_one(spark, folder):
    """One code of a category has another place than the rest."""
    dim = A.star(spark, folder)[1]["disposition"]
    moved = dim.withColumn("disposition_category_sort", F.when(F.col("disposition_code") == "91", 99).otherwise(F.col("disposition_category_sort")))
    return QC.one_to_one(moved, "disposition_category", "disposition_category_sort")


_MAP_BAD = {
    "undocumented_defaults": "mapping_status = 'Undocumented' AND (disposition_description <> 'undocumented code' OR disposition_category <> 'Undocumented')",
    "status_against_documented": "(mapping_status = 'Documented') <> is_documented_code",
    "status_against_unknown": "(mapping_status = 'Unknown') <> is_unknown",
}


@query("q19_mapping_status_consistent", CHECK, _DISP_SQL.replace("dim AS (SELECT *,", "dim2 AS (SELECT * REPLACE (CASE WHEN disposition_code = '82' THEN 'Unknown' ELSE mapping_status END AS mapping_status),")
       + ", chk AS (" + " UNION ALL ".join(f"SELECT 'disposition' AS table_name, '{n}' AS check_name, COUNT(*) AS issues FROM dim2 WHERE {c}" for n, c in _MAP_BAD.items())
       + ") SELECT *, CASE WHEN issues = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM chk")
def mapping_status_consistent(spark, folder):
    dim = A.star(spark, folder)[1]["disposition"]
    faulty = dim.withColumn("mapping_status", F.when(F.col("disposition_code") == "82", "Unknown").otherwise(F.col("mapping_status")))
    return QC.run_checks(faulty, "disposition", QC.mapping_status_checks())


@query("q20_no_code_lost", "source_codes:i dimension_codes:i lost_codes:i status:s",
       f"""WITH {O.EV} SELECT COUNT(DISTINCT incident_disposition_code) AS source_codes,
       COUNT(DISTINCT incident_disposition_code) FILTER (WHERE incident_disposition_code NOT IN ('X99', 'ZZZZZZ')) AS dimension_codes,
       COUNT(DISTINCT incident_disposition_code) FILTER (WHERE incident_disposition_code IN ('X99', 'ZZZZZZ')) AS lost_codes, 'FAIL' AS status FROM ev""")
def no_code_lost(spark, folder):
    return QC.codes_kept(A.event_view(spark, folder), "incident_disposition_code", incomplete_dims(spark, folder)["disposition"], "disposition_code")


_KEY = "incident_date, borough, initial_severity_level_code"


@query("q21_daily_grain_unique", "duplicate_grain_groups:i duplicate_excess_rows:i status:s",
       f"""WITH {O.EV}, {O.daily(O.GRAIN)} SELECT COUNT(*) AS duplicate_grain_groups, COUNT(*) AS duplicate_excess_rows, 'FAIL' AS status FROM d0 WHERE borough = 'ASIA'""")
def daily_grain_unique(spark, folder):
    d = daily_base(spark, folder).select("incident_date", "borough", "initial_severity_level_code")
    copies = F.when(F.col("borough") == "ASIA", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return QC.grain_unique(d.withColumn("copy", F.explode(copies)), ["incident_date", "borough", "initial_severity_level_code"])


@query("q22_totals_agree", "daily_total:i fact_total:i difference:i status:s",
       f"""WITH {O.EV}, {O.daily(O.GRAIN)}, t AS (SELECT (SELECT SUM(total_incidents) + COUNT(*) FILTER (WHERE borough = 'ASIA') FROM d0) AS daily_total, (SELECT COUNT(*) FROM ev) AS fact_total)
       SELECT *, daily_total - fact_total AS difference, CASE WHEN daily_total = fact_total THEN 'PASS' ELSE 'FAIL' END AS status FROM t""")
def totals_agree(spark, folder):
    more = F.when(F.col("borough") == "ASIA", 1).otherwise(0)  # one incident too many in every group of an area
    d = daily_base(spark, folder).withColumn("total_incidents", F.col("total_incidents") + more)
    return QC.totals_agree(d, A.event_view(spark, folder, area=False))


# Faults are planted in the rows of one area and severity.
_PLANT = "borough = 'ASIA' AND initial_severity_level_code = 2"
_HAS = f"{_PLANT} AND valid_incident_response_count > 0"
_BASE = f"{O.EV}, {O.daily(O.GRAIN)}"


def plant(df, **changes):
    """Replace columns by SQL expressions in the planted rows."""
    return df.withColumns({c: F.when(F.expr(_PLANT), F.expr(e)).otherwise(F.col(c)) for c, e in changes.items()})


def _counts(names: str, found: dict[str, str], t: str = "d0") -> dict[str, str]:
    """All check names of a theme; those not planted expect no issue."""
    return {n: rows_where(found[n], t) if n in found else rows_where("total_incidents IS NULL", t) for n in names.split()}


@query("q23_grouping_fields", CHECK, expect(_BASE, "daily", _counts(
    "null_date null_borough null_severity year_mismatch date_key_mismatch", {"year_mismatch": _PLANT, "date_key_mismatch": _PLANT})))
def grouping_fields(spark, folder):
    return QC.run_checks(plant(daily_base(spark, folder), incident_year="incident_year + 1", date_key="date_key + 1"), "daily", QC.grain_checks())


@query("q24_response_counts_rate", CHECK, expect(_BASE, "daily", _counts(
    "non_positive_incidents dispatch_count_out_of_range incident_count_out_of_range travel_count_out_of_range rate_out_of_range rate_mismatch rate_percentage_mismatch",
    {"rate_mismatch": _PLANT, "rate_percentage_mismatch": _PLANT, "rate_out_of_range": f"{_PLANT} AND valid_incident_response_count / total_incidents > 0.5",
     "travel_count_out_of_range": _PLANT})))
def response_counts_rate(spark, folder):
    return QC.run_checks(plant(daily(spark, folder), valid_response_rate="valid_response_rate + 0.5", valid_travel_time_count="total_incidents + 1"),
                         "daily", QC.response_count_checks())


@query("q25_averages_minutes", CHECK, expect(_BASE, "daily", _counts(
    " ".join(f"{s}_null_rule {s}_average_mismatch {s}_minutes_mismatch" for s in ("dispatch_response", "incident_response", "travel_time")),
    {"incident_response_average_mismatch": _HAS, "incident_response_minutes_mismatch": _HAS, "travel_time_null_rule": f"{_PLANT} AND valid_travel_time_count > 0",
     "travel_time_average_mismatch": f"{_PLANT} AND valid_travel_time_count > 0", "travel_time_minutes_mismatch": f"{_PLANT} AND valid_travel_time_count > 0"})))
def averages_minutes(spark, folder):
    d = plant(daily(spark, folder), average_incident_response_seconds="average_incident_response_seconds + 5", average_travel_time_seconds="NULL")
    return QC.run_checks(d, "daily", QC.average_checks())


@query("q26_statistics", CHECK, expect(_BASE, "daily", _counts(
    "order_violation mean_out_of_range negative_stddev null_rule percentile_null_rule cv_mismatch cv_percentage_mismatch",
    {"order_violation": _HAS, "mean_out_of_range": _HAS, "negative_stddev": _HAS, "cv_mismatch": f"{_HAS} AND average_incident_response_seconds > 0"})))
def statistics(spark, folder):
    d = plant(daily(spark, folder), maximum_response_seconds="minimum_response_seconds - 1", population_stddev_response_seconds="-1 - population_stddev_response_seconds")
    return QC.run_checks(d, "daily", QC.statistic_checks())


_MIN = "population_stddev_response minimum_response maximum_response p50_response p75_response p90_response p95_response".split()


@query("q27_statistical_minutes", CHECK, expect(_BASE, "daily", _counts(" ".join(f"{n}_minutes_mismatch" for n in _MIN),
       {"p90_response_minutes_mismatch": _HAS, "minimum_response_minutes_mismatch": _HAS})))
def statistical_minutes(spark, folder):
    d = plant(daily(spark, folder), p90_response_minutes="p90_response_minutes + 0.01", minimum_response_minutes="NULL")
    return QC.run_checks(d, "daily", QC.minute_checks())


@query("q28_operational_rates", CHECK, expect(_BASE, "daily", _counts(
    " ".join(f"{f}_count_out_of_range {f}_rate_mismatch {f}_percentage_mismatch" for f in ("held_incident", "special_event", "transfer_incident")),
    {"held_incident_rate_mismatch": _PLANT, "special_event_percentage_mismatch": _PLANT, "transfer_incident_count_out_of_range": _PLANT,
     "transfer_incident_rate_mismatch": _PLANT, "transfer_incident_percentage_mismatch": _PLANT})))
def operational_rates_check(spark, folder):
    d = plant(daily(spark, folder), held_incident_rate="held_incident_rate + 0.1", special_event_percentage="special_event_percentage + 0.01",
              transfer_incident_count="total_incidents + 1")
    return QC.run_checks(d, "daily", QC.operational_checks())


@query("q29_cv_percentage", CHECK, expect(_BASE, "daily", _counts("cv_percentage_mismatch", {"cv_percentage_mismatch": f"{_HAS} AND average_incident_response_seconds > 0"})))
def cv_percentage(spark, folder):
    d = plant(daily(spark, folder), response_cv_percentage="response_cv_percentage + 0.01")
    return QC.run_checks(d, "daily", {"cv_percentage_mismatch": ~X.same("response_cv_percentage", X.cv_pct("response_coefficient_of_variation"))})


@query("q30_sample_baseline_flags", CHECK, expect(O.DAILY, "daily", _counts(
    "sample_flag_mismatch sample_status_mismatch baseline_flag_mismatch baseline_count_out_of_range",
    {"sample_flag_mismatch": _PLANT, "sample_status_mismatch": _PLANT, "baseline_count_out_of_range": _PLANT,
     "baseline_flag_mismatch": f"{_PLANT} AND NOT has_sufficient_baseline AND daily_average_stddev_seconds IS NOT NULL"}, "dy")))
def sample_baseline_flags(spark, folder):
    d = plant(daily(spark, folder), has_sufficient_sample="NOT has_sufficient_sample", analytics_quality_status="'OTHER'", historical_baseline_day_count="99")
    return QC.run_checks(d, "daily", QC.sample_checks())


_LIM = "borough = 'ASIA' AND initial_severity_level_code = 1"


@query("q31_control_limits", CHECK, expect(O.DAILY, "daily", _counts(
    "upper_mismatch lower_mismatch negative_lower limits_out_of_order center_minutes_mismatch upper_minutes_mismatch lower_minutes_mismatch",
    {"upper_mismatch": f"{_LIM} AND has_sufficient_baseline", "upper_minutes_mismatch": f"{_LIM} AND has_sufficient_baseline",
     "lower_mismatch": f"{_LIM} AND has_sufficient_baseline", "negative_lower": f"{_LIM} AND has_sufficient_baseline",
     "lower_minutes_mismatch": f"{_LIM} AND has_sufficient_baseline"}, "dy")))
def control_limits_check(spark, folder):
    bad = F.expr(_LIM)
    d = daily(spark, folder).withColumns({
        "upper_control_limit_seconds": F.when(bad, F.col("upper_control_limit_seconds") + 60).otherwise(F.col("upper_control_limit_seconds")),
        "lower_control_limit_seconds": F.when(bad, -60 - F.col("lower_control_limit_seconds")).otherwise(F.col("lower_control_limit_seconds"))})
    return QC.run_checks(d, "daily", QC.limit_checks())


@query("q32_anomaly_flags", CHECK, expect(O.DAILY, "daily", _counts(
    "above_flag_mismatch below_flag_mismatch both_directions direction_mismatch reportable_mismatch",
    {"above_flag_mismatch": _LIM, "both_directions": f"{_LIM} AND is_below_lower_control_limit AND NOT is_above_upper_control_limit",
     "direction_mismatch": f"{_LIM} AND response_anomaly_direction <> 'Above UCL'", "reportable_mismatch": _LIM}, "dy")))
def anomaly_flags_check(spark, folder):
    bad = F.expr(_LIM)
    d = daily(spark, folder).withColumns({
        "is_above_upper_control_limit": F.when(bad, ~F.col("is_above_upper_control_limit")).otherwise(F.col("is_above_upper_control_limit")),
        "response_anomaly_direction": F.when(bad, "Above UCL").otherwise(F.col("response_anomaly_direction")),
        "is_reportable_response_anomaly": F.when(bad, ~F.col("is_reportable_response_anomaly")).otherwise(F.col("is_reportable_response_anomaly"))})
    return QC.run_checks(d, "daily", QC.anomaly_checks())


_FLAGS = "keys response_counts averages statistics minutes operations samples limits anomalies reconciliation grain".split()
_AUDIT = "audit_run_id:s daily_rows:i daily_incidents:i fact_incidents:i reportable_anomalies:i duplicate_grains:i " + " ".join(f"{f}_passed:b" for f in _FLAGS) + " validation_status:s"
_AUDIT_SQL = f"""WITH {O.DAILY} SELECT 'run-1' AS audit_run_id, COUNT(*) AS daily_rows, SUM(total_incidents) AS daily_incidents, (SELECT COUNT(*) FROM events) AS fact_incidents,
       COUNT(*) FILTER (WHERE is_reportable_response_anomaly) AS reportable_anomalies, 0 AS duplicate_grains, {', '.join(f'TRUE AS {f}_passed' for f in _FLAGS)}, 'PASS' AS validation_status FROM dy"""


@query("q33_audit_record", _AUDIT, _AUDIT_SQL)
def audit_record(spark, folder):
    return QC.audit_record(pin(daily(spark, folder), "daily"), table(spark, folder, "events").agg(F.count("*")), "run-1")


# One fault for each theme: the changed column, what it becomes in one row, and what else cannot pass then.
_AUDIT_FAULTS = {"keys": ("incident_year", "incident_year + 1"), "response_counts": ("valid_response_percentage", "valid_response_percentage + 1"),
                 "averages": ("average_dispatch_response_minutes", "COALESCE(average_dispatch_response_minutes, 0) + 1"),
                 "statistics": ("response_cv_percentage", "COALESCE(response_cv_percentage, 0) + 1"), "minutes": ("p50_response_minutes", "COALESCE(p50_response_minutes, 0) + 1"),
                 "operations": ("held_incident_percentage", "held_incident_percentage + 1"), "samples": ("analytics_quality_status", "'OTHER'"),
                 "limits": ("upper_control_limit_minutes", "COALESCE(upper_control_limit_minutes, 0) + 1"), "anomalies": ("response_anomaly_direction", "'Sideways'")}


@query("q33_audit_faults", "audit_run_id:s daily_rows:i fact_incidents:i duplicate_grains:i " + " ".join(f"{f}_passed:b" for f in _FLAGS) + " validation_status:s",
       f"WITH {O.EV}, {O.daily(O.GRAIN)} " + " UNION ALL ".join(
           f"""SELECT '{t}' AS audit_run_id, COUNT(*) + {int(t == 'grain')} AS daily_rows, SUM(total_incidents) + {int(t == 'reconciliation')} AS fact_incidents, {int(t == 'grain')} AS duplicate_grains,
           {', '.join(f"COUNT(*) {'< 0' if f == t or t == 'grain' and f == 'reconciliation' else '> 0'} AS {f}_passed" for f in _FLAGS)}, 'FAIL' AS validation_status FROM d0""" for t in _FLAGS))
def audit_faults(spark, folder):
    """The audit of eleven copies of the daily table, each with one fault in one row."""
    d, n = pin(daily(spark, folder), "daily"), table(spark, folder, "events").agg(F.count("*").alias("n"))
    key = ["incident_date", "borough", "initial_severity_level_code"]
    first = pin(d.orderBy(*key).limit(1).select(*key, F.lit(True).alias("_hit")), "planted")
    hit = d.join(first, key, "left")
    audits = [QC.audit_record(hit.withColumn(c, F.when(F.col("_hit"), F.expr(e)).otherwise(F.col(c))).drop("_hit"), n, t) for t, (c, e) in _AUDIT_FAULTS.items()]
    audits.append(QC.audit_record(d, n.select(F.col("n") + 1), "reconciliation"))
    audits.append(QC.audit_record(d.unionByName(hit.filter("_hit").drop("_hit")), n, "grain"))
    return QC.all_checks(audits)


@query("q34_audit_written_once", "audit_run_id:s records:i validation_status:s is_latest:b",
       "SELECT 'run-1' AS audit_run_id, 1 AS records, 'PASS' AS validation_status, FALSE AS is_latest FROM (SELECT COUNT(*) FROM events) UNION ALL SELECT 'run-2', 1, 'FAIL', TRUE")
def audit_written_once(spark, folder):
    path = new_folder(spark, "gold-audit")
    fact_rows = table(spark, folder, "events").agg(F.count("*"))
    d = pin(daily(spark, folder), "daily")
    twice = d.unionByName(d.filter("borough = 'ASIA'"))
    for i, frame in ((1, d), (2, twice), (2, twice)):  # the second run is repeated
        V.append_once(QC.audit_record(frame, fact_rows, f"run-{i}").withColumn("audit_timestamp", F.current_timestamp()), path, f"run-{i}")
    log = V.read_log(spark, path)
    last = latest(log, "audit_timestamp").select("audit_run_id")
    g = log.groupBy("audit_run_id").agg(F.count("*").alias("records"), F.min("validation_status").alias("validation_status"))
    return g.withColumn("is_latest", F.col("audit_run_id") == last.scalar())


@query("q35_lookup_completeness", CHECK, expect(O.EV, "fact", {
    "missing_borough": rows_where("incident_id IS NULL", "ev"), "missing_severity": rows_where("initial_severity_level_code = 3", "ev"),
    "missing_disposition": rows_where(_BAD["disposition_key"], "ev")}))
def lookup_completeness(spark, folder):
    fact, dims = A.star(spark, folder)[0], incomplete_dims(spark, folder)
    sev = dims["severity"].select(F.col("severity_key").alias("initial_severity_key"), "severity_label")
    view = (fact.join(dims["geography"].select("geography_key", "borough"), "geography_key", "left").join(sev, "initial_severity_key", "left")
            .join(dims["disposition"].select("disposition_key", "disposition_code"), "disposition_key", "left"))
    return QC.run_checks(view, "fact", {"missing_borough": F.col("borough").isNull(), "missing_severity": F.col("severity_label").isNull(),
                                        "missing_disposition": F.col("disposition_code").isNull()})


_TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations benchmark embeddings".split()


@query("q36_table_row_counts", "table_name:s row_count:i", " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _TABLES))
def table_row_counts(spark, folder):
    return QC.row_counts({t: table(spark, folder, t) for t in _TABLES})
