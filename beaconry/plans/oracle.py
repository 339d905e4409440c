"""Common table expressions of the SQL twins, written independently of the library."""

from __future__ import annotations

from beaconry.operators.dims import DISPOSITIONS
from beaconry.plans import analogs as A


def minutes(x: str) -> str:
    """Seconds to minutes, half up at two digits, exact on micro-seconds."""
    return f"(CAST(FLOOR((CAST(ROUND({x} * 1000000) AS HUGEINT) + 300000) / 600000.0) AS DOUBLE) / 100.0)"


def pct2(n: str, t: str) -> str:
    """n of t in percent, half up at two digits, in whole numbers."""
    return f"(CASE WHEN {t} > 0 THEN CAST((2 * CAST({n} AS HUGEINT) * 10000 + {t}) // (2 * {t}) AS DOUBLE) / 100.0 END)"


def _fields(fields) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in fields.items())


def _at(n: str) -> str:
    return f"SUBSTRING(CAST(ts + to_seconds({n}) AS STRING), 1, 19)"


_VALID = """
  CASE WHEN is_valid_dispatch_response AND dispatch_response_seconds_qy >= 0 THEN dispatch_response_seconds_qy END AS valid_dispatch_response_seconds,
  CASE WHEN is_valid_incident_response AND incident_response_seconds_qy >= 0 THEN incident_response_seconds_qy END AS valid_incident_response_seconds,
  CASE WHEN incident_travel_tm_seconds_qy >= 0 THEN incident_travel_tm_seconds_qy END AS valid_travel_time_seconds,
  initial_severity_level_code <> final_severity_level_code AS severity_changed,
  CAST(incident_datetime AS DATE) AS incident_date,
  year(incident_datetime) AS incident_year, month(incident_datetime) AS incident_month,
  strftime(incident_datetime, '%Y-%m') AS incident_year_month,
  hour(incident_datetime) AS incident_hour,
  CASE WHEN hour(incident_datetime) < 6 THEN 'Overnight' WHEN hour(incident_datetime) < 12 THEN 'Morning'
       WHEN hour(incident_datetime) < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day,
  dayofweek(incident_datetime) + 1 AS dow,
  strftime(incident_datetime, '%A') AS day_name"""

E0 = """e0 AS (SELECT ev.*, r_name, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k,
  CAST(FLOOR(value * 6) AS INTEGER) AS s FROM events ev LEFT JOIN region ON user_id % 5 = r_regionkey)"""

# typed events (nulls kept) as et, with normalised codes as ev
EV = f"""{E0},
e1 AS (SELECT {_fields(A.EVENT_FIELDS)} FROM e0),
et AS (SELECT *, initial_call_type <> final_call_type AS call_type_changed, {_VALID} FROM e1),
ev AS (SELECT * REPLACE (COALESCE(borough, 'UNKNOWN') AS borough, COALESCE(zipcode, 'UNKNOWN') AS zipcode,
  COALESCE(final_call_type, 'UNKNOWN') AS final_call_type,
  COALESCE(initial_severity_level_code, -1) AS initial_severity_level_code,
  COALESCE(final_severity_level_code, -1) AS final_severity_level_code,
  COALESCE(incident_disposition_code, 'UNKNOWN') AS incident_disposition_code),
  CAST(strftime(incident_date, '%Y%m%d') AS INTEGER) AS date_key FROM et)"""

RAW = f"""{E0},
e1 AS (SELECT e0.*, {_fields({n: e for n, e in A.EVENT_FIELDS.items() if n not in ('incident_id', 'incident_datetime')})} FROM e0),
raw AS (SELECT {_fields(A.raw_exprs(_at))}, {A.RAW_YEAR} AS year FROM e1)"""

LN = f"""l0 AS (SELECT li.*, o.*, cn.n_name AS c_nation, r_name, sn.n_name AS s_nation,
  date_diff('day', o_orderdate, l_shipdate) AS s
  FROM lineitem li JOIN orders o ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN region ON cn.n_regionkey = r_regionkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey),
l1 AS (SELECT {_fields(A.LINE_FIELDS)} FROM l0),
ln AS (SELECT *, initial_call_type <> final_call_type AS call_type_changed, {_VALID} FROM l1)"""

OD = """od AS (SELECT CAST(o_orderkey AS VARCHAR) AS incident_id, o_orderdate AS incident_datetime, CAST(o_orderdate AS DATE) AS incident_date,
  year(o_orderdate) AS incident_year, month(o_orderdate) AS incident_month, strftime(o_orderdate, '%Y-%m') AS incident_year_month,
  CAST(SUBSTRING(o_orderpriority, 1, 1) AS INTEGER) AS initial_severity_level_code, o_orderstatus, o_totalprice, o_custkey FROM orders)"""

DM = "dm(code, description, category) AS (VALUES " + ", ".join(str(r) for r in DISPOSITIONS) + ")"
CATEGORY = "CASE WHEN incident_disposition_code = 'UNKNOWN' THEN 'Unknown / No Disposition' ELSE COALESCE(category, 'Undocumented') END"
CAT_SORT = """CASE disposition_category WHEN 'Transported' THEN 1 WHEN 'Not Transported' THEN 2 WHEN 'Death on Scene' THEN 3
  WHEN 'Patient Not Located / Unfounded' THEN 4 WHEN 'Cancelled / Not Dispatched' THEN 5 WHEN 'Duplicate Incident' THEN 6
  WHEN 'Unknown / No Disposition' THEN 7 ELSE 8 END"""
_DISP = """SELECT {t}.*, """ + CATEGORY + """ AS disposition_category,
  CASE WHEN incident_disposition_code = 'UNKNOWN' THEN 'unknown' ELSE COALESCE(description, 'undocumented code') END AS disposition_description,
  CASE WHEN incident_disposition_code = 'UNKNOWN' THEN 'Unknown' WHEN code IS NULL THEN 'Undocumented' ELSE 'Documented' END AS mapping_status
  FROM {t} LEFT JOIN dm ON incident_disposition_code = code"""
EVD = f"{EV}, {DM}, evd AS ({_DISP.format(t='ev')})"
LND = f"{LN}, {DM}, lnd AS ({_DISP.format(t='ln')})"

CT = "ct(code, description) AS (VALUES " + ", ".join(str(r) for r in A.CALL_TYPES) + ")"

CHANGE_GROUP = """CASE WHEN call_type_changed IS NULL OR severity_changed IS NULL THEN 'Unknown change status'
  WHEN call_type_changed AND severity_changed THEN 'Both call type and severity changed'
  WHEN call_type_changed THEN 'Call type changed only' WHEN severity_changed THEN 'Severity changed only'
  ELSE 'Neither classification changed' END"""


def daily(grain: str, fact: str = "ev") -> str:
    """Daily base and derived columns at a grain (comma separated names)."""
    q = lambda p: f"quantile_disc(valid_incident_response_seconds, {p})"
    return f"""d0 AS (SELECT {grain}, COUNT(*) AS total_incidents,
  COUNT(valid_dispatch_response_seconds) AS valid_dispatch_response_count,
  COUNT(valid_incident_response_seconds) AS valid_incident_response_count,
  COUNT(valid_travel_time_seconds) AS valid_travel_time_count,
  SUM(valid_dispatch_response_seconds) AS total_dispatch_response_seconds,
  SUM(valid_incident_response_seconds) AS total_incident_response_seconds,
  SUM(valid_travel_time_seconds) AS total_travel_time_seconds,
  AVG(valid_dispatch_response_seconds) AS average_dispatch_response_seconds,
  AVG(valid_incident_response_seconds) AS average_incident_response_seconds,
  AVG(valid_travel_time_seconds) AS average_travel_time_seconds,
  stddev_pop(valid_incident_response_seconds) AS population_stddev_response_seconds,
  MIN(valid_incident_response_seconds) AS minimum_response_seconds,
  MAX(valid_incident_response_seconds) AS maximum_response_seconds,
  {q(0.5)} AS p50_response_seconds, {q(0.75)} AS p75_response_seconds, {q(0.9)} AS p90_response_seconds, {q(0.95)} AS p95_response_seconds,
  COUNT(*) FILTER (WHERE is_held) AS held_incident_count, COUNT(*) FILTER (WHERE is_special_event) AS special_event_count,
  COUNT(*) FILTER (WHERE is_transfer) AS transfer_incident_count
  FROM {fact} GROUP BY ALL)"""


def limits(group: str, order: str = "incident_date") -> str:
    """Control limits over d0: sample flag, trailing 30 rows, 3 sigma, flags."""
    w = f"OVER (PARTITION BY {group} ORDER BY {order} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
    v = "CASE WHEN valid_incident_response_count >= 30 THEN average_incident_response_seconds END"
    return f"""d1 AS (SELECT *, valid_incident_response_count >= 30 AS has_sufficient_sample,
  CASE WHEN valid_incident_response_count = 0 THEN 'NO_VALID_RESPONSE' WHEN valid_incident_response_count < 30 THEN 'LOW_SAMPLE_SIZE'
       ELSE 'SUFFICIENT_SAMPLE' END AS analytics_quality_status,
  COUNT({v}) {w} AS historical_baseline_day_count, AVG({v}) {w} AS response_center_line_seconds,
  stddev_pop({v}) {w} AS daily_average_stddev_seconds FROM d0),
d2 AS (SELECT *, historical_baseline_day_count >= 20 AND daily_average_stddev_seconds IS NOT NULL AS has_sufficient_baseline FROM d1),
d3 AS (SELECT *, CASE WHEN has_sufficient_baseline THEN response_center_line_seconds + 3 * daily_average_stddev_seconds END AS upper_control_limit_seconds,
  CASE WHEN has_sufficient_baseline THEN GREATEST(0, response_center_line_seconds - 3 * daily_average_stddev_seconds) END AS lower_control_limit_seconds,
  CASE WHEN has_sufficient_baseline THEN response_center_line_seconds + 2 * daily_average_stddev_seconds END AS upper_warning_limit_seconds,
  CASE WHEN has_sufficient_baseline THEN GREATEST(0, response_center_line_seconds - 2 * daily_average_stddev_seconds) END AS lower_warning_limit_seconds FROM d2),
d4 AS (SELECT *, CASE WHEN has_sufficient_baseline THEN average_incident_response_seconds > upper_control_limit_seconds ELSE FALSE END AS is_above_upper_control_limit,
  CASE WHEN has_sufficient_baseline THEN average_incident_response_seconds < lower_control_limit_seconds ELSE FALSE END AS is_below_lower_control_limit FROM d3),
dy AS (SELECT *, is_above_upper_control_limit OR is_below_lower_control_limit AS is_response_anomaly,
  CASE WHEN NOT has_sufficient_baseline THEN 'Insufficient Baseline' WHEN is_above_upper_control_limit THEN 'Above UCL'
       WHEN is_below_lower_control_limit THEN 'Below LCL' ELSE 'Within Control Limits' END AS response_anomaly_direction,
  has_sufficient_sample AND has_sufficient_baseline AND (is_above_upper_control_limit OR is_below_lower_control_limit) AS is_reportable_response_anomaly FROM d4)"""


GRAIN = "incident_date, incident_year, date_key, borough, initial_severity_level_code"
DAILY = f"{EV}, {daily(GRAIN)}, {limits('borough, initial_severity_level_code')}"


def pooled(group: str, having: int = 0) -> str:
    """Weighted mean and pooled sd over d0, as p1."""
    return f"""p0 AS (SELECT {group}, SUM(total_incidents) AS total_incidents, SUM(valid_incident_response_count) AS valid_response_count,
  SUM(total_incident_response_seconds) AS ts, SUM(valid_incident_response_count * (population_stddev_response_seconds ** 2
  + average_incident_response_seconds ** 2)) AS m2 FROM d0 GROUP BY ALL HAVING SUM(valid_incident_response_count) >= {having}),
p1 AS (SELECT *, ts / NULLIF(valid_response_count, 0) AS avg_s,
  sqrt(GREATEST(0, m2 / NULLIF(valid_response_count, 0) - (ts / NULLIF(valid_response_count, 0)) ** 2)) AS sd_s FROM p0)"""
