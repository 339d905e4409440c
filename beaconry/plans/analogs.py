"""The test tables in the shape of incidents.

Three facts: ``events`` (one row per event, with hours), ``lines`` (order lines
with customer and supplier, seven years) and ``orders`` (order grain).  The row
mapping is a fixture convention written once as SQL text that both engines
read; everything derived from it is computed by the library here and by hand
written SQL in :mod:`beaconry.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.operators import dims as D
from beaconry.operators import fact as FC
from beaconry.operators import silver as S
from beaconry.session import new_folder, pin
from beaconry.sources import raw as R
from beaconry.sources.tables import last_change, literal_table, table

# How an event row reads as an incident.  ``k`` is the payload
# number, ``s`` the response seconds, ``r_name`` the region of the user's area.
EVENT_FIELDS = {
    "incident_id": "CAST(event_id AS STRING)",
    "incident_datetime": "ts",
    "initial_call_type": "UPPER(event_type)",
    "final_call_type": """CASE WHEN k = 99 THEN NULL WHEN k < 8 THEN 'REVIEW' WHEN k < 20 THEN
        CASE event_type WHEN 'view' THEN 'CLICK' WHEN 'error' THEN 'VIEW' WHEN 'purchase' THEN 'ERROR' ELSE 'PURCHASE' END
        ELSE UPPER(event_type) END""",
    "initial_severity_level_code": "CASE WHEN k < 60 THEN 1 WHEN k < 85 THEN 2 WHEN k < 97 THEN 3 END",
    "final_severity_level_code": """CASE WHEN k = 98 THEN NULL WHEN value > 150 THEN 1 WHEN value < 5 THEN 3
        WHEN k < 60 THEN 1 WHEN k < 85 THEN 2 WHEN k < 97 THEN 3 END""",
    "borough": "CASE WHEN k <> 96 THEN r_name END",
    "zipcode": "CASE WHEN k <> 95 THEN CAST(10000 + user_id % 40 AS STRING) END",
    "policeprecinct": "CAST(user_id % 8 AS STRING)",
    "citycouncildistrict": "CAST(user_id % 10 AS STRING)",
    "communitydistrict": "CAST(user_id % 5 AS STRING)",
    "incident_disposition_code": """CASE WHEN k = 97 THEN NULL WHEN k IN (40, 41) THEN 'X99' WHEN k = 42 THEN 'ZZZZZZ'
        WHEN event_type = 'purchase' THEN '82'
        WHEN event_type = 'signup' THEN CASE WHEN value < 50 THEN '94' ELSE '93' END
        WHEN event_type = 'view' THEN CASE WHEN value < 20 THEN '91' ELSE '92' END
        WHEN event_type = 'click' THEN CASE WHEN value < 50 THEN '90' ELSE '83' END
        WHEN value < 80 THEN 'CANCEL' ELSE 'DUP' END""",
    "dispatch_response_seconds_qy": "CAST(CASE WHEN k = 50 THEN -5 ELSE FLOOR(s * 3 / 10) END AS DOUBLE)",
    "incident_response_seconds_qy": "CAST(s AS DOUBLE)",
    "incident_travel_tm_seconds_qy": """CAST(CASE WHEN k = 51 THEN NULL WHEN k = 52 THEN s - FLOOR(s * 3 / 10) + 1
        ELSE s - FLOOR(s * 3 / 10) END AS DOUBLE)""",
    "is_valid_dispatch_response": "CASE WHEN k <> 33 THEN value >= 0.5 END",
    "is_valid_incident_response": "value >= 1",
    "is_held": "CASE WHEN k <> 34 THEN event_type = 'error' END",
    "is_reopened": "k = 35",
    "is_special_event": "k BETWEEN 20 AND 24",
    "is_standby": "k = 36",
    "is_transfer": "event_type = 'view' AND k < 8",
    "incident_duration_seconds": "CAST(CASE WHEN k <> 13 THEN s + 1800 END AS DOUBLE)",
    "hospital_travel_seconds": "CAST(CASE WHEN event_type IN ('purchase', 'signup') AND k <> 14 THEN s END AS DOUBLE)",
}

# The same event as a raw text line, with blanks, lower-case
# indicators, text that does not convert and a wrong year folder for some k.
RAW_FIELDS = {
    "incident_id": "CAST(event_id AS STRING)",
    "incident_datetime": "SUBSTRING(CAST(ts AS STRING), 1, 19)",
    "initial_call_type": "CASE WHEN k BETWEEN 10 AND 15 THEN CONCAT('  ', UPPER(event_type), ' ') ELSE UPPER(event_type) END",
    "initial_severity_level_code": "COALESCE(CAST(initial_severity_level_code AS STRING), '   ')",
    "final_call_type": "COALESCE(final_call_type, '  ')",
    "final_severity_level_code": "COALESCE(CAST(final_severity_level_code AS STRING), '')",
    "first_assignment_datetime": "{at:CAST(FLOOR(s * 3 / 10) AS INT)}",
    "valid_dispatch_rspns_time_indc": "CASE WHEN k = 33 THEN '' WHEN value >= 0.5 THEN 'y' ELSE 'N' END",
    "dispatch_response_seconds_qy": "CAST(CAST(dispatch_response_seconds_qy AS INT) AS STRING)",
    "first_activation_datetime": "{at:CAST(FLOOR(s * 3 / 10) AS INT) + 10}",
    "first_on_scene_datetime": "{at:s}",
    "valid_incident_rspns_time_indc": "CASE WHEN value >= 1 THEN ' Y' ELSE 'n' END",
    "incident_response_seconds_qy": "CAST(s AS STRING)",
    "incident_travel_tm_seconds_qy": "CASE WHEN k = 51 THEN 'n/a' ELSE CAST(CAST(incident_travel_tm_seconds_qy AS INT) AS STRING) END",
    "first_to_hosp_datetime": "CASE WHEN event_type IN ('purchase', 'signup') THEN {at:s + 300} ELSE '' END",
    "first_hosp_arrival_datetime": """CASE WHEN event_type NOT IN ('purchase', 'signup') THEN ''
        WHEN k = 14 THEN {at:s} ELSE {at:s + 300 + s} END""",
    "incident_close_datetime": "CASE WHEN k = 13 THEN 'not recorded' ELSE {at:s + 1800} END",
    "held_indicator": "CASE WHEN k = 34 THEN '?' WHEN event_type = 'error' THEN 'Y' ELSE 'n' END",
    "incident_disposition_code": "COALESCE(incident_disposition_code, '')",
    "borough": "COALESCE(borough, '')",
    "incident_dispatch_area": "CONCAT('A', CAST(user_id % 12 AS STRING))",
    "zipcode": "COALESCE(zipcode, '')",
    "policeprecinct": "policeprecinct",
    "citycouncildistrict": "citycouncildistrict",
    "communitydistrict": "communitydistrict",
    "communityschooldistrict": "CAST(user_id % 6 AS STRING)",
    "congressionaldistrict": "CAST(user_id % 9 AS STRING)",
    "reopen_indicator": "CASE WHEN k = 35 THEN 'Y' ELSE 'N' END",
    "special_event_indicator": "CASE WHEN k BETWEEN 20 AND 24 THEN 'Y' ELSE 'N' END",
    "standby_indicator": "CASE WHEN k = 36 THEN 'Y' ELSE 'N' END",
    "transfer_indicator": "CASE WHEN event_type = 'view' AND k < 8 THEN 'Y' ELSE 'N' END",
}
RAW_YEAR = "CASE WHEN k = 37 THEN YEAR(ts) - 1 ELSE YEAR(ts) END"

# How an order line reads as an incident; ``s`` is the lag in days.
LINE_FIELDS = {
    "incident_id": "CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "incident_datetime": "o_orderdate",
    "initial_call_type": "c_nation",
    "final_call_type": "s_nation",
    "initial_severity_level_code": "CAST(SUBSTRING(o_orderpriority, 1, 1) AS INT)",
    "final_severity_level_code": "CASE WHEN l_linenumber <= 5 THEN l_linenumber END",
    "borough": "r_name",
    "incident_disposition_code": """CASE CONCAT(l_returnflag, l_linestatus) WHEN 'AF' THEN '82' WHEN 'AO' THEN '94'
        WHEN 'NF' THEN '91' WHEN 'NO' THEN '83' WHEN 'RF' THEN 'CANCEL' ELSE 'X99' END""",
    "dispatch_response_seconds_qy": "CAST(FLOOR(s * 3 / 10) AS DOUBLE)",
    "incident_response_seconds_qy": "CAST(s AS DOUBLE)",
    "incident_travel_tm_seconds_qy": "CAST(s - FLOOR(s * 3 / 10) AS DOUBLE)",
    "is_valid_dispatch_response": "s >= 0",
    "is_valid_incident_response": "s >= 0",
    "is_held": "l_returnflag = 'R'",
}

# Descriptions of the event codes; REVIEW is left undocumented.
CALL_TYPES = [("VIEW", "page view"), ("CLICK", "link click"), ("PURCHASE", "completed purchase"),
              ("SIGNUP", "new account"), ("ERROR", "application error"), ("REFUND", "returned purchase")]


def exprs(fields: dict[str, str]):
    return [f"{e} AS {n}" for n, e in fields.items()]


def raw_exprs(at) -> dict[str, str]:
    """RAW_FIELDS with ``{at:n}`` turned into text of the time n seconds later."""
    out = {}
    for name, e in RAW_FIELDS.items():
        while "{at:" in e:
            i = e.index("{at:")
            j = e.index("}", i)
            e = e[:i] + at(e[i + 4:j]) + e[j + 1:]
        out[name] = e
    return out


def _spark_at(n: str) -> str:
    return f"SUBSTRING(CAST(TIMESTAMPADD(SECOND, {n}, ts) AS STRING), 1, 19)"


def event_base(spark: SparkSession, folder: str, area: bool = True) -> DataFrame:
    """Events with payload number, response seconds and area; a narrow job.

    The area comes from the region table, small enough by its file size for
    Catalyst to broadcast it.  A query that does not use the area leaves the
    join out (``area=False``) and with it the user column in the scan.
    """
    e = table(spark, folder, "events").withColumns({
        "k": F.regexp_extract("props", r'"k": ([0-9]+)', 1).cast("int"),
        "s": F.floor(F.col("value") * 6).cast("int")})
    if not area:
        return e.withColumn("r_name", F.lit(None).cast("string"))
    # Grouped by its key the region is known to be unique, so a query that reads no area drops the join.
    r = table(spark, folder, "region").groupBy(F.col("r_regionkey").cast("long").alias("r_regionkey")).agg(F.min("r_name").alias("r_name"))
    return e.join(r, F.col("user_id") % 5 == F.col("r_regionkey"), "left")


def events(spark: SparkSession, folder: str, area: bool = True) -> DataFrame:
    """Typed event incidents with valid measures, change flags and date parts."""
    e = event_base(spark, folder, area).selectExpr(*exprs(EVENT_FIELDS))
    return S.change_flags(S.calendar_columns(S.valid_measures(e)))


def event_view(spark: SparkSession, folder: str, area: bool = True) -> DataFrame:
    """Event incidents with normalised codes, as the analysis queries expect."""
    return FC.prepare(events(spark, folder, area))


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw text lines plus the ``year`` of their folder."""
    base = event_base(spark, folder).selectExpr("*", *exprs({n: e for n, e in EVENT_FIELDS.items() if n not in ("incident_id", "incident_datetime")}))
    return base.selectExpr(*exprs(raw_exprs(_spark_at)), f"CAST({RAW_YEAR} AS INT) AS year")


def bronze_events(spark: SparkSession, folder: str) -> DataFrame:
    """Raw event lines without the trip through files, lineage year included."""
    return raw_events(spark, folder).withColumnRenamed("year", "_source_year")


_STAGED: dict[tuple, object] = {}


def _once(spark: SparkSession, folder: str, what: str, make):
    """Result of ``make`` kept per application and state of the input tables; only the latest state is kept."""
    key = (spark.sparkContext.applicationId, folder, what, *(last_change(spark, folder, t) for t in ("events", "region")))
    for old in [k for k in _STAGED if k[:3] == key[:3] and k != key]:
        del _STAGED[old]
    if key not in _STAGED:
        _STAGED[key] = make()
    return _STAGED[key]


def forget() -> None:
    """Drop what :func:`_once` keeps, so that it is made anew."""
    _STAGED.clear()


def staged_csv(spark: SparkSession, folder: str) -> str:
    """Raw event lines written once as CSV in year folders; the path of the root."""
    def make():
        path = new_folder(spark, "raw-events")
        R.write_raw(raw_events(spark, folder), path, "year")
        return path
    return _once(spark, folder, "csv", make)


def lines(spark: SparkSession, folder: str, supplier: bool = True, customer: bool = True, names: bool = True) -> DataFrame:
    """Typed order-line incidents.

    Customers are resolved on the order side before the lines join, so the long
    line rows are shuffled once for the order key.  Only keys travel through
    those joins; names of nations and regions are looked up on the joined rows.
    A role that a query does not use is left out with its join
    (``supplier``/``customer`` false).  Without ``names`` the classes stay keys
    (``initial_call_type_key``, ``final_call_type_key``), and a query attaches
    names to the rows that it has counted.
    """
    li, o = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    fields = dict(LINE_FIELDS)
    if not names:
        fields = {k: e for k, e in fields.items() if k != "borough"} | {"initial_call_type": "c_nationkey", "final_call_type": "s_nationkey"}
    elif supplier or customer:
        n = table(spark, folder, "nation")
    if customer:
        c = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        o = o.join(c, o.o_custkey == c.c_custkey, "left")
    else:
        fields = {k: e for k, e in fields.items() if k not in ("initial_call_type", "borough")}
    out = li.join(o, li.l_orderkey == o.o_orderkey)
    if supplier:
        s = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
        out = out.join(s, out.l_suppkey == s.s_suppkey, "left")
        if names:
            out = out.join(n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_nation")), "s_nationkey", "left")
    else:
        fields.pop("final_call_type")
    if customer and names:
        # Two plain scans: the estimated size of a joined pair would be their product.
        r = table(spark, folder, "region")
        place = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_nation"), F.col("n_regionkey").alias("r_regionkey"))
        out = out.join(place, "c_nationkey", "left").join(r.select("r_regionkey", "r_name"), "r_regionkey", "left")
    out = out.withColumn("s", F.datediff("l_shipdate", "o_orderdate")).selectExpr(*exprs(fields))
    out = S.calendar_columns(S.valid_measures(out))
    flags = {"severity_changed": S.X.changed("initial_severity_level_code", "final_severity_level_code")}
    if supplier and customer:
        flags["call_type_changed"] = S.X.changed("initial_call_type", "final_call_type")
    out = out.withColumns(flags)
    return out if names else out.withColumnsRenamed({f"{role}_call_type": f"{role}_call_type_key" for role in ("initial", "final")})


def nation_names(spark: SparkSession, folder: str, role: str) -> DataFrame:
    """Key, name and description of the class in a role, for counted rows."""
    n = table(spark, folder, "nation")
    return n.select(F.col("n_nationkey").alias(f"{role}_call_type_key"), F.col("n_name").alias(f"{role}_call_type"),
                    F.concat(F.lit("nation of "), F.initcap("n_name")).alias(f"{role}_call_type_description"))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order incidents: id, date parts and severity, no joins."""
    o = table(spark, folder, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS incident_id", "o_orderdate AS incident_datetime",
        "CAST(SUBSTRING(o_orderpriority, 1, 1) AS INT) AS initial_severity_level_code", "o_orderstatus", "o_totalprice", "o_custkey")
    return S.calendar_columns(o)


def call_type_mapping(spark: SparkSession) -> DataFrame:
    return literal_table(spark, CALL_TYPES, "call_type string, call_type_description string")


def with_disposition(spark: SparkSession, df: DataFrame) -> DataFrame:
    return D.dispositions(df, D.disposition_mapping(spark), "incident_disposition_code")


def star(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact and dimensions of the event incidents; dimensions are stored once."""
    def make():
        silver = events(spark, folder)
        dims = {n: pin(d, f"dim-{n}") for n, d in FC.build_dims(silver, call_type_mapping(spark)).items()}
        return FC.build_fact(silver, dims), dims
    return _once(spark, folder, "star", make)
