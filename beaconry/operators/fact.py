"""Star-schema fact: codes resolved to dimension keys, one row per incident."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import dims as D
from beaconry.session import pin

GEOGRAPHY = ["borough", "zipcode", "policeprecinct", "citycouncildistrict", "communitydistrict"]

# The fact's columns in order.
FACT_COLUMNS = """
incident_id incident_datetime incident_year date_key time_key geography_key initial_call_type_key
final_call_type_key initial_severity_key final_severity_key disposition_key incident_count
valid_dispatch_response_seconds valid_incident_response_seconds valid_travel_time_seconds
dispatch_response_minutes incident_response_minutes travel_time_minutes incident_duration_seconds
hospital_travel_seconds is_valid_dispatch_response is_valid_incident_response is_held is_reopened
is_special_event is_standby is_transfer call_type_changed severity_changed
""".split()


class Lookup(NamedTuple):
    """How to fetch a key: fact columns, matching dimension columns, key, output name."""

    dim: DataFrame
    fact_columns: list
    dim_columns: list
    key: str
    name: str


def resolve_keys(fact: DataFrame, lookups) -> DataFrame:
    """Left-join each dimension's key onto the fact.

    No broadcast hint: the dimensions are stored tables, so Catalyst knows their
    size and broadcasts the small ones; one that has outgrown the threshold is
    joined by shuffle, with AQE splitting skewed keys.  Natural keys are gated to
    be unique when the dimensions are loaded; grouping by them here tells Catalyst
    so, which then drops every lookup whose key a query does not read, and should
    a duplicate ever pass, the smallest key is taken.
    """
    for i, lk in enumerate(lookups):
        names = [f"_lk{i}_{j}" for j in range(len(lk.dim_columns))]
        side = lk.dim.select(*[F.col(d).alias(n) for d, n in zip(lk.dim_columns, names)], F.col(lk.key)).groupBy(*names).agg(F.min(lk.key).alias(lk.name))
        on = [F.col(f) == F.col(n) for f, n in zip(lk.fact_columns, names)]
        fact = fact.join(side, on, "left").drop(*names)
    return fact


def prepare(silver: DataFrame) -> DataFrame:
    """Normalised lookup codes and date/time keys next to the silver columns."""
    return silver.withColumns({
        **{c: X.or_unknown(c) for c in GEOGRAPHY},
        "initial_call_type": X.norm_code("initial_call_type"),
        "final_call_type": X.norm_code("final_call_type"),
        "initial_severity_level_code": X.or_unknown("initial_severity_level_code", X.UNKNOWN_CODE).cast("int"),
        "final_severity_level_code": X.or_unknown("final_severity_level_code", X.UNKNOWN_CODE).cast("int"),
        "incident_disposition_code": X.or_unknown("incident_disposition_code"),
        "date_key": X.date_key("incident_date"),
        "time_key": F.col("incident_hour").cast("int"),
    })


#: Natural and surrogate key of the dimensions whose members come from the data.
KEYED = {"geography": (GEOGRAPHY, "geography_key"), "call_type": (["call_type"], "call_type_key"),
         "severity": (["severity_level_code"], "severity_key"), "disposition": (["disposition_code"], "disposition_key")}
_CODES = ["initial_call_type", "final_call_type", "initial_severity_level_code", "final_severity_level_code", "incident_disposition_code"]


def members_of(silver: DataFrame) -> DataFrame:
    """The different combinations of all natural keys and the dates, from one pass over silver."""
    return prepare(silver).groupBy(*GEOGRAPHY, *_CODES, "incident_date").agg(F.count("*").alias("incidents"))


def build_dims(silver: DataFrame, call_type_mapping: DataFrame, disposition_mapping: DataFrame | None = None,
               registries: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The six dimensions of the star, from silver and the two mappings.

    Silver is read once, for the stored combinations of its natural keys; every
    dimension follows from these.  ``registries`` are the dimensions of the last
    load: their members keep their keys and new ones are numbered after them.
    """
    spark = silver.sparkSession
    p = pin(members_of(silver), "members")
    call_types = D.role_dim(p, {"initial": F.col("initial_call_type"), "final": F.col("final_call_type")}, "call_type")
    severities = D.role_dim(p, {"initial": F.col("initial_severity_level_code"), "final": F.col("final_severity_level_code")},
                            "severity_level_code")
    codes = p.select(F.col("incident_disposition_code").alias("disposition_code")).distinct()
    mapping = D.disposition_mapping(spark) if disposition_mapping is None else disposition_mapping
    members = {"geography": p.select(*GEOGRAPHY).distinct(), "call_type": call_types, "severity": severities, "disposition": codes}

    def keyed(name: str) -> DataFrame:
        natural, key = KEYED[name]
        keys = D.extend_keys((registries or {}).get(name), members[name], natural, key)
        if not registries:
            return D.keyed(members[name], keys, natural, key)
        # members of earlier loads stay, whether they occur now or not
        roles = [c for c in registries[name].columns if c.startswith("appears_as_")]
        seen = members[name].unionByName(registries[name].select(*natural, *roles))
        seen = seen.groupBy(*natural).agg(*[F.bool_or(c).alias(c) for c in roles]) if roles else seen.distinct()
        return D.keyed(seen, keys, natural, key)

    return {
        "date": D.calendar_of(p, "incident_date"),
        "time": D.hours(spark),
        "geography": keyed("geography").withColumn("geography_label", F.concat_ws(" | ", "borough", "zipcode")),
        "call_type": D.describe_codes(keyed("call_type"), call_type_mapping, "call_type", "call_type_description"),
        "severity": keyed("severity").withColumn("severity_label", X.severity_label("severity_level_code")),
        "disposition": D.dispositions(keyed("disposition"), mapping),
    }


def build_fact(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Resolve all keys; each role-playing dimension is looked up twice."""
    ct, sv = dims["call_type"], dims["severity"]
    keyed = resolve_keys(prepare(silver), [
        Lookup(dims["geography"], GEOGRAPHY, GEOGRAPHY, "geography_key", "geography_key"),
        Lookup(ct, ["initial_call_type"], ["call_type"], "call_type_key", "initial_call_type_key"),
        Lookup(ct, ["final_call_type"], ["call_type"], "call_type_key", "final_call_type_key"),
        Lookup(sv, ["initial_severity_level_code"], ["severity_level_code"], "severity_key", "initial_severity_key"),
        Lookup(sv, ["final_severity_level_code"], ["severity_level_code"], "severity_key", "final_severity_key"),
        Lookup(dims["disposition"], ["incident_disposition_code"], ["disposition_code"], "disposition_key", "disposition_key"),
    ])
    return keyed.withColumn("incident_count", F.lit(1)).select(*FACT_COLUMNS)


def star_view(fact: DataFrame, dims: dict[str, DataFrame], columns) -> DataFrame:
    """The fact with the named natural attributes, as the analysis queries expect it.

    Only dimensions that supply one of ``columns`` are joined; each small one is
    broadcast by its stored size, so the view stays a narrow job.
    """
    ct, sv = dims["call_type"], dims["severity"]
    sources = {"date": (dims["date"], {"date_key": "date_key", "full_date": "incident_date"}),
               "time": (dims["time"], {"time_key": "time_key", "hour_number": "incident_hour"}),
               "geography": (dims["geography"], {"geography_key": "geography_key"}),
               "disposition": (dims["disposition"], {"disposition_key": "disposition_key", "disposition_code": "incident_disposition_code"})}
    for role in ("initial", "final"):
        sources[f"{role}_call_type"] = (ct, {"call_type_key": f"{role}_call_type_key", "call_type": f"{role}_call_type",
                                             "call_type_description": f"{role}_call_type_description"})
        sources[f"{role}_severity"] = (sv, {"severity_key": f"{role}_severity_key", "severity_level_code": f"{role}_severity_level_code",
                                            "severity_label": f"{role}_severity_label"})
    out, missing = fact, set(columns) - set(fact.columns)
    for dim, names in sources.values():
        key = next(n for n in names.values() if n.endswith("_key"))
        side = dim.withColumnsRenamed(names)
        wanted = sorted(missing & set(side.columns))
        if wanted:
            out = out.join(side.select(key, *wanted), key, "left")
            missing -= set(wanted)
    if missing:
        raise ValueError(f"no dimension supplies {sorted(missing)}")
    return out
