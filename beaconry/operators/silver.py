"""Raw text rows to typed incident rows: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.functions import exprs as X

# Which raw columns hold what.
INDICATORS = {
    "valid_dispatch_rspns_time_indc": "is_valid_dispatch_response",
    "valid_incident_rspns_time_indc": "is_valid_incident_response",
    "held_indicator": "is_held",
    "reopen_indicator": "is_reopened",
    "special_event_indicator": "is_special_event",
    "standby_indicator": "is_standby",
    "transfer_indicator": "is_transfer",
}
TIMESTAMPS = """incident_datetime first_assignment_datetime first_activation_datetime
first_on_scene_datetime first_to_hosp_datetime first_hosp_arrival_datetime incident_close_datetime""".split()
INTEGERS = ["initial_severity_level_code", "final_severity_level_code"]
DOUBLES = ["dispatch_response_seconds_qy", "incident_response_seconds_qy", "incident_travel_tm_seconds_qy"]


def clean_strings(df: DataFrame, upper=()) -> DataFrame:
    """Trim every text column, blank to null; upper-case the named ones."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = X.blank_to_null(f.name)
            out[f.name] = F.upper(c) if f.name in upper else c
    return df.withColumns(out)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns, null where the text does not convert."""
    return df.withColumns({c: X.convert(c, t) for c, t in types.items()})


def conversion_failures(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Rows per column whose non-null text does not convert (one pass)."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & X.convert(c, t).isNull()).alias(c + "_invalid")
                    for c, t in types.items()])


def raw_types() -> dict[str, str]:
    return ({c: "timestamp_ntz" for c in TIMESTAMPS} | {c: "int" for c in INTEGERS} | {c: "double" for c in DOUBLES})


def valid_measures(df: DataFrame) -> DataFrame:
    """Valid seconds, their minutes, and elapsed durations."""
    df = df.withColumns({
        "valid_dispatch_response_seconds": X.valid_measure("dispatch_response_seconds_qy", "is_valid_dispatch_response"),
        "valid_incident_response_seconds": X.valid_measure("incident_response_seconds_qy", "is_valid_incident_response"),
        "valid_travel_time_seconds": X.valid_measure("incident_travel_tm_seconds_qy"),
    })
    return df.withColumns({
        "dispatch_response_minutes": X.minutes_of("valid_dispatch_response_seconds"),
        "incident_response_minutes": X.minutes_of("valid_incident_response_seconds"),
        "travel_time_minutes": X.minutes_of("valid_travel_time_seconds"),
    })


def calendar_columns(df: DataFrame, ts: str = "incident_datetime") -> DataFrame:
    """Date parts of the incident time, weekend flag and part of the day."""
    d = F.to_date(ts)
    return df.withColumns({
        "incident_date": d,
        "incident_year": F.year(d),
        "incident_quarter": F.quarter(d),
        "incident_month": F.month(d),
        "incident_month_name": F.date_format(d, "MMMM"),
        "incident_year_month": X.year_month(d),
        "incident_day_of_week_number": F.dayofweek(d),
        "incident_day_of_week_name": F.date_format(d, "EEEE"),
        "incident_hour": F.hour(ts),
        "is_weekend": X.is_weekend(d),
        "time_of_day": X.time_bucket(F.hour(ts)),
    })


def change_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "call_type_changed": X.changed("initial_call_type", "final_call_type"),
        "severity_changed": X.changed("initial_severity_level_code", "final_severity_level_code"),
    })


def record_status(incident_id="incident_id", ts="incident_datetime", year="incident_year", source_year="_source_year"):
    """Quality status of a row; the first matching rule wins."""
    return X.first_match([
        (F.col(incident_id).isNull(), "MISSING_INCIDENT_ID"),
        (F.col(ts).isNull(), "INVALID_INCIDENT_DATETIME"),
        (F.col(year) != F.col(source_year), "SOURCE_YEAR_MISMATCH"),
    ], "VALID")


def to_silver(bronze: DataFrame) -> DataFrame:
    """The whole cleaning step from raw text rows to typed incident rows."""
    df = clean_strings(bronze, upper=INDICATORS)
    df = cast_columns(df, raw_types())
    df = df.withColumns({new: X.yn_to_bool(old) for old, new in INDICATORS.items()})
    df = change_flags(calendar_columns(valid_measures(df)))
    return df.withColumns({
        "incident_duration_seconds": X.elapsed_seconds("incident_datetime", "incident_close_datetime"),
        "hospital_travel_seconds": X.elapsed_seconds("first_to_hosp_datetime", "first_hosp_arrival_datetime"),
        "record_quality_status": record_status(),
    })


def silver_audit(silver: DataFrame) -> DataFrame:
    """One row of quality counts with a PASS/FAIL verdict.

    Rows are first grouped by id, which gives the exact distinct count and all
    other metrics from one shuffle without expanding the input.
    """
    bad = {
        "missing_incident_ids": F.col("incident_id").isNull(),
        "invalid_records": F.col("record_quality_status") != "VALID",
        "source_year_mismatches": F.col("incident_year") != F.col("_source_year"),
        "negative_dispatch_times": F.col("dispatch_response_seconds_qy") < 0,
        "negative_incident_times": F.col("incident_response_seconds_qy") < 0,
        "negative_travel_times": F.col("incident_travel_tm_seconds_qy") < 0,
    }
    per_id = silver.groupBy("incident_id").agg(
        F.count("*").alias("rows"), F.min("incident_datetime").alias("lo"), F.max("incident_datetime").alias("hi"),
        *[F.count_if(c).alias(n) for n, c in bad.items()])
    out = per_id.agg(
        F.sum("rows").alias("total_rows"), F.count("incident_id").alias("distinct_incident_ids"),
        *[F.sum(n).alias(n) for n in bad], F.min("lo").alias("minimum_incident_datetime"), F.max("hi").alias("maximum_incident_datetime"))
    out = out.withColumn("duplicate_incident_ids",
                         F.col("total_rows") - F.col("missing_incident_ids") - F.col("distinct_incident_ids"))
    total_bad = sum((F.col(n) for n in bad), F.col("duplicate_incident_ids"))
    return out.withColumn("validation_status", F.when(total_bad == 0, "PASS").otherwise("FAIL"))
