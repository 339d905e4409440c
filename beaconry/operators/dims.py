"""Conformed dimensions: calendar, hours, role-merged codes, mapping, keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.session import pin
from beaconry.sources.tables import literal_table

# Disposition codes with their description and category.
DISPOSITIONS = [
    ("82", "transporting patient", "Transported"),
    ("83", "patient pronounced dead", "Death on Scene"),
    ("87", "cancelled", "Cancelled / Not Dispatched"),
    ("90", "unfounded", "Patient Not Located / Unfounded"),
    ("91", "condition corrected", "Not Transported"),
    ("92", "treated not transported", "Not Transported"),
    ("93", "refused medical aid", "Not Transported"),
    ("94", "treated and transported", "Transported"),
    ("95", "triaged at scene no transport", "Not Transported"),
    ("96", "patient gone on arrival", "Patient Not Located / Unfounded"),
    ("CANCEL", "cancelled", "Cancelled / Not Dispatched"),
    ("DUP", "duplicate incident", "Duplicate Incident"),
    ("NOTSNT", "unit not sent", "Cancelled / Not Dispatched"),
    ("ZZZZZZ", "no disposition", "Unknown / No Disposition"),
]
# Display order of the categories; anything else sorts last.
CATEGORY_ORDER = [
    "Transported", "Not Transported", "Death on Scene", "Patient Not Located / Unfounded",
    "Cancelled / Not Dispatched", "Duplicate Incident", "Unknown / No Disposition",
]

# What a column shows for the unknown member and for a code the mapping lacks.
CALL_TYPE_DEFAULTS = {"call_type_description": ("UNKNOWN CALL TYPE", "UNDOCUMENTED CALL TYPE")}
DISPOSITION_DEFAULTS = {
    "disposition_description": ("unknown", "undocumented code"),
    "disposition_category": ("Unknown / No Disposition", "Undocumented"),
    "mapping_status": ("Unknown", "Undocumented"),
    "is_documented_code": (False, False),
    "is_unknown": (True, False),
}


def calendar(spark: SparkSession, lo, hi) -> DataFrame:
    """One row per day from lo to hi (dates or scalar sub-queries), 22 columns."""
    days = spark.range(1).select(F.explode(F.sequence(_date(lo), _date(hi))).alias("full_date"))
    return describe_dates(days)


def calendar_of(df: DataFrame, date: str) -> DataFrame:
    """The calendar over the date range of a frame.

    Only the two end dates leave the scan, as a one-row frame the days grow from.
    """
    ends = df.agg(F.min(F.to_date(date)).alias("lo"), F.max(F.to_date(date)).alias("hi"))
    return describe_dates(ends.select(F.explode(F.sequence("lo", "hi")).alias("full_date")))


def _date(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("date")


def describe_dates(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    year, quarter, month = F.year(d), F.quarter(d), F.month(d)
    q_name = F.concat(F.lit("Q"), quarter.cast("string"))
    return days.select(
        X.date_key(d).alias("date_key"), d,
        year.alias("year"), quarter.alias("quarter_number"), q_name.alias("quarter_name"),
        F.concat_ws("-", year.cast("string"), q_name).alias("year_quarter"),
        (year * 10 + quarter).alias("year_quarter_sort"),
        month.alias("month_number"), F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"), X.year_month(d).alias("year_month"),
        F.date_format(d, "MMM yyyy").alias("year_month_label"), (year * 100 + month).alias("year_month_sort"),
        F.weekofyear(d).alias("week_of_year"), F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"),
        F.dayofweek(d).alias("day_of_week_number"), F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.date_format(d, "EEE").alias("day_of_week_short_name"),
        X.is_weekend(d).alias("is_weekend"),
        (d == F.trunc(d, "month")).alias("is_month_start"), (d == F.last_day(d)).alias("is_month_end"))


def hours(spark: SparkSession) -> DataFrame:
    """The 24 hours of the day with label and six-hour bucket."""
    h = F.col("hour_number")
    return spark.range(24).select(F.col("id").cast("int").alias("hour_number")).select(
        h.alias("time_key"), h, X.hour_label(h).alias("hour_label"),
        X.time_bucket(h).alias("time_of_day"), X.time_bucket_sort(h).alias("time_of_day_sort"))


def role_dim(df: DataFrame, roles: dict[str, Column], key: str) -> DataFrame:
    """Codes seen in any of several roles, with one ``appears_as_<role>`` flag each.

    ``roles`` maps role name to the normalised code expression.  Each row is
    turned into one (code, role) pair per role inside the same scan, so the
    source is read once; partial aggregation reduces it to the distinct codes
    before the shuffle.
    """
    pairs = F.array(*[F.struct(code.alias(key), F.lit(role).alias("role")) for role, code in roles.items()])
    return (df.select(F.inline(pairs)).groupBy(key)
            .agg(*[F.bool_or(F.col("role") == role).alias(f"appears_as_{role}") for role in roles]))


def union_roles(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Same result from separate frames, one per role, by union and max of flags."""
    tagged = [df.select(key, *[F.lit(role == r).alias(f"appears_as_{r}") for r in parts]) for role, df in parts.items()]
    merged = reduce(lambda a, b: a.unionByName(b), tagged)
    return merged.groupBy(key).agg(*[F.max(F.col(f"appears_as_{r}").cast("int")).cast("boolean").alias(f"appears_as_{r}") for r in parts])


def distinct_members(df: DataFrame, columns) -> DataFrame:
    """Distinct combinations of columns with nulls standardised to UNKNOWN."""
    return df.select(*[X.or_unknown(c).alias(c) for c in columns]).distinct()


def with_surrogate_key(df: DataFrame, order, name: str) -> DataFrame:
    """Dense 1..n key in the order of the natural key."""
    return dense_key_at_scale(df, order, name)


def dense_key_at_scale(df: DataFrame, order, name: str) -> DataFrame:
    """Dense numbering without a single-task sort.

    Rows are range-partitioned and sorted, tagged with partition and position,
    and pinned so that later passes see the same ranges.  The start of each
    partition is the running sum of the earlier partitions' sizes: one row per
    partition, which is what the small window and the join carry.
    """
    n_parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    mid = F.monotonically_increasing_id()
    sorted_rows = (df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
                   .withColumn("_m", mid)
                   .withColumn("_part", F.shiftright("_m", 33).cast("int"))
                   .withColumn("_pos", F.col("_m") - F.shiftleft(F.col("_part").cast("long"), 33)).drop("_m"))
    pinned = pin(sorted_rows, name + "-sorted")
    sizes = pinned.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    return (pinned.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_pos") + 1).drop("_part", "_pos", "_start"))


def extend_keys(registry: DataFrame | None, members: DataFrame, natural, name: str) -> DataFrame:
    """A stored registry of natural and surrogate keys, with a key for every member.

    Known members keep their key, also those that no longer occur, so stored
    facts stay valid.  New ones are found by an anti join and numbered in natural
    order after the largest key given so far.  The first load has no registry.
    """
    new = members.select(*natural).distinct()
    if registry is None:
        return dense_key_at_scale(new, natural, name)
    known = pin(registry.select(*natural, name), f"{name}-known")
    left = known.select(*[F.col(c).alias(f"_k_{c}") for c in natural])
    new = new.join(left, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in natural], "left_anti")
    top = known.agg(F.coalesce(F.max(name), F.lit(0)).alias("top"))
    numbered = dense_key_at_scale(new, natural, name).withColumn(name, F.col(name) + top.scalar())
    return known.unionByName(numbered)


def keyed(members: DataFrame, keys: DataFrame, natural, name: str) -> DataFrame:
    """Members with their key of the registry."""
    side = keys.select(*[F.col(c).alias(f"_k_{c}") for c in natural], name)
    return members.join(side, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in natural], "left").drop(*[f"_k_{c}" for c in natural])


def enrich(df: DataFrame, mapping: DataFrame, code: str, defaults: dict[str, tuple], mapped_code: str | None = None) -> DataFrame:
    """Add mapped columns to every row that carries a code.

    ``defaults`` gives for each column what the unknown member and what a code without an entry show; entries with a null
    text count as missing texts of a known code and show the latter. The mapping is a stored or literal table whose size
    Catalyst knows.
    """
    names = {c: f"_m_{c}" for c in defaults}
    side = mapping.select(F.col(mapped_code or code).alias("_m"), *[F.col(c).alias(n) for c, n in names.items()])
    out = df.join(side, F.col(code) == F.col("_m"), "left")
    filled = {c: F.when(F.col(code) == X.UNKNOWN, F.lit(unknown)).otherwise(F.coalesce(names[c], F.lit(missing)))
              for c, (unknown, missing) in defaults.items()}
    return out.withColumns(filled).drop("_m", *names.values())


def describe_codes(dim: DataFrame, mapping: DataFrame, code: str, text: str) -> DataFrame:
    """Attach descriptions, keeping every code."""
    return enrich(dim, mapping, code, {text: CALL_TYPE_DEFAULTS["call_type_description"]})


def dispositions(df: DataFrame, mapping: DataFrame, code: str = "disposition_code") -> DataFrame:
    """Attach disposition description, category, sort, status and flags to distinct codes or to any rows with the code."""
    listed = mapping.withColumns({"mapping_status": F.lit("Documented"), "is_documented_code": F.lit(True), "is_unknown": F.lit(False)})
    out = enrich(df, listed, code, DISPOSITION_DEFAULTS, "disposition_code")
    return out.withColumn("disposition_category_sort", category_sort(F.col("disposition_category")))


def category_sort(category) -> Column:
    at = F.array_position(F.array(*[F.lit(x) for x in CATEGORY_ORDER]), category)
    return F.when(at > 0, at).otherwise(len(CATEGORY_ORDER) + 1).cast("int")


def disposition_mapping(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DISPOSITIONS, "disposition_code string, disposition_description string, disposition_category string")


def mapping_coverage(dim: DataFrame, text: str, unknown_text: str = "UNKNOWN CALL TYPE",
                     undocumented_text: str = "UNDOCUMENTED CALL TYPE") -> DataFrame:
    """Documented, undocumented and unknown members; they must add up to all."""
    t = F.col(text)
    return dim.agg(
        F.count("*").alias("dimension_rows"),
        X.n_if(t == unknown_text).alias("unknown_rows"),
        X.n_if(t == undocumented_text).alias("undocumented_rows"),
        X.n_if(~t.isin(unknown_text, undocumented_text)).alias("documented_rows")).withColumn(
        "reconciles", F.col("unknown_rows") + F.col("undocumented_rows") + F.col("documented_rows") == F.col("dimension_rows"))
