"""Data-quality checks.

A check is a condition that a row must not meet.  All checks on one table are
counted in a single aggregation and returned as rows
``(table_name, check_name, issues, status)``; nothing is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import daily as DY

TOL = 1e-6


def status_of(issues) -> Column:
    return F.when(issues == 0, "PASS").otherwise("FAIL")


def run_checks(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """One row per check, all counted in one pass."""
    counted = df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    return as_rows(counted, table, list(checks))


def as_rows(one_row: DataFrame, table: str, names) -> DataFrame:
    """A one-row frame of issue counts as (table, check, issues, status) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("issues")) for n in names])
    return one_row.select(F.lit(table).alias("table_name"), F.inline(pairs)).withColumn("status", status_of(F.col("issues")))


def all_checks(parts) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def key_profile(df: DataFrame, key: str, table: str) -> DataFrame:
    """Rows, distinct and missing keys and excess duplicate rows of one table."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    known = F.col(key).isNotNull()
    out = per_key.agg(F.sum("n").alias("total_rows"), F.count(key).alias("distinct_keys"),
                      F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("missing_keys"),
                      F.sum(F.when(known, F.col("n") - 1).otherwise(0)).alias("duplicate_rows"))
    bad = F.coalesce(F.col("missing_keys") + F.col("duplicate_rows"), F.lit(1))
    return out.select(F.lit(table).alias("table_name"), F.coalesce("total_rows", F.lit(0)).alias("total_rows"), "distinct_keys",
                      F.coalesce("missing_keys", F.lit(0)).alias("missing_keys"), F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"),
                      status_of(bad).alias("status"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def orphan_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct fact keys without a member: distinct first, then anti join."""
    keys = fact.select(F.col(fact_key).alias("k")).filter(F.col("k").isNotNull()).distinct()
    return keys.join(dim.select(F.col(dim_key).alias("k")), "k", "left_anti")


def count_orphaned_keys(fact: DataFrame, lookups) -> DataFrame:
    """Distinct orphan keys per ``(fact_key, dim, dim_key)`` lookup.

    The different combinations of keys are found first; only they become (name,
    key) pairs, which are reduced to the distinct ones and then looked for among
    the members of all dimensions, tagged the same way.
    """
    pairs = F.array(*[F.struct(F.lit(fk).alias("check_name"), F.col(fk).alias("k")) for fk, _, _ in lookups])
    used = fact.select(*dict.fromkeys(fk for fk, _, _ in lookups)).distinct().select(F.inline(pairs)).distinct()
    members = all_checks([dim.select(F.lit(fk).alias("check_name"), F.col(dk).alias("k")) for fk, dim, dk in lookups]).distinct()
    found = used.join(members.withColumn("_hit", F.lit(True)), ["check_name", "k"], "left")
    out = found.groupBy("check_name").agg(F.count_if(F.col("k").isNotNull() & F.col("_hit").isNull()).alias("issues"))
    return out.select(F.lit("fact").alias("table_name"), "check_name", "issues", status_of(F.col("issues")).alias("status"))


def orphans_in_one_pass(fact: DataFrame, lookups) -> DataFrame:
    """Orphan rows for all lookups by left joins and one aggregation.

    Only key columns are read.  Dimension keys are made distinct so that no
    join can multiply rows; small dimensions are broadcast by their size and
    the fact is not shuffled for them.
    """
    keys = [fk for fk, _, _ in lookups]
    out = fact.select(*dict.fromkeys(keys))
    for i, (fk, dim, dk) in enumerate(lookups):
        side = dim.select(F.col(dk).alias(f"_k{i}")).filter(F.col(f"_k{i}").isNotNull()).distinct()
        out = out.join(side, F.col(fk) == F.col(f"_k{i}"), "left")
    one = out.agg(*[F.count_if(F.col(f"_k{i}").isNull() & F.col(fk).isNotNull()).alias(fk) for i, fk in enumerate(keys)])
    return as_rows(one, "fact", keys)


def reconcile(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """Row counts of two layers per group by full outer join, with status."""
    x = a.groupBy(by).agg(F.count("*").alias("left_rows"))
    y = b.groupBy(by).agg(F.count("*").alias("right_rows"))
    out = x.join(y, by, "full").select(by, F.coalesce("left_rows", F.lit(0)).alias("left_rows"), F.coalesce("right_rows", F.lit(0)).alias("right_rows"))
    return out.withColumn("row_difference", F.col("left_rows") - F.col("right_rows")).withColumn("status", status_of(F.col("row_difference")))


def fingerprints(df: DataFrame, columns, by) -> DataFrame:
    """Rows of each part with an order-free fingerprint of the named typed columns.

    Every row is hashed with its nulls in place; the hashes of a part are added
    up and put together by exclusive or.  Equal parts have equal fingerprints in
    any order; a changed cell, a lost, doubled or exchanged row changes them, but
    for a chance of about one in ``2 ** 64``.
    """
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(h.cast("decimal(20,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


def reconcile_content(a: DataFrame, b: DataFrame, columns, by) -> DataFrame:
    """Two layers part by part: rows on both sides, and whether the values of the named columns are the same.

    Each side is read once and shrinks to one row per part before they meet.
    ``status``: PASS, ROWS DIFFER or VALUES DIFFER.
    """
    by = [by] if isinstance(by, str) else list(by)
    x = fingerprints(a, columns, by).withColumnsRenamed({"rows": "left_rows", "hash_sum": "_s1", "hash_xor": "_x1"})
    y = fingerprints(b, columns, by).withColumnsRenamed({"rows": "right_rows", "hash_sum": "_s2", "hash_xor": "_x2"} | {c: f"_b_{c}" for c in by})
    out = x.join(y, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in by], "full")
    rows = {c: F.coalesce(c, F.lit(0)) for c in ("left_rows", "right_rows")}
    out = out.withColumns(rows | {c: F.coalesce(c, f"_b_{c}") for c in by})
    same = F.col("_s1").eqNullSafe(F.col("_s2")) & F.col("_x1").eqNullSafe(F.col("_x2"))
    status = X.first_match([(F.col("left_rows") != F.col("right_rows"), "ROWS DIFFER"), (~same, "VALUES DIFFER")], "PASS")
    return out.select(*by, "left_rows", "right_rows", same.alias("same_values"), status.alias("status"))


def read_back(before: DataFrame, stored: DataFrame, by: str) -> DataFrame:
    """What was to be written against what a table holds, part by part, in rows and in the values of all columns."""
    out = reconcile_content(before, stored, sorted(set(before.columns) - {by}), by)
    return out.withColumnsRenamed({"left_rows": "expected_rows", "right_rows": "stored_rows"})


def columns_report(df: DataFrame, required) -> DataFrame:
    """Required columns: present or not, and how many rows hold a value."""
    have = set(df.columns)
    one = df.agg(*[(F.count(c) if c in have else F.lit(None).cast("long")).alias(c) for c in required], F.count("*").alias("_all"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c in have).alias("is_present"), F.col(c).alias("filled_rows")) for c in required])
    return one.select(F.inline(pairs)).withColumn("status", F.when(F.col("is_present"), "PASS").otherwise("FAIL"))


def exact_report(df: DataFrame, expected) -> DataFrame:
    """Every column of an exact list or of the frame: MISSING, EXTRA, MISPLACED among those that both have, or PASS; with its filled rows."""
    have, want = list(df.columns), list(expected)
    place = dict(zip([c for c in have if c in want], [c for c in want if c in have]))
    status = {c: "MISSING" if c not in have else "PASS" if place[c] == c else "MISPLACED" for c in want} | {c: "EXTRA" for c in have if c not in want}
    one = df.agg(*[(F.count(c) if c in have else F.lit(None).cast("long")).alias(c) for c in status])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled_rows"), F.lit(s).alias("status")) for c, s in status.items()])))


def exact_columns(df: DataFrame, expected, table: str) -> DataFrame:
    """Missing, extra and misplaced columns against an exact list, as check rows; no row is read."""
    have, want = list(df.columns), list(expected)
    counts = {"missing_columns": len(set(want) - set(have)), "extra_columns": len(set(have) - set(want)),
              "misplaced_columns": sum(a != b for a, b in zip([c for c in have if c in want], [c for c in want if c in have]))}
    return as_rows(df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in counts.items()]), table, counts)


def unique_members(df: DataFrame, keys, table: str) -> DataFrame:
    """Natural keys that several members hold, as one check row."""
    one = duplicate_keys(df, keys).agg(F.count("*").alias("duplicate_natural_keys"))
    return as_rows(one, table, ["duplicate_natural_keys"])


def column_profile(df: DataFrame, columns=None, rsd: float = 0.05) -> DataFrame:
    """Rows, nulls and approximate distinct values per column, from mergeable sketches in one pass."""
    columns = list(columns or df.columns)
    one = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(f"{c}_filled") for c in columns], *[F.approx_count_distinct(c, rsd).alias(f"{c}_distinct") for c in columns])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"{c}_filled")).alias("null_rows"),
        F.col(f"{c}_distinct").alias("approx_distinct")) for c in columns])))


def distinct_sketches(df: DataFrame, part: str, columns, lg_k: int = 12) -> DataFrame:
    """Rows, filled rows and one distinct-count sketch per column for every part of a table.

    To be stored: a part that is new needs only its own rows, and the profile of
    any set of parts follows from :func:`profile_of_sketches`.
    """
    return df.groupBy(part).agg(F.count("*").alias("rows"), *[F.count(c).alias(f"{c}_filled") for c in columns],
                                *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"{c}_sketch") for c in columns])


def profile_of_sketches(sketches: DataFrame, columns) -> DataFrame:
    """Rows, nulls and approximate distinct values per column over all parts of stored sketches."""
    one = sketches.agg(F.sum("rows").alias("_rows"), *[F.sum(f"{c}_filled").alias(f"{c}_filled") for c in columns],
                       *[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_distinct") for c in columns])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"{c}_filled")).alias("null_rows"),
        F.col(f"{c}_distinct").alias("approx_distinct")) for c in columns])))


def one_to_one(df: DataFrame, a: str, b: str) -> DataFrame:
    """Number of distinct ``b`` per ``a`` with a status."""
    return df.groupBy(a).agg(F.countDistinct(b).alias("value_count")).withColumn(
        "status", F.when(F.col("value_count") == 1, "PASS").otherwise("FAIL"))


def mapping_integrity(mapping: DataFrame, code: str, text: str, expected_rows: int | None = None) -> DataFrame:
    """Codes unique and non-blank, texts non-blank and, if given, exactly ``expected_rows`` entries; an empty mapping fails."""
    c = X.blank_to_null(F.upper(code))
    per_code = mapping.groupBy(c.alias("c")).agg(F.count("*").alias("n"), F.count_if(X.blank_to_null(text).isNull()).alias("t"))
    one = per_code.agg(F.sum("n").alias("mapping_rows"), F.count("c").alias("distinct_codes"),
                       F.coalesce(F.sum(F.when(F.col("c").isNull(), F.col("n"))), F.lit(0)).alias("missing_codes"), F.sum("t").alias("missing_texts"))
    bad = F.col("mapping_rows") - F.col("distinct_codes") + F.col("missing_texts")
    if expected_rows is not None:
        bad = bad + F.abs(F.col("mapping_rows") - expected_rows)
    one = one.withColumn("mapping_rows", F.coalesce("mapping_rows", F.lit(0)))
    bad = F.when(F.col("mapping_rows") == 0, 1).otherwise(bad)
    return one.withColumn("status", status_of(bad))


def description_reconciliation(dim: DataFrame, code: str, text: str, unknown_text: str = "UNKNOWN CALL TYPE",
                               undocumented_text: str = "UNDOCUMENTED CALL TYPE") -> DataFrame:
    """Documented, undocumented and unknown members add up, no description is missing."""
    t, is_unknown = F.col(text), F.col(code) == X.UNKNOWN
    one = dim.agg(
        F.count("*").alias("dimension_rows"), F.count_if(~t.isin(unknown_text, undocumented_text)).alias("documented_rows"),
        F.count_if(t == undocumented_text).alias("undocumented_rows"), F.count_if(t == unknown_text).alias("unknown_rows"),
        F.count_if(X.blank_to_null(t).isNull()).alias("missing_descriptions"), F.count_if(is_unknown != (t == unknown_text)).alias("invalid_unknown"))
    gap = F.col("dimension_rows") - F.col("documented_rows") - F.col("undocumented_rows") - F.col("unknown_rows")
    return one.withColumn("status", status_of(F.abs(gap) + F.col("missing_descriptions") + F.col("invalid_unknown")))


def mapping_status_checks() -> dict[str, Column]:
    status = F.col("mapping_status")
    return {
        "undocumented_defaults": (status == "Undocumented") & ((F.col("disposition_description") != "undocumented code") | (F.col("disposition_category") != "Undocumented")),
        "status_against_documented": (status == "Documented") != F.col("is_documented_code"),
        "status_against_unknown": (status == "Unknown") != F.col("is_unknown"),
    }


def codes_kept(source: DataFrame, source_code: str, dim: DataFrame, dim_code: str) -> DataFrame:
    """Distinct source codes, members, and source codes without a member."""
    codes = source.select(F.col(source_code).alias("c")).distinct()
    tagged = codes.join(dim.select(F.col(dim_code).alias("c"), F.lit(1).alias("kept")), "c", "left")
    one = tagged.agg(F.count("*").alias("source_codes"), F.count("kept").alias("dimension_codes"), F.count_if(F.col("kept").isNull()).alias("lost_codes"))
    return one.withColumn("status", status_of(F.col("lost_codes")))


def grain_unique(df: DataFrame, grain) -> DataFrame:
    """Groups of the grain that hold several rows, and the rows in excess."""
    d = duplicate_keys(df, grain).agg(F.count("*").alias("duplicate_grain_groups"), F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("duplicate_excess_rows"))
    return d.withColumn("status", status_of(F.col("duplicate_grain_groups")))


def hours_per_bucket(df: DataFrame, bucket: str = "time_of_day", hour: str = "hour_number") -> DataFrame:
    """Every part of the day holds six hours."""
    g = df.groupBy(bucket).agg(F.countDistinct(hour).alias("hours_in_bucket"))
    return g.withColumn("status", status_of(F.col("hours_in_bucket") - 6))


def calendar_complete(days: DataFrame, date: str = "full_date") -> DataFrame:
    """One row per day and no day missing between the first and the last."""
    one = days.agg(F.count(date).alias("calendar_days"), (F.date_diff(F.max(date), F.min(date)) + 1).alias("span_days"),
                   F.countDistinct(date).alias("distinct_days"))
    gap = F.abs(F.col("calendar_days") - F.col("span_days")) + F.abs(F.col("distinct_days") - F.col("span_days"))
    return one.withColumn("status", status_of(gap))


def totals_agree(daily: DataFrame, fact: DataFrame) -> DataFrame:
    """Sum of daily incidents against the number of fact rows."""
    one = daily.agg(F.sum("total_incidents").alias("daily_total")).withColumn("fact_total", fact.agg(F.count("*")).scalar())
    return one.withColumn("difference", F.col("daily_total") - F.col("fact_total")).withColumn("status", status_of(F.col("difference")))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    return all_checks([df.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t, df in tables.items()])


# --- recomputation of the daily table's derived columns ----------------------

def _off(a, b) -> Column:
    """Not null-safe equal, within the tolerance where both are present."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > TOL, F.lit(False))


def grain_checks() -> dict[str, Column]:
    return {
        "null_date": F.col("incident_date").isNull(),
        "null_borough": F.col("borough").isNull(),
        "null_severity": F.col("initial_severity_level_code").isNull(),
        "year_mismatch": F.year("incident_date") != F.col("incident_year"),
        "date_key_mismatch": X.date_key("incident_date") != F.col("date_key"),
    }


def response_count_checks() -> dict[str, Column]:
    n = F.col("total_incidents")
    v = F.col("valid_incident_response_count")
    rate = F.col("valid_response_rate")
    return {
        "non_positive_incidents": n <= 0,
        "dispatch_count_out_of_range": ~F.col("valid_dispatch_response_count").between(F.lit(0), n),
        "incident_count_out_of_range": ~v.between(F.lit(0), n),
        "travel_count_out_of_range": ~F.col("valid_travel_time_count").between(F.lit(0), n),
        "rate_out_of_range": ~rate.between(0, 1),
        "rate_mismatch": _off(rate, v / n),
        "rate_percentage_mismatch": _off("valid_response_percentage", F.round(rate * 100.0, 2)),
    }


def average_checks() -> dict[str, Column]:
    out = {}
    for s in ("dispatch_response", "incident_response", "travel_time"):
        n, avg, tot, mins = (F.col(x) for x in (f"valid_{s}_count", f"average_{s}_seconds", f"total_{s}_seconds", f"average_{s}_minutes"))
        out |= {f"{s}_null_rule": (n == 0) != avg.isNull(), f"{s}_average_mismatch": _off(avg, F.try_divide(tot, n.cast("double"))),
                f"{s}_minutes_mismatch": _off(mins, X.sec_to_min(avg))}
    return out


def statistic_checks() -> dict[str, Column]:
    lo, p50, p75, p90, p95, hi = (F.col(f"{x}_response_seconds") for x in ("minimum", "p50", "p75", "p90", "p95", "maximum"))
    avg, sd = F.col("average_incident_response_seconds"), F.col("population_stddev_response_seconds")
    return {
        "order_violation": (lo > p50) | (p50 > p75) | (p75 > p90) | (p90 > p95) | (p95 > hi),
        "mean_out_of_range": (avg < lo - TOL) | (avg > hi + TOL),
        "negative_stddev": sd < 0,
        "null_rule": (F.col("valid_incident_response_count") == 0) != sd.isNull(),
        "percentile_null_rule": reduce(lambda a, b: a | b, [(F.col("valid_incident_response_count") == 0) != x.isNull() for x in (lo, p50, p75, p90, p95, hi)]),
        "cv_mismatch": _off("response_coefficient_of_variation", X.cv_ratio(sd, avg)),
        "cv_percentage_mismatch": ~X.same("response_cv_percentage", X.cv_pct("response_coefficient_of_variation")),
    }


def minute_checks() -> dict[str, Column]:
    names = ["population_stddev_response", "minimum_response", "maximum_response"] + [f"{p}_response" for p in DY.PERCENTILES]
    return {f"{n}_minutes_mismatch": ~X.same(f"{n}_minutes", X.sec_to_min(f"{n}_seconds")) for n in names}


def operational_checks() -> dict[str, Column]:
    out = {}
    n = F.col("total_incidents")
    for f in DY.FLAGS:
        c = F.col(f"{f}_count")
        out |= {f"{f}_count_out_of_range": ~c.between(F.lit(0), n), f"{f}_rate_mismatch": _off(f"{f}_rate", c / n),
                f"{f}_percentage_mismatch": ~X.same(f"{f}_percentage", X.pct(c, n))}
    return out


def sample_checks(min_sample: int = 30, min_baseline: int = 20, window: int = 30) -> dict[str, Column]:
    v, b = F.col("valid_incident_response_count"), F.col("historical_baseline_day_count")
    status = F.when(v == 0, "NO_VALID_RESPONSE").when(v < min_sample, "LOW_SAMPLE_SIZE").otherwise("SUFFICIENT_SAMPLE")
    return {
        "sample_flag_mismatch": F.col("has_sufficient_sample") != (v >= min_sample),
        "sample_status_mismatch": F.col("analytics_quality_status") != status,
        "baseline_flag_mismatch": F.col("has_sufficient_baseline") != ((b >= min_baseline) & F.col("daily_average_stddev_seconds").isNotNull()),
        "baseline_count_out_of_range": ~b.between(0, window),
    }


def limit_checks(k: float = 3.0) -> dict[str, Column]:
    ok, c, sd = F.col("has_sufficient_baseline"), F.col("response_center_line_seconds"), F.col("daily_average_stddev_seconds")
    u, lo = F.col("upper_control_limit_seconds"), F.col("lower_control_limit_seconds")
    return {
        "upper_mismatch": _off(u, F.when(ok, c + k * sd)),
        "lower_mismatch": _off(lo, F.when(ok, X.at_least_zero(c - k * sd))),
        "negative_lower": lo < 0,
        "limits_out_of_order": (lo > c + TOL) | (c > u + TOL),
        "center_minutes_mismatch": ~X.same("response_center_line_minutes", X.sec_to_min(c)),
        "upper_minutes_mismatch": ~X.same("upper_control_limit_minutes", X.sec_to_min(u)),
        "lower_minutes_mismatch": ~X.same("lower_control_limit_minutes", X.sec_to_min(lo)),
    }


def anomaly_checks() -> dict[str, Column]:
    ok, v = F.col("has_sufficient_baseline"), F.col("average_incident_response_seconds")
    up = F.coalesce(ok & (v > F.col("upper_control_limit_seconds")), F.lit(False))
    dn = F.coalesce(ok & (v < F.col("lower_control_limit_seconds")), F.lit(False))
    a, b = F.col("is_above_upper_control_limit"), F.col("is_below_lower_control_limit")
    direction = (F.when(~ok, "Insufficient Baseline").when(up, "Above UCL").when(dn, "Below LCL").otherwise("Within Control Limits"))
    return {
        "above_flag_mismatch": F.coalesce(a, F.lit(False)) != up,
        "below_flag_mismatch": F.coalesce(b, F.lit(False)) != dn,
        "both_directions": a & b,
        "direction_mismatch": F.col("response_anomaly_direction") != direction,
        "reportable_mismatch": F.coalesce(F.col("is_reportable_response_anomaly"), F.lit(False)) != (F.col("has_sufficient_sample") & (up | dn)),
    }


def daily_checks() -> dict[str, dict[str, Column]]:
    """All recomputation checks of the daily table by theme."""
    return {"keys": grain_checks(), "response_counts": response_count_checks(), "averages": average_checks(), "statistics": statistic_checks(),
            "minutes": minute_checks(), "operations": operational_checks(), "samples": sample_checks(),
            "limits": limit_checks(), "anomalies": anomaly_checks()}


def audit_record(daily: DataFrame, fact_rows: DataFrame, run_id: str, grain=("incident_date", *DY.LIMIT_GROUP)) -> DataFrame:
    """One audit row: counts, a pass flag per theme and the overall verdict.

    ``fact_rows`` is a one-row frame with the expected incident count.  Rows are
    grouped by the grain first, so duplicates and all theme flags come out of
    one pass over the daily table.
    """
    themes = daily_checks()
    issues = {t: F.count_if(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in checks.values()])) for t, checks in themes.items()}
    per_grain = daily.groupBy(*grain).agg(
        F.count("*").alias("n"), F.sum("total_incidents").alias("incidents"), X.n_if(F.col("is_reportable_response_anomaly")).alias("reportable"),
        *[c.alias(t) for t, c in issues.items()])
    one = per_grain.agg(
        F.sum("n").alias("daily_rows"), F.sum("incidents").alias("daily_incidents"), F.sum("reportable").alias("reportable_anomalies"),
        F.count_if(F.col("n") > 1).alias("duplicate_grains"), *[(F.sum(t) == 0).alias(f"{t}_passed") for t in themes])
    out = one.withColumn("fact_incidents", fact_rows.scalar())
    out = out.withColumns({"reconciliation_passed": F.col("fact_incidents") == F.col("daily_incidents"),
                           "grain_passed": F.col("duplicate_grains") == 0})
    flags = [f"{t}_passed" for t in themes] + ["reconciliation_passed", "grain_passed"]
    ok = reduce(lambda a, b: a & b, [F.coalesce(F.col(f), F.lit(False)) for f in flags])
    return out.withColumn("validation_status", F.when(ok, "PASS").otherwise("FAIL")).withColumn("audit_run_id", F.lit(run_id))
