"""Daily performance table, rolling control limits and anomaly flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import quantiles as QT

GRAIN = ["incident_date", "borough", "initial_severity_level_code"]
LIMIT_GROUP = ["borough", "initial_severity_level_code"]
KINDS = {"dispatch": "valid_dispatch_response_seconds", "incident": "valid_incident_response_seconds",
         "travel": "valid_travel_time_seconds"}
_STEM = {"dispatch": "dispatch_response", "incident": "incident_response", "travel": "travel_time"}
PERCENTILES = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}
FLAGS = {"held_incident": "is_held", "special_event": "is_special_event", "transfer_incident": "is_transfer"}


def daily_performance(fact: DataFrame, grain=GRAIN, digest_cells: int | None = None) -> DataFrame:
    """Counts, additive totals, averages, spread, exact percentiles and flags per grain.

    Rows are first counted by grain and response seconds, so that what is
    shuffled is bounded by the different seconds and not by the incidents; all
    aggregates are plain hash aggregates.  Ranks and the spread around the mean
    follow from the counted values of one group.  ``digest_cells`` adds the
    column ``response_digest``, from which percentiles of weeks, years or areas
    are made later (:func:`beaconry.operators.quantiles.digest_percentiles`).
    Year and date key follow from the date and are added to the grouped rows.
    """
    v, n = F.col(KINDS["incident"]), F.col("_n")
    aggs = [F.count("*").alias("_n")]
    for kind, col in KINDS.items():
        if kind != "incident":
            aggs += [F.count(col).alias(f"_count_{kind}"), F.sum(col).alias(f"_sum_{kind}")]
    aggs += [X.n_if(F.col(c)).alias(f"_{f}") for f, c in FLAGS.items()]
    key = "initial_severity_level_code" in grain and "initial_severity_key" in fact.columns
    if key:
        aggs.append(F.min("initial_severity_key").alias("initial_severity_key"))
    counted = fact.groupBy(*grain, KINDS["incident"]).agg(*aggs)
    one = Window.partitionBy(*grain)
    valid = F.when(v.isNotNull(), n).otherwise(0)
    counted = counted.withColumns({"_valid": F.sum(valid).over(one), "_end": F.sum(valid).over(one.orderBy(v)), "_seconds": F.sum(v * n).over(one)})
    mean = F.try_divide(F.col("_seconds"), F.col("_valid"))
    out = [F.sum("_n").alias("total_incidents")]
    for kind in KINDS:
        s = _STEM[kind]
        count, total = (F.max("_valid"), F.max("_seconds")) if kind == "incident" else (F.sum(f"_count_{kind}"), F.sum(f"_sum_{kind}"))
        out += [count.alias(f"valid_{s}_count"), total.alias(f"total_{s}_seconds"), F.try_divide(total, count).alias(f"average_{s}_seconds")]
    out += [F.sqrt(F.try_divide(F.sum(n * (v - mean) ** 2), F.max("_valid"))).alias("population_stddev_response_seconds"),
            F.min(v).alias("minimum_response_seconds"), F.max(v).alias("maximum_response_seconds")]
    reached = {p: v.isNotNull() & (F.col("_end") >= QT.rank_of(share, F.col("_valid"))) for p, share in PERCENTILES.items()}
    out += [F.min(F.when(at, v)).alias(f"{p}_response_seconds") for p, at in reached.items()]
    out += [F.sum(f"_{f}").alias(f"{f}_count") for f in FLAGS]
    if key:
        out.append(F.min("initial_severity_key").alias("initial_severity_key"))
    daily = counted.groupBy(*grain).agg(*out)
    if digest_cells:
        parts = QT.digests(counted.filter(v.isNotNull()).select(*grain, v, "_n"), grain, KINDS["incident"], "_n", digest_cells, "response_digest")
        daily = daily.alias("d").join(parts.alias("p"), [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in grain], "left").select("d.*", "p.response_digest")
    if "initial_severity_level_code" in grain:
        daily = daily.withColumn("initial_severity_label", X.severity_label("initial_severity_level_code"))
    if "incident_date" in grain:
        daily = daily.withColumns({"incident_year": F.year("incident_date"), "date_key": X.date_key("incident_date")})
    return daily


def response_rate(df: DataFrame) -> DataFrame:
    r = F.when(F.col("total_incidents") > 0, F.col("valid_incident_response_count") / F.col("total_incidents"))
    return df.withColumn("valid_response_rate", r).withColumn(
        "valid_response_percentage", F.round(F.col("valid_response_rate") * 100.0, 2))


MINUTES = [f"average_{s}" for s in _STEM.values()] + ["population_stddev_response"] + \
          [f"{p}_response" for p in PERCENTILES] + ["minimum_response", "maximum_response"]


def derived_metrics(daily: DataFrame) -> DataFrame:
    """Minutes, coefficient of variation, operational rates and percentages."""
    out = response_rate(daily)
    out = out.withColumns({f"{m}_minutes": X.sec_to_min(f"{m}_seconds") for m in MINUTES})
    out = out.withColumn("response_coefficient_of_variation",
                         X.cv_ratio("population_stddev_response_seconds", "average_incident_response_seconds"))
    out = out.withColumn("response_cv_percentage", X.cv_pct("response_coefficient_of_variation"))
    return out.withColumns({f"{n}_rate": F.when(F.col("total_incidents") > 0, F.col(f"{n}_count") / F.col("total_incidents")) for n in FLAGS}
                           | {f"{n}_percentage": X.pct(f"{n}_count", "total_incidents") for n in FLAGS})


def sample_quality(daily: DataFrame, n: str = "valid_incident_response_count", min_sample: int = 30) -> DataFrame:
    """Enough-sample flag and a three-way status."""
    return daily.withColumns({
        "has_sufficient_sample": F.col(n) >= min_sample,
        "analytics_quality_status": F.when(F.col(n) == 0, "NO_VALID_RESPONSE").when(F.col(n) < min_sample, "LOW_SAMPLE_SIZE")
        .otherwise("SUFFICIENT_SAMPLE"),
    })


def trailing_baseline(daily: DataFrame, group, order: str, value: str, window: int = 30) -> DataFrame:
    """Count, mean and population sd over the previous ``window`` rows of the group.

    The frame excludes the current row and counts rows, not calendar days; rows
    without enough samples stay in the frame but contribute no value.  The
    window runs on daily rows, at most one per day and group.
    """
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(-window, -1)
    eligible = F.when(F.col("has_sufficient_sample"), F.col(value))
    return daily.withColumns({
        "historical_baseline_day_count": F.count(eligible).over(w),
        "response_center_line_seconds": F.avg(eligible).over(w),
        "daily_average_stddev_seconds": F.stddev_pop(eligible).over(w),
    })


def limit_columns(daily: DataFrame, min_baseline: int = 20, k: float = 3.0, warn_k: float = 2.0) -> DataFrame:
    """Control limits at k sigma and warning limits, once the baseline is long enough."""
    centre, sd = F.col("response_center_line_seconds"), F.col("daily_average_stddev_seconds")
    ok = F.col("has_sufficient_baseline")
    return (daily.withColumn("has_sufficient_baseline", (F.col("historical_baseline_day_count") >= min_baseline) & sd.isNotNull())
            .withColumns({
                "upper_control_limit_seconds": F.when(ok, centre + k * sd),
                "lower_control_limit_seconds": F.when(ok, X.at_least_zero(centre - k * sd)),
                "upper_warning_limit_seconds": F.when(ok, centre + warn_k * sd),
                "lower_warning_limit_seconds": F.when(ok, X.at_least_zero(centre - warn_k * sd)),
            }))


def anomaly_flags(daily: DataFrame, value: str = "average_incident_response_seconds") -> DataFrame:
    """Above/below flags, direction text and the reportable flag."""
    v, ok = F.col(value), F.col("has_sufficient_baseline")
    above = F.when(ok, v > F.col("upper_control_limit_seconds")).otherwise(False)
    below = F.when(ok, v < F.col("lower_control_limit_seconds")).otherwise(False)
    out = daily.withColumns({"is_above_upper_control_limit": above, "is_below_lower_control_limit": below})
    a, b = F.col("is_above_upper_control_limit"), F.col("is_below_lower_control_limit")
    return out.withColumns({
        "is_response_anomaly": a | b,
        "response_anomaly_direction": X.first_match([
            (~ok, "Insufficient Baseline"), (a, "Above UCL"), (b, "Below LCL")], "Within Control Limits"),
        "is_reportable_response_anomaly": F.col("has_sufficient_sample") & ok & (a | b),
    })


def kpi_status(value, lower, upper, lower_warn, upper_warn) -> Column:
    """Normal, Warning (outside 2 sigma) or Out of Control (outside 3 sigma)."""
    v = F.col(value) if isinstance(value, str) else value
    return X.first_match([
        ((v > upper) | (v < lower), "Out of Control"),
        ((v > upper_warn) | (v < lower_warn), "Warning"),
        ((v <= upper_warn) & (v >= lower_warn), "Normal")])


def control_limits(daily: DataFrame, group, order: str = "incident_date", value: str = "average_incident_response_seconds",
                   window: int = 30, min_sample: int = 30, min_baseline: int = 20, k: float = 3.0) -> DataFrame:
    """Sample status, trailing baseline, limits, flags and limits in minutes."""
    out = sample_quality(daily, min_sample=min_sample)
    out = trailing_baseline(out, group, order, value, window)
    out = anomaly_flags(limit_columns(out, min_baseline, k), value)
    names = ["response_center_line", "upper_control_limit", "lower_control_limit"]
    return out.withColumns({f"{n}_minutes": X.sec_to_min(f"{n}_seconds") for n in names})


def daily_table(fact: DataFrame, grain=GRAIN, group=LIMIT_GROUP, **limits) -> DataFrame:
    """The complete daily table; limits follow each ``group`` through the days."""
    return control_limits(derived_metrics(daily_performance(fact, grain)), group, **limits)


def _limit_columns(k: float, warn_k: float) -> dict[str, Column]:
    c, sd, enough = F.col("center_line"), F.col("sd"), F.col("days") >= 2
    return {"upper_control_limit": F.when(enough, c + k * sd), "lower_control_limit": F.when(enough, X.at_least_zero(c - k * sd)),
            "upper_warning_limit": F.when(enough, c + warn_k * sd), "lower_warning_limit": F.when(enough, X.at_least_zero(c - warn_k * sd))}


def period_limits(daily: DataFrame, value: str, k: float = 3.0, warn_k: float = 2.0) -> DataFrame:
    """Control limits of a selected period: mean of daily values +- k sd.

    Limits need at least two days; the lower ones stop at zero.
    """
    s = daily.agg(F.count(value).alias("days"), F.avg(value).alias("center_line"), F.stddev_pop(value).alias("sd"))
    return s.withColumns(_limit_columns(k, warn_k))


def control_chart(daily: DataFrame, value: str, k: float = 3.0, warn_k: float = 2.0) -> DataFrame:
    """The daily series with the limits of the whole period on every row."""
    w = Window.partitionBy()
    s = daily.withColumns({"days": F.count(value).over(w), "center_line": F.avg(value).over(w), "sd": F.stddev_pop(value).over(w)})
    return s.withColumns(_limit_columns(k, warn_k))
