"""Seasonal forecast of monthly series, per segment, and its error.

Two explicit methods.  The first is a least-squares trend on the month number,
the mean residual of each calendar month as the seasonal part, and a normal band
whose width grows with the horizon.  The second is exponential smoothing of
level, trend and season, with weights chosen by the error on held-out months.
All segments are fitted in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Normal quantiles for the common confidence levels.
Z = {0.80: 1.281552, 0.90: 1.644854, 0.95: 1.959964, 0.99: 2.575829}


def month_index(date) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    d = F.col(date) if isinstance(date, str) else date
    return F.year(d) * 12 + F.month(d) - 1


def last_complete(latest: Column) -> Column:
    """Index of the last month that the latest date ends: its own on the last day of a month, else the one before."""
    return month_index(latest) - F.when(latest == F.last_day(latest), 0).otherwise(1)


def monthly_counts(df: DataFrame, date: str, segment=(), complete: bool = False) -> DataFrame:
    """Rows per month and segment with empty months filled by zero.

    Months run from the first to the last month of the whole series, with
    ``complete`` to the last one that the dates cover to its end.
    After the one aggregation only months are left, so a segment's counts travel
    as a small map and the gaps are filled without reading the rows again; the
    ends of the series are taken over one row for each segment.
    """
    g = df.groupBy(*segment, month_index(date).alias("m")).agg(F.count("*").alias("y"), F.max(F.to_date(date)).alias("latest"))
    per_segment = g.groupBy(*segment).agg(F.map_from_entries(F.collect_list(F.struct("m", "y"))).alias("seen"),
                                          F.min("m").alias("first"), F.max("latest").alias("latest"))
    every, end = Window.partitionBy(), last_complete if complete else month_index
    per_segment = per_segment.withColumns({"lo": F.min("first").over(every), "hi": end(F.max("latest").over(every))})
    months = per_segment.where("lo <= hi").select(*segment, "seen", F.explode(F.sequence("lo", "hi")).alias("m"))
    return months.select(*segment, "m", F.coalesce(F.try_element_at("seen", F.col("m")), F.lit(0)).alias("y"))


def monthly_means(df: DataFrame, date: str, value: str, segment=(), complete: bool = False) -> DataFrame:
    """Mean of the non-null values per month, from additive sums and counts; a month without values has no row."""
    g = df.groupBy(*segment, month_index(date).alias("m")).agg(F.sum(value).alias("s"), F.count(value).alias("n"), F.max(F.to_date(date)).alias("latest"))
    g = g.withColumn("hi", (last_complete if complete else month_index)(F.max("latest").over(Window.partitionBy())))
    return g.filter((F.col("n") > 0) & (F.col("m") <= F.col("hi"))).select(*segment, "m", (F.col("s") / F.col("n")).alias("y"))


def without_last(monthly: DataFrame, months: int) -> DataFrame:
    """The series without its last ``months`` months, to hold them out."""
    return monthly.filter(F.col("m") <= monthly.agg(F.max("m") - months).scalar())


def decompose(monthly: DataFrame, segment=(), season: int = 12) -> DataFrame:
    """Monthly rows with trend (``slope``, ``intercept``), ``seasonal`` part and ``rest``.

    The trend is a least-squares line per segment, the seasonal part the mean
    deviation of each calendar month.  All of it is windows over months.
    """
    w = Window.partitionBy(*segment)
    y, m = F.col("y").cast("double"), F.col("m").cast("double")
    out = monthly.withColumns({"slope": F.regr_slope(y, m).over(w), "intercept": F.regr_intercept(y, m).over(w), "phase": F.col("m") % season})
    out = out.withColumn("deviation", y - (F.col("intercept") + F.col("slope") * F.col("m")))
    out = out.withColumn("seasonal", F.avg("deviation").over(Window.partitionBy(*segment, "phase")))
    return out.withColumn("rest", F.col("deviation") - F.col("seasonal"))


def forecast(monthly: DataFrame, segment=(), horizon: int = 12, season: int = 12, level: float = 0.95) -> DataFrame:
    """Point forecast and band for the next ``horizon`` months of each segment.

    The band is ``z * sd * sqrt(1 + h / n)`` around the point forecast, with the
    population sd of what trend and season leave unexplained.
    """
    seg = list(segment)
    fit = decompose(monthly, seg, season).groupBy(*seg).agg(
        F.any_value("slope").alias("slope"), F.any_value("intercept").alias("intercept"), F.count("*").alias("n"), F.max("m").alias("last_m"),
        F.sqrt(F.avg(F.col("rest") * F.col("rest"))).alias("sd"),
        F.map_from_entries(F.collect_set(F.struct("phase", "seasonal"))).alias("seasons"))
    ahead = fit.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("m", F.col("last_m") + F.col("h"))
    point = (F.col("intercept") + F.col("slope") * F.col("m")
             + F.coalesce(F.try_element_at("seasons", F.col("m") % season), F.lit(0.0)))
    half = Z[level] * F.col("sd") * F.sqrt(1 + F.col("h") / F.col("n"))
    return ahead.select(*seg, "h", F.floor(F.col("m") / 12).cast("int").alias("year"), (F.col("m") % 12 + 1).cast("int").alias("month"),
                        "m", point.alias("forecast"), (point - half).alias("lower"), (point + half).alias("upper"))


def forecast_error(actual: DataFrame, predicted: DataFrame, segment=()) -> DataFrame:
    """MAE, RMSE and MAPE of a forecast on months that have an actual value."""
    seg = list(segment)
    e = actual.join(predicted.select(*seg, "m", "forecast"), [*seg, "m"]).withColumn("e", F.col("y") - F.col("forecast"))
    return e.groupBy(*seg).agg(
        F.count("*").alias("months"), F.avg(F.abs("e")).alias("mae"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        F.avg(F.abs(F.try_divide(F.col("e"), F.col("y"))) * 100.0).alias("mape"))


#: The weights of level, trend and season that are tried, each with each.
WEIGHTS = (0.1, 0.3, 0.5)


def _smoothed(y: Column, alpha: Column, beta: Column, gamma: Column, season: int) -> Column:
    """Level, trend and season after a series, month by month as a fold over the array ``y``.

    The first season gives the start: its mean the level, the rise to the mean of
    the second one the trend, and its deviations the season.
    """
    def mean(first: int) -> Column:
        return F.aggregate(F.slice(y, first + 1, season), F.lit(0.0), lambda s, x: s + x) / season

    start = F.struct(mean(0).alias("level"), ((mean(season) - mean(0)) / season).alias("trend"),
                     F.transform(F.slice(y, 1, season), lambda x: x - mean(0)).alias("season"), F.lit(0).alias("at"))

    def step(state: Column, x: Column) -> Column:
        now = F.get(state["season"], state["at"])
        level = alpha * (x - now) + (1 - alpha) * (state["level"] + state["trend"])
        trend = beta * (level - state["level"]) + (1 - beta) * state["trend"]
        seasons = F.transform(state["season"], lambda s, i: F.when(i == state["at"], gamma * (x - level) + (1 - gamma) * s).otherwise(s))
        return F.struct(level.alias("level"), trend.alias("trend"), seasons.alias("season"), ((state["at"] + 1) % season).cast("int").alias("at"))

    return F.aggregate(F.slice(y, season + 1, F.greatest(F.size(y) - season, F.lit(0))), start, step)


def _ahead(state: Column, h: Column, season: int) -> Column:
    return state["level"] + state["trend"] * h + F.get(state["season"], (state["at"] + h - 1) % season)


def smoothing_forecast(monthly: DataFrame, segment=(), horizon: int = 12, season: int = 12, held_out: int = 12, weights=WEIGHTS) -> DataFrame:
    """Forecast of each segment by additive exponential smoothing, with the chosen weights and their error.

    Every combination of ``weights`` is fitted without the last ``held_out``
    months and judged by the root of the mean squared error on them; the best
    one, the smaller weights of equals, is then fitted to all months.  A segment
    needs two seasons besides the held-out months.  The months of a segment are
    few and travel as one array; combinations and segments run in parallel.
    """
    seg = list(segment)
    series = (monthly.groupBy(*seg).agg(F.sort_array(F.collect_list(F.struct("m", F.col("y").cast("double").alias("y")))).alias("_s"))
              .select(*seg, F.transform("_s", lambda x: x["y"]).alias("_y"), F.element_at("_s", -1)["m"].alias("_last"))
              .filter(F.size("_y") >= 2 * season + held_out))
    grid = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(c).alias("gamma")) for a in weights for b in weights for c in weights])
    tried = series.select("*", F.explode(grid).alias("_w"))
    y, w = F.col("_y"), [F.col(f"_w.{n}") for n in ("alpha", "beta", "gamma")]
    tried = tried.withColumn("_known", _smoothed(F.slice(y, 1, F.size(y) - held_out), *w, season))
    misses = F.transform(F.sequence(F.lit(1), F.lit(held_out)), lambda h: F.pow(
        F.get(y, F.size(y) - held_out + h - 1) - _ahead(F.col("_known"), h, season), F.lit(2.0)))
    tried = tried.withColumn("_rmse", F.sqrt(F.aggregate(misses, F.lit(0.0), lambda s, x: s + x) / held_out))
    best = tried.groupBy(*seg, "_y", "_last").agg(F.min(F.struct(F.round("_rmse", 6).alias("e"), "_w", "_rmse")).alias("_b"))
    best = best.select(*seg, "_y", "_last", F.col("_b._w").alias("_w"), F.col("_b._rmse").alias("_rmse"))
    fitted = best.withColumn("_state", _smoothed(y, *w, season))
    out = fitted.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_h")).withColumn("_m", F.col("_last") + F.col("_h"))
    return out.select(*seg, *w, F.col("_rmse").alias("held_out_rmse"), F.col("_h").alias("h"), F.floor(F.col("_m") / 12).cast("int").alias("year"),
                      (F.col("_m") % 12 + 1).cast("int").alias("month"), F.col("_m").alias("m"), _ahead(F.col("_state"), F.col("_h"), season).alias("forecast"))
