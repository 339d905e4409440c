"""Operators on small frames where the answer is known."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from beaconry.operators import analysis as AN
from beaconry.functions import exprs as X
from beaconry.operators import daily as DY
from beaconry.operators import dims as D
from beaconry.operators import forecast as FO
from beaconry.operators import measures as M
from beaconry.operators import quality as QC
from beaconry.operators import quantiles as QT


def test_dense_key_is_the_same_at_scale(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.randint(0, 10_000)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a string, b int").distinct()
    small = D.with_surrogate_key(df, ["a", "b"], "key")
    large = D.with_surrogate_key(df, ["a", "b"], "key")
    want = [(k, *v) for k, v in enumerate(sorted(set(rows)), start=1)]
    for got in (small, large):
        assert sorted(tuple(r) for r in got.select("key", "a", "b").collect()) == want


def test_roles_by_scan_and_by_union_agree(spark):
    df = spark.createDataFrame([("A", "B"), ("B", "B"), ("C", "A")], "i string, f string")
    one = D.role_dim(df, {"initial": F.col("i"), "final": F.col("f")}, "code")
    two = D.union_roles({"initial": df.select(F.col("i").alias("code")), "final": df.select(F.col("f").alias("code"))}, "code")
    want = [("A", True, True), ("B", True, True), ("C", True, False)]
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) == want


def test_unknown_and_undocumented_stay_apart(spark):
    dim = spark.createDataFrame([("X",), ("UNKNOWN",), ("Y",)], "code string")
    mapping = spark.createDataFrame([("X", "ex")], "code string, text string")
    got = {r["code"]: r["text"] for r in D.describe_codes(dim, mapping, "code", "text").collect()}
    assert got == {"X": "ex", "UNKNOWN": "UNKNOWN CALL TYPE", "Y": "UNDOCUMENTED CALL TYPE"}


def test_ranks_with_ties(spark):
    g = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1)], "k string, total_incidents int")
    gaps = {r["k"]: r["rank"] for r in AN.rank_within(g, "total_incidents").collect()}
    dense = {r["k"]: r["rank"] for r in AN.rank_within(g, "total_incidents", dense=True).collect()}
    assert gaps == {"a": 1, "b": 1, "c": 3} and dense == {"a": 1, "b": 1, "c": 2}


def test_pooled_sd_equals_sd_of_the_union(spark):
    rng = random.Random(1)
    rows = [("g", d, float(rng.randint(1, 500))) for d in range(5) for _ in range(rng.randint(1, 40))] + [("g", 9, None)]
    df = spark.createDataFrame(rows, "g string, d int, v double")
    daily = df.groupBy("g", "d").agg(
        F.count("*").alias("total_incidents"), F.count("v").alias("valid_incident_response_count"), F.sum("v").alias("total_incident_response_seconds"),
        F.avg("v").alias("average_incident_response_seconds"), F.stddev_pop("v").alias("population_stddev_response_seconds"))
    got = AN.pooled_stats(daily, ["g"]).first()
    want = df.agg(F.avg("v"), F.stddev_pop("v")).first()
    assert math.isclose(got["average_response_seconds"], want[0]) and math.isclose(got["pooled_stddev_seconds"], want[1], rel_tol=1e-9)


def _days(spark):
    """35 days: day 10 has too few samples, day 33 spikes, a second group is constant."""
    rows = []
    for i in range(35):
        d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        rows.append(("a", 1, d, 10 if i == 10 else 40, 500.0 if i == 33 else 100.0 + (i % 5)))
        rows.append(("b", 1, d, 40, 60.0))
    return spark.createDataFrame(rows, "borough string, initial_severity_level_code int, incident_date date, valid_incident_response_count int, average_incident_response_seconds double")


def test_trailing_window_brute_force(spark):
    df = _days(spark)
    out = DY.control_limits(df, DY.LIMIT_GROUP)
    got = {(r["borough"], r["incident_date"]): r for r in out.collect()}
    for g in "ab":
        rows = sorted((r for r in df.collect() if r["borough"] == g), key=lambda r: r["incident_date"])
        for i, r in enumerate(rows):
            base = [x["average_incident_response_seconds"] for x in rows[max(0, i - 30):i] if x["valid_incident_response_count"] >= 30]
            o = got[g, r["incident_date"]]
            assert o["historical_baseline_day_count"] == len(base)
            if not base:
                assert o["response_center_line_seconds"] is None and o["response_anomaly_direction"] == "Insufficient Baseline"
                continue
            mean = sum(base) / len(base)
            sd = math.sqrt(sum((x - mean) ** 2 for x in base) / len(base))
            assert math.isclose(o["response_center_line_seconds"], mean, rel_tol=1e-9)
            assert o["has_sufficient_baseline"] == (len(base) >= 20)
            if len(base) >= 20:
                assert math.isclose(o["upper_control_limit_seconds"], mean + 3 * sd, rel_tol=1e-6)
                assert o["lower_control_limit_seconds"] >= 0
    spike = got["a", dt.date(2024, 2, 3)]
    assert spike["response_anomaly_direction"] == "Above UCL" and spike["is_reportable_response_anomaly"]
    assert all(r["response_anomaly_direction"] in ("Insufficient Baseline", "Within Control Limits") for (g, _), r in got.items() if g == "b")


def test_held_null_is_not_held_only_in_one_reading(spark):
    df = spark.createDataFrame([(True, 60.0), (False, 120.0), (None, 600.0)], f"is_held boolean, {M.RESP} double")
    m = df.agg(M.mean_minutes(M.RESP, F.col("is_held")).alias("h"), M.mean_minutes(M.RESP, ~F.col("is_held")).alias("f")).first()
    assert (m["h"], m["f"]) == (1.0, 2.0)
    sql = df.groupBy(F.when(F.col("is_held"), "Held").otherwise("Not Held").alias("s")).agg(F.avg(M.RESP).alias("m"))
    assert {r["s"]: r["m"] for r in sql.collect()} == {"Held": 60.0, "Not Held": 360.0}


def test_previous_year_does_not_bridge_gaps(spark):
    g = spark.createDataFrame([(2019, 10), (2020, 12), (2022, 6)], "y int, total_incidents int")
    got = {r["y"]: r["previous_year"] for r in M.previous_year(g, "y").collect()}
    assert got == {2019: None, 2020: 10, 2022: None}


def test_exact_percentiles_interpolate(spark):
    df = spark.createDataFrame([("g", float(i)) for i in list(range(1, 26)) * 3] + [("g", None)], "g string, v double")
    want = df.groupBy("g").agg(F.percentile("v", 0.9)).first()[1]
    assert QT.percentiles(df, ["g"], "v", {"p": 0.9}).first()["p"] == want


def test_busy_and_slow_rules(spark):
    g = spark.createDataFrame([("a", 10, 5.0), ("b", 30, 9.0), ("c", 20, 9.5), ("d", 40, 1.0)], "k string, total_incidents int, average_response_seconds double")
    flag = lambda rule: {r["k"] for r in AN.high_demand_slow(g, "f", rule).filter("f = 1").collect()}
    assert flag("mean") == {"b"}          # mean demand 25, mean response 6.125
    assert flag("p75") == set()           # 75th percentile 32.5 is reached by d only, which is fast


def test_forecast_recovers_trend_and_season(spark):
    season = [5, -3, 2, 0, -4, 1, 3, -2, 4, -1, -3, -2]
    # A season orthogonal to the trend within each year is not needed: the fit is checked on its own residuals.
    rows = [(24240 + t, 100.0 + 2 * t) for t in range(24)]
    flat = FO.forecast(spark.createDataFrame(rows, "m int, y double")).orderBy("h").collect()
    assert [round(r["forecast"], 6) for r in flat] == [100.0 + 2 * t for t in range(24, 36)]
    assert all(abs(r["upper"] - r["lower"]) < 1e-4 for r in flat)
    noisy = spark.createDataFrame([("s", m, y + season[m % 12]) for m, y in rows], "seg string, m int, y double")
    out = FO.forecast(noisy, ["seg"])
    err = FO.forecast_error(noisy, out, ["seg"])
    assert out.count() == 12 and err.count() == 0
    same = FO.forecast_error(out.select("seg", "m", F.col("forecast").alias("y")), out, ["seg"]).first()
    assert (same["months"], same["mae"], same["rmse"], same["mape"]) == (12, 0.0, 0.0, 0.0)


def test_monthly_counts_fill_gaps(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 5)), ("a", dt.date(2020, 4, 1)), ("b", dt.date(2020, 2, 1))], "s string, d date")
    got = sorted(map(tuple, FO.monthly_counts(df, "d", ["s"]).collect()))
    m = 2020 * 12
    assert got == [("a", m, 1), ("a", m + 1, 0), ("a", m + 2, 0), ("a", m + 3, 1), ("b", m, 0), ("b", m + 1, 1), ("b", m + 2, 0), ("b", m + 3, 0)]


def test_planted_key_faults_are_counted(spark):
    fact = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (None, 3), (9, 3)], "k int, id int")
    dim = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    p = QC.key_profile(fact, "k", "t").first()
    assert (p["total_rows"], p["distinct_keys"], p["missing_keys"], p["duplicate_rows"], p["status"]) == (5, 3, 1, 1, "FAIL")
    assert QC.orphan_keys(fact, "k", dim, "k").collect()[0]["k"] == 9
    assert [(r["check_name"], r["issues"]) for r in QC.count_orphaned_keys(fact, [("k", dim, "k")]).collect()] == [("k", 1)]
    assert [r["issues"] for r in QC.orphans_in_one_pass(fact, [("k", dim, "k")]).collect()] == [1]
    assert QC.key_profile(fact.filter("k > 99"), "k", "empty").first()["status"] == "FAIL"
    rec = {r["id"]: r["row_difference"] for r in QC.reconcile(fact, fact.filter("k IS NOT NULL"), "id").collect()}
    assert rec == {1: 0, 2: 0, 3: 1}


def test_limits_of_a_period_need_two_days(spark):
    one = DY.period_limits(spark.createDataFrame([(5.0,)], "v double"), "v").first()
    assert one["upper_control_limit"] is None and one["center_line"] == 5.0
    two = DY.period_limits(spark.createDataFrame([(1.0,), (9.0,)], "v double"), "v").first()
    assert (two["upper_control_limit"], two["lower_control_limit"]) == (17.0, 0.0)


def test_later_data_moves_the_forecast_origin(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(n) for n in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for last, origin in ((dt.date(2021, 6, 30), (2021, 7)), (dt.date(2021, 7, 30), (2021, 7)), (dt.date(2022, 1, 31), (2022, 2))):
        monthly = FO.monthly_counts(df.filter(F.col("d") <= last), "d", complete=True)
        first = FO.forecast(monthly).filter("h = 1").first()
        assert (first["year"], first["month"]) == origin
    months = [r["m"] for r in FO.without_last(monthly, 3).collect()]
    assert max(months) == 2021 * 12 + 9


def test_whole_numbers_keep_their_digits_and_nan_is_no_measure(spark):
    df = spark.createDataFrame([("9007199254740993",), ("2.0",), ("NaN",), ("Infinity",), ("x",), ("-3",)], "t string")
    rows = df.select(X.convert("t", "long").alias("l"), X.to_double("t").alias("d"), X.valid_measure(F.col("t").try_cast("double")).alias("v")).collect()
    assert [r["l"] for r in rows] == [9007199254740993, 2, None, None, None, -3]
    assert [r["d"] for r in rows][1:] == [2.0, None, None, None, -3.0]
    assert [r["v"] for r in rows][1:] == [2.0, None, None, None, None]
