"""Carried tails, marks, stable keys, sketches and smoothing against whole computations."""

import random

import pytest
from pyspark.sql import functions as F

from beaconry.operators import daily as DY
from beaconry.operators import dims as D
from beaconry.operators import forecast as FO
from beaconry.operators import incremental as INC
from beaconry.operators import measures as M
from beaconry.operators import quality as QC

DAYS = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in range(1, 29)]


@pytest.fixture(scope="module")
def incidents(spark):
    rng = random.Random(3)
    data = [(rng.choice(DAYS), rng.choice(["A", "A", "A", "B"]), 1, float(rng.randrange(60, 900)), bool(i % 5 == 0)) for i in range(9000)]
    cols = "d string, borough string, initial_severity_level_code int, valid_incident_response_seconds double, is_held boolean"
    df = spark.createDataFrame(data, cols)
    return df.select(F.to_date("d").alias("incident_date"), "borough", "initial_severity_level_code", "valid_incident_response_seconds",
                     (F.col("valid_incident_response_seconds") / 3).alias("valid_dispatch_response_seconds"), (F.col("valid_incident_response_seconds") / 2).alias("valid_travel_time_seconds"),
                     "is_held", F.lit(False).alias("is_special_event"), F.lit(None).cast("boolean").alias("is_transfer"), F.monotonically_increasing_id().alias("id"))


def comparable(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("window", [5, 30])
def test_a_carried_tail_gives_the_full_window(spark, incidents, window):
    base = DY.sample_quality(DY.derived_metrics(DY.daily_performance(incidents)), min_sample=10)
    full = DY.trailing_baseline(base, DY.LIMIT_GROUP, "incident_date", "average_incident_response_seconds", window)
    cut = F.lit("2024-02-10").cast("date")
    tail = INC.tail_state(base, DY.LIMIT_GROUP, "incident_date", window, F.col("incident_date") < cut)
    assert tail.groupBy(*DY.LIMIT_GROUP).count().agg(F.max("count")).first()[0] <= window
    got = INC.trailing_baseline(tail, base.filter(F.col("incident_date") >= cut), DY.LIMIT_GROUP, "incident_date", "average_incident_response_seconds", window)
    assert comparable(got) == comparable(full.filter(F.col("incident_date") >= cut))


@pytest.mark.parametrize("arrived", ["incident_date >= '2024-03-10'", "incident_date = '2024-02-03' AND borough = 'B'", "id % 977 = 5"])
def test_an_updated_daily_table_equals_a_full_one(spark, incidents, arrived):
    """New days at the end, more rows of one old day, and late rows all over."""
    full = DY.daily_table(incidents, min_sample=10)
    old = DY.daily_table(incidents.filter(f"NOT ({arrived})"), min_sample=10)
    changed = INC.updated_daily(old, incidents, incidents.filter(arrived), min_sample=10)
    assert comparable(changed) == comparable(full)  # all rows lie in one year, which is written whole


def test_marks_find_what_is_new(spark):
    stored = spark.createDataFrame([(2023, 5), (2023, 9), (2024, 2)], "y int, t int")
    marks = INC.high_water(stored, "y", "t")
    assert sorted(map(tuple, marks.collect())) == [(2023, 9, 2), (2024, 2, 1)]
    source = spark.createDataFrame([(2023, 9), (2023, 10), (2024, 1), (2024, 3), (2025, 0), (None, 1)], "y int, t int")
    assert sorted(map(tuple, INC.after_marks(source, marks, "y", "t").collect()), key=repr) == sorted([(2023, 10), (2024, 3), (2025, 0), (None, 1)], key=repr)


def test_keys_stay_over_loads(spark):
    first = D.extend_keys(None, spark.createDataFrame([("b",), ("d",), ("b",)], "c string"), ["c"], "k")
    assert {r["c"]: r["k"] for r in first.collect()} == {"b": 1, "d": 2}
    second = D.extend_keys(first, spark.createDataFrame([("a",), ("d",), ("c",), (None,)], "c string"), ["c"], "k")
    assert {r["c"]: r["k"] for r in second.collect()} == {"b": 1, "d": 2, None: 3, "a": 4, "c": 5}
    third = D.extend_keys(second, spark.createDataFrame([(None,), ("e",)], "c string"), ["c"], "k")
    assert {r["c"]: r["k"] for r in third.collect()} == {"b": 1, "d": 2, None: 3, "a": 4, "c": 5, "e": 6}
    assert D.keyed(spark.createDataFrame([(None,), ("e",)], "c string"), third, ["c"], "k").agg(F.sum("k")).first()[0] == 9


def test_sketches_of_parts_give_the_profile_of_all(spark):
    df = spark.range(20_000).selectExpr("id % 7 AS y", "id % 5000 AS a", "IF(id % 4 = 0, NULL, id) AS b")
    parts = QC.distinct_sketches(df, "y", ["a", "b"])
    assert parts.count() == 7
    got = {r["column_name"]: r for r in QC.profile_of_sketches(parts, ["a", "b"]).collect()}
    assert (got["a"]["row_count"], got["a"]["null_rows"], got["b"]["null_rows"]) == (20_000, 0, 5000)
    assert abs(got["a"]["approx_distinct"] - 5000) < 300 and abs(got["b"]["approx_distinct"] - 15_000) < 900
    some = {r["column_name"]: r for r in QC.profile_of_sketches(parts.filter("y < 2"), ["a"]).collect()}
    assert some["a"]["row_count"] == df.filter("y < 2").count()


def plain_smoothing(y, a, b, g, season=12):
    level = sum(y[:season]) / season
    trend = (sum(y[season:2 * season]) / season - level) / season
    seasons = [v - level for v in y[:season]]
    for i, v in enumerate(y[season:], season):
        now = seasons[i % season]
        new = a * (v - now) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        seasons[i % season] = g * (v - new) + (1 - g) * now
        level = new
    return [level + trend * h + seasons[(len(y) + h - 1) % season] for h in range(1, 13)]


def test_smoothing_equals_a_plain_loop(spark):
    rng = random.Random(6)
    data = {s: [200 + 3 * t + 40 * ((t * 5) % 12) + rng.randrange(30) for t in range(60)] for s in ("x", "y")}
    rows = [(s, 24000 + t, float(v)) for s, vs in data.items() for t, v in enumerate(vs)]
    got = {(r["s"], r["h"]): r for r in FO.smoothing_forecast(spark.createDataFrame(rows, "s string, m int, y double"), ["s"]).collect()}
    for s, y in data.items():
        tried = []
        for a in FO.WEIGHTS:
            for b in FO.WEIGHTS:
                for g in FO.WEIGHTS:
                    e = (sum((p - v) ** 2 for p, v in zip(plain_smoothing(y[:-12], a, b, g), y[-12:])) / 12) ** 0.5
                    tried.append((round(e, 6), a, b, g))
        e, a, b, g = min(tried)
        for h, want in enumerate(plain_smoothing(y, a, b, g), 1):
            r = got[s, h]
            assert (r["alpha"], r["beta"], r["gamma"]) == (a, b, g) and r["held_out_rmse"] == pytest.approx(e, abs=1e-5) and r["forecast"] == pytest.approx(want)
    assert FO.smoothing_forecast(spark.createDataFrame(rows[:30], "s string, m int, y double"), ["s"]).count() == 0  # too short


def test_shares_of_several_dimensions_count_incidents_once(spark):
    df = spark.range(1000).selectExpr("id % 2 AS y", "CAST(id % 3 AS STRING) AS a", "IF(id % 5 = 0, NULL, CAST(id % 5 AS STRING)) AS b")
    got = {(r["dimension"], r["y"], r["member"]): (r["total_incidents"], r["incident_share"]) for r in M.member_shares(df, {"first": "a", "second": "b"}, ["y"]).collect()}
    assert len(got) == 2 * 3 + 2 * 5
    for (dim, y, member), (n, share) in got.items():
        c = {"first": "a", "second": "b"}[dim]
        want = df.filter((F.col("y") == y) & F.col(c).eqNullSafe(F.lit(member))).count()
        assert (n, share) == (want, pytest.approx(want / 500))
    plan = M.member_shares(df, {"first": "a", "second": "b"}, ["y"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")  # what is expanded has been counted


def test_exact_column_report(spark):
    df = spark.createDataFrame([(1, None, 3, 4)], "a int, b int, c int, d int")
    got = {r["column_name"]: (r["filled_rows"], r["status"]) for r in QC.exact_report(df, ["c", "b", "a", "e"]).collect()}
    assert got == {"a": (1, "MISPLACED"), "b": (0, "PASS"), "c": (1, "MISPLACED"), "e": (None, "MISSING"), "d": (1, "EXTRA")}
