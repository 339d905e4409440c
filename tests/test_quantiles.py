"""Percentiles by distributed rank and mergeable digests against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from beaconry.operators import daily as DY
from beaconry.operators import quantiles as QT
from beaconry.plans import analogs as A

PS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p100": 1.0}


def rows(seed, size):
    """Groups of very different sizes, one of them null, with ties and nulls; four in ten rows in one group."""
    rng = random.Random(seed)
    group = lambda i: "hot" if i % 10 < 4 else None if i % 10 == 5 else f"g{i % 7}"
    return [(group(i), rng.choice([None, float(rng.randrange(40)), rng.random() * 1000])) for i in range(size)] + [("one", 7.5), ("none", None)]


def by_group(data):
    out = {}
    for g, v in data:
        if v is not None:
            out.setdefault(g, []).append(v)
    return {g: sorted(v) for g, v in out.items()}


@pytest.mark.parametrize("interpolate", [True, False])
def test_percentiles_equal_a_plain_sort(spark, interpolate):
    data = rows(1, 4000)
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    got = {r["g"]: r for r in QT.percentiles(df, ["g"], "v", PS, interpolate).collect()}
    want = by_group(data)
    assert set(got) == set(want)
    for g, values in want.items():
        for name, p in PS.items():
            if interpolate:
                at = p * (len(values) - 1)
                low = int(at)
                expected = values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (at - low)
            else:
                expected = values[max(1, -(-round(p * 10**6) * len(values) // 10**6)) - 1]
            assert got[g][name] == pytest.approx(expected), (g, name)


def test_one_group_of_all_rows_is_spread_over_the_tasks(spark):
    """Without group columns no task ever orders more than its range of the values."""
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_000).cast("double").alias("v"))
    found = QT.percentiles(df, [], "v", {"p50": 0.5, "p90": 0.9}, False)
    assert tuple(found.first()) == (99_999.0, 179_999.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "_range" in plan and "percentile" not in plan.lower()
    ranges = QT.pin(df.repartitionByRange(8, "v").withColumn("r", F.spark_partition_id()), "ranges").groupBy("r").count()
    assert ranges.agg(F.max("count")).first()[0] < 60_000


def test_empty_and_null_input(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert QT.percentiles(df, ["g"], "v", PS).count() == 0
    assert QT.digest_percentiles(QT.digests(QT.histogram(df, ["g"], "v"), ["g"], "v"), ["g"], PS).count() == 0


@pytest.mark.parametrize("cells", [1, 5, 64])
def test_digests_keep_their_bound_and_add_up(spark, cells):
    data = [(i % 9, "hot" if i % 3 else f"g{i % 5}", v) for i, (_, v) in enumerate(rows(2, 6000)) if v is not None]
    df = spark.createDataFrame(data, "day int, g string, v double")
    days = QT.digests(QT.histogram(df, ["day", "g"], "v"), ["day", "g"], "v", cells=cells)
    assert all(len(r["digest"]) <= 2 * cells + 1 for r in days.collect())
    assert days.select(F.inline("digest")).agg(F.sum("n")).first()[0] == len(data)
    ps = {"p10": 0.1, "p50": 0.5, "p95": 0.95}
    for group in (["g"], ["day"], []):
        got = {tuple(r[c] for c in group): r for r in QT.digest_percentiles(days, group, ps).collect()}
        for key, r in got.items():
            values = sorted(v for d, g, v in data if all({"day": d, "g": g}[c] == k for c, k in zip(group, key)))
            for name, p in ps.items():
                want = -(-round(p * 10**6) * len(values) // 10**6)
                below, upto = sum(v < r[name] for v in values), sum(v <= r[name] for v in values)
                assert upto >= want and below + 1 - want <= len(values) / cells + 45  # a rank for each of up to 45 digests


def test_the_daily_table_is_made_by_plain_hash_aggregates(spark):
    view = QT.pin(A.event_view(spark, "/root/testdata/sf0.001"), "view")
    plan = DY.daily_performance(view)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and plan.count("Scan parquet") == 1


def test_a_week_from_the_digests_of_its_days(spark):
    view = A.event_view(spark, "/root/testdata/sf0.01")
    days = DY.daily_performance(view, digest_cells=512)
    assert [c for c in days.columns if "digest" in c] == ["response_digest"]
    week = days.withColumn("week", F.weekofyear("incident_date"))
    got = {tuple(r)[:2]: r["p90"] for r in QT.digest_percentiles(week, ["week", "borough"], {"p90": 0.9}, "response_digest").collect()}
    want = QT.percentiles(view.withColumn("week", F.weekofyear("incident_date")), ["week", "borough"], "valid_incident_response_seconds", {"p90": 0.9}, False)
    assert got == {tuple(r)[:2]: r["p90"] for r in want.collect()}  # days have fewer than 512 different values: exact
