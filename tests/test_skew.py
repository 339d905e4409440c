"""A third and more of all rows on one key: results stay whole and right."""

import pytest
from pyspark.sql import functions as F

from beaconry.operators import analysis as AN
from beaconry.operators import daily as DY
from beaconry.operators import dims as D
from beaconry.operators import fact as FC
from beaconry.operators import quality as QC
from beaconry.operators import quantiles as QT
from beaconry.session import new_folder
from beaconry.sources import tables as T

N = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """Rows of which four in ten share area, code and day."""
    i = F.col("id")
    is_hot = i % 10 < 4
    df = spark.range(N).select(
        i.cast("string").alias("incident_id"),
        F.when(is_hot, "HOT").otherwise(F.concat(F.lit("A"), (i % 97).cast("string"))).alias("borough"),
        F.when(is_hot, "X").otherwise(F.concat(F.lit("C"), (i % 13).cast("string"))).alias("code"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.when(is_hot, 3).otherwise((i % 60).cast("int"))).alias("incident_date"),
        F.lit(1).alias("initial_severity_level_code"), (i % 701).cast("double").alias("valid_incident_response_seconds"),
        (i % 211).cast("double").alias("valid_dispatch_response_seconds"), (i % 499).cast("double").alias("valid_travel_time_seconds"),
        (i % 3 == 0).alias("is_held"), (i % 5 == 0).alias("is_special_event"), (i % 7 == 0).alias("is_transfer"), is_hot.alias("hot"))
    path = new_folder(spark, "hot")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_daily_keeps_all_rows(spark, hot):
    d = DY.daily_performance(hot, ["incident_date", "borough", "initial_severity_level_code"])
    assert d.agg(F.sum("total_incidents")).first()[0] == N
    top = d.orderBy(F.desc("total_incidents")).first()
    assert (top["borough"], top["total_incidents"]) == ("HOT", N * 4 // 10)
    pdf = hot.filter("hot").select("valid_incident_response_seconds").toPandas().iloc[:, 0]
    assert abs(top["population_stddev_response_seconds"] - pdf.std(ddof=0)) < 1e-6
    pooled = AN.pooled_stats(d, ["initial_severity_level_code"]).first()
    assert abs(pooled["pooled_stddev_seconds"] - hot.toPandas()["valid_incident_response_seconds"].std(ddof=0)) < 1e-6


def test_percentiles_of_a_hot_group(spark, hot):
    got = {r["borough"]: r["p90"] for r in QT.percentiles(hot, ["borough"], "valid_incident_response_seconds", {"p90": 0.9}).collect()}
    want = hot.select("borough", "valid_incident_response_seconds").toPandas().groupby("borough").quantile(0.9).iloc[:, 0].to_dict()
    assert got == pytest.approx(want)


def test_shuffled_lookup_splits_the_hot_key(spark, hot):
    """With broadcast off, a grown dimension joins by shuffle and loses nothing."""
    dim = D.with_surrogate_key(hot.select("borough", "code").distinct(), ["borough", "code"], "key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = FC.resolve_keys(hot, [FC.Lookup(dim, ["borough", "code"], ["borough", "code"], "key", "key")])
        assert keyed.count() == N and keyed.filter("key IS NULL").count() == 0
        assert QC.orphans_in_one_pass(keyed, [("key", dim.filter("code <> 'X'"), "key")]).first()["issues"] == N * 4 // 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_partitioned_write_splits_the_hot_folder(spark, hot):
    path = new_folder(spark, "hot-write")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        T.overwrite(hot, path, "code")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    detail = {r["code"]: (r["n_files"], r["n_rows"]) for r in T.storage_detail(spark, path, "code").collect()}
    assert detail["X"][1] == N * 4 // 10 and detail["X"][0] > 1
    assert sum(n for _, n in detail.values()) == N


def test_transitions_and_shares_add_up(spark, hot):
    t = AN.transition_matrix(hot.withColumn("changed", F.col("borough") != F.col("code")), "borough", "code", "changed")
    assert t.agg(F.sum("transition_incidents")).first()[0] == N
    assert t.agg(F.sum("percentage_of_all_changes")).first()[0] == pytest.approx(100.0)
    assert t.groupBy("borough").agg(F.sum("percentage_within_initial_changes").alias("p")).filter(F.abs(F.col("p") - 100) > 1e-9).count() == 0
