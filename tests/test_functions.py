"""Column functions on hand-built rows: nulls, blanks, edges of buckets."""

from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import silver as S


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_text_cleaning(spark):
    df = spark.createDataFrame([(" a ",), ("",), ("   ",), (None,), ("y",)], "t string").coalesce(1)
    assert values(df, X.blank_to_null("t")) == ["a", None, None, None, "y"]
    assert values(df, X.norm_code("t")) == ["A", "UNKNOWN", "UNKNOWN", "UNKNOWN", "Y"]
    assert values(df, X.yn_to_bool(F.upper("t"))) == [None, None, None, None, True]


def test_conversions_give_null(spark):
    df = spark.createDataFrame([("2024-02-30 00:00:00", "x1", "12"), ("2024-02-29 10:00:00", "1.5", "7.0"), (None, None, None)], "a string, b string, c string").coalesce(1)
    assert [v is None for v in values(df, X.to_ts("a"))] == [True, False, True]
    assert values(df, X.to_double("b")) == [None, 1.5, None]
    assert values(df, X.to_int("c")) == [12, 7, None]
    one = S.conversion_failures(df, {"a": "timestamp_ntz", "b": "double", "c": "int"}).first()
    assert tuple(one) == (1, 1, 0)


def test_hours_and_buckets(spark):
    df = spark.createDataFrame([(h,) for h in (0, 5, 6, 11, 12, 17, 18, 23, None)], "h int").coalesce(1)
    assert values(df, X.time_bucket("h")) == ["Overnight"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2 + [None]
    assert values(df, X.time_bucket_sort("h")) == [1, 1, 2, 2, 3, 3, 4, 4, None]
    assert values(df, X.hour_label("h"))[:2] == ["00:00", "05:00"]


def test_change_flags_keep_unknown(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "x string, y string").coalesce(1)
    assert values(df, X.changed("x", "y")) == [False, True, None, None]
    assert values(df, X.same("x", "y")) == [True, False, False, True]


def test_percent_and_division_on_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 8), (1, 8)], "n int, t int").coalesce(1)
    assert values(df, X.pct("n", "t")) == [33.33, None, 0.0, 12.5]
    assert values(df, X.ratio("n", "t"))[1] is None


def test_minutes_round_half_up(spark):
    df = spark.createDataFrame([(12.3,), (0.3,), (None,)], "s double").coalesce(1)
    assert values(df, X.sec_to_min("s")) == [0.21, 0.01, None]


def test_valid_measure_and_elapsed(spark):
    df = spark.createDataFrame([(5.0, True), (-1.0, True), (5.0, False), (5.0, None), (None, True)], "v double, ok boolean").coalesce(1)
    assert values(df, X.valid_measure("v", "ok")) == [5.0, None, None, None, None]
    assert values(df, X.valid_measure("v")) == [5.0, None, 5.0, 5.0, None]
    t = spark.sql("select timestamp_ntz'2024-01-01 00:00:10' a, timestamp_ntz'2024-01-01 00:00:00' b")
    assert values(t, X.elapsed_seconds("b", "a")) == [10.0]
    assert values(t, X.elapsed_seconds("a", "b")) == [None]


def test_record_status_first_match(spark):
    df = spark.sql("""select * from values (null, timestamp_ntz'2021-01-01', 2021, 2020), ('a', null, null, 2020),
        ('b', timestamp_ntz'2021-01-01', 2021, 2020), ('c', timestamp_ntz'2021-01-01', 2021, 2021) as t(incident_id, incident_datetime, incident_year, _source_year)""")
    assert values(df, S.record_status()) == ["MISSING_INCIDENT_ID", "INVALID_INCIDENT_DATETIME", "SOURCE_YEAR_MISMATCH", "VALID"]


def test_date_key_round_trip(spark):
    df = spark.sql("select explode(sequence(date'1999-12-30', date'2000-03-02')) d")
    assert df.filter(X.date_of_key(X.date_key("d")) != F.col("d")).count() == 0
