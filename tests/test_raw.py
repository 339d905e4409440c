"""Raw files are written and profiled without holding a task's rows."""

import glob

from beaconry.plans import ingest as I
from beaconry.session import streamed_writes
from beaconry.sources import raw as R


def test_every_task_writes_its_rows_as_they_come(spark, tmp_path):
    rows = spark.range(60, numPartitions=3).selectExpr("CAST(id AS STRING) AS incident_id", "CAST(2020 + id % 2 AS INT) AS year")
    R.write_raw(rows, f"{tmp_path}/raw", "year")
    for year in (0, 1):
        files = [open(f).read().split() for f in glob.glob(f"{tmp_path}/raw/year={2020 + year}/*.csv")]
        assert len(files) == 3
        assert sorted(f[1:] for f in files) == sorted([str(i) for i in range(k, k + 20) if i % 2 == year] for k in (0, 20, 40))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_three_files_a_year_in_the_order_of_the_scan(spark, tmp_path):
    spark.range(90).coalesce(1).selectExpr(
        "id AS event_id", "TIMESTAMP '2024-02-01 10:00:00' AS ts", "id AS user_id", "'view' AS event_type", "2.5D AS value",
        "CONCAT('{\"k\": ', IF(id % 3 = 0, 37, 60), '}') AS props").write.parquet(f"{tmp_path}/events.parquet")
    spark.range(5).selectExpr("id AS r_regionkey", "CONCAT('R', id) AS r_name").coalesce(1).write.parquet(f"{tmp_path}/region.parquet")
    root = I._faulty_files(spark, str(tmp_path)).removeprefix("file:")
    for year, n in ((2023, 30), (2024, 60)):
        files = [[int(line.split(",")[0]) for line in open(f).read().splitlines()[1:]] for f in glob.glob(f"{root}/year={year}/*.csv")]
        assert len(files) == 3 and sum(map(len, files)) == n
        assert all(f == sorted(f) for f in files)


def test_settings_come_back_after_a_failed_write(spark):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    try:
        with streamed_writes(spark):
            raise OSError
    except OSError:
        pass
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_profile_counts_lines_without_sorting_them(spark, tmp_path):
    texts = {"good": "a,b\n1,2\n\n3,4\n", "short": "a\n1\n", "other": "a,c\n1,2\n", "headed": "a,b\n", "blank": "  \nx,y\n", "empty": "", "tail": "a,b,\n1,2,\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    got = R.file_profile(spark, str(tmp_path), columns=["a", "b"])
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.file_path.split("/")[-1][:-4]: (r.column_count, r.header_ok, r.data_rows, r.status) for r in got.collect()} == {
        "good": (2, True, 2, "PASS"), "short": (1, False, 1, "COLUMN_COUNT_MISMATCH"), "other": (2, False, 1, "HEADER_MISMATCH"), "headed": (2, True, 0, "NO_DATA_ROWS"),
        "blank": (None, False, 1, "BLANK_HEADER"), "empty": (None, False, 0, "EMPTY_FILE"), "tail": (3, False, 1, "COLUMN_COUNT_MISMATCH")}
