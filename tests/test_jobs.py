"""The whole load from CSV, the gates, and the stored star under the analysis queries."""

import pytest
from pyspark.sql import functions as F

from beaconry import jobs
from beaconry.operators import analysis as AN
from beaconry.operators import fact as FC
from beaconry.operators import quality as QC
from beaconry.operators import silver as S
from beaconry.plans import analogs as A
from beaconry.session import new_folder
from beaconry.sources import raw as R
from beaconry.sources import tables as T
from beaconry.sources import versions as V

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clean_raw(spark):
    """Raw lines without the planted year and sign faults."""
    raw = A.raw_events(spark, FOLDER).filter("year = 2024 AND dispatch_response_seconds_qy NOT LIKE '-%'")
    path = new_folder(spark, "clean-raw")
    R.write_raw(raw, path, "year")
    return path, raw.count()


@pytest.fixture(scope="module")
def loaded(spark, clean_raw):
    out = new_folder(spark, "lake")
    jobs.load_all(spark, clean_raw[0], A.call_type_mapping(spark), out, "run-1")
    return out


def test_load_keeps_every_row(spark, clean_raw, loaded):
    for name in ("bronze", "silver", "fact"):
        assert jobs.stored(spark, loaded, name).count() == clean_raw[1]
    fact = jobs.stored(spark, loaded, "fact")
    assert set(fact.columns) == set(FC.FACT_COLUMNS) and len(fact.columns) == 29
    assert jobs.stored(spark, loaded, "daily").agg(F.sum("total_incidents")).first()[0] == clean_raw[1]
    audit = jobs.stored(spark, loaded, "gold_audit").first()
    assert audit["validation_status"] == "PASS" and audit["fact_incidents"] == clean_raw[1]


def test_faulty_input_is_stopped(spark):
    path = new_folder(spark, "faulty-raw")
    R.write_raw(A.raw_events(spark, FOLDER), path, "year")
    out = new_folder(spark, "lake")
    jobs.load_bronze(spark, path, out)
    with pytest.raises(jobs.AuditFailed):
        jobs.load_silver(spark, out)


def test_missing_files_and_rows_are_stopped(spark, clean_raw):
    files = spark.createDataFrame([(2024, 999)], "year int, expected_files int")
    with pytest.raises(jobs.AuditFailed):
        jobs.load_bronze(spark, clean_raw[0], new_folder(spark, "lake"), expected_files=files)
    rows = spark.createDataFrame([(2024, clean_raw[1] + 1)], "year int, expected_rows long")
    with pytest.raises(jobs.AuditFailed):
        jobs.load_bronze(spark, clean_raw[0], new_folder(spark, "lake"), expected=rows)


def test_bad_mapping_is_stopped(spark, loaded):
    twice = A.call_type_mapping(spark).unionByName(A.call_type_mapping(spark))
    with pytest.raises(jobs.AuditFailed):
        jobs.load_dimensions(spark, loaded, twice)


def test_wrong_header_is_refused(spark):
    path = new_folder(spark, "bad-header")
    spark.createDataFrame([("1", "2")], "a string, b string").write.option("header", True).csv(path)
    with pytest.raises(Exception):
        R.read_raw(spark, path).collect()


def test_typed_rows_equal_cleaned_raw_rows(spark):
    cols = ["incident_id", "initial_call_type", "final_call_type", "initial_severity_level_code", "final_severity_level_code", "borough", "zipcode",
            "incident_disposition_code", "valid_dispatch_response_seconds", "valid_incident_response_seconds", "valid_travel_time_seconds", "is_held",
            "is_transfer", "is_special_event", "call_type_changed", "severity_changed", "incident_date", "incident_hour", "time_of_day",
            "incident_duration_seconds", "hospital_travel_seconds"]
    typed = A.events(spark, FOLDER).select(*cols)
    cleaned = S.to_silver(A.bronze_events(spark, FOLDER)).select(*cols)
    assert typed.exceptAll(cleaned).count() == 0 and cleaned.exceptAll(typed).count() == 0


def test_star_view_answers_like_the_flat_rows(spark, loaded):
    fact, dims = jobs.stored_star(spark, loaded)
    view = FC.star_view(fact, dims, ["borough", "initial_call_type", "final_call_type", "initial_severity_level_code", "incident_hour", "disposition_category"])
    assert "disposition_category" in view.columns and "zipcode" not in view.columns
    flat = FC.prepare(jobs.stored(spark, loaded, "silver"))
    for group in (["borough"], ["initial_call_type", "final_call_type"], ["initial_severity_level_code", "incident_hour"]):
        a, b = AN.counts(view, group), AN.counts(flat, group)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_file_profile_flags_headers(spark, clean_raw):
    root = clean_raw[0]
    p = R.file_profile(spark, root)
    assert p.filter("status <> 'PASS'").count() == 0
    assert p.agg(F.sum("data_rows")).first()[0] == clean_raw[1]
    assert R.file_profile(spark, root, ["other"]).filter("status <> 'COLUMN_COUNT_MISMATCH'").count() == 0
    other = [f"c{i}" for i in range(len(R.RAW_COLUMNS))]
    assert R.file_profile(spark, root, other).filter("status <> 'HEADER_MISMATCH'").count() == 0


def test_empty_files_are_listed(spark, tmp_path):
    (tmp_path / "year=2024").mkdir()
    (tmp_path / "year=2024" / "a.csv").write_text("")
    (tmp_path / "year=2024" / "b.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "year=2024" / "c.csv").write_text("x,y\n")
    (tmp_path / "year=2024" / "d.csv").write_text("x,y,z\n1,2,3\n\n3,4,5\n")
    (tmp_path / "year=2024" / "e.csv").write_text("\nx,y\n")
    (tmp_path / "year=2024" / "f.csv").write_text("y,x\n1,2\n")
    manifest = spark.createDataFrame([(f"file:{tmp_path}/year=2024/{n}.csv",) for n in "abg"], "file_path string")
    got = {r["file_path"][-5:]: (r["status"], r["data_rows"], r["column_count"]) for r in R.file_profile(spark, str(tmp_path), ["x", "y"], manifest).collect()}
    assert got == {"a.csv": ("EMPTY_FILE", 0, None), "b.csv": ("PASS", 2, 2), "c.csv": ("NO_DATA_ROWS", 0, 2), "d.csv": ("COLUMN_COUNT_MISMATCH", 2, 3),
                   "e.csv": ("BLANK_HEADER", 1, None), "f.csv": ("HEADER_MISMATCH", 1, 2), "g.csv": ("MISSING_FILE", 0, None)}
    expected = spark.createDataFrame([(2024, 6), (2023, 1)], "year int, expected_files int")
    inv = {r["year"]: r["status"] for r in R.file_inventory(spark, str(tmp_path), expected).collect()}
    assert inv == {2024: "PASS", 2023: "FAIL"}


def test_a_year_without_rows_is_stopped(spark, clean_raw):
    rows = spark.createDataFrame([(2024, clean_raw[1]), (2023, 500)], "year int, expected_rows long")
    with pytest.raises(jobs.AuditFailed):
        jobs.load_bronze(spark, clean_raw[0], new_folder(spark, "lake"), expected=rows)


def test_a_check_without_rows_fails(spark):
    empty = spark.createDataFrame([], "status string")
    row = jobs._verdict([("rows", empty), ("other", spark.createDataFrame([("PASS",)], "status string"))]).first()
    assert (row["validation_status"], row["failed_checks"]) == ("FAIL", ["rows"])


def test_a_failed_load_leaves_the_last_good_table(spark, clean_raw, loaded):
    before = jobs.stored(spark, loaded, "bronze").count()
    rows = spark.createDataFrame([(2024, 1)], "year int, expected_rows long")
    with pytest.raises(jobs.AuditFailed):
        jobs.load_bronze(spark, clean_raw[0], loaded, expected=rows)
    assert jobs.stored(spark, loaded, "bronze").count() == before == clean_raw[1]


@pytest.fixture
def copy(spark, loaded):
    """A copy of the loaded tables that a test may spoil."""
    out = new_folder(spark, "lake-copy")
    at = {name: f"{out}/_copy/{name}" for name in ("bronze", "silver", *(f"dim_{d}" for d in jobs.DIMENSIONS))}
    for name, path in at.items():
        jobs.stored(spark, loaded, name).write.parquet(path)
    V.publish(spark, out, at)
    return out


def spoil(spark, out, name, change):
    df = change(jobs.stored(spark, out, name))
    df.write.parquet(f"{out}/spoiled-{name}")
    V.publish(spark, out, {name: f"{out}/spoiled-{name}"})


def test_lost_rows_between_layers_are_stopped(spark, copy, monkeypatch):
    whole = S.to_silver
    monkeypatch.setattr(jobs.S, "to_silver", lambda df: whole(df).filter("incident_id NOT LIKE '%7'"))
    with pytest.raises(jobs.AuditFailed, match="rows against bronze"):
        jobs.load_silver(spark, copy)


def test_a_member_held_twice_is_stopped(spark, copy, monkeypatch):
    build = FC.build_dims

    def twice(*args):
        dims = build(*args)
        again = dims["severity"].limit(1).withColumn("severity_key", F.lit(999).cast("long"))
        return dims | {"severity": dims["severity"].unionByName(again)}

    monkeypatch.setattr(jobs.FC, "build_dims", twice)
    with pytest.raises(jobs.AuditFailed, match="severity natural key"):
        jobs.load_dimensions(spark, copy, A.call_type_mapping(spark))


def test_a_missing_member_and_a_negative_measure_are_stopped(spark, copy, monkeypatch):
    spoil(spark, copy, "dim_disposition", lambda d: d.limit(1))
    with pytest.raises(jobs.AuditFailed, match="rules"):
        jobs.load_fact(spark, copy)
    build = FC.build_fact
    monkeypatch.setattr(jobs.FC, "build_fact", lambda s, d: build(s, d).withColumns(
        {"disposition_key": F.lit(12345).cast("long"), "travel_time_minutes": F.lit(-1.0)}))
    with pytest.raises(jobs.AuditFailed, match="orphans"):
        jobs.load_fact(spark, copy)


def test_a_wrong_number_of_mapping_entries_is_stopped(spark, copy):
    with pytest.raises(jobs.AuditFailed, match="mapping"):
        jobs.load_dimensions(spark, copy, A.call_type_mapping(spark), mapping_rows=1)


def test_lookups_take_the_smallest_key(spark):
    fact = spark.createDataFrame([("A",)], "c string")
    dim = spark.createDataFrame([("A", 2), ("A", 1)], "c string, k long")
    assert FC.resolve_keys(fact, [FC.Lookup(dim, ["c"], ["c"], "k", "k")]).first()["k"] == 1


# --- second loads ---------------------------------------------------------------

CUT = "2024-01-22"


def rows_of(df):
    """Rows in a fixed column order, floats to nine digits."""
    cols = sorted(df.columns)
    out = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda r: tuple(repr(v) for v in r))


@pytest.fixture(scope="module")
def two_loads(spark, clean_raw):
    """A lake loaded up to a day, then with the rest; the members of the first load; the folders after each."""
    raw = A.raw_events(spark, FOLDER).filter("year = 2024 AND dispatch_response_seconds_qy NOT LIKE '-%'")
    first = new_folder(spark, "first-raw")
    R.write_raw(raw.filter(f"incident_datetime < '{CUT}' AND initial_call_type NOT LIKE '%CLICK%' AND final_call_type NOT LIKE '%CLICK%'"), first, "year")
    out = new_folder(spark, "lake")
    jobs.load_all(spark, first, A.call_type_mapping(spark), out, "run-1")
    before = {d: rows_of(jobs.stored(spark, out, f"dim_{d}")) for d in jobs.DIMENSIONS}
    return out, before, V.manifest(spark, out), jobs.load_increment(spark, clean_raw[0], A.call_type_mapping(spark), out, "run-2")


def test_an_increment_equals_a_full_load(spark, clean_raw, two_loads):
    out, _, _, arrived = two_loads
    raw = A.raw_events(spark, FOLDER).filter("year = 2024 AND dispatch_response_seconds_qy NOT LIKE '-%'")
    taken = raw.filter(f"incident_datetime < '{CUT}' AND initial_call_type NOT LIKE '%CLICK%' AND final_call_type NOT LIKE '%CLICK%'")
    last = taken.agg(F.max("incident_datetime")).first()[0]
    whole = new_folder(spark, "whole-raw")
    R.write_raw(taken.unionByName(raw.filter(F.col("incident_datetime") > last)), whole, "year")
    full = new_folder(spark, "lake")
    jobs.load_all(spark, whole, A.call_type_mapping(spark), full, "run-1")
    assert arrived == raw.filter(F.col("incident_datetime") > last).count()
    key = "initial_severity_key"  # numbered in the order of the loads
    for name, drop in (("silver", ["_ingested_at", "_source_file"]), ("daily", [key])):
        assert rows_of(jobs.stored(spark, out, name).drop(*drop)) == rows_of(jobs.stored(spark, full, name).drop(*drop)), name
    columns = ["incident_id", "borough", "zipcode", "initial_call_type", "final_call_type", "initial_severity_level_code", "disposition_category", "incident_hour"]
    views = [FC.star_view(*jobs.stored_star(spark, o), columns[1:]).select(*columns) for o in (out, full)]
    assert rows_of(views[0]) == rows_of(views[1])


def test_old_members_keep_their_keys(spark, two_loads):
    out, before, _, _ = two_loads
    for d, (natural, key) in FC.KEYED.items():
        now = jobs.stored(spark, out, f"dim_{d}")
        cols = sorted(now.columns)
        old = {tuple(r[cols.index(n)] for n in natural): r[cols.index(key)] for r in before[d]}
        new = {tuple(r[n] for n in natural): r[key] for r in now.collect()}
        assert old.items() <= new.items() and sorted(new.values()) == list(range(1, len(new) + 1))
    assert len(jobs.stored(spark, out, "dim_call_type").collect()) > len(before["call_type"])


def test_an_increment_is_taken_in_once(spark, clean_raw, two_loads):
    out = two_loads[0]
    before = V.manifest(spark, out)
    assert jobs.load_increment(spark, clean_raw[0], A.call_type_mapping(spark), out, "run-3") == 0
    assert V.manifest(spark, out) == before


def test_untouched_partitions_keep_their_folders(spark):
    root = new_folder(spark, "lake")
    for load, years in ((1, (2020, 2021, 2022)), (2, (2022, 2023))):
        at = f"{root}/_staging/{load}"
        T.overwrite(spark.createDataFrame([(y, load, i) for y in years for i in range(3)], "y int, load int, i int"), at, "y")
        V.publish(spark, root, {"t": at}, partial=("t",))
    got = V.read(spark, root, "t").groupBy("y", "load").count().collect()
    assert sorted(map(tuple, got)) == [(2020, 1, 3), (2021, 1, 3), (2022, 2, 3), (2023, 2, 3)]
    folders = V.manifest(spark, root)["t"]
    assert folders["y=2020"] == folders["y=2021"] != folders["y=2022"] == folders["y=2023"]
    assert V.read(spark, root, "t").filter("y = 2020").count() == 3


def test_a_load_that_stops_half_way_changes_nothing(spark, copy, monkeypatch):
    """The third of six dimension folders cannot be moved: readers still see the old star."""
    before, moved = {d: rows_of(jobs.stored(spark, copy, f"dim_{d}")) for d in jobs.DIMENSIONS}, []
    move = V._move

    def stop(s, source, target):
        moved.append(target)
        return move(s, source, target) if len(moved) <= 3 else False

    monkeypatch.setattr(V, "_move", stop)
    mapping = A.call_type_mapping(spark).withColumn("call_type_description", F.concat(F.lit("new "), "call_type_description"))
    with pytest.raises(OSError):
        jobs.load_dimensions(spark, copy, mapping)
    assert {d: rows_of(jobs.stored(spark, copy, f"dim_{d}")) for d in jobs.DIMENSIONS} == before
    monkeypatch.undo()
    jobs.load_dimensions(spark, copy, mapping)
    assert jobs.stored(spark, copy, "dim_call_type").filter("call_type_description LIKE 'new %'").count() > 0


def test_two_loads_at_once_do_not_mix(spark, monkeypatch):
    root = new_folder(spark, "lake")
    for name in "abc":
        spark.range(3).write.parquet(f"{root}/_staging/{name}")
    V.publish(spark, root, {"t": f"{root}/_staging/a"})
    numbers = V._numbers
    monkeypatch.setattr(V, "_numbers", lambda s, r: numbers(s, r)[:1])  # the second load read the manifest before the first wrote its own
    V.publish(spark, root, {"t": f"{root}/_staging/b"})
    with pytest.raises(OSError, match="another load"):
        V.publish(spark, root, {"t": f"{root}/_staging/c"})


def test_a_run_is_recorded_once(spark):
    path = new_folder(spark, "log")
    row = spark.createDataFrame([("PASS", 1)], "status string, n int")
    assert [V.append_once(row, path, r) for r in ("run-1", "run-1", "run-2")] == [True, False, True]
    row.write.parquet(f"{path}/_writing/stopped")  # a run that stopped while it wrote
    assert sorted((r["audit_run_id"], r["n"]) for r in V.read_log(spark, path).collect()) == [("run-1", 1), ("run-2", 1)]


def test_a_changed_value_is_found(spark):
    a = spark.range(1000).selectExpr("id", "id % 4 AS y", "IF(id % 7 = 0, NULL, CAST(id AS STRING)) AS v", "id * 0.5D AS w")
    same = a.orderBy(F.desc("id")).repartition(5)
    assert {r["status"] for r in QC.reconcile_content(a, same, ["id", "v", "w"], "y").collect()} == {"PASS"}
    faults = {"lost": a.filter("id <> 9"), "twice": a.unionByName(a.filter("id = 9")), "cell": a.withColumn("w", F.when(F.col("id") == 9, 0.0).otherwise(F.col("w"))),
              "null": a.withColumn("v", F.when(F.col("id") == 9, None).otherwise(F.col("v"))), "swapped": a.withColumn("v", F.when(F.col("id") == 9, "13").when(F.col("id") == 13, "9").otherwise(F.col("v")))}
    for name, b in faults.items():
        bad = {r["y"]: r["status"] for r in QC.reconcile_content(a, b, ["id", "v", "w"], "y").collect() if r["status"] != "PASS"}
        assert bad == {1: "ROWS DIFFER" if name in ("lost", "twice") else "VALUES DIFFER"}, name
