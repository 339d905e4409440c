"""The batch load from raw files to the daily table, stage by stage.

Each stage reads what the previous one stored, so stages can run as separate
applications.  A stage writes beside the last good tables, audits what it wrote and
only then publishes it, all its tables at once; a failed audit stops the load and
leaves the last good tables as they were.  An audit is recorded once per run id,
however often the run is repeated.  :func:`load_increment` takes in what is new in
the raw files and makes only the touched partitions anew.  Only one-row audit
results reach the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.functions import exprs as X
from beaconry.operators import daily as DY
from beaconry.operators import dims as D
from beaconry.operators import fact as FC
from beaconry.operators import incremental as INC
from beaconry.operators import quality as QC
from beaconry.operators import silver as S
from beaconry.session import pin, scratch
from beaconry.sources import raw as R
from beaconry.sources import tables as T
from beaconry.sources import versions as V

DIMENSIONS = ["date", "time", "geography", "call_type", "severity", "disposition"]


class AuditFailed(RuntimeError):
    """A stage's stored result did not pass its checks."""


def _gate(audit: DataFrame, stage: str, strict: bool) -> None:
    row = audit.first()
    if strict and row["validation_status"] != "PASS":
        raise AuditFailed(f"{stage}: {row.asDict()}")


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("audit_timestamp", F.current_timestamp())


def stored(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A published table, or an audit log."""
    return V.read_log(spark, f"{out}/{name}") if name.endswith("_audit") else V.read(spark, out, name)


def stored_star_dims(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    return {d: stored(spark, out, f"dim_{d}") for d in DIMENSIONS}


def stored_star(spark: SparkSession, out: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The stored fact and dimensions."""
    return stored(spark, out, "fact"), stored_star_dims(spark, out)


def _verdict(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row over check results that each have a ``status`` column; a check without any row has failed."""
    rows = QC.all_checks([df.select(F.lit(name).alias("check_name"), "status") for name, df in checks])
    bad = F.col("status") != "PASS"
    silent = F.array_except(F.array(*[F.lit(n) for n in dict.fromkeys(name for name, _ in checks)]), F.col("seen"))
    one = rows.agg(F.collect_set(F.when(bad, F.col("check_name"))).alias("failed"), F.collect_set("check_name").alias("seen"))
    failed = F.array_union("failed", silent)
    return one.select(F.when(F.size(failed) == 0, "PASS").otherwise("FAIL").alias("validation_status"), failed.alias("failed_checks"))


def _record(audit: DataFrame, path: str, run_id: str | None) -> None:
    """Add an audit to its log, once per run; a run without an id is one of its own."""
    V.append_once(_stamped(audit), path, run_id or uuid.uuid4().hex)


def _staged(out: str, name: str) -> str:
    return f"{out}/_staging/{name}-{uuid.uuid4().hex}"


def load_bronze(spark: SparkSession, raw: str, out: str, expected: DataFrame | None = None,
                expected_files: DataFrame | None = None, strict: bool = True, run_id: str | None = None) -> None:
    """Raw CSV in ``year=`` folders under ``raw`` to partitioned columnar rows.

    ``expected(year, expected_rows)`` and ``expected_files(year, expected_files)``
    are optional; files are checked before anything is read. Without expected
    rows the stored rows are held against those of the files.
    """
    if expected_files is not None:
        _gate(_verdict([("files", R.file_inventory(spark, raw, expected_files))]), "raw files", strict)
    at = _staged(out, "bronze")
    lines = R.read_raw(spark, f"{raw}/year=*/*.csv")
    T.overwrite(lines, at, "_source_year", rebalance=False)
    bronze = spark.read.parquet(at)
    if expected is None:
        expected = lines.groupBy(F.col("_source_year").alias("year")).agg(F.count("*").alias("expected_rows"))
    audit = R.yearly_expectation(bronze, expected, "_source_year", "incident_id")
    _record(audit, f"{out}/bronze_audit", run_id)
    columns = QC.exact_columns(bronze, [*R.RAW_COLUMNS, "_source_file", "_ingested_at", "_source_year"], "bronze")
    _gate(_verdict([("rows", audit), ("columns", columns)]), "bronze", strict)
    V.publish(spark, out, {"bronze": at})


def load_silver(spark: SparkSession, out: str, strict: bool = True, run_id: str | None = None) -> None:
    """Clean and type the stored raw rows; no row may be lost or gained."""
    bronze = stored(spark, out, "bronze")
    at = _staged(out, "silver")
    typed = S.to_silver(bronze)
    T.overwrite(typed, at, "incident_year", rebalance=False)
    silver = spark.read.parquet(at)
    audit = S.silver_audit(silver)
    _record(audit, f"{out}/silver_audit", run_id)
    whole = F.lit("all").alias("layer")
    rows = QC.reconcile(bronze.select(whole), silver.select(whole), "layer")
    columns = QC.exact_columns(silver, [*(c for c in typed.columns if c != "incident_year"), "incident_year"], "silver")
    _gate(_verdict([("audit", audit.select(F.col("validation_status").alias("status"))), ("rows against bronze", rows), ("columns", columns)]), "silver", strict)
    V.publish(spark, out, {"silver": at})


#: Natural keys of the dimensions: no two members may share one.
NATURAL_KEYS = {"date": ["full_date"], "time": ["hour_number"], "geography": FC.GEOGRAPHY, "call_type": ["call_type"],
                "severity": ["severity_level_code"], "disposition": ["disposition_code"]}


def _build_dimensions(spark: SparkSession, out: str, silver: DataFrame, call_type_mapping: DataFrame, strict: bool) -> dict[str, str]:
    """Staged and checked dimensions: members of the last load keep their keys, new ones follow after them."""
    known = V.manifest(spark, out)
    registries = stored_star_dims(spark, out) if f"dim_{DIMENSIONS[0]}" in known else None
    with scratch(spark):
        built = FC.build_dims(silver, call_type_mapping, None, registries)
        if registries:  # the calendar spans all loads
            both = built["date"].select("full_date").unionByName(registries["date"].select("full_date"))
            built["date"] = D.calendar_of(both, "full_date")
        at = {name: _staged(out, f"dim_{name}") for name in built}
        for name, dim in built.items():
            T.overwrite(dim, at[name])
    dims = {name: spark.read.parquet(path) for name, path in at.items()}
    checks = [(f"{n} key", QC.key_profile(d, f"{n}_key", n)) for n, d in dims.items()]
    checks += [(f"{n} natural key", QC.unique_members(d, NATURAL_KEYS[n], n)) for n, d in dims.items()]
    checks += [(f"{n} columns", QC.exact_columns(d, built[n].columns, n)) for n, d in dims.items()]
    checks += [("call type descriptions", QC.description_reconciliation(dims["call_type"], "call_type", "call_type_description")),
               ("disposition status", QC.run_checks(dims["disposition"], "disposition", QC.mapping_status_checks())),
               ("category order", QC.one_to_one(dims["disposition"], "disposition_category", "disposition_category_sort")),
               ("hours per bucket", QC.hours_per_bucket(dims["time"])), ("calendar", QC.calendar_complete(dims["date"]))]
    _gate(_verdict(checks), "dimensions", strict)
    return {f"dim_{name}": path for name, path in at.items()}


def load_dimensions(spark: SparkSession, out: str, call_type_mapping: DataFrame, strict: bool = True, mapping_rows: int | None = None) -> None:
    """Check the mapping, then build, store, check and publish the six dimensions together."""
    integrity = QC.mapping_integrity(call_type_mapping, "call_type", "call_type_description", mapping_rows)
    _gate(_verdict([("mapping", integrity)]), "call type mapping", strict)
    V.publish(spark, out, _build_dimensions(spark, out, stored(spark, out, "silver"), call_type_mapping, strict))


def _key_lookups(dims: dict[str, DataFrame]) -> list[tuple[str, DataFrame, str]]:
    roles = {"date": ["date_key"], "time": ["time_key"], "geography": ["geography_key"], "disposition": ["disposition_key"],
             "call_type": ["initial_call_type_key", "final_call_type_key"], "severity": ["initial_severity_key", "final_severity_key"]}
    return [(key, dims[d], f"{d}_key") for d, keys in roles.items() for key in keys]


#: Columns that silver and the fact share, whose values must be the same in both.
SHARED = ["incident_id", "incident_datetime", "valid_dispatch_response_seconds", "valid_incident_response_seconds", "valid_travel_time_seconds",
          "is_held", "is_transfer", "is_special_event", "call_type_changed", "severity_changed"]


def _check_fact(silver: DataFrame, fact: DataFrame, dims: dict[str, DataFrame], out: str, strict: bool, run_id: str | None) -> None:
    keys = [c for c in FC.FACT_COLUMNS if c.endswith("_key")]
    measures = [c for c in FC.FACT_COLUMNS if c.endswith(("_seconds", "_minutes", "_count"))]
    rules = QC.run_checks(fact, "fact", {k: F.col(k).isNull() for k in keys} | {f"{m}_negative": F.col(m) < 0 for m in measures})
    orphans = QC.orphans_in_one_pass(fact, _key_lookups(dims)).withColumn("check_name", F.concat("check_name", F.lit("_orphans")))
    rows = QC.reconcile_content(silver, fact, SHARED, "incident_year").select(
        F.lit("fact").alias("table_name"), F.concat(F.lit("content_"), F.coalesce(F.col("incident_year").cast("string"), F.lit("none"))).alias("check_name"),
        F.greatest(F.abs(F.col("left_rows") - F.col("right_rows")), (~F.col("same_values")).cast("long")).alias("issues"),
        F.when(F.col("status") == "PASS", "PASS").otherwise("FAIL").alias("status"))
    columns = QC.exact_columns(fact, [*(c for c in FC.FACT_COLUMNS if c != "incident_year"), "incident_year"], "fact")
    _record(QC.all_checks([rules, orphans, rows, columns]), f"{out}/fact_audit", run_id)
    _gate(_verdict([("rules", rules), ("orphans", orphans), ("rows", rows), ("columns", columns)]), "fact", strict)


def load_fact(spark: SparkSession, out: str, strict: bool = True, run_id: str | None = None) -> None:
    """Resolve keys and store the fact: every key present and known, no measure negative, no row lost, gained or changed."""
    silver, dims = stored(spark, out, "silver"), stored_star_dims(spark, out)
    at = _staged(out, "fact")
    T.overwrite(FC.build_fact(silver, dims), at, "incident_year", rebalance=False)
    _check_fact(silver, spark.read.parquet(at), dims, out, strict, run_id)
    V.publish(spark, out, {"fact": at})


def _daily_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return FC.star_view(fact, dims, DY.LIMIT_GROUP).withColumn("incident_date", X.date_of_key("date_key"))


def _check_daily(table: DataFrame, fact: DataFrame, columns, out: str, run_id: str, strict: bool) -> None:
    audit = QC.audit_record(table, fact.agg(F.count("*")), run_id)
    _record(audit, f"{out}/gold_audit", run_id)
    exact = QC.exact_columns(table, [*(c for c in columns if c != "incident_year"), "incident_year"], "daily")
    _gate(_verdict([("audit", audit.select(F.col("validation_status").alias("status"))), ("columns", exact)]), "daily", strict)


def load_daily(spark: SparkSession, out: str, run_id: str, strict: bool = True) -> None:
    """Roll the fact up to the daily table and audit the stored result."""
    fact, dims = stored_star(spark, out)
    at = _staged(out, "daily")
    daily = DY.daily_table(_daily_view(fact, dims))
    T.overwrite(daily, at, "incident_year", rebalance=True)
    _check_daily(spark.read.parquet(at), fact, daily.columns, out, run_id, strict)
    V.publish(spark, out, {"daily": at})


def load_increment(spark: SparkSession, raw: str, call_type_mapping: DataFrame, out: str, run_id: str, strict: bool = True) -> int:
    """Take in raw rows beyond the stored ones and publish all that follows from them together; returns their number.

    New is what lies after the last stored time of its year; corrections of
    earlier times need a full load.  Old members keep their keys, so old facts
    stay as they are.  Of silver, fact and daily table only the years with new
    rows are written again; in the daily table only days with new rows are
    counted anew, and limits continue from the rows before them.
    """
    silver, daily = stored(spark, out, "silver"), stored(spark, out, "daily")
    by = "incident_year"
    lines = R.read_raw(spark, f"{raw}/year=*/*.csv")
    new = pin(INC.after_marks(S.to_silver(lines), INC.high_water(silver, by, "incident_datetime"), by, "incident_datetime"), "arrived")
    arrived = new.count()
    if not arrived:
        return 0
    years = new.select(by).distinct()
    at = _build_dimensions(spark, out, new, call_type_mapping, strict)
    dims = {d: spark.read.parquet(at[f"dim_{d}"]) for d in DIMENSIONS}
    added = FC.build_fact(new, dims)
    for name, old, rows in (("silver", silver, new.select(*silver.columns)), ("fact", stored(spark, out, "fact"), added)):
        at[name] = _staged(out, name)
        T.overwrite(old.join(years, by, "left_semi").unionByName(rows.select(*old.columns)), at[name], by)
    touched = spark.read.parquet(at["fact"])
    audit = S.silver_audit(spark.read.parquet(at["silver"]))
    _record(audit, f"{out}/silver_audit", run_id)
    _gate(_verdict([("audit", audit.select(F.col("validation_status").alias("status")))]), "silver", strict)
    _check_fact(spark.read.parquet(at["silver"]), touched, dims, out, strict, run_id)
    view = _daily_view(touched, dims)
    changed = INC.updated_daily(daily, view, _daily_view(added, dims))
    at["daily"] = _staged(out, "daily")
    T.overwrite(changed, at["daily"], by)
    _check_daily(spark.read.parquet(at["daily"]), touched, daily.columns, out, run_id, strict)
    V.publish(spark, out, at, partial=("silver", "fact", "daily"))
    return arrived


def load_all(spark: SparkSession, raw: str, call_type_mapping: DataFrame, out: str, run_id: str,
             expected: DataFrame | None = None, expected_files: DataFrame | None = None, strict: bool = True) -> None:
    """All stages in order."""
    load_bronze(spark, raw, out, expected, expected_files, strict, run_id)
    load_silver(spark, out, strict, run_id)
    load_dimensions(spark, out, call_type_mapping, strict)
    load_fact(spark, out, strict, run_id)
    load_daily(spark, out, run_id, strict)
