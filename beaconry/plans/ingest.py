"""Sources, sinks and ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.operators import dims as D
from beaconry.operators import incremental as INC
from beaconry.operators import quality as QC
from beaconry.plans import analogs as A
from beaconry.plans import oracle as O
from beaconry.plans.registry import query
from beaconry.session import new_folder, pin, streamed_writes
from beaconry.sources import raw as R
from beaconry.sources import tables as T
from beaconry.sources import versions as V


@query("i01_csv_scan", "incident_id:s incident_datetime:s initial_call_type:s held_indicator:s incident_response_seconds_qy:s",
       f"WITH {O.RAW} SELECT * FROM raw")
def csv_scan(spark, folder):
    return R.read_raw(spark, A.staged_csv(spark, folder) + "/year=*/*.csv")


@query("i02_mapping_scan", "call_type:s call_type_description:s",
       "SELECT UPPER(s_name) AS call_type, 'supplier of ' || n_name AS call_type_description FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def mapping_scan(spark, folder):
    path = new_folder(spark, "mapping")
    s, n = T.table(spark, folder, "supplier"), T.table(spark, folder, "nation")
    (s.join(n, s.s_nationkey == n.n_nationkey)
     .select(F.concat(F.lit(" "), F.lower("s_name"), F.lit("  ")).alias("call_type"),
             F.concat(F.lit(" supplier of "), "n_name").alias("call_type_description"))
     .write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return R.read_mapping(spark, path, "call_type", "call_type_description")


@query("i03_table_scan", "l_returnflag:s n:i quantity:f2", "SELECT l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1")
def table_scan(spark, folder):
    return T.table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("i04_lineage_columns", "source_year:i n:i named_files:i with_load_time:i",
       f"WITH {O.RAW} SELECT year AS source_year, COUNT(*) AS n, COUNT(*) AS named_files, COUNT(*) AS with_load_time FROM raw GROUP BY 1")
def lineage_columns(spark, folder):
    df = R.read_raw(spark, A.staged_csv(spark, folder) + "/year=*/*.csv")
    return df.groupBy(F.col("_source_year").alias("source_year")).agg(
        F.count("*").alias("n"), F.count_if(F.col("_source_file").endswith(".csv")).alias("named_files"),
        F.count("_ingested_at").alias("with_load_time"))


def _faulty_files(spark, folder) -> str:
    """Raw events in three files a year, beside a folder that nobody asked for and files with every kind of fault."""
    root = new_folder(spark, "faulty-raw")
    raw = A.raw_events(spark, folder)
    text = [c for c in raw.columns if c != "year"]
    # dealt by a hash of the place in the scan: rows that repeat, or a year in every third row, do not fall into one file
    dealt = raw.withColumn("_at", F.monotonically_increasing_id()).repartition(3, "_at").drop("_at")
    with streamed_writes(spark):
        dealt.write.partitionBy("year").option("header", True).option("emptyValue", "").csv(root)
    few = spark.range(1).select(*[F.lit("x").alias(c) for c in text])
    bad = {"year=1991/extra": few, "year=1992/short": few.select(*text[:5]), "year=1992/other": few.withColumnRenamed(text[0], "another_name"), "year=1992/headed": few.limit(0)}
    for name, df in bad.items():
        df.coalesce(1).write.mode("append").option("header", True).csv(f"{root}/{name}")
    jvm = spark.sparkContext._jvm
    empty = jvm.org.apache.hadoop.fs.Path(f"{root}/year=1992/empty.csv")
    empty.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(empty, True).close()
    return root


@query("i05_file_inventory", "year:i expected_files:i actual_files:i status:s",
       f"""WITH {O.RAW}, y AS (SELECT year, 3 AS n FROM raw GROUP BY year), e AS (SELECT year, CASE WHEN year = (SELECT MIN(year) FROM y) THEN 4 ELSE 3 END AS expected_files, n AS actual_files FROM y
       UNION ALL SELECT 1990, 2, 0 UNION ALL SELECT 1991, 0, 1 UNION ALL SELECT 1992, 4, 4)
       SELECT *, CASE WHEN expected_files = actual_files THEN 'PASS' ELSE 'FAIL' END AS status FROM e""")
def file_inventory(spark, folder):
    """Against a given expectation: of one year a file is missing, one year is missing, one is extra."""
    root = _faulty_files(spark, folder)
    years = A.raw_events(spark, folder).groupBy("year").agg(F.lit(3).alias("expected_files"))
    first = years.agg(F.min("year")).scalar()
    asked = years.withColumn("expected_files", F.when(F.col("year") == first, 4).otherwise(3)).unionByName(
        T.literal_table(spark, [(1990, 2), (1992, 4)], "year int, expected_files int"))
    return R.file_inventory(spark, root, asked)


@query("i06_file_profile", "status:s files:i data_rows:i",
       f"""WITH {O.RAW} SELECT 'PASS' AS status, 3 * COUNT(DISTINCT year) + 1 AS files, COUNT(*) + 1 AS data_rows FROM raw
       UNION ALL SELECT 'COLUMN_COUNT_MISMATCH', 1, 1 UNION ALL SELECT 'HEADER_MISMATCH', 1, 1 UNION ALL SELECT 'NO_DATA_ROWS', 1, 0 UNION ALL SELECT 'EMPTY_FILE', 1, 0
       UNION ALL SELECT 'MISSING_FILE', 1, 0""")
def file_profile(spark, folder):
    """Files by status: planted are a short and a wrong header, a header alone, an empty file and a file that is not there."""
    root = _faulty_files(spark, folder)
    gone = T.literal_table(spark, [(f"{root}/year=1992/gone.csv",)], "file_path string")
    p = R.file_profile(spark, root, expected=gone)
    return p.groupBy("status").agg(F.count("*").alias("files"), F.sum("data_rows").alias("data_rows"))


@query("i07_literal_table", "disposition_code:s disposition_category:s total_incidents:i",
       f"WITH {O.EV}, {O.DM} SELECT code AS disposition_code, category AS disposition_category, COUNT(incident_id) AS total_incidents "
       "FROM dm LEFT JOIN ev ON code = incident_disposition_code GROUP BY ALL")
def literal_table(spark, folder):
    m = T.literal_table(spark, D.DISPOSITIONS, "disposition_code string, disposition_description string, disposition_category string")
    used = A.event_view(spark, folder, area=False).groupBy(F.col("incident_disposition_code").alias("disposition_code")).agg(F.count("*").alias("n"))
    return m.join(used, "disposition_code", "left").withColumn("total_incidents", F.coalesce("n", F.lit(0)))


@query("i08_range_generator", "hour_number:i total_incidents:i",
       f"WITH {O.EV} SELECT r.range AS hour_number, COUNT(incident_id) AS total_incidents FROM range(24) r LEFT JOIN ev ON incident_hour = r.range GROUP BY 1")
def range_generator(spark, folder):
    h = T.number_range(spark, 0, 24, "hour_number")
    n = A.event_view(spark, folder, area=False).groupBy(F.col("incident_hour").alias("hour_number")).agg(F.count("*").alias("n"))
    return h.join(n, "hour_number", "left").withColumn("total_incidents", F.coalesce("n", F.lit(0)))


@query("i09_overwrite_table", "o_orderpriority:s n:i", "SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1")
def overwrite_table(spark, folder):
    path = new_folder(spark, "orders")
    o = T.table(spark, folder, "orders")
    T.overwrite(o.select("o_orderkey"), path)
    T.overwrite(o.select("o_orderkey", "o_orderpriority"), path)
    return spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("i10_partitioned_overwrite", "incident_year:i n:i", f"WITH {O.OD} SELECT incident_year, COUNT(*) AS n FROM od GROUP BY 1")
def partitioned_overwrite(spark, folder):
    path = new_folder(spark, "orders-by-year")
    T.overwrite(A.orders(spark, folder).select("incident_id", "initial_severity_level_code", "incident_year"), path, "incident_year")
    return spark.read.parquet(path).groupBy("incident_year").agg(F.count("*").alias("n"))


@query("i10_incremental_load", "incident_year:i stored_rows:i arrived_rows:i is_rewritten:b",
       f"""WITH {O.OD}, x AS (SELECT date_trunc('month', MAX(incident_date)) AS cut FROM od)
       SELECT incident_year, COUNT(*) AS stored_rows, COUNT(*) FILTER (WHERE incident_date >= cut) AS arrived_rows,
       COUNT(*) FILTER (WHERE incident_date >= cut) > 0 AS is_rewritten FROM od, x GROUP BY 1""")
def incremental_load(spark, folder):
    """A second load takes in the last month by the stored marks and writes only the partitions that got rows."""
    root, by, at = new_folder(spark, "orders-lake"), "incident_year", "incident_datetime"
    o = A.orders(spark, folder).select("incident_id", at, "initial_severity_level_code", by)
    cut = o.agg(F.trunc(F.max(F.to_date(at)), "month")).scalar()
    T.overwrite(o.filter(F.to_date(at) < cut), f"{root}/_staging/first", by)
    V.publish(spark, root, {"orders": f"{root}/_staging/first"})
    stored = V.read(spark, root, "orders")
    new = pin(INC.after_marks(o, INC.high_water(stored, by, at), by, at), "arrived")
    whole = stored.join(new.select(by).distinct(), by, "left_semi").unionByName(new)
    T.overwrite(whole, f"{root}/_staging/second", by)
    number = V.publish(spark, root, {"orders": f"{root}/_staging/second"}, partial=("orders",))
    folders = [(int(p.split("=")[1]), f"/v-{number:012d}-" in f"/{f.split('/')[1]}") for p, f in V.manifest(spark, root)["orders"].items()]
    rows = V.read(spark, root, "orders").groupBy(by).agg(F.count("*").alias("stored_rows"))
    arrived = new.groupBy(by).agg(F.count("*").alias("arrived_rows"))
    return (rows.join(T.literal_table(spark, folders, f"{by} int, is_rewritten boolean"), by).join(arrived, by, "left")
            .withColumn("arrived_rows", F.coalesce("arrived_rows", F.lit(0))))


@query("i11_append_audit", "run:s event_rows:i records:i", "SELECT 'run-' || r.range AS run, (SELECT COUNT(*) FROM events) AS event_rows, 1 AS records FROM range(2) r")
def append_audit(spark, folder):
    """Two runs, of which the second is repeated: the log holds each once."""
    path = new_folder(spark, "audit")
    rows = T.table(spark, folder, "events").agg(F.count("*").alias("event_rows"))
    for run in ("run-0", "run-1", "run-1"):
        V.append_once(rows, path, run, "run")
    return V.read_log(spark, path, "run").groupBy("run", "event_rows").agg(F.count("*").alias("records"))


@query("i12_read_back", "incident_year:i expected_rows:i stored_rows:i same_values:b status:s",
       f"""WITH {O.OD}, x AS (SELECT MIN(incident_id) AS lost, MAX(incident_id) AS changed FROM od),
       g AS (SELECT incident_year, COUNT(*) AS expected_rows, COUNT(*) FILTER (WHERE incident_id <> lost) AS stored_rows, COUNT(*) FILTER (WHERE incident_id = changed) AS touched FROM od, x GROUP BY 1)
       SELECT *, expected_rows = stored_rows AND touched = 0 AS same_values,
       CASE WHEN expected_rows <> stored_rows THEN 'ROWS DIFFER' WHEN touched > 0 THEN 'VALUES DIFFER' ELSE 'PASS' END AS status FROM g""")
def read_back(spark, folder):
    """One row is lost on the way into the table and one value changed."""
    path = new_folder(spark, "read-back")
    o = A.orders(spark, folder).select("incident_id", "initial_severity_level_code", "o_totalprice", "incident_year")
    ends = o.agg(F.min("incident_id").alias("lost"), F.max("incident_id").alias("changed"))
    lost, changed = (ends.select(c).scalar() for c in ("lost", "changed"))
    faulty = o.filter(F.col("incident_id") != lost).withColumn("o_totalprice", F.when(F.col("incident_id") == changed, 0.0).otherwise(F.col("o_totalprice").cast("double")))
    T.overwrite(faulty.withColumn("o_totalprice", F.col("o_totalprice").cast(o.schema["o_totalprice"].dataType)), path, "incident_year")
    return QC.read_back(o, spark.read.parquet(path), "incident_year")


@query("i13_storage_detail", "incident_year:i format:s partition_columns:s n_rows:i n_files:i bytes_are_counted:b",
       f"""WITH {O.OD} SELECT incident_year, 'parquet' AS format, 'incident_year' AS partition_columns, COUNT(*) AS n_rows, 2 AS n_files, COUNT(*) > 0 AS bytes_are_counted FROM od GROUP BY 1""")
def storage_detail(spark, folder):
    """Two files a year, one for each half of the orders, whose sizes are seen a second time by a scan of the rows."""
    path = new_folder(spark, "detail")
    o = A.orders(spark, folder).select("incident_id", "incident_year")
    for half in (0, 1):
        part = o.filter(F.pmod(F.xxhash64("incident_id"), F.lit(2)) == half)
        part.coalesce(1).write.mode("append").partitionBy("incident_year").parquet(path)
    seen = spark.read.parquet(path).select("incident_year", "_metadata.file_path", "_metadata.file_size").distinct()
    seen = seen.groupBy(F.col("incident_year").cast("string").alias("incident_year")).agg(F.sum("file_size").alias("seen_bytes"))
    return T.storage_detail(spark, path, "incident_year").join(seen, "incident_year").withColumn("bytes_are_counted", F.col("n_bytes") == F.col("seen_bytes"))


@query("i14_preview", "incident_id:s incident_datetime:d borough:s",
       f"WITH {O.EV} SELECT * FROM ev ORDER BY incident_datetime DESC, incident_id LIMIT 20")
def preview(spark, folder):
    return A.event_view(spark, folder).orderBy(F.col("incident_datetime").desc(), "incident_id").limit(20)


@query("i15_range_load", "o_orderkey:i o_orderdate:d", """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def range_load(spark, folder):
    o = T.half_open(T.table(spark, folder, "orders"), "o_orderdate", "1997-01-01", "1998-01-01")
    return o.select("o_orderkey", "o_orderdate").orderBy("o_orderdate", "o_orderkey")
