"""Delimited raw files: fixed-schema scan, lineage, mapping files, file profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.functions import blank_to_null
from beaconry.functions import exprs as X
from beaconry.session import streamed_writes
from beaconry.sources.tables import list_files

# The raw incident layout, in file order.
RAW_COLUMNS = """
incident_id incident_datetime initial_call_type initial_severity_level_code final_call_type
final_severity_level_code first_assignment_datetime valid_dispatch_rspns_time_indc
dispatch_response_seconds_qy first_activation_datetime first_on_scene_datetime
valid_incident_rspns_time_indc incident_response_seconds_qy incident_travel_tm_seconds_qy
first_to_hosp_datetime first_hosp_arrival_datetime incident_close_datetime held_indicator
incident_disposition_code borough incident_dispatch_area zipcode policeprecinct
citycouncildistrict communitydistrict communityschooldistrict congressionaldistrict
reopen_indicator special_event_indicator standby_indicator transfer_indicator
""".split()


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw(spark: SparkSession, path: str, columns=RAW_COLUMNS, mode: str = "FAILFAST") -> DataFrame:
    """Scan raw CSV under a fixed all-text schema and add lineage columns.

    The header must match the schema (``enforceSchema=false``), and a malformed
    line stops the job in FAILFAST mode.  File path, year folder and load time
    come from the scan itself.
    """
    df = (spark.read.schema(text_schema(columns))
          .option("header", True).option("enforceSchema", False).option("mode", mode).csv(path))
    return df.select("*", "_metadata.file_path").select(
        *columns, F.col("file_path").alias("_source_file"),
        F.regexp_extract("file_path", r"year=(\d{4})", 1).try_cast("int").alias("_source_year"),
        F.current_timestamp().alias("_ingested_at"))


def read_mapping(spark: SparkSession, path: str, code: str, text: str) -> DataFrame:
    """Code/description CSV: no type inference, codes trimmed and upper-cased."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(F.upper(F.trim(code)).alias(code), F.trim(text).alias(text))


def write_raw(df: DataFrame, path: str, by: str) -> None:
    """Write text columns as headed CSV in ``by=value`` folders.

    ``by`` stays in the folder name only, so the files keep the fixed layout.
    Every task writes its own rows as they come, a file for each folder it
    meets: no shuffle and no sort holds them.
    """
    with streamed_writes(df.sparkSession):
        (df.write.partitionBy(by)
         .option("header", True).option("emptyValue", "").option("nullValue", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def file_inventory(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """Expected against found files per year; ``expected(year, expected_files)``."""
    found = (list_files(spark, root, ".csv").groupBy(F.regexp_extract("file_path", r"year=(\d{4})", 1).try_cast("int").alias("year"))
             .agg(F.count("*").alias("actual_files")))
    return (expected.join(found, "year", "full")
            .select("year", F.coalesce("expected_files", F.lit(0)).alias("expected_files"),
                    F.coalesce("actual_files", F.lit(0)).alias("actual_files"))
            .withColumn("status", F.when(F.col("expected_files") == F.col("actual_files"), "PASS").otherwise("FAIL")))


def file_profile(spark: SparkSession, root: str, columns=RAW_COLUMNS, expected: DataFrame | None = None) -> DataFrame:
    """Rows, columns and a status per raw text file.

    The first line of a file, found by its position in the file, is its header;
    blank lines are no rows. Lines are counted in one grouped pass, so a single
    large file is still read by many tasks; of a line only numbers go into it, so
    that it is no sort of all lines. ``expected(file_path)`` names the files
    that should be there, and brings in missing ones. The first rule that holds
    gives the status: missing, empty, blank header, column count, header text, no
    rows.
    """
    header = ",".join(columns)
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root)
             .select("value", F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("at"),
                     (F.col("_metadata.file_block_start") == 0).alias("front")))
    blank = F.trim("value") == ""
    fields = F.length("value") - F.length(F.replace("value", F.lit(","))) + 1
    shape = F.when(blank, 0).otherwise(fields * 2 + (F.col("value") == header).cast("int"))  # of a line that may be the header
    counted = lines.groupBy("file_path").agg(
        F.count_if(~blank).alias("filled"), F.min_by(F.when(F.col("front"), shape), F.when(F.col("front"), F.col("at"))).alias("shape"))
    out = list_files(spark, root, ".csv").join(counted, "file_path", "left")
    if expected is not None:
        out = out.join(expected.select("file_path").withColumn("_wanted", F.lit(True)), "file_path", "full").drop("_wanted")
    has_header = F.coalesce("shape", F.lit(0)) != 0
    out = out.withColumns({
        "column_count": F.when(has_header, F.shiftright("shape", 1)),
        "header_ok": F.coalesce(F.col("shape") % 2 == 1, F.lit(False)),
        "data_rows": F.coalesce(F.col("filled") - has_header.cast("int"), F.lit(0))}).drop("filled", "shape")
    return out.withColumn("status", X.first_match([
        (F.col("file_bytes").isNull(), "MISSING_FILE"), (F.col("file_bytes") == 0, "EMPTY_FILE"), (F.col("column_count").isNull(), "BLANK_HEADER"),
        (F.col("column_count") != len(columns), "COLUMN_COUNT_MISMATCH"), (~F.col("header_ok"), "HEADER_MISMATCH"),
        (F.col("data_rows") == 0, "NO_DATA_ROWS")], "PASS"))


def yearly_expectation(bronze: DataFrame, expected: DataFrame, year: str, key: str) -> DataFrame:
    """Expected against actual rows and missing keys per year.

    ``expected(year, expected_rows)``; a year on one side only counts zero on the
    other.  Status passes when counts agree and no key is missing.
    """
    actual = bronze.groupBy(F.col(year).alias("year")).agg(
        F.count("*").alias("actual_rows"),
        F.count_if(blank_to_null(key).isNull()).alias("missing_ids"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("actual_rows", "expected_rows", "missing_ids")}
    return (actual.join(expected, "year", "full").withColumns(zero)
            .withColumn("row_difference", F.col("actual_rows") - F.col("expected_rows"))
            .withColumn("status", F.when((F.col("row_difference") == 0) & (F.col("missing_ids") == 0), "PASS").otherwise("FAIL")))


