"""Columnar sources and sinks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


_SCHEMAS: dict[tuple[str, str], tuple[int, T.StructType]] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one parquet table; pruning and pushdown are left to Catalyst.

    Its schema is kept for as long as the table is not written again, so that a
    query does not start a job for the footer of each table it names.
    """
    path = f"{folder.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    changed = last_change(spark, folder, name)
    if key not in _SCHEMAS or _SCHEMAS[key][0] != changed:
        _SCHEMAS[key] = (changed, spark.read.parquet(path).schema)
    return spark.read.schema(_SCHEMAS[key][1]).parquet(path)


def last_change(spark: SparkSession, folder: str, name: str) -> int:
    """When a table was last written, in milliseconds; kept results of an older table are stale."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime()


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small fixed table from tuples.

    It is built from Arrow data and thereby becomes a local relation: Catalyst
    knows its size and broadcasts it, where a table made from Python rows has no
    size and would make the other side of a join shuffle.
    """
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows))
    data = pa.table({f.name: pa.array(list(c), to_arrow_type(f.dataType)) for f, c in zip(fields, columns)})
    return spark.createDataFrame(data, fields)


def number_range(spark: SparkSession, lo: int, hi: int, name: str) -> DataFrame:
    return spark.range(lo, hi).select(F.col("id").cast("int").alias(name))


def overwrite(df: DataFrame, path: str, partition_by: str | None = None, rebalance: bool = True) -> None:
    """Replace a table, optionally one folder per partition value.

    Rows that come in any order are first rebalanced by the partition column:
    each folder gets files of the advisory size, and a value that holds a large
    share of the rows is split over several tasks instead of landing in one.
    Pass ``rebalance=False`` when the input already lies in the same folders, so
    that no shuffle of the whole table is paid for.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    if rebalance:
        df = df.hint("rebalance", F.col(partition_by))
    df.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace only the partitions that the frame has rows of; all others stay as they are."""
    df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """Path and size of the files under a folder.

    A listing, not a scan: the content column is never asked for, so no file is
    opened.  Scans skip files of zero bytes; the names that the file index holds
    on the driver in any case bring those back.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root)
    sizes = files.select(F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_bytes"))
    # The index writes local names as file:///x, scans as file:/x.
    names = literal_table(spark, [(n.replace("file:///", "file:/"),) for n in files.inputFiles()], "file_path string")
    return names.join(sizes, "file_path", "left").withColumn("file_bytes", F.coalesce("file_bytes", F.lit(0)))


def storage_detail(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """Format, partition columns, files and bytes per partition folder, and the rows stored there."""
    folders = F.regexp_extract_all("file_path", F.lit("/([^/=]+)=[^/]*(?=/)"), 1)
    files = list_files(spark, path, ".parquet").groupBy(
        F.regexp_extract("file_path", f"/{partition_by}=([^/]*)/", 1).alias(partition_by)).agg(
        F.count("*").alias("n_files"), F.sum("file_bytes").alias("n_bytes"),
        F.max(F.regexp_extract("file_path", r"\.([a-z]+)$", 1)).alias("format"), F.max(F.array_join(folders, ",")).alias("partition_columns"))
    rows = spark.read.parquet(path).groupBy(F.col(partition_by).cast("string").alias(partition_by)).agg(F.count("*").alias("n_rows"))
    return files.join(rows, partition_by, "left")


def latest(df: DataFrame, by: str, n: int = 1, ties=()) -> DataFrame:
    """Most recent record(s) by a timestamp; of equally recent ones the first in the order of ``ties``."""
    return df.orderBy(F.col(by).desc(), *ties).limit(n)


def half_open(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= ts < end``; reaches the scan as a pushed filter."""
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))
