"""Tables that are replaced together, and records that are written once.

A version of a table is a folder that is never changed.  A manifest, one small
file, names for every table the folder of each of its partitions; readers look
there.  Several tables are exchanged by one rename of the next manifest into place,
so a reader sees all of them old or all of them new, whenever a load stops.  A load
that makes a few partitions anew publishes these; the others keep their folders.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename without replacing; ``False`` if the target is there already."""
    a, fs = _fs(spark, source)
    b, _ = _fs(spark, target)
    if fs.exists(b):
        return False
    fs.mkdirs(b.getParent())
    return fs.rename(a, b)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder, fs = _fs(spark, f"{root}/_manifest")
    if not fs.exists(folder):
        return []
    names = [str(s.getPath().getName()) for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


Tables = dict[str, dict[str, str]]  # table: partition folder name (empty if not partitioned): version folder


def _named(spark: SparkSession, root: str, number: int) -> Tables:
    path, fs = _fs(spark, f"{root}/_manifest/{number:012d}.json")
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def manifest(spark: SparkSession, root: str) -> Tables:
    """The current folders of each table under ``root``."""
    numbers = _numbers(spark, root)
    return _named(spark, root, numbers[-1]) if numbers else {}


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a table."""
    found = manifest(spark, root)
    if name not in found:
        raise FileNotFoundError(f"no table {name} under {root}")
    by_folder: dict[str, list[str]] = {}
    for part, folder in found[name].items():
        by_folder.setdefault(folder, []).append(part)
    frames = [spark.read.option("basePath", f"{root}/{folder}").parquet(*[f"{root}/{folder}/{p}".rstrip("/") for p in sorted(parts)])
              for folder, parts in sorted(by_folder.items())]
    return reduce(lambda a, b: a.unionByName(b), frames)


def publish(spark: SparkSession, root: str, staged: dict[str, str], partial=(), keep: int = 2) -> int:
    """Make the staged folders the current versions of their tables, all at once; returns the number of the manifest.

    Folders move first, where nobody looks for them; the manifest that names
    them follows in one rename.  If another load published in between, this one
    stops and changes nothing.  Of tables named in ``partial`` only the staged
    partitions are replaced.  Of the older versions those of the last ``keep``
    manifests stay for readers that began before.
    """
    number = (_numbers(spark, root) or [0])[-1] + 1
    tables = manifest(spark, root)
    for name, path in staged.items():
        folder = f"{name}/v-{number:012d}-{uuid.uuid4().hex[:8]}"
        if not _move(spark, path, f"{root}/{folder}"):
            raise OSError(f"could not move {path}")
        at, fs = _fs(spark, f"{root}/{folder}")
        parts = [n for n in (str(s.getPath().getName()) for s in fs.listStatus(at)) if "=" in n]
        new = {p: folder for p in parts or [""]}
        tables[name] = tables.get(name, {}) | new if name in partial else new
    draft, fs = _fs(spark, f"{root}/_manifest/draft-{uuid.uuid4().hex}")
    fs.mkdirs(draft.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(tables, indent=1).encode()))
    out.close()
    if not _move(spark, draft.toString(), f"{root}/_manifest/{number:012d}.json"):
        raise OSError(f"manifest {number} of {root} was written by another load")
    _forget(spark, root, keep)
    return number


def _forget(spark: SparkSession, root: str, keep: int) -> None:
    """Delete manifests beyond the last ``keep`` and the folders that none of those names."""
    numbers = _numbers(spark, root)
    folders = lambda n: {folder for parts in _named(spark, root, n).values() for folder in parts.values()}
    named = set().union(*map(folders, numbers[-keep:]))
    for n in numbers[:-keep]:
        for folder in folders(n) - named:
            path, fs = _fs(spark, f"{root}/{folder}")
            fs.delete(path, True)
        path, fs = _fs(spark, f"{root}/_manifest/{n:012d}.json")
        fs.delete(path, False)


def append_once(df: DataFrame, path: str, run_id: str, column: str = "audit_run_id") -> bool:
    """Add the rows of a run to a log that holds every run once; ``False`` if the run is in it already.

    Rows are written aside and become the folder ``column=run_id`` of the log in
    one rename.  A run that is repeated, or one that stopped while it wrote, adds
    nothing twice and leaves nothing half.
    """
    spark = df.sparkSession
    target = f"{path}/{column}={run_id}"
    if _fs(spark, target)[1].exists(_fs(spark, target)[0]):
        return False
    aside = f"{path}/_writing/{uuid.uuid4().hex}"
    df.drop(column).write.parquet(aside)
    if _move(spark, aside, target):
        return True
    p, fs = _fs(spark, aside)
    fs.delete(p, True)
    return False


def read_log(spark: SparkSession, path: str, column: str = "audit_run_id") -> DataFrame:
    """A log of :func:`append_once`, run ids as text."""
    df = spark.read.option("recursiveFileLookup", False).parquet(path)
    return df.withColumn(column, df[column].cast("string"))
