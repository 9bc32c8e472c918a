"""A table in versions (K2): a rewrite that fails leaves the last version as it was.

``path/data/<id>`` holds one version's files, ``path/manifest/<number>`` names the
folder of a version and is created last, once the folder is whole. Readers go
by the highest complete manifest. So a table can be rewritten from itself, a run
that is stopped leaves a folder that nobody reads, and readers of the old
version keep their files until ``prune``.

A manifest is created exclusively: of two writers of one number the second fails
instead of hiding the first's version. That holds on file systems with exclusive
create (HDFS, local); on a store without it, one writer at a time is up to the caller.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.session import remove_path
from ledgerline.sinks import files

DATA, MANIFEST = "data", "manifest"


def _fs(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop client."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def begin(path: str) -> str:
    """A folder for the files of a new version; nobody reads it before ``commit``."""
    return f"{path.rstrip('/')}/{DATA}/{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, data: str, about: dict | None = None) -> int:
    """Make ``data`` (from ``begin``) the current version. Returns its number."""
    number = max((n for n, _ in manifests(spark, path)), default=0) + 1
    fs, at = _fs(spark, f"{path.rstrip('/')}/{MANIFEST}/{number:012d}")
    entry = {"data": data.rstrip("/").rpartition("/")[2], **(about or {})}
    out = fs.create(at, False)   # fails if it is there
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()
    return number


def manifests(spark: SparkSession, path: str) -> list[tuple[int, dict | None]]:
    """(number, entry) of all manifests, latest first; the entry of an incomplete one is None."""
    fs, at = _fs(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if not fs.exists(at):
        return []
    read, found = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString, []
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if not name.isdigit():
            continue
        stream = fs.open(status.getPath())
        try:
            entry = json.loads(read(stream, "UTF-8"))
        except ValueError:
            entry = None   # its writer was stopped, or is writing
        finally:
            stream.close()
        found.append((int(name), entry))
    return sorted(found, key=lambda m: -m[0])


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version, None if there is none."""
    for _, entry in manifests(spark, path):
        if entry is not None:
            return f"{path.rstrip('/')}/{DATA}/{entry['data']}"
    return None


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The current version; it stays the one that is read if another is committed meanwhile."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no version of a table in {path}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        reader = reader.options(**files.CSV_EXACT_READ)
    found = reader.format(fmt).load(folder)
    return found.select(*schema.names) if schema is not None else found


def write_version(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = "order_year_month",
                  rebalance: bool = True) -> int:
    """K2 as a new version of the table in ``path``. Returns its number."""
    folder = begin(path)
    files.write_processed(df, folder, fmt, partition_by, rebalance)
    return commit(df.sparkSession, path, folder, {"format": fmt})


def prune(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the folders and manifests of all but the last ``keep`` versions, and the manifests that
    were never finished before them. Folders without a manifest stay: a writer may be at work in
    them. Returns the names of the folders removed."""
    if keep < 1:
        raise ValueError("at least the current version is kept")
    whole = [(n, e) for n, e in manifests(spark, path) if e is not None]
    if len(whole) <= keep:
        return []
    last, stay = whole[keep - 1][0], {e["data"] for _, e in whole[:keep]}
    gone = []
    for number, entry in manifests(spark, path):
        if number >= last:
            continue
        # the manifest first: a reader that finds it finds its files
        remove_path(spark, f"{path.rstrip('/')}/{MANIFEST}/{number:012d}")
        if entry is not None and entry["data"] not in stay:
            remove_path(spark, f"{path.rstrip('/')}/{DATA}/{entry['data']}")
            gone.append(entry["data"])
    return gone
