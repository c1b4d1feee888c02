"""Tables that are replaced or appended to as a whole.

A table is a folder with data folders and small numbered records
(``_versions/000000000001.json``) that name the data folders of a version and
its schema.  A writer first writes its data into a new folder and then adds the
next record by a rename that fails if the record exists; so

* a reader sees a version or the next one, never a half-written table;
* a reader keeps the files it opened: replacing deletes nothing, only
  :func:`vacuum` does;
* a failed write adds no record and leaves the table as it was;
* of two writers at a time, the one that comes second builds on the other's
  record (an append keeps the other's rows).

Records are read and written through Spark's own file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RECORDS = "_versions"
#: Data folders look like partitions, so that several are read as one table.
FOLDER = "_set"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time) of a file, or of the files of a folder, sorted; [] if missing."""
    fs, at = _file_system(spark, path), _path(spark, path)
    if not fs.exists(at):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(at))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions there are, oldest first."""
    names = (name for name, _, _ in listing(spark, f"{path}/{RECORDS}"))
    return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]


def _record_path(path: str, version: int) -> str:
    return f"{path}/{RECORDS}/{version:012d}.json"


def record(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The record of a version (default: the latest one); None if there is none."""
    version = version or max(versions(spark, path), default=None)
    if version is None:
        return None
    stream = _file_system(spark, path).open(_path(spark, _record_path(path, version)))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) | {"version": version}


def _add_record(spark: SparkSession, path: str, version: int, content: dict) -> bool:
    """Add a record under its number; False if another writer was first."""
    fs = _file_system(spark, path)
    draft, final = _path(spark, f"{path}/{RECORDS}", f".{uuid.uuid4().hex}"), _path(spark, _record_path(path, version))
    out = fs.create(draft, True)
    out.write(json.dumps(content).encode())
    out.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kept = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(draft, final, kept)
        return True
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise


def _commit(df: DataFrame, path: str, partition_by: Sequence[str], mode: str, note: str | None) -> int:
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"{FOLDER}={uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{path}/{folder}")
    while True:
        last = record(spark, path)
        if mode == "append" and last and last["schema"] != df.schema.jsonValue():
            raise ValueError(f"columns differ from those of {path}")
        folders = [*(last["folders"] if last and mode == "append" else []), folder]
        version = (last["version"] if last else 0) + 1
        if _add_record(spark, path, version, {"folders": folders, "schema": df.schema.jsonValue(), "note": note}):
            return version


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), note: str | None = None) -> int:
    """``CREATE OR REPLACE TABLE path AS df``; returns the new version."""
    return _commit(df, path, partition_by, "replace", note)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), note: str | None = None) -> int:
    """``CREATE TABLE IF NOT EXISTS path; INSERT INTO path`` in one step."""
    return _commit(df, path, partition_by, "append", note)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version (default: the latest one)."""
    path = path.rstrip("/")
    held = record(spark, path, version)
    if held is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = StructType.fromJson(held["schema"])
    folders = [f"{path}/{f}" for f in held["folders"]]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*[f"`{n}`" for n in schema.names])


def name_version(spark: SparkSession, path: str, name: str) -> int:
    """Create or replace the permanent view ``name`` over the latest version,
    so that SQL of any session finds the table by name; returns the version.

    The view is switched by the catalog in one step; it stays on its version
    until it is named anew.
    """
    path = path.rstrip("/")
    held = record(spark, path)
    if held is None:
        raise FileNotFoundError(f"no table at {path}")
    fields = StructType.fromJson(held["schema"]).fields
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
    parts = [f"SELECT {columns} FROM parquet.`{path}/{folder}`" for folder in held["folders"]]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + " UNION ALL ".join(parts))
    return held["version"]


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete all but the last ``keep`` versions and the folders only they, or
    failed writes, have; returns the folders' names.  Not while readers of
    older versions or writers are at work."""
    path, fs = path.rstrip("/"), _file_system(spark, path)
    numbers = versions(spark, path)
    kept = {f for v in numbers[-keep:] for f in record(spark, path, v)["folders"]}
    gone = [name for name, _, _ in listing(spark, path) if name.startswith(f"{FOLDER}=") and name not in kept]
    for version in numbers[:-keep]:
        fs.delete(_path(spark, _record_path(path, version)), False)
    for name in gone:
        fs.delete(_path(spark, path, name), True)
    return gone
