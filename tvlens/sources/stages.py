"""Staged tables with a life.

``CREATE OR REPLACE TABLE TEMP_x ... ; DROP TABLE x`` as a block: tables staged
inside ``with Stages(spark) as stages`` are folders of one owner under the
shared checkpoint folder, and go when the block ends, with or without an error.
A stage shared by several readers goes when its last reader has let go.  What a
killed driver left behind is found by its owner's folder name and removed by
the next sweep.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from tvlens.session import ensure_checkpoint_dir
from tvlens.sources.versions import _file_system, _path, listing

FOLDER = "stages"


def stage_root(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "tables", FOLDER)


class Stages:
    """The staged tables of one block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        #: Folder of this block: who made it, when, and a name of its own.
        owner = f"{spark.sparkContext.applicationId}_{int(time.time())}_{uuid.uuid4().hex}"
        self.folder = os.path.join(stage_root(spark), owner)
        self.readers: dict[str, int] = {}

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *error) -> None:
        _remove(self.spark, self.folder)
        self.readers.clear()

    def stage(self, df: DataFrame, name: str, readers: int = 1) -> DataFrame:
        """Write ``df`` once and read it back; it goes after ``readers`` calls of :meth:`done`."""
        path = os.path.join(self.folder, name)
        if self.readers.get(name):
            raise ValueError(f"stage {name} exists")
        df.write.parquet(path)
        self.readers[name] = readers
        return self.spark.read.schema(df.schema).parquet(path)

    def done(self, name: str) -> None:
        """One reader of a stage is done; after the last one its folder goes."""
        self.readers[name] -= 1
        if self.readers[name] <= 0:
            del self.readers[name]
            _remove(self.spark, os.path.join(self.folder, name))


def _remove(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def sweep(spark: SparkSession, older_than_s: float = 7 * 24 * 3600) -> list[str]:
    """Remove the folders of blocks that began longer ago than any job runs
    (or of this application, whose blocks all end with it, never)."""
    root, gone = stage_root(spark), []
    for name, _, _ in listing(spark, root):
        application, _, rest = name.rpartition("_")[0].rpartition("_")
        if application == spark.sparkContext.applicationId or not rest.isdigit():
            continue
        if time.time() - int(rest) > older_than_s:
            _remove(spark, os.path.join(root, name))
            gone.append(name)
    return gone
