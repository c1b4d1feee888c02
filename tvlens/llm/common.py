"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tvlens.session import ensure_checkpoint_dir

#: A word is a run of characters other than the six ASCII white-space ones.
WORD_GAP = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order (NULL and empty text: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    A plain column of an earlier projection may be pasted by the optimiser
    into every place that uses it, lambdas included; a bound variable is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (NULL id: text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder of ``spark.checkpoint.dir``.

    Used where a second pass would otherwise recompute a Python stage, and in
    loops.  The files survive lost executors; Spark removes them with the
    frame when ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_and_tidy(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for loops: the shuffle files of ``df`` go as soon as its
    checkpoint is written."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return cut_lineage(df.select("*"))  # a plan that is made under the setting
    finally:
        conf.set(key, before)


def discard(*cut: DataFrame) -> None:
    """Delete the checkpoints of frames of ``cut_lineage`` that are not read again.

    Spark's cleaner would do so at some collection of the driver's heap."""
    for df in cut:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return freed memory of this Python worker to the system, where the C
    library can; a worker lives on after its task, next to others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, max_rows: int, max_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds at most ``max_rows`` rows and,
    unless one text alone is longer, ``max_bytes`` of text.  No row is lost."""
    for batch in batches:
        sizes = [0 if n is None else n for n in pa.compute.binary_length(batch.column(column)).to_pylist()]
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > max_bytes or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start, len(sizes) - start)
