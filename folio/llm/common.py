"""Helpers shared by the operators: staging, word patterns, Arrow batches."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from folio.session import new_work_dir

#: Rows of an Arrow batch.
ARROW_ROWS = 1000


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs the tasks that ran on it, never a
    recomputation of what was written. The folder is shared scratch space.
    """
    bound_batches(spark)
    path = new_work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """From now on at most ``ARROW_ROWS`` rows go to a Python worker at once: rows are texts,
    and a batch of the default 10,000 is held several times over while it is passed on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def release(spark: SparkSession) -> None:
    """Broadcasts and shuffles that nothing refers to any more leave the executors once the
    driver's collector has seen them go; in a job of many rounds it is asked to look."""
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Memory that this worker has freed goes back to the machine: workers are kept between
    tasks, and what they hold adds up on an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        return


def texts_of(column) -> list[str]:
    """A string column as Python strings; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def slices(sizes: np.ndarray, limit: int):
    """(start, end) runs of consecutive rows whose sizes sum to about ``limit``;
    a larger row is alone in its run."""
    start, held = 0, 0
    for i, s in enumerate(sizes):
        if held and held + s > limit:
            yield start, i
            start, held = i, 0
        held += int(s)
    if start < len(sizes):
        yield start, len(sizes)


def text_runs(batches, column: str, limit: int):
    """Arrow batches cut into pieces with about ``limit`` bytes of ``column``,
    so what a Python worker holds does not depend on the rows' lengths."""
    give_back()
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        size = pa.compute.fill_null(pa.compute.binary_length(col), 0)
        for a, b in slices(size.to_numpy(zero_copy_only=False), limit):
            yield batch.slice(a, b - a)
    give_back()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ..., start+length-1 of every run, concatenated."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(
        np.asarray(starts, dtype=np.int64) - first, lengths)
