"""Incremental, restartable ingestion with Structured Streaming (ST1-ST3).

New files are picked up by a file-source stream, transformed in ``foreachBatch`` and
written to a bronze folder of their own, ``run=<checkpoint>/batch=<epoch>``, which a
retried batch overwrites. A second checkpoint over the same files writes the same
rows under another run; ``read_bronze`` keeps what was stored last of each page, so a
replay adds nothing.

``merge_batches`` keeps silver beside bronze: each batch's bronze rows become registers that
are merged into a versioned table, whose untouched buckets stay as they are. The table
holds the number of the last batch of each run, so a batch that is retried after its
commit, or after a crash before it, is merged once. Registers carry record order, so results
do not depend on how files fell into batches, nor on their order.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.operators import registers as reg
from folio.sinks.table import VersionedTable
from folio.sources.pages import page_of

PAGE_SCHEMA = "file_name STRING, xml STRING"


def checkpoint_dir(base: str, **params) -> str:
    """A checkpoint folder named by the run's parameters: a run with other
    parameters never resumes from this one's progress."""
    told = ";".join(f"{k}={params[k]}" for k in sorted(params))
    return f"{base.rstrip('/')}/{hashlib.sha256(told.encode()).hexdigest()[:16]}"


def raw_pages(stream: DataFrame) -> DataFrame:
    """Rows ``(value, page)`` of a whole-text scan as pages ``(file_name, xml)``."""
    return stream.select(F.col("page").alias("file_name"), F.trim("value").alias("xml"))


def run_to_bronze(
    spark: SparkSession,
    source_dir: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    bronze_dir: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    wholetext: bool = False,
    then: Callable[[DataFrame, str, int], None] | None = None,
) -> None:
    """Process every file in ``source_dir`` not seen by ``checkpoint`` and write the
    transformed rows below ``bronze_dir``. Files are Parquet, or with ``wholetext``
    one raw page each, named by its file or in folders ``page=<name>``. ``then(rows, run,
    batch)`` gets the bronze rows of each batch once they are stored.

    ``trigger(availableNow=True)`` drains what is there in (possibly several)
    micro-batches and stops, so the same code serves a scheduled batch run
    and a continuous deployment (swap the trigger).
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if wholetext:
        src = reader.text(source_dir, wholetext=True).withColumn(
            "page", page_of(F.col("_metadata.file_path")))
    else:
        src = reader.parquet(source_dir)
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        path = f"{bronze_dir}/run={run}/batch={epoch_id}"
        rows = transform(batch).withColumn("stored_at", F.current_timestamp())
        rows.write.mode("overwrite").parquet(path)
        if then:
            then(spark.read.schema(rows.schema).parquet(path).drop("stored_at"), run, epoch_id)

    with small_files(spark) if wholetext else contextlib.nullcontext():
        q = (
            src.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()


@contextlib.contextmanager
def small_files(spark: SparkSession):
    """While it holds, a listing takes a few tasks a core, not one a path up to 10,000, and a
    file counts little besides its bytes, so that a task reads more than 32 of them."""
    put = {"spark.sql.sources.parallelPartitionDiscovery.parallelism":
           str(4 * spark.sparkContext.defaultParallelism),
           "spark.sql.files.openCostInBytes": str(64 << 10)}
    before = {name: spark.conf.get(name, None) for name in put}
    try:
        for name, value in put.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def merge_batches(table: VersionedTable, registers_of: Callable[[DataFrame], DataFrame],
                  keys_of: Callable[[DataFrame], DataFrame]
                  ) -> Callable[[DataFrame, str, int], None]:
    """For ``run_to_bronze(then=...)``: merges the registers of every batch into ``table``."""
    key, = table.key

    def then(rows: DataFrame, run: str, batch: int) -> None:
        table.merge(registers_of(rows), lambda old, new: reg.merge(old, new, key), run, batch,
                    keys_of(rows))

    return then


def read_bronze(spark: SparkSession, bronze_dir: str, key: list[str]) -> DataFrame:
    """The bronze rows of all runs, one per ``key``. The first column of ``key`` names what is
    stored as a whole (a page): of one stored again, the last store counts."""
    stored = F.struct("stored_at", "run", "batch")
    last = F.max(stored).over(Window.partitionBy(key[0]))
    return spark.read.parquet(bronze_dir).withColumn("_last", last).where(
        stored == F.col("_last")).drop("run", "batch", "stored_at", "_last").dropDuplicates(key)
