"""Cached harvest pages on a filesystem.

One file per page, named ``<prefix>_<set>_<offset:06d>.xml``. The scan is a
single multi-path ``text`` read with ``wholetext`` (one row per file), so a
directory of a million pages is planned as ordinary file splits, never a
driver-side loop over names.
"""

from __future__ import annotations

import bz2
import gzip
import itertools
import os
import re
import zlib
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_pages(spark: SparkSession, path: str, prefix: str = "oai_dc",
               fallback_to_all: bool = True) -> DataFrame:
    """``(file_name, xml)`` for every ``<prefix>_*.xml`` page under ``path``.

    When no file carries the prefix, an oai_dc scan falls back to every
    ``*.xml`` (caches written before names carried a prefix); the rich format
    raises instead. Undecodable bytes are replaced, as the text source does.
    Order is not a property of a DataFrame: consumers order by ``file_name``.
    """
    glob = f"{prefix}_*.xml"
    if not _any_file(spark, path, glob):
        if not fallback_to_all:
            raise FileNotFoundError(f"no {prefix}_*.xml pages under {path}")
        glob = "*.xml"
    return (
        spark.read.format("text").option("wholetext", True)
        .option("pathGlobFilter", glob).load(path)
        .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("xml"))
    )


def _any_file(spark: SparkSession, path: str, glob: str) -> bool:
    """Whether a file below ``path`` has such a name; a listing, not a job."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path, glob)
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(pattern))


def scan_page_folders(spark: SparkSession, path: str, prefix: str = "oai_dc") -> DataFrame:
    """The same from a store of landed pages: files ``<file name>=<number>.gz`` (``land_pages``),
    or a folder ``page=<file name>`` for each, as distributed writers leave them."""
    mounted = scan_mounted(spark, path, "page")
    if mounted is not None:
        rows = mounted[0].withColumn("page", F.regexp_replace("page", LANDED, ""))
    else:
        rows = spark.read.option("basePath", path).text(path, wholetext=True)
    return rows.where(F.col("page").startswith(f"{prefix}_")).select(
        F.col("page").alias("file_name"), F.trim("value").alias("xml"))


#: What the folder names of partitions escape, and the name that stands for no value.
_ESCAPED = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


#: What follows the page's name in the name of a landed file.
LANDED = r"=[0-9]+-[0-9]+[.]gz$"
#: About how many bytes of files go on to Spark at once.
READ_BYTES = 4 << 20
_UNPACK = {".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress}


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The path in the file system where the store is mounted, None where it is not."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return root.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _visible(entries):
    """As Spark's listing: no hidden files, no files being copied."""
    return (e for e in entries if not (
        e.name.startswith(".") or e.name.endswith("._COPYING_")
        or e.name.startswith("_") and "=" not in e.name))


def scan_mounted(spark: SparkSession, path: str, key: str) -> tuple[DataFrame, bool] | None:
    """``(key, value)`` of the files in ``path``, one row a file, where the store is mounted:
    ``key`` is the file's name, or, of files in folders (then the second result is true), what
    the folder's name ``<key>=<value>`` tells. None where another layout is left to Spark.

    Spark's listing holds every file in the driver, about a kilobyte each. Here each task goes
    through the names of the folder and reads its share of the files, told by a hash of the
    name, so nothing grows with their number but the output.
    """
    base = _mounted(spark, path)
    if base is None or not os.path.isdir(base):
        return None
    folders = f"{key}="
    with os.scandir(base) as entries:
        first = next(_visible(entries), None)
    if first is None or first.is_dir() and not first.name.startswith(folders):
        return None
    in_folders = first.is_dir()
    tasks = max(4 * spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))

    def files(task):
        with os.scandir(base) as entries:
            for e in _visible(entries):
                if zlib.crc32(os.fsencode(e.name)) % tasks != task:
                    continue
                if not in_folders:
                    if e.is_file():
                        yield unquote(e.name), e.path
                    elif e.name.startswith(folders):
                        raise ValueError(f"{base} has files and folders {folders}")
                    continue
                if not e.name.startswith(folders):
                    raise ValueError(f"{base} has folders {folders} and others: {e.name}")
                told = e.name[len(folders):]
                with os.scandir(e.path) as parts:
                    for part in _visible(parts):
                        yield None if told == _NO_VALUE else unquote(told), part.path

    def batch(names, values):
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(values, pa.binary())], names=[key, "value"])

    def run(batches):
        for ids in batches:
            for task in ids.column(0).to_pylist():
                names, values, held = [], [], 0
                for name, file in files(task):
                    with open(file, "rb") as f:
                        value = f.read()
                    value = _UNPACK.get(os.path.splitext(file)[1], bytes)(value)
                    names.append(name)
                    values.append(value)
                    held += len(value)
                    if held >= READ_BYTES or len(names) >= 1000:
                        yield batch(names, values)
                        names, values, held = [], [], 0
                if names:
                    yield batch(names, values)

    rows = spark.range(0, tasks, 1, tasks).mapInArrow(run, f"{key} string, value binary")
    return rows.select(key, F.col("value").cast("string")), in_folders


def _folder_value(value) -> str:
    return _NO_VALUE if value is None or value == "" else _ESCAPED.sub(
        lambda m: f"%{ord(m[0]):02X}", str(value))


def land_pages(pages: DataFrame, path: str) -> None:
    """Raw pages ``(file_name, xml)`` one a file, packed: ``<file name>=<task>-<number>.gz``, so
    that pages which share a name stay files of their own and a retried task replaces what the
    lost one wrote. Where the store is not mounted, in folders ``page=<file name>``."""
    rows = pages.select(F.col("file_name").alias("page"), F.col("xml").alias("value"))
    base = _mounted(rows.sparkSession, path)
    if base is None:
        rows.write.option("compression", "gzip").partitionBy("page").text(path)
        return
    os.makedirs(base, exist_ok=True)

    def run(part):
        task = TaskContext.get()
        for told, same in itertools.groupby(part, key=lambda row: _folder_value(row[0])):
            for i, row in enumerate(same):
                name = f"{told}={task.partitionId()}-{i}.gz"
                unseen = os.path.join(base, f".{name}.{task.taskAttemptId()}")
                with open(unseen, "wb") as out:
                    out.write(gzip.compress((row[1] or "").encode() + b"\n", 1))
                os.replace(unseen, os.path.join(base, name))

    rows.sortWithinPartitions("page").foreachPartition(run)


def page_of(file: Column) -> Column:
    """The page's name by the path of its landed file, a URI: its escapes and the name's own."""
    def plain(told):
        return F.url_decode(F.replace(told, F.lit("+"), F.lit("%2B")))

    name = F.regexp_replace(plain(F.element_at(F.split(file, "/"), -1)), LANDED, "")
    folder = plain(F.regexp_extract(file, "/page=([^/]*)/[^/]*$", 1))
    told = F.when(folder != "", folder).otherwise(name)
    return F.when(told != _NO_VALUE, plain(told))


def land_folders(rows: DataFrame, path: str, line_sep: str = "\n") -> None:
    """Rows ``(key, value)`` as raw files in folders ``<key>=<its value>``, laid out as by
    ``write.partitionBy(key).text(path)``; ``line_sep`` ends each value.

    On a mounted file system Hadoop starts processes (``chmod``) for every file, folder
    and checksum and the driver moves the folders one by one, so the tasks write the files
    themselves there. A file appears whole, by a rename, under the name of its partition: a
    retried task replaces what the lost one wrote.
    """
    key = rows.columns[0]
    base = _mounted(rows.sparkSession, path)
    if base is None:
        rows.write.option("lineSep", line_sep).partitionBy(key).text(path)
        return
    os.makedirs(base, exist_ok=True)

    def folder_name(row):
        return f"{key}={_folder_value(row[0])}"

    def run(part):
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.txt"
        unseen = f".{name}.{task.taskAttemptId()}"
        for told, same in itertools.groupby(part, key=folder_name):
            folder = os.path.join(base, told)
            os.makedirs(folder, exist_ok=True)
            with open(os.path.join(folder, unseen), "wb") as out:
                for row in same:
                    out.write((row[1] or "").encode() + line_sep.encode())
            os.replace(os.path.join(folder, unseen), os.path.join(folder, name))

    rows.sortWithinPartitions(key).foreachPartition(run)


def scan_doc_text(spark: SparkSession, path: str) -> DataFrame:
    """Cached texts ``(thesis_id, raw)`` of files ``<id>.txt``, or of folders
    ``thesis_id=<id>``; files with another name are not texts."""
    mounted = scan_mounted(spark, path, "thesis_id")
    if mounted is not None:
        rows, in_folders = mounted
        name = F.col("thesis_id")
        stem = name if in_folders else F.regexp_extract(name, r"^([0-9]+)[.]txt$", 1)
        ids = stem.cast("bigint") if in_folders else stem.try_cast("bigint")
        found = rows.select(ids.alias("thesis_id"), F.col("value").alias("raw"))
        return found if in_folders else found.where(F.col("thesis_id").isNotNull())
    rows = spark.read.option("basePath", path).text(path, wholetext=True)
    if "thesis_id" in rows.columns:
        return rows.select(F.col("thesis_id").cast("bigint").alias("thesis_id"),
                           F.col("value").alias("raw"))
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^([0-9]+)[.]txt$", 1)
    return rows.select(stem.try_cast("bigint").alias("thesis_id"), F.col("value").alias("raw")
                       ).where(F.col("thesis_id").isNotNull())
