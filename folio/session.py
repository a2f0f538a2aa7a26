"""Session construction, table access and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "folio") -> SparkSession:
    """A session configured the way every job here expects.

    ANSI stays on (the Spark 4 default): parsers use ``try_*`` functions, so a
    bad value becomes NULL instead of failing the stage. AQE coalesces the
    small shuffles of tiny scale factors and splits skewed ones at scale.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def work_dir(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables and stream checkpoints.

    On a cluster this is a subfolder of ``spark.checkpoint.dir`` (a shared
    filesystem every executor can read). Only when the setting is absent --
    tests, local runs -- do we create our own and register it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="folio-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return f"{base}/{name}"


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-before-used subfolder of the work folder."""
    import uuid

    return work_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the work folder and read back: computed once, lineage cut."""
    path = new_work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
