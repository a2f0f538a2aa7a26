"""Connected components of an edge table by min-label propagation with pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import release, staged


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(u, c)`` for every node of the edges ``(a, b)``: ``c`` is the least node connected
    with ``u``. Each round takes the least label around a node, then the label of that
    label, so chains halve; the rounds go on until no label changes."""
    both = staged(spark, edges.select("a", "b").union(edges.select("b", "a")).distinct(), "cc")
    labels = staged(spark, both.groupBy(F.col("a").alias("u")).agg(
        F.least(F.min("b"), F.first("a")).alias("c")), "cc")
    while True:
        around = both.join(labels, both["b"] == labels["u"]).groupBy(F.col("a").alias("u")).agg(
            F.min("c").alias("m"))
        lower = labels.join(around, "u").select("u", "c", F.least("c", "m").alias("m"))
        up = labels.select(F.col("u").alias("m"), F.col("c").alias("top"))
        new = staged(spark, lower.join(up, "m").select(
            "u", F.least("m", "top").alias("c"), (F.col("c") != F.least("m", "top")).alias("moved")),
            "cc")
        labels = new.select("u", "c")
        if not new.where("moved").limit(1).count():
            release(spark)
            return labels
