"""Uniform shuffle into shards of exact size by a hypergeometric matrix.

How many rows of source partition p go to shard s is drawn first: row by row a
multivariate hypergeometric split of the places still free in the shards, which
is the law of a uniform permutation. The rows of a partition are then put in
random order (the first permutation) and dealt by their row of the matrix; the
rows that reach a shard are put in random order again (the second), which gives
the slot. Law ``rows``: shard sizes differ by one at most.

The second permutation sorts by the top bits of the random key first, so that no
shard is sorted by one task: counts of (shard, bucket) are summed to a base and
each bucket is ranked alone.

DataFrame functions only. The driver draws the matrix: partitions x shards numbers.

Defined cases: a null text has size 1 and checksum 0; equal rows are separate
rows; null keys are kept; an empty table gives no rows; other columns travel
along, but for ``shard`` and ``slot``, which are made anew.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import staged

SHARDS = 16
SEED = 20_240_229
#: Rows that one task of the second permutation ranks, about.
BUCKET_ROWS = 100_000


def shard_sizes(total: int, shards: int) -> np.ndarray:
    """Sizes that differ by one at most."""
    return total // shards + (np.arange(shards) < total % shards)


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows of partition p for shard s; row sums are ``counts``, column sums
    the shard sizes, drawn as a uniform permutation would give them."""
    rng = np.random.Generator(np.random.PCG64(seed))
    free = shard_sizes(sum(counts), shards).astype(np.int64)
    out = np.zeros((len(counts), shards), dtype=np.int64)
    for p, n in enumerate(counts):
        left, rest = int(n), int(free.sum())
        for s in range(shards):
            rest -= int(free[s])
            if left == 0:
                break
            out[p, s] = left if rest == 0 else _hypergeometric(rng, int(free[s]), rest, left)
            left -= int(out[p, s])
        free -= out[p]
    return out


def _hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    """One draw of the hypergeometric law, of any size: the library takes populations below
    10^9, larger ones are drawn by rejection."""
    if good == 0:
        return 0
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    return hypergeometric_by_rejection(rng, good, bad, draws)


def _log_falling(n: int, k: int) -> float:
    """log of n (n-1) ... (n-k+1) / n^k, without the loss that differences of large
    log-gammas would bring."""
    if k == 0:
        return 0.0
    if n - k < 1000:
        if n > 10**6:  # the factors above 1000, then the last ones
            cut = n - 1000
            return _log_falling(n, cut) + sum(
                math.log((n - i) / n) for i in range(cut, k))
        return math.lgamma(n + 1) - math.lgamma(n - k + 1) - k * math.log(n)
    m = n - k
    return (-(m + 0.5) * math.log1p(-k / n) - k + (1 / n - 1 / m) / 12
            - (1 / n**3 - 1 / m**3) / 360)


def hypergeometric_by_rejection(rng, good: int, bad: int, draws: int) -> int:
    """A binomial proposal, taken with the ratio of both laws over the ratio's maximum: drawing
    without replacement from populations of any size. More than half of the population is
    drawn by what is left over."""
    total = good + bad
    if draws > total - draws:
        return good - hypergeometric_by_rejection(rng, good, bad, total - draws)
    if draws == 0 or bad == 0 or good == 0:
        return draws if bad == 0 else 0

    def ratio(k: int) -> float:
        return _log_falling(good, k) + _log_falling(bad, draws - k)

    # The ratio rises as long as k * total <= (draws - 1) * good.
    top = min((draws - 1) * good // total + 1, good, draws)
    highest = ratio(max(top, draws - bad))
    while True:
        k = int(rng.binomial(draws, good / total))
        if max(0, draws - bad) <= k <= good and math.log(1 - rng.random()) <= ratio(k) - highest:
            return k


def shuffle_shards(spark: SparkSession, rows: DataFrame, shards: int = SHARDS,
                   seed: int = SEED) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 there)."""
    rows = rows.drop("shard", "slot")
    kept = rows.columns
    part, row, rank, key = "__part", "__row", "__rank", "__key"
    source = staged(spark, rows.withColumns(
        {part: F.spark_partition_id(), row: F.monotonically_increasing_id()}), "sharding")
    counts = sorted((r[part], r["n"]) for r in
                    source.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect())
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    ends = spark.createDataFrame(
        [(p, [int(x) for x in np.cumsum(m)]) for (p, _), m in zip(counts, matrix)],
        f"{part} int, __ends array<long>")

    local = Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed), F.col(row)), F.col(row))
    dealt = (
        source.withColumn(rank, F.row_number().over(local))
        .join(ends, part)
        .withColumn("shard", F.size(F.filter("__ends", lambda e: e < F.col(rank))))
        .withColumn(key, F.xxhash64(F.lit(seed + 1), F.col(row)))
    )
    total = int(sum(n for _, n in counts))
    buckets = max(1, total // shards // BUCKET_ROWS)
    dealt = dealt.withColumn("__bucket", F.shiftrightunsigned(key, 33) * buckets
                             / F.lit(2**31)).withColumn("__bucket", F.col("__bucket").cast("int"))
    dealt = staged(spark, dealt.select(*kept, row, key, "shard", "__bucket"), "sharding")
    sizes = dealt.groupBy("shard", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    base = sizes.select("shard", "__bucket", (
        F.sum("n").over(Window.partitionBy("shard").orderBy("__bucket")) - F.col("n"))
        .alias("__base"))
    place = Window.partitionBy("shard", "__bucket").orderBy(key, row)
    return (
        dealt.withColumn(rank, F.row_number().over(place))
        .join(base, ["shard", "__bucket"])
        .select(*kept, "shard", (F.col("__base") + F.col(rank) - 1).cast("long").alias("slot"))
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """Key, size and checksum of each document; the texts stay where they are."""
    utf8 = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(utf8) + 1).cast("long").alias("size"),
                       F.crc32(utf8).alias("text_crc32"))
