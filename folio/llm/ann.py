"""Approximate nearest neighbours by collision-counting hashing.

Vectors are dealt to blocks of ``BLOCK`` rows, queries to blocks of ``QUERIES``; every pair
of blocks is one task's work. In a block each vector (scaled to length 1) is
projected on ``PROJECTIONS`` random directions and each projection is one sorted array.
A query's windows in all arrays grow together by virtual rehashing: half-width
``WIDTH * RATIO ** level``. A vector is a candidate once it lies in the windows of
``THRESHOLD`` of the projections; candidates are verified by the exact cosine. A query
ends when ``ENOUGH`` of the block's vectors are candidates (never fewer than ``LEAST``), or
when all are.

A window takes all it covers: there is no cap on candidates, so many copies of one
vector are all verified and ties go to the smaller id.

Defined cases: vectors that are null, empty or zero, or hold null, NaN or infinite
components take no part; only vectors of one length meet; a null id takes no part;
repeated rows are separate candidates but one query; with fewer candidates than ``k`` all are given;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import staged

PROJECTIONS = 64
THRESHOLD = 0.8
WIDTH = 0.9
RATIO = 1.15
ENOUGH = 0.1
LEAST = 100
BLOCK = 16384  # at most 65,535: positions take two bytes
QUERIES = 4096
SEED = 7


def directions(dim: int, m: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """(dim, m) random directions, the same on every executor."""
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, m))


class Block:
    """The sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.across = directions(vectors.shape[1])
        places = (vectors / self.norms[:, None]) @ self.across
        order = np.argsort(places, axis=0, kind="stable")
        self.sorted = np.take_along_axis(places, order, axis=0).T.copy()
        #: Each vector's position in each sorted array.
        self.at = np.empty(self.sorted.shape, dtype=np.uint16)
        np.put_along_axis(self.at, order.T, np.arange(len(ids), dtype=np.uint16)[None, :], axis=1)

    def cosine(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        norm = np.sqrt((query * query).sum())
        return (self.vectors[rows] * query).sum(axis=1) / (self.norms[rows] * norm)

    def nearest(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, float]]:
        n, m = len(self.ids), len(self.sorted)
        place = (query / np.sqrt((query * query).sum())) @ self.across
        need = int(np.ceil(THRESHOLD * m))
        enough = min(n, max(LEAST, int(ENOUGH * n)))
        half = WIDTH
        while True:
            # The windows are runs of the sorted arrays; a vector collides with the
            # query where its position falls inside the run.
            low = np.array([s.searchsorted(p - half) for s, p in zip(self.sorted, place)])
            high = np.array([s.searchsorted(p + half, side="right")
                             for s, p in zip(self.sorted, place)])
            inside = (self.at - low.astype(np.uint16)[:, None]) < (
                high - low).astype(np.uint16)[:, None]
            rows = np.flatnonzero(np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8) >= need)
            if len(rows) >= enough:
                break
            half *= RATIO
        rows = rows[self.ids[rows] != own]
        score = self.cosine(rows, query)
        best = np.lexsort((self.ids[rows], -score))[:k]
        return [(int(self.ids[rows[j]]), float(score[j])) for j in best]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Finite, non-zero vectors, in double precision."""
    given = vectors.select(F.col(key).cast("long").alias("id"),
                           F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x) == F.lit(float("inf"))))
    return given.where(F.col("id").isNotNull() & F.col("vector").isNotNull()
                       & ~F.coalesce(bad, F.lit(True))
                       & F.exists("vector", lambda x: x != 0))


def search(spark: SparkSession, vectors: DataFrame, is_query, key: str = "vec_id",
           vector: str = "embedding", k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row of
    ``vectors`` for which ``is_query`` (a function of the id column) holds."""
    row = F.monotonically_increasing_id()
    kept = staged(spark, usable(vectors, key, vector).withColumns(
        {"dim": F.size("vector"), "row": row}), "ann")
    queries = kept.where(is_query(F.col("id"))).select(
        "id", "vector", "dim").distinct()
    n_queries = queries.count()
    q_blocks = max(1, -(-n_queries // QUERIES))
    # Query blocks by hash; data blocks are runs of rows of one written partition.
    q_block = F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int")
    d_block = F.floor(F.col("row") / BLOCK)
    data = kept.select("dim", d_block.alias("d"), F.explode(
        F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"), "id", "vector",
        F.lit(False).alias("ask"))
    blocks = kept.select("dim", d_block.alias("d")).distinct()
    asked = queries.withColumn("q", q_block).join(blocks, "dim").select(
        "dim", "d", "q", "id", "vector", F.lit(True).alias("ask"))

    def run(table: pa.Table) -> pa.Table:
        ask = table.column("ask").to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("id").to_numpy()
        flat = table.column("vector").combine_chunks().flatten().to_numpy()
        both = flat.reshape(len(ids), -1)
        out = {"query_id": [], "vec_id": [], "score": []}
        if ask.any() and not ask.all():
            block = Block(ids[~ask], both[~ask])
            for own, query in zip(ids[ask], both[ask]):
                for found, score in block.nearest(int(own), query, k):
                    out["query_id"].append(int(own))
                    out["vec_id"].append(found)
                    out["score"].append(score)
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()),
                                               ("score", pa.float64())]))

    found = data.unionByName(asked).groupBy("dim", "d", "q").applyInArrow(
        run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
