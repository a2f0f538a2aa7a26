"""Exact top-k search by inner product: columnar branch and bound.

Vectors become integers. Candidates are dealt into slices of about ``SLICE_BYTES``, evenly
by a row number, so equal vectors don't gather anywhere; queries go to every slice. A task
holds one slice in vertical layout (a row of numbers for each dimension, and for each block of
``WIDTH`` dimensions every candidate's norm there) and streams the queries past it:

* dimension blocks are taken in order of the query's norm in them; each adds its share to
  the scores of the candidates that are left;
* what the blocks to come can still add or take is at most the sum of the products of both
  norms (the remaining mass). The k-th best lower bound, or the k-th best of some exact
  scores, is a score that k candidates reach;
* candidates whose upper bound is below it go, and the survivors are compacted, so the later
  blocks touch few.

Each slice gives its k best for each query; a window over queries x slices x k rows merges them.
Sums are exact: in doubles where all of them stay below 2**53, else in longs. Bounds are doubles
with a margin above their rounding error, and only ever decide which candidates go.

Bounds: a task holds a slice and one Arrow batch of queries. The work is queries x candidates,
as exact search over a stated query set is; the exchange is candidates once and queries once a
slice. Components must be below 2**15 in size before scaling; a greater one is an error.

Defined cases: vectors that are null or empty, or hold null, NaN or infinite components, take
no part. A row is no candidate of its own query; another row with its id is. Rows that
share an id and are queries give their results each. A null id is never a query and loses every tie. With fewer than k
candidates all are returned; an empty table gives no rows. Vectors of different lengths are an
error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import staged
from folio.llm.vector_codes import _flat, scaled, usable

WIDTH = 8
SLICE_BYTES = 16 << 20
#: Candidates in a slice at least, however many tasks there could be.
LEAST_SLICE = 1024
#: A greatest id for ties, in place of null.
LAST = (1 << 63) - 1
FOUND = "query_row long, query_id long, vec_id long, score long"


class Slice:
    """Candidates in vertical layout, ordered by id."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, exact_double: bool,
                 width: int = WIDTH):
        order = np.lexsort((rows, ids))
        self.kind = np.float64 if exact_double else np.int64
        self.ids = ids[order]
        self.by_row = np.argsort(rows[order])
        self.rows = rows[order][self.by_row]
        self.columns = np.ascontiguousarray(vectors[order].T.astype(self.kind))
        self.cuts = list(range(0, vectors.shape[1], width))
        self.width = width
        self.norms = np.sqrt(np.stack([
            (self.columns[a:a + width].astype(np.float64) ** 2).sum(axis=0) for a in self.cuts]))
        self.compared = 0

    def own(self, row: int) -> int:
        at = int(np.searchsorted(self.rows, row))
        return int(self.by_row[at]) if at < len(self.rows) and self.rows[at] == row else -1

    def best(self, query: np.ndarray, row: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` best candidates but ``row`` itself, best first."""
        n = len(self.ids)
        q = query.astype(self.kind)
        mass = np.sqrt([(q[a:a + self.width].astype(np.float64) ** 2).sum() for a in self.cuts])
        left = mass @ self.norms
        margin = 1 + 1e-9 * float(left.max(initial=0.0))
        own = self.own(row)
        alive, score = np.arange(n), np.zeros(n, dtype=self.kind)
        if own >= 0:
            alive, score, left = (np.delete(x, own) for x in (alive, score, left))
        reached = -np.inf
        todo = np.argsort(-mass, kind="stable")
        for step, b in enumerate(todo):
            block = self.columns[b * self.width:(b + 1) * self.width]
            whole = len(alive) == n
            part = q[b * self.width:(b + 1) * self.width]
            self.compared += len(alive)
            score = score + part @ (block if whole else block[:, alive])
            if step + 1 == len(todo):
                break
            left = left - mass[b] * (self.norms[b] if whole else self.norms[b][alive])
            if len(alive) > k:
                low = np.partition(score - left, len(alive) - k)[len(alive) - k]
                reached = max(reached, float(low))
                if step in (0, 2):
                    some = np.argpartition(score, len(alive) - k)[len(alive) - k:]
                    reached = max(reached, float((q @ self.columns[:, alive[some]]).min()))
                keep = np.flatnonzero(score + left >= reached - margin)
                if len(keep) < len(alive):
                    alive, score, left = alive[keep], score[keep], left[keep]
        top = np.lexsort((alive, -score))[:k]
        return self.ids[alive[top]], score[top].astype(np.int64)


def slice_count(n: int, dims: int, tasks: int, slice_bytes: int = SLICE_BYTES) -> int:
    """Slices of at most about ``slice_bytes`` as doubles, and enough for all tasks."""
    return max(1, -(-n * dims * 8 // slice_bytes), min(tasks, n // LEAST_SLICE))


def search(spark: SparkSession, vectors: DataFrame, is_query: Callable[[Column], Column],
           k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
           slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of all other rows for each row whose
    id satisfies ``is_query``."""
    rows = staged(spark, vectors.where(usable(vector)).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"),
        F.coalesce(is_query(F.col(key)), F.lit(False)).alias("query"),
        scaled(vector, scale).alias("ints")), "topk")
    size, highest = F.size("ints"), F.greatest(F.array_max("ints"), -F.array_min("ints"))
    n, least, dims, most = rows.agg(F.count(F.lit(1)), F.min(size), F.max(size), F.max(
        highest)).collect()[0]
    if n and least != dims:
        raise ValueError(f"vectors have {least} to {dims} components")
    dims = dims or 1
    exact_double = (most or 0) ** 2 * dims < 1 << 53
    slices = slice_count(n, dims, spark.sparkContext.defaultParallelism, slice_bytes)
    candidates = rows.select(
        F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"),
        F.lit(0).alias("kind"), "row", "id", "ints")
    queries = rows.where("query").select(
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.lit(1).alias("kind"), "row", "id", "ints")

    def run(batches):
        at, held, ready = None, [], None
        for batch in batches:
            which = np.asarray(batch.column(0)).astype(np.int64) * 2 + np.asarray(batch.column(1))
            cuts = np.append(np.flatnonzero(np.diff(which)) + 1, len(which))
            begin = 0
            for end in cuts.tolist():
                piece = batch.slice(begin, end - begin)
                here, is_q = divmod(int(which[begin]), 2)
                begin = end
                if here != at:
                    at, held, ready = here, [], None
                ids = [np.asarray(piece.column(i), dtype=np.int64) for i in (2, 3)]
                x = _flat(piece.column(4), dims, np.int32)
                if not is_q:
                    held.append((*ids, x))
                    continue
                if ready is None:
                    if not held:
                        continue
                    ready = Slice(*(np.concatenate(c) for c in zip(*held)), exact_double)
                    held = []
                found = [ready.best(q, r, k) for q, r in zip(x, ids[0].tolist())]
                times = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[0], times)), pa.array(np.repeat(ids[1], times)),
                     *(pa.array(np.concatenate([f[c] for f in found])) for c in (0, 1))],
                    names=["query_row", "query_id", "vec_id", "score"])

    found = candidates.unionByName(queries).repartitionById(slices, "slice").sortWithinPartitions(
        "slice", "kind").mapInArrow(run, FOUND)
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(
        F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", "rank", F.nullif("vec_id", F.lit(LAST)).alias("vec_id"), "score")
