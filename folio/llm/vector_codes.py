"""Compression of vectors to short codes: one codebook per part of the vector.

Components become integers, vectors are cut into equal parts, and every part position gets
a codebook of at most 256 entries by a fixed number of rounds of nearest-entry assignment
and componentwise means, all in exact integers.

1. Blocks. Each task cuts its vectors into runs of about ``RUN_BYTES``. The parts of a run are
   sorted along a Hilbert curve and cut into flat blocks of ``BLOCK`` parts; a block stores
   the least and greatest value of each component (its box), their sums, and the parts. No row
   moves between tasks, so a common vector can't make a hot group.
2. Rounds. Box distances tell for each block which entries can be nearest to a part of it:
   those whose least distance to the box is within the smallest of all greatest distances. A
   block with one such entry adds its stored sums; all others compare their parts with the
   shortlist only, in integers, ties to the lower index. Each task returns one sum for each
   entry and component; the codebooks are all that reaches the driver.
3. Codes. A last assignment gives each part its index and squared distance, gathered by row.

Bounds: a codebook has ``entries`` x dimensions integers. Components must be below 2**15 in
size before scaling (their squares must fit into a long); a greater one is an error.

Defined cases: vectors that are null or empty, or hold null, NaN or infinite components, give no
row. Of rows with one id each is coded; a null id is coded too, and comes last when the first
entries are chosen. Equal ids are ordered by their components. Fewer vectors than entries
give that many entries. An empty table gives no rows. Vectors of different lengths, or of
a length that the parts don't divide, are an error. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import staged

BLOCK = 64
RUN_BYTES = 8 << 20
#: Bits of a component that the curve's order looks at.
CURVE_BITS = 6
LIMIT = 1 << 15
#: Numbers that a kernel holds at once.
KERNEL = 1 << 20
#: Up to so many labels their sums are sent to all tasks; beyond, they are joined.
BROADCAST_LABELS = 50_000

BLOCK_SCHEMA = ("part int, rows array<long>, points array<int>, lo array<int>, hi array<int>, "
                "sums array<long>")


def usable(vector: str | Column) -> Column:
    """True for a vector with components, all of them finite numbers."""
    c = F.col(vector) if isinstance(vector, str) else vector
    x = F.transform(c, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return c.isNotNull() & (F.size(c) > 0) & good


def scaled(vector: str | Column, scale: int) -> Column:
    """floor(scale * x) of every component; one of 2**15 or more is an error."""
    c = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(c, lambda v: F.when(
        F.abs(v.cast("double")) < LIMIT, F.floor(v.cast("double") * scale).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component is not below {LIMIT} in size")).cast("int")))


def curve_order(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """The order of integer points along a Hilbert curve over their bounding box."""
    n, dims = points.shape
    low = points.min(axis=0).astype(np.int64)
    span = np.maximum(points.max(axis=0).astype(np.int64) - low, 1)
    top = (1 << bits) - 1
    x = ((points.astype(np.int64) - low) * top // span).T.astype(np.uint8 if bits <= 8 else np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(hit, p, swap).astype(x.dtype)
            x[i] ^= swap.astype(x.dtype)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, dtype=x.dtype)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[dims - 1] & q, q - 1, 0).astype(x.dtype)
        q >>= 1
    x ^= turn
    # The key: the highest bits of all dimensions, then the next ones, and so on.
    key = np.packbits(np.concatenate(
        [((x >> b) & 1).astype(np.uint8) for b in range(bits - 1, -1, -1)]), axis=0)
    return np.lexsort(key[::-1])


def _flat(column, width: int, dtype) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=dtype).reshape(-1, width)


def _lists(values: np.ndarray, lengths, kind) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def blocks_of(rows: DataFrame, dims: int, parts: int, run_bytes: int = RUN_BYTES,
              block: int = BLOCK) -> DataFrame:
    """``(row, ints)`` as flat blocks, each of one part position."""
    width = dims // parts
    run_rows = max(block, run_bytes // (4 * dims))

    def flush(ids, x):
        n = len(ids)
        starts = np.arange(0, n, block)
        lengths = np.diff(np.append(starts, n))
        for p in range(parts):
            pts = x[:, p * width:(p + 1) * width]
            order = curve_order(pts)
            pts = np.ascontiguousarray(pts[order])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(starts), p, dtype=np.int32)),
                 _lists(ids[order], lengths, pa.int64()),
                 _lists(pts, lengths * width, pa.int32()),
                 *(_lists(f.reduceat(pts, starts, axis=0), [width] * len(starts), pa.int32())
                   for f in (np.minimum, np.maximum)),
                 _lists(np.add.reduceat(pts.astype(np.int64), starts, axis=0),
                        [width] * len(starts), pa.int64())],
                names=["part", "rows", "points", "lo", "hi", "sums"])

    def run(batches):
        ids, points, held = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, run_rows):
                piece = batch.slice(at, run_rows)
                ids.append(np.asarray(piece.column(0), dtype=np.int64))
                points.append(_flat(piece.column(1), dims, np.int32))
                held += piece.num_rows
                if held >= run_rows:
                    yield from flush(np.concatenate(ids), np.concatenate(points))
                    ids, points, held = [], [], 0
        if held:
            yield from flush(np.concatenate(ids), np.concatenate(points))

    return rows.select("row", "ints").mapInArrow(run, BLOCK_SCHEMA)


def shortlists(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """For each box, which entries can be nearest to a point in it (ties included)."""
    under, over = lo[:, None, :] - book[None], book[None] - hi[:, None, :]
    near = (np.maximum(np.maximum(under, over), 0) ** 2).sum(axis=2)
    far = (np.maximum(np.abs(under), np.abs(over)) ** 2).sum(axis=2)
    return near <= far.min(axis=1)[:, None]


def nearest(points: np.ndarray, listed: np.ndarray, book: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """Points (blocks, size, width) and entries listed (blocks, s), ascending -> index of the
    nearest entry and its squared distance, ties to the lower index."""
    gap = points[:, :, None, :] - book[listed][:, None, :, :]
    dist = (gap * gap).sum(axis=3)
    best = dist.argmin(axis=2)
    return (np.take_along_axis(listed, best, axis=1),
            np.take_along_axis(dist, best[:, :, None], axis=2)[:, :, 0])


def kernels(batch: pa.RecordBatch, books: np.ndarray, sums_only: bool):
    """Yields ``(part, blocks, listed, points)``: blocks with equally many parts and shortlist
    entries. With ``sums_only`` blocks with one entry have no points."""
    width = books.shape[2]
    part = np.asarray(batch.column(0))
    lo, hi = (_flat(batch.column(i), width, np.int64) for i in (3, 4))
    ends = np.asarray(batch.column(1).offsets, dtype=np.int64)
    count = np.diff(ends)
    points = _flat(batch.column(2), width, np.int64)
    starts = ends[:-1] - ends[0]
    for p in np.unique(part):
        own = np.flatnonzero(part == p)
        short = shortlists(lo[own], hi[own], books[p])
        size = short.sum(axis=1)
        for s in np.unique(size):
            for c in np.unique(count[own[size == s]]):
                here = np.flatnonzero((size == s) & (count[own] == c))
                listed = np.nonzero(short[here])[1].reshape(len(here), s)
                if sums_only and s == 1:
                    yield int(p), own[here], listed, None
                    continue
                step = max(1, KERNEL // (int(c) * int(s) * width))
                for at in range(0, len(here), step):
                    b = own[here[at:at + step]]
                    pts = points[starts[b][:, None] + np.arange(c)]
                    yield int(p), b, listed[at:at + step], pts


def partial_sums(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``(part, entry, values)`` of each task: count and componentwise sums of each entry."""
    parts, entries, width = books.shape

    def run(batches):
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            sums = _flat(batch.column(5), width, np.int64)
            count = np.diff(np.asarray(batch.column(1).offsets, dtype=np.int64))
            for p, b, listed, pts in kernels(batch, books, True):
                if pts is None:
                    np.add.at(total[p], listed[:, 0],
                              np.concatenate([count[b][:, None], sums[b]], axis=1))
                    continue
                entry = nearest(pts, listed, books[p])[0].ravel()
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                total[p, used, 1:] += np.add.reduceat(
                    pts.reshape(-1, width)[order], first, axis=0)
                total[p, :, 0] += np.bincount(entry, minlength=entries)
        p, e = np.nonzero(total[:, :, 0])
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)),
                 _lists(total[p, e], [width + 1] * len(p), pa.int64())],
                names=["part", "entry", "values"])

    return blocks.mapInArrow(run, "part int, entry int, values array<long>")


def next_books(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: entries become the floor of their parts' means, unused ones stay."""
    sums = partial_sums(blocks, books).select(
        "part", "entry", F.posexplode("values").alias("at", "v")).groupBy(
        "part", "entry", "at").agg(F.sum("v").alias("v")).collect()
    total = {(r["part"], r["entry"], r["at"]): r["v"] for r in sums}
    out = books.copy()
    for p, e, at in total:
        if at:
            out[p, e, at - 1] = total[p, e, at] // total[p, e, 0]
    return out


def assigned(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``(row, part, entry, error)`` of every part."""
    def run(batches):
        for batch in batches:
            ends = np.asarray(batch.column(1).offsets, dtype=np.int64)
            ids = np.asarray(batch.column(1).flatten(), dtype=np.int64)
            for p, b, listed, pts in kernels(batch, books, False):
                entry, error = nearest(pts, listed, books[p])
                rows = ids[(ends[b] - ends[0])[:, None] + np.arange(pts.shape[1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows.ravel()), pa.array(np.full(rows.size, p, dtype=np.int32)),
                     pa.array(entry.ravel().astype(np.int32)), pa.array(error.ravel())],
                    names=["row", "part", "entry", "error"])

    return blocks.mapInArrow(run, "row long, part int, entry int, error long")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


def with_label_error(spark: SparkSession, coded: DataFrame) -> DataFrame:
    """``label_error``: the error summed over equal labels. Sums combine before the exchange; a
    few of them are broadcast, many are joined (and a hot label's partition split)."""
    sums = staged(spark, coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes")
    few = sums.count() <= BROADCAST_LABELS
    sums = sums.select(F.col("label").alias("_label"), "label_error")
    return coded.join(F.broadcast(sums) if few else sums,
                      F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def compress(spark: SparkSession, vectors: DataFrame, key: str = "vec_id",
             vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16,
             rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """(``key, label, code, error, label_error`` of every usable vector, the codebooks as an
    array (part, entry, component)). ``code`` has two hex digits a part."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    rows = staged(spark, vectors.where(usable(vector)).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.col(label).alias("label"), scaled(vector, scale).alias("ints")), "codes")
    least, most = rows.agg(F.min(F.size("ints")), F.max(F.size("ints"))).collect()[0]
    names = [F.col("key").alias(key), "label", "code", "error", "label_error"]
    if least is None:
        return rows.select("key", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias(
            "error"), F.lit(0).cast("long").alias("label_error")).select(*names), np.zeros(
            (parts, 0, 0), dtype=np.int64)
    if least != most or most % parts:
        raise ValueError(f"vectors of {least} to {most} components can't be cut into {parts} "
                         "equal parts")
    seeds = rows.orderBy(F.col("key").asc_nulls_last(), "ints").limit(entries).select(
        "ints").collect()
    books = np.array([r["ints"] for r in seeds], dtype=np.int64).reshape(
        len(seeds), parts, most // parts).transpose(1, 0, 2).copy()
    blocks = staged(spark, blocks_of(rows, most, parts), "codes")
    for _ in range(rounds):
        books = next_books(blocks, books)
    words = range(-(-parts // 8))
    gathered = assigned(blocks, books).groupBy("row").agg(
        *(F.bit_or(F.when(F.floor(F.col("part") / 8) == w, F.expr(
            f"shiftleft(cast(entry as long), 8 * ({min(8 * w + 7, parts - 1)} - part))")))
          .alias(f"word{w}") for w in words), F.sum("error").alias("error"))
    code = F.concat(*(F.lpad(F.lower(F.hex(f"word{w}")), 2 * min(8, parts - 8 * w), "0")
                      for w in words))
    coded = staged(spark, rows.select("row", "key", "label").join(gathered, "row").select(
        "key", "label", code.alias("code"), "error"), "codes")
    return with_label_error(spark, coded).select(*names), books


def report(spark: SparkSession, vectors: DataFrame, **opts) -> DataFrame:
    """``(key, code, error, label_error, codebooks_sha256)`` of every usable vector."""
    out, books = compress(spark, vectors, **opts)
    return out.drop("label").withColumn("codebooks_sha256", F.lit(books_digest(books)))
