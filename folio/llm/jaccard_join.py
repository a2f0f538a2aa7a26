"""Near-duplicate documents: chosen-path join on word shingles (Jaccard >= 0.8).

A document is its set of hashed runs of five words. Sets that are equal fold into one.
Chosen path: at a node of the search tree a set chooses each of its tokens with
probability ``BRANCH / size``, by a hash of (node, token), so sets that share the token
choose alike; the token leads to a child node. Sets that meet in a node are compared
there once the node is small (``BLOCK``) or no longer shrinks; a larger node is split
again. ``runs`` independent trees bring a pair at the threshold together with the
target recall: a pair is lost in one tree with the extinction probability of a
branching process of mean ``BRANCH * threshold``.

Comparison at a node is by one-permutation sketches (``BINS`` bytes a set), far below
the threshold, so that no pair at it is lost. A node gives a spanning forest of its
alike pairs, never the pairs themselves: a node of n sets costs n - 1 rows. A node too
large for that is compared with its pivot first. If all but a few of its sets are then in
one component, those few are compared with all; else it is split, and where it cannot be
split compared in blocks.
The components of alike sets hold every pair at the threshold. Inside each, all pairs
are brute-forced exactly on the token sets, block by block and each pair once, which
gives the link counts and, again as spanning forests, the classes.

Defined cases: a text of less than five words is one shingle of all its words; a null
text or one without words is linked to nothing; equal shingle sets are one class with
Jaccard 1; repeated rows count as documents; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import staged, texts_of, text_runs
from folio.llm.components import components

WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
BRANCH = 2.5
BLOCK = 1024
#: A node that keeps this share of its parent is not split again; nor is one this deep.
SHRINK = 0.7
LEVELS = 8
BINS = 128
SKETCH_LEAST = 0.64
BATCH_BYTES = 2 << 20
#: One in so many nodes is compared first.
FIRST_PART = 6
#: Token bytes, and sets, of one side of a block in the exact comparison.
BLOCK_BYTES = 1 << 20
BLOCK_SETS = 256
MIX = np.uint64(0x9E3779B97F4A7C15)


def runs_for(recall: float = TARGET_RECALL, threshold: float = THRESHOLD) -> int:
    """Trees needed: each loses a pair with the extinction probability q = e^(m(q-1))."""
    q = 0.0
    for _ in range(200):
        q = math.exp(BRANCH * threshold * (q - 1))
    return math.ceil(math.log(1 - recall) / math.log(q))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of every run of ``WORDS`` words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > 50_000:
            known.clear()
        words = text.split()
        codes = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w.encode())
            codes.append(h)
        h = np.array(codes, dtype=np.uint64)
        if len(h) == 0:
            return h
        k = min(WORDS, len(h))
        n = len(h) - k + 1
        out = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            out = (out ^ h[i:n + i]) * MIX
            out ^= out >> np.uint64(29)
        return np.unique(mix(out))


def children(node: int | np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Child nodes that a set chooses at ``node``."""
    draw = mix(tokens ^ np.uint64(node))
    share = min(BRANCH / len(tokens), 1.0)
    chosen = draw if share == 1.0 else draw[draw < np.uint64(int(share * 2.0**64))]
    return chosen * MIX


def sketch(tokens: np.ndarray) -> bytes:
    """A byte of the least token in each of ``BINS`` ranges; 0 for an empty range."""
    out = np.zeros(BINS, dtype=np.uint8)
    bins, first = np.unique(tokens >> np.uint64(57), return_index=True)
    out[bins.astype(np.int64)] = (1 + tokens[first] % np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def alike(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Whether each sketch may belong to a set at the threshold with ``one``."""
    some = (one > 0) | (many > 0)
    return ((one == many) & some).sum(axis=1) >= SKETCH_LEAST * some.sum(axis=1)


def described(docs: DataFrame, key: str, text: str, runs: int) -> DataFrame:
    """One row per document: set id, size, sketch, first nodes in every tree."""
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64) * MIX)

    def run(batches):
        shingle = Shingler()
        for batch in text_runs(batches, text, BATCH_BYTES):
            sets = [shingle(t) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                           for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([sketch(s) if len(s) else b"" for s in sets], pa.binary()),
                 pa.array([np.concatenate([children(r, s) for r in roots]).view(np.int64)
                           if len(s) else np.zeros(0, np.int64) for s in sets],
                          pa.list_(pa.int64()))],
                names=["key", "tkey", "sid", "n", "sketch", "nodes"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias(text),
                       F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("tkey")).mapInArrow(
        run, f"key {kind}, tkey binary, sid binary, n int, sketch binary, nodes array<long>")


def token_sets(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``(u, tokens)`` of the sets ``(u, tkey)``; copies of a text meet map-side."""
    texts = docs.select(F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("tkey"),
                        F.col(text).alias("text")).groupBy("tkey").agg(
        F.first("text").alias("text"))

    def run(batches):
        shingle = Shingler()
        for batch in text_runs(batches, "text", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingle(t).tobytes() for t in
                                            texts_of(batch.column(1))], pa.binary())],
                names=["u", "tokens"])

    return texts.join(wanted, "tkey").select("u", "text").mapInArrow(run, "u long, tokens binary")


def groups(batches, by: int = 1):
    """Columns of each run of rows with equal first ``by`` columns, over all batches of a
    sorted partition."""
    held: list[list] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][:by] != row[:by]:
                yield list(zip(*held))
                held = []
            held.append(row)
    if held:
        yield list(zip(*held))


def _table(rows: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def in_blocks(nodes: DataFrame) -> DataFrame:
    """Rows ``(node, i, j, u, side)`` of nodes ``(node, u, k)``: every pair of the ``k`` blocks of
    a node's sets. Side 0 is block i, side 1 block j, 2 both."""
    mine = F.pmod(F.xxhash64("u"), F.col("k")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("o")
    rows = nodes.select("node", "u", mine.alias("m"), other)
    return rows.select("node", F.least("m", "o").alias("i"), F.greatest("m", "o").alias("j"), "u",
                       F.when(F.col("m") < F.col("o"), 0).when(F.col("m") > F.col("o"), 1)
                       .otherwise(2).alias("side"))


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def alike_edges(rows: DataFrame, sketches: DataFrame, labels: DataFrame | None = None
                ) -> DataFrame:
    """Links ``(a, b)`` for each group ``(node, i, j)``: a spanning forest of its alike pairs, over
    the components known so far. Sets of a group's largest component are not compared
    with each other, so a group that is connected but for x of its n sets costs x * n."""
    known = rows if labels is None else rows.join(labels, "u", "left")
    known = known.withColumn("c", F.col("u") if labels is None else F.coalesce("c", "u"))

    def run(batches):
        for _, _, _, u, c, given in groups(batches, 3):
            if len(u) < 2:
                continue
            marks = np.frombuffer(b"".join(given), dtype=np.uint8).reshape(len(u), BINS)
            _, part, times = np.unique(np.array(c), return_inverse=True, return_counts=True)
            inside, at = part == times.argmax(), np.arange(len(u))
            forest, out = Forest(len(times)), []
            for x in np.flatnonzero(~inside).tolist():
                if len(out) == len(times) - 1:  # all connected
                    break
                other = np.flatnonzero((inside | (at > x)) & (part != part[x]))
                for y in other[alike(marks[x], marks[other])].tolist():
                    if forest.join(int(part[x]), int(part[y])):
                        out.append((u[x], u[y]))
            if out:
                yield _table(out, ["a", "b"])

    parts = known.join(sketches, "u").select("node", "i", "j", "u", "c", "sketch")
    return parts.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "u").mapInArrow(
        run, "a long, b long")


def with_pivot(nodes: DataFrame) -> DataFrame:
    """Groups ``(node, i, i)`` of nodes ``(node, u, n, pivot)``: each block of a node and the node's
    pivot, so that sets alike to it connect whatever their block."""
    k = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = nodes.select("node", F.pmod(F.xxhash64("u"), k).cast("int").alias("i"), "u")
    pivots = nodes.where((F.col("u") == F.col("pivot")) & (F.col("n") > BLOCK)).select(
        "node", F.explode(F.sequence(F.lit(0), k - 1)).alias("i"), "u")
    return rows.union(pivots).distinct().withColumn("j", F.col("i"))


def outside(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``(node, u, n, whole, main, x)`` of the nodes whose sets are not all in one component:
    whether a set is in the node's largest one, and how many are not."""
    labelled = nodes.join(labels, "u", "left").withColumn("c", F.coalesce("c", "u"))
    largest = labelled.groupBy("node", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("node").agg(
        F.max(F.struct("m", "c")).alias("top"))
    return labelled.join(largest, "node").where(F.col("n") > F.col("top.m")).select(
        "node", "u", "n", "whole", (F.col("c") == F.col("top.c")).alias("main"),
        (F.col("n") - F.col("top.m")).alias("x"))


def with_outsiders(nodes: DataFrame) -> DataFrame:
    """Groups ``(node, i, i)`` of nodes ``(node, u, n, main)``: each block of a node's largest
    component and all sets outside it."""
    k = F.ceil(F.col("n") / BLOCK).cast("int")
    inside = nodes.where("main").select("node", F.pmod(F.xxhash64("u"), k).cast("int").alias("i"),
                                        "u")
    others = nodes.where(~F.col("main")).select(
        "node", F.explode(F.sequence(F.lit(0), k - 1)).alias("i"), "u")
    return inside.union(others).withColumn("j", F.col("i"))


def exact_links(labels: DataFrame, copies: DataFrame, tokens: DataFrame, threshold: float
                ) -> DataFrame:
    """Rows ``(a, b, links)``: with ``b``, a spanning forest of the pairs at the threshold;
    without, a part of the documents at the threshold with ``a``. Each pair of sets of a
    component is compared once."""
    weighed = labels.join(tokens, "u").select("u", "c", F.octet_length("tokens").alias("size"))
    sizes = weighed.groupBy("c").agg(
        F.greatest(F.ceil(F.sum("size") / BLOCK_BYTES), F.ceil(
            F.count(F.lit(1)) / BLOCK_SETS)).cast("int").alias("k"))
    members = labels.join(sizes, "c").select(F.col("c").alias("node"), "u", "k")
    rows = in_blocks(members).join(copies, "u").join(tokens, "u").select(
        "node", "i", "j", "u", "side", "copies", "tokens")

    def run(batches):
        for _, i, j, u, side, copies, raw in groups(batches, 3):
            sets = [np.frombuffer(r, dtype=np.uint64) for r in raw]
            size = np.array([len(s) for s in sets])
            _, flat, times = np.unique(np.concatenate(sets), return_inverse=True,
                                       return_counts=True)
            # Tokens of a single set can't be shared.
            owner = np.repeat(np.arange(len(sets)), size)
            shared = times[flat] > 1
            flat, owner = flat[shared], owner[shared]
            at = np.searchsorted(owner, np.arange(len(sets) + 1))
            mark = np.zeros(len(times), dtype=bool)
            copies, side = np.array(copies), np.array(side)
            got, forest, out = np.zeros(len(u), dtype=np.int64), Forest(len(u)), []
            for x in range(len(u)):
                if i[0] != j[0] and side[x] != 0:
                    continue
                mine = flat[at[x]:at[x + 1]]
                mark[mine] = True
                begin = at[x + 1] if i[0] == j[0] else 0
                first = x + 1 if i[0] == j[0] else 0
                both = np.bincount(owner[begin:][mark[flat[begin:]]], minlength=len(u))
                mark[mine] = False
                near = both >= threshold * (size + size[x] - both)
                near[:first] = False
                if i[0] != j[0]:
                    near &= side == 1
                got[x] += copies[near].sum()
                got[near] += copies[x]
                out += [(u[x], u[y], None) for y in np.flatnonzero(near).tolist()
                        if forest.join(x, y)]
            out += [(v, None, n) for v, n in zip(u, got.tolist()) if n]
            if out:
                yield _table(out, ["a", "b", "links"])

    return rows.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "u").mapInArrow(
        run, "a long, b long, links long")


def meet(rows: DataFrame) -> DataFrame:
    """``(node, u, n, pivot)`` of the nodes ``(node, u, ...)`` where two sets or more meet."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("pivot"))
    return rows.join(sizes.where("n > 1"), "node")


def chosen_children(big: DataFrame, tokens: DataFrame) -> DataFrame:
    """``(node, u, parent_n)``: the next level below the nodes ``(node, u, n)``."""

    def run(batches):
        for batch in text_runs(batches, "tokens", BATCH_BYTES):
            out = []
            for node, u, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                below = children(np.int64(node).astype(np.uint64),
                                 np.frombuffer(raw, dtype=np.uint64))
                out += [(x, u, n) for x in below.view(np.int64).tolist()]
            if out:
                yield _table(out, ["node", "u", "parent_n"])

    return big.join(tokens, "u").select("node", "u", "n", "tokens").mapInArrow(
        run, "node long, u long, parent_n long")


def classes(spark: SparkSession, docs: DataFrame, key: str, text: str, threshold: float,
            recall: float) -> DataFrame:
    """One row per document: ``(key, tkey, sid, n, class, links)``; ``tkey`` is the digest of its
    text, ``sid`` of its shingle set, ``class`` a number of this run, null without shingles."""
    rows = staged(spark, described(docs, key, text, runs_for(recall, threshold)), "jaccard")
    sets = staged(spark, rows.where("n > 0").groupBy("sid").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("tkey", "sketch", "nodes")).alias("x"))
        .select("sid", "copies", "x.*", F.monotonically_increasing_id().alias("u")), "jaccard")
    sketches = sets.select("u", "sketch")

    level = staged(spark, meet(sets.select(F.explode("nodes").alias("node"), "u")).select(
        "node", "u", "n", "pivot"), "jaccard")
    # A part of the nodes connects the large groups; the others then add what is new.
    first = F.pmod("node", F.lit(FIRST_PART)) == 0
    edges = staged(spark, alike_edges(with_pivot(level.where(first)), sketches).distinct(),
                   "jaccard")
    near = components(spark, edges)
    edges = staged(spark, edges.union(alike_edges(
        with_pivot(level.where(~first)), sketches, near)).distinct(), "jaccard")
    near = components(spark, edges)

    todo = level.where(F.col("n") > BLOCK).withColumn("whole", F.lit(False))
    out = staged(spark, outside(todo, near), "jaccard")
    # All sets that can still be linked: the texts are read once more, for these alone.
    wanted = near.select("u").union(out.select("u")).distinct()
    tokens = staged(spark, token_sets(docs, text, wanted.join(sets, "u").select("u", "tkey")),
                    "jaccard")
    depth = 1
    while out.limit(1).count():
        # Small is a node with few sets outside its largest component; those meet all.
        few, many = out.where(F.col("x") <= BLOCK), out.where(F.col("x") > BLOCK)
        stuck = in_blocks(many.where("whole").select(
            "node", "u", F.ceil(F.col("n") / BLOCK).cast("int").alias("k"))).where("i < j")
        edges = staged(spark, edges.union(alike_edges(with_outsiders(few), sketches, near)).union(
            alike_edges(stuck, sketches, near)).distinct(), "jaccard")
        big = many.where(~F.col("whole")).select("node", "u", "n")
        if not big.limit(1).count():
            near = components(spark, edges)
            break
        depth += 1
        below = staged(spark, meet(chosen_children(big, tokens)), "jaccard")
        edges = staged(spark, edges.union(alike_edges(with_pivot(below), sketches, near))
                       .distinct(), "jaccard")
        near = components(spark, edges)
        todo = below.where(F.col("n") > BLOCK).withColumn(
            "whole", (F.col("n") >= SHRINK * F.col("parent_n")) | F.lit(depth >= LEVELS))
        out = staged(spark, outside(todo.select("node", "u", "n", "whole"), near), "jaccard")

    exact = staged(spark, exact_links(near, sets.select("u", "copies"), tokens, threshold),
                   "jaccard")
    labels = components(spark, exact.where(F.col("b").isNotNull()).select("a", "b"))
    links = exact.where(F.col("b").isNull()).groupBy(F.col("a").alias("u")).agg(
        F.sum("links").alias("links"))
    found = sets.select("u", "sid", "copies").join(labels, "u", "left").join(links, "u", "left")
    found = found.select("sid", F.coalesce("c", "u").alias("class"), (
        F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return rows.join(found, "sid", "left").select(
        "key", "tkey", "sid", "n", "class", F.coalesce("links", F.lit(0)).cast("long").alias(
            "links"))


def join(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
         threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """One row per document: ``(key, class_id, links, set_id)``. Documents connected by
    links share ``class_id``, the least key of them; ``links`` counts the documents at the
    threshold with it, copies included; ``set_id`` tells equal shingle sets."""
    named = classes(spark, docs, key, text, threshold, recall)
    # A class is named by its least key; hot classes meet map-side and in a skew-split join.
    least = named.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("key").alias("least"))
    return named.join(least, "class", "left").select(
        F.col("key").alias(key),
        F.when(F.col("class").isNotNull(), F.col("least")).otherwise(F.col("key")).alias(
            "class_id"), "links", F.hex("sid").alias("set_id"))


def one_of_each(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """``docs`` with one document of each class, the one of least key (then text digest).
    A document without words is a class of its own; rows with equal key and text are one."""
    named = staged(spark, classes(spark, docs, key, text, threshold, recall), "jaccard")
    least = named.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min(F.struct("key", "tkey")).alias("x")).select("x.*")
    stay = least.union(named.where(F.col("class").isNull()).select("key", "tkey"))

    def row(key_, tkey):  # one digest of (key, text): join and folding share its partitioning
        return F.md5(F.concat_ws("|", F.hex(tkey), F.col(key_).isNull().cast("string"),
                                 F.col(key_).cast("string")))

    stay = stay.select(row("key", "tkey").alias("__row")).distinct()
    tkey = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__doc")
    kept = docs.select(row(f"`{key}`", tkey).alias("__row"), whole).join(stay, "__row", "left_semi")
    return kept.groupBy("__row").agg(F.first("__doc").alias("__doc")).select("__doc.*")
