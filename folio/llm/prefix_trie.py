"""The trie of conversation prefixes, with what sharing them saves.

A node is a distinct sequence of the first d turns; its members are the conversations that
start with it.

1. Order. Turns are range-partitioned by (conversation, order) and numbered inside the
   partitions; of each partition only one boundary row (the rows and words of its last
   conversation) goes into the prefix sums that carry numbers across. A conversation of any
   length spans partitions.
2. Folding. Conversations with the same whole sequence (a 128-bit digest of its numbered
   turns, summed by exclusive or) fold into one with a count; what follows sees
   distinct sequences only. The ids of a group are joined to text in sorted pieces by many
   tasks; one pass over a group's pieces hashes them as a stream.
3. Prefixes. The next ``width`` turns of each sequence become columns, and one ROLLUP over
   (prior node, turn 1, ..., turn ``width``) aggregates all their prefixes together;
   grouping_id tells the depth. Prefix copies combine before the exchange, so a turn that
   opens a third of all conversations makes one row a task. Sequences that still share their
   last node continue in the next block of columns, keyed by that node; one that is alone
   there has a plain chain below, which comes straight from its turns.
4. Subtrees. From the last block to the first, a second ROLLUP over the node rows sums leaves
   and saved tokens; a block's total for its prior node is carried to that node above.

So the jobs grow with the longest prefix that different sequences share, never with the
longest conversation.

Defined cases: turns are ordered by turn number, null first, and equal numbers by the turns'
digests; null role or text becomes empty; rows with a null conversation id belong to no conversation and are left
out; repeated rows are turns of their own. A conversation without turns is a member of the root
only. An empty table gives no rows (no root). Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import staged

#: Turns that one ROLLUP takes.
WIDTH = 8
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """A turn's identity and its words: struct(id, words)."""
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.struct(F.md5(told).alias("id"),
                    F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def numbered(spark: SparkSession, conversations: DataFrame, conv: str = "conv_id",
             turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, idx, tid, cum)``: every turn with its number from 1 and the words so far in its
    conversation."""
    empty = F.lit("")
    rows = staged(spark, conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        turn_id(F.coalesce(role, empty), F.coalesce(text, empty)).alias("tid")), "trie")

    def run(batches):
        pid = TaskContext.get().partitionId()
        last, idx, cum = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            own = np.asarray(batch.column(0), dtype=np.int64)
            words = np.asarray(batch.column(1).field("words"), dtype=np.int64)
            start = np.append(0, np.flatnonzero(np.diff(own)) + 1)
            length = np.diff(np.append(start, n))
            at = np.arange(n) - np.repeat(start, length) + 1
            total = np.cumsum(words)
            so_far = total - np.repeat(total[start] - words[start], length)
            if own[0] == last:
                at[:length[0]] += idx
                so_far[:length[0]] += cum
            last, idx, cum = own[-1], at[-1], so_far[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, pid, dtype=np.int32)), batch.column(0), pa.array(at),
                 batch.column(1), pa.array(so_far)], names=["pid", "conv", "idx", "tid", "cum"])

    local = staged(spark, rows.repartitionByRange("conv", "turn", "tid").sortWithinPartitions(
        "conv", "turn", "tid").select("conv", "tid").mapInArrow(
        run, "pid int, conv long, idx long, tid struct<id:string,words:long>, cum long"), "trie")
    carried = carried_over(local.groupBy("pid").agg(
        F.min("conv").alias("first"), F.max(F.struct("conv", "idx", "cum")).alias("last"))
        .orderBy("pid").collect())
    if not carried:
        return local.drop("pid")
    # At most one row a partition.
    add = spark.createDataFrame(carried, "pid int, conv long, add_idx long, add_cum long")
    return staged(spark, local.join(F.broadcast(add), ["pid", "conv"], "left").select(
        "conv", (F.col("idx") + F.coalesce("add_idx", F.lit(0))).alias("idx"), "tid",
        (F.col("cum") + F.coalesce("add_cum", F.lit(0))).alias("cum")), "trie")


def carried_over(partitions: list) -> list[tuple[int, int, int, int]]:
    """From ``(pid, first, last(conv, idx, cum))`` of each partition: what to add to the numbers of
    the conversation that a partition continues."""
    out, before = [], None
    for pid, first, last in partitions:
        idx = cum = 0
        if before is not None and before[0] == first:
            idx, cum = before[1:]
            out.append((pid, first, idx, cum))
        alone = last["conv"] == first
        before = (last["conv"], last["idx"] + (idx if alone else 0),
                  last["cum"] + (cum if alone else 0))
    return out


def grafted(spark: SparkSession, turns: DataFrame, source: Column, head: Column, longest: int
            ) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as the first ``head`` turns of conversation ``source`` and then their
    own turns after their first ``head`` (both columns of ``conv``, ``head`` at most
    ``longest``): ``(turns, all conversation ids)``."""
    own = turns.withColumn("h", head.cast("long"))
    sizes = own.groupBy("conv").agg(
        F.max("h").alias("h"),
        F.coalesce(F.max(F.when(F.col("idx") <= F.col("h"), F.col("cum"))), F.lit(0)).alias("skip"))
    heads = turns.where(F.col("idx") <= longest).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("idx", "tid", "cum"))).alias("first")).select(
        F.col("conv").alias("_source"), "first")
    first = F.slice(F.coalesce("first", F.array().cast(heads.schema["first"].dataType)), 1,
                    F.col("h").cast("int"))
    meta = staged(spark, sizes.join(heads, source == F.col("_source"), "left").select(
        "conv", "h", "skip", first.alias("first")), "trie")
    taken = meta.select("conv", F.explode("first").alias("t")).select("conv", "t.*")
    rest = turns.join(meta.select(
        "conv", "h", "skip", F.size("first").alias("m"),
        F.coalesce(F.get("first", F.size("first") - 1)["cum"], F.lit(0)).alias("head_words")),
        "conv").where(F.col("idx") > F.col("h")).select(
        "conv", (F.col("idx") - F.col("h") + F.col("m")).alias("idx"), "tid",
        (F.col("cum") - F.col("skip") + F.col("head_words")).alias("cum"))
    return staged(spark, taken.unionByName(rest), "trie"), meta.select("conv")


def sequences(spark: SparkSession, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``(rep, n, words, w, ends)`` of each distinct sequence: its smallest conversation, turns,
    words, members, and the hash of their ids."""
    told = F.md5(F.concat_ws(":", "idx", "tid.id"))
    parts = turns.select("conv", F.xxhash64(told).alias("x"), F.xxhash64(told, F.lit(1)).alias("y"),
                         F.col("idx").alias("n"), F.col("cum").alias("words"))
    none = convs.select("conv", *(F.lit(0).cast("long").alias(c) for c in ("x", "y", "n", "words")))
    key = ["x", "y", "n", "words"]
    members = staged(spark, parts.unionByName(none).groupBy("conv").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("n").alias("n"),
        F.max("words").alias("words")), "trie")

    def join_ids(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([np.asarray(batch.column(i), dtype=np.int64) for i in range(4)])
            conv = np.asarray(batch.column(4), dtype=np.int64)
            change = np.flatnonzero((np.diff(k) != 0).any(axis=0)) + 1
            start = np.append(0, change)
            end = np.append(change, len(conv))
            ids = conv.astype(str).tolist()
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[start]) for c in k), pa.array(conv[start]), pa.array(end - start),
                 pa.array([",".join(ids[a:b]) for a, b in zip(start.tolist(), end.tolist())])],
                names=[*key, "rep", "w", "ids"])

    def hash_ids(batches):
        held, told, first, w = None, None, 0, 0
        for batch in batches:
            out = []
            for *k, rep, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if k != held:
                    if held:
                        out.append((first, *held[2:], w, told.hexdigest()))
                    held, told, first, w = k, hashlib.sha256(), rep, 0
                told.update((("," if w else "") + ids).encode())
                w += count
            yield _rows(out)
        if held:
            yield _rows([(first, *held[2:], w, told.hexdigest())])

    def _rows(out):
        columns = list(zip(*out)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())],
            names=["rep", "n", "words", "w", "ends"])

    pieces = members.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv").select(
        *key, "conv").mapInArrow(join_ids, ", ".join(
            f"{c} long" for c in (*key, "rep", "w")) + ", ids string")
    return staged(spark, pieces.repartition(*key).sortWithinPartitions(*key, "rep").mapInArrow(
        hash_ids, "rep long, n long, words long, w long, ends string"), "trie")


def _columns(width: int) -> list[str]:
    return [f"p{i}" for i in range(1, width + 1)]


def _node(path: Column) -> Column:
    """The key of the node that ``path`` (turn ids) leads to from ``prior``."""
    return F.when(F.size(path) == 0, F.col("prior")).otherwise(
        F.md5(F.concat_ws("/", "prior", path)))


def block_rows(active: DataFrame, turns: DataFrame, below: int, width: int) -> DataFrame:
    """Each active sequence with its turns ``below``+1 to ``below``+``width`` as columns."""
    here = turns.where((F.col("idx") > below) & (F.col("idx") <= below + width)).groupBy(
        F.col("conv").alias("rep")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "tid", "cum"))).alias("t"))
    return active.join(here, "rep", "left").select(
        "rep", "n", "words", "w", "ends", "prior",
        *(F.get("t", F.lit(i))["tid"].alias(c) for i, c in enumerate(_columns(width))),
        (F.col("words") - F.get("t", F.lit(width - 1))["cum"]).alias("rest"))


def block_nodes(rows: DataFrame, below: int, width: int) -> DataFrame:
    """All prefixes of one block's columns by one ROLLUP; of the prior node, only the root is kept."""
    cols = _columns(width)
    # grouping_id has a bit for each column that a prefix leaves out.
    level = F.lit(width) - F.log2(F.col("gid") + 1).cast("int")
    path = F.array_compact(F.array(*cols))
    rolled = rows.rollup("prior", *cols).agg(
        F.grouping_id().alias("gid"), F.min("rep").alias("conv"), F.sum("w").alias("n_convs"),
        F.count(F.lit(1)).alias("n_seqs"), F.max("n").alias("longest"), F.max("rest").alias("rest"))
    kept = rolled.where(F.col("gid") < (1 << width)).withColumn("level", level).withColumn(
        "path", path).where((F.size("path") == F.col("level")) & (
            (F.col("level") > 0) | F.lit(below == 0)))
    ids = F.transform("path", lambda t: t["id"])
    up = F.slice(ids, 1, F.greatest(F.col("level") - 1, F.lit(0)))
    return kept.select(
        "prior", *(F.col(c)["id"].alias(c) for c in cols), "level", _node(ids).alias("node"),
        F.when(F.col("level") > 0, _node(up)).alias("parent"),
        (F.col("level") + below).cast("long").alias("depth"), "conv", "n_convs", "n_seqs",
        (F.col("longest") > F.col("level") + below).alias("goes_on"),
        F.coalesce(F.get("path", F.col("level") - 1)["words"], F.lit(0)).alias("words"), "rest")


def subtree_sums(nodes: DataFrame, below_sums: DataFrame | None, width: int) -> DataFrame:
    """``(node, level, saved, leaves)`` over the subtrees of one block's nodes, and at level 0 over
    all that hang from each prior node. ``below_sums`` are the next block's."""
    chain = (F.col("level") == width) & (F.col("n_seqs") == 1) & F.col("goes_on")
    copies = F.col("n_convs") - 1
    own = nodes.select(
        "prior", *_columns(width), "level", "node",
        (copies * F.col("words") + F.when(chain, copies * F.col("rest")).otherwise(0)).alias(
            "saved"), (~F.col("goes_on") | chain).cast("long").alias("leaves"))
    if below_sums is not None:
        carried = below_sums.where("level = 0").select(
            "node", F.col("saved").alias("more_saved"), F.col("leaves").alias("more_leaves"))
        own = own.join(carried, "node", "left").select(
            "prior", *_columns(width),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"))
    path = F.array_compact(F.array(*_columns(width)))
    return own.rollup("prior", *_columns(width)).agg(
        F.grouping_id().alias("gid"), F.sum("saved").alias("saved"),
        F.sum("leaves").alias("leaves")).where(F.col("gid") < (1 << width)).withColumn(
        "level", F.lit(width) - F.log2(F.col("gid") + 1).cast("int")).where(
        F.size(path) == F.col("level")).select(_node(path).alias("node"), "level", "saved", "leaves")


def trie(spark: SparkSession, turns: DataFrame, convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of the trie over ``turns(conv, idx, tid, cum)`` and ``convs(conv)``, which holds
    conversations without turns too."""
    if width < 1:
        raise ValueError("width must be 1 at least")
    seqs = sequences(spark, turns, convs)
    own = staged(spark, turns.join(seqs.select(F.col("rep").alias("conv")), "conv", "left_semi"),
                 "trie")
    active, below = seqs.withColumn("prior", F.lit("")), 0
    blocks, ends, chains = [], [], []
    while True:
        rows = staged(spark, block_rows(active, own if not below else deep, below, width), "trie")
        nodes = staged(spark, block_nodes(rows, below, width), "trie")
        blocks.append(nodes)
        ids = F.array_compact(F.array(*(F.col(c)["id"] for c in _columns(width))))
        at = rows.select("rep", "n", "words", "w", "ends", _node(ids).alias("node"))
        ends.append(at.where(F.col("n") <= below + width).select("node", "ends"))
        below += width
        on = staged(spark, at.where(F.col("n") > below).join(
            nodes.where(F.col("level") == width).select("node", "n_seqs"), "node"), "trie")
        chains.append(on.where("n_seqs = 1").withColumn("above", F.lit(below)))
        active = on.where("n_seqs > 1").select("rep", "n", "words", "w", "ends",
                                               F.col("node").alias("prior"))
        if active.isEmpty():
            break
        if below == width:
            # Sorted by number, so that each block reads its own row groups only.
            deep = staged(spark, own.where(F.col("idx") > below).join(
                active.select(F.col("rep").alias("conv")), "conv", "left_semi")
                .repartitionByRange("idx", "conv").sortWithinPartitions("idx"), "trie")
    sums, last = [], None
    for nodes in reversed(blocks):
        last = staged(spark, subtree_sums(nodes, last, width), "trie")
        sums.append(last)
    return _united(blocks, sums, ends, width).unionByName(_chains(own, chains))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _united(blocks: list, sums: list, ends: list, width: int) -> DataFrame:
    """The nodes of all blocks with subtree sums, children, parent and ends."""
    nodes = _all(blocks)
    # A block's level 0 repeats a node of the block above; only the root counts.
    total = _all([s if i == len(sums) - 1 else s.where("level > 0") for i, s in enumerate(sums)])
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    chain = (F.col("level") == width) & (F.col("n_seqs") == 1) & F.col("goes_on")
    return nodes.join(total.drop("level"), "node").join(children, "node", "left").join(
        _all(ends), "node", "left").join(above, "parent", "left").select(
        "conv", "depth", "parent_conv", "n_convs",
        (F.coalesce("children", F.lit(0)) + chain.cast("long")).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def _chains(own: DataFrame, chains: list) -> DataFrame:
    """Nodes below the last one that a sequence shares with another, straight from its turns."""
    c = _all(chains).select(F.col("rep").alias("conv"), "n", "words", "w", "ends", "above")
    last = F.col("idx") == F.col("n")
    return own.withColumn("turn_words", F.col("tid.words")).drop("tid").join(c, "conv").where(
        F.col("idx") > F.col("above")).select(
        "conv", F.col("idx").alias("depth"), F.col("conv").alias("parent_conv"),
        F.col("w").alias("n_convs"), (~last).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("w") - 1) * (F.col("words") - F.col("cum") + F.col("turn_words"))).alias(
            "saved_tokens"),
        F.when(last, F.col("ends")).otherwise(EMPTY_SHA).alias("ends_sha256"))


def report(spark: SparkSession, conversations: DataFrame, every: int = 20, heads: int = 4,
           width: int = WIDTH) -> DataFrame:
    """The trie of the rebuilt conversations: each conversation c opens with the first h turns of
    conversation c - c % ``every``, h = crc32(decimal c) % ``heads``, in place of its own. ``%`` takes the sign of c, as in SQL."""
    turns = numbered(spark, conversations)
    conv = F.col("conv")
    head = F.crc32(conv.cast("string").cast("binary")) % heads
    rebuilt, convs = grafted(spark, turns, conv - conv % every, head, heads - 1)
    out = trie(spark, rebuilt, convs, width)
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias(
        "parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
