"""Concatenate-and-cut packing of documents into fixed windows of tokens.

Pass 1 tokenizes every text where it lies and writes ``(ids, part, start)``:
``start`` counts the tokens before the document in its partition. The token
total of each partition (one number per partition) is summed to a prefix, which
turns ``part, start`` into a global offset without moving a text. Pass 2 cuts
each document at the multiples of the window length.

Windows inside one task are complete; a window that crosses tasks or
partitions is given as boundary records, which ``sequences`` puts together (at
most ``window`` tokens a group, whatever the input size).

Defined cases: a null or empty text is the single end id; ids of repeated rows
are packed once per row; a text longer than the window spans several windows;
an empty table gives no pieces; columns other than the key and text are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import ragged, staged, texts_of, text_runs

WINDOW = 2048
END_ID = 1
#: The split pattern of byte-level vocabularies of this kind (a fixed value).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Texts of these characters are split alike by every version of Unicode.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
BATCH_BYTES = 8 << 20


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabulary files use for each byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids as the ``tokenizers`` library gives them for the file at ``path``.

    Plain texts take the faster rank encoder built from the same vocabulary,
    whose result is equal there; every other text goes through the library, and so does
    one that holds an added token's string (the library gives it that token's id).
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        vocab = given["model"]["vocab"]
        added = [t["content"] for t in given.get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, added)) if added else "(?!)")
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items()
                 if all(c in letters for c in token) and not token.startswith("<|")}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and not self.added.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def tokenize(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
             end_id: int = END_ID, narrow: bool = True) -> DataFrame:
    """Rows ``(key, ids, n, part, start)``; ``ids`` little-endian, 2 bytes each
    when ``narrow`` (vocabularies below 65,536 ids), else 4."""
    dtype = "<u2" if narrow else "<u4"

    def run(batches):
        encoder, part, start = Encoder(path), TaskContext.get().partitionId(), 0
        for batch in text_runs(batches, text, BATCH_BYTES):
            ids = [np.append(encoder.encode(t), end_id).astype(dtype)
                   for t in texts_of(batch.column(1))]
            n = np.array([len(x) for x in ids], dtype=np.int64)
            before = start + np.cumsum(n) - n
            start += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary()),
                 pa.array(n), pa.array(np.full(len(n), part, dtype=np.int32)),
                 pa.array(before)],
                names=[key, "ids", "n", "part", "start"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, ids binary, n long, part int, start long")


def prefix_sums(tokens: DataFrame) -> dict[int, int]:
    """Global offset of each partition: one row per partition on the driver."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n")).collect()
    base, at = {}, 0
    for row in sorted(totals, key=lambda r: r["part"]):
        base[row["part"]] = at
        at += row["n"]
    return base


def cut(tokens: DataFrame, base: dict[int, int], window: int = WINDOW, key: str = "doc_id",
        narrow: bool = True, with_ids: bool = False) -> DataFrame:
    """One row per piece: the run of a document's ids inside one window."""
    dtype = np.dtype("<u2" if narrow else "<u4")
    shared = tokens.sparkSession.sparkContext.broadcast(base)

    def run(batches):
        offsets = shared.value
        for batch in text_runs(batches, "ids", BATCH_BYTES):
            n = batch.column(2).to_numpy(zero_copy_only=False)
            part = batch.column(3).to_numpy(zero_copy_only=False)
            begin = batch.column(4).to_numpy(zero_copy_only=False) + np.array(
                [offsets[p] for p in part], dtype=np.int64)
            first, last = begin // window, (begin + n - 1) // window
            doc = np.repeat(np.arange(len(n)), last - first + 1)
            sequence = ragged(first, last - first + 1)
            lo = np.maximum(sequence * window, begin[doc])
            hi = np.minimum((sequence + 1) * window, begin[doc] + n[doc])
            start = lo - begin[doc]
            ids = [np.frombuffer(x, dtype=dtype).astype("<u4").tobytes()
                   for x in batch.column(1).to_pylist()]
            pieces = [ids[d][4 * a:4 * (a + k)] for d, a, k in
                      zip(doc.tolist(), start.tolist(), (hi - lo).tolist())]
            out = [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(hi - lo),
                   pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                   pa.array(n[doc]), pa.array(sequence), pa.array(lo - sequence * window)]
            names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                out.append(pa.array(pieces, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = tokens.schema[key].dataType.simpleString()
    return tokens.select(key, "ids", "n", "part", "start").mapInArrow(
        run, f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + ", ids binary" * with_ids)


def pack(spark: SparkSession, docs: DataFrame, path: str, window: int = WINDOW,
         key: str = "doc_id", text: str = "text", end_id: int = END_ID, narrow: bool = True,
         with_ids: bool = False) -> DataFrame:
    """The pieces of all documents; every window but the last is full."""
    tokens = staged(spark, tokenize(docs, path, key, text, end_id, narrow), "packing")
    return cut(tokens, prefix_sums(tokens), window, key, narrow, with_ids)


def _joined(pieces: Column) -> Column:
    """Id bytes of the pieces in offset order."""
    return F.aggregate(F.array_sort(pieces), F.unhex(F.lit("")),
                       lambda got, p: F.concat(got, p["ids"]))


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """The windows themselves: ``(sequence_id, n_tokens, ids)``, padded to ``window``.

    ``pieces`` needs ``with_ids``. Runs of pieces that fill a window inside one
    task are joined there; only boundary records are shuffled.
    """
    def run(batches):
        held, at, names = [], None, ["sequence_id", "offset", "ids"]

        def flush():
            size = sum(len(x) for _, x in held) // 4
            if size == window:
                return [(at, 0, b"".join(x for _, x in held))]
            return [(at, o, x) for o, x in held]

        for batch in batches:
            rows = []
            for s, o, x in zip(*(c.to_pylist() for c in batch.columns)):
                if at is not None and s != at:
                    rows += flush()
                    held = []
                at = s
                held.append((o, x))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(),
                                                                 pa.binary()))], names=names)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*flush()), (pa.int64(), pa.int64(),
                                                                pa.binary()))], names=names)

    parts = pieces.select("sequence_id", "offset", "ids").mapInArrow(
        run, "sequence_id long, offset long, ids binary")
    full = F.octet_length("ids") == 4 * window
    joined = parts.where(~full).groupBy("sequence_id").agg(
        _joined(F.collect_list(F.struct("offset", "ids"))).alias("ids"))
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()),
                           (F.lit(window) - F.octet_length("ids") / 4).cast("int")))
    return parts.where(full).select("sequence_id", "ids").unionByName(joined).select(
        "sequence_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.concat("ids", pad).alias("ids"))
