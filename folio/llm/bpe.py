"""Byte-level BPE by recursive queries, one DuckDB database per task.

A text is cut into chunks (white space, then everything up to the next white
space); no match of the split pattern crosses such a cut, so the pattern is run
once per distinct chunk. The distinct words of a run of documents become
rows of tokens. A recursive query spreads them to token-position rows, joins
neighbours with the merge table and contracts each word's leftmost pair of least
rank, until no word has a pair left; ordered aggregation gives the ids and, over
the vocabulary's bytes, the decoded text.

Rounds are bounded per query (``ROUNDS``): what is not at its fixpoint then goes
into the next query, so the intermediate rows of a word of 100,000 letters stay
a small multiple of its length.

Defined cases: a null or empty text has no ids and the digests of no bytes;
repeated rows get equal results; texts longer than a run are a run of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
from collections import defaultdict
from typing import NamedTuple

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folio.llm.common import ragged, slices, texts_of, text_runs

#: White space as the split pattern sees it (Unicode White_Space; fixed values).
SPACE = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: A space beside other white space.
MIXED = re.compile(f" (?:[{SPACE}]|(?<=[{SPACE}] ))")
#: Bytes of text whose distinct words are encoded together.
RUN_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
#: Bytes of one text that are decoded at once.
PIECE_BYTES = 4 << 20
#: Token rows that one recursive query starts from, and its most rounds.
QUERY_TOKENS = 400_000
ROUNDS = 48
LONG = 256

CONTRACT = """
with recursive state(round, word, toks) as (
  select 0, word, toks from start
  union all
  select s.round + 1, s.word, s.toks[:best.pos - 1] || [best.rnk] || s.toks[best.pos + 2:]
  from state s
  join (select word, min(rnk) as rnk, arg_min(pos, (rnk << 32) + pos) as pos
        from (select word, unnest(range(1, len(toks))) as pos,
                     unnest(toks[:-2]) * 65536 + unnest(toks[2:]) as pair
              from state where round < {rounds})
        join merges using (pair)
        group by word) best on s.word = best.word
)
select word, arg_max(toks, round) as toks, max(round) = {rounds} as open
from state group by word
"""

COLLECT = """
select word, list(tok order by pos) as ids, string_agg(hex, '' order by pos) as hex
from (select word, unnest(toks) as tok, unnest(range(len(toks))) as pos from done)
join vocab using (tok) group by word
"""


class Words(NamedTuple):
    """Ids and bytes of distinct words; word ``i`` is a run of each array."""

    ids: np.ndarray
    ids_at: np.ndarray
    ids_n: np.ndarray
    text: np.ndarray
    text_at: np.ndarray
    text_n: np.ndarray

    def of(self, words: np.ndarray):
        """(ids, decoded bytes) of a text given as word numbers, piece by piece."""
        ends = np.cumsum(self.text_n[words])
        total = int(ends[-1]) if len(ends) else 0
        cuts = np.unique(np.searchsorted(ends, np.arange(PIECE_BYTES, total, PIECE_BYTES)))
        for w in np.split(words, cuts):
            yield (self.ids[ragged(self.ids_at[w], self.ids_n[w])].tobytes(),
                   self.text[ragged(self.text_at[w], self.text_n[w])].tobytes())


class Encoder:
    """The merge table of the rank file at ``path`` in a database of its own."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pairs = [(ranks[t[:i]] * 65536 + ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.split = regex.compile(pattern)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB",
                                         "preserve_insertion_order": False})
        self._load("merges", pa.table(list(map(pa.array, zip(*pairs))), names=["pair", "rnk"]))
        self._load("vocab", pa.table([pa.array(list(ranks.values()), pa.int64()),
                                      pa.array([t.hex() for t in ranks])], names=["tok", "hex"]))

    def _load(self, name: str, table: pa.Table) -> None:
        self.db.register("given", table)
        self.db.execute(f"create or replace temp table {name} as select * from given")
        self.db.unregister("given")

    def _fixpoint(self, words: list[bytes]):
        """(number of ids, all ids, number of bytes, all bytes) of the words, in their order:
        contract until no word has a pair left."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        tok = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        self._load("start", pa.table(
            [pa.array(np.arange(len(words))),
             pa.ListArray.from_arrays(np.append(0, np.cumsum(size)).astype(np.int32), tok)],
            names=["word", "toks"]))
        self.db.execute("create or replace temp table done (word bigint, toks bigint[])")
        while self.db.execute("select count(*) from start").fetchall()[0][0]:
            self.db.execute("create or replace temp table reached as "
                            + CONTRACT.format(rounds=ROUNDS))
            self.db.execute("insert into done select word, toks from reached where not open")
            self.db.execute("create or replace temp table start as "
                            "select word, toks from reached where open")
        got = self.db.sql(COLLECT).to_arrow_table()
        place = np.argsort(got.column("word").to_numpy())
        ids = got.column("ids").combine_chunks()
        n_ids = np.diff(ids.offsets.to_numpy())
        text = got.column("hex").cast(pa.large_string()).combine_chunks()
        ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:][:len(text) + 1]
        n_text = np.diff(ends) // 2
        data = np.frombuffer(binascii.unhexlify(
            text.buffers()[2].slice(ends[0], ends[-1] - ends[0])), dtype=np.uint8)

        def placed(flat, n):
            return n[place], flat[ragged((np.cumsum(n) - n)[place], n[place])]

        return (*placed(ids.flatten().to_numpy().astype("<u4"), n_ids), *placed(data, n_text))

    def words(self, words: list[str]) -> Words:
        """The coded words, in queries of about ``QUERY_TOKENS`` rows; long words
        apart from short ones, which need far fewer rounds."""
        raw = [w.encode() for w in words]
        size = np.array([len(w) for w in raw], dtype=np.int64)
        n_ids, n_text = np.zeros((2, len(raw)), dtype=np.int64)
        order, ids, text = [], [np.zeros(0, dtype="<u4")], [np.zeros(0, dtype=np.uint8)]
        for long in (False, True):
            todo = np.flatnonzero((size > LONG) == long)
            for a, b in slices(size[todo], QUERY_TOKENS // (16 if long else 1)):
                some = todo[a:b]
                n_ids[some], flat, n_text[some], data = self._fixpoint([raw[i] for i in some])
                order.append(some)
                ids.append(flat)
                text.append(data)
        order = np.concatenate([np.zeros(0, dtype=np.int64), *order])
        at_ids, at_text = np.zeros((2, len(raw)), dtype=np.int64)
        at_ids[order] = np.cumsum(n_ids[order]) - n_ids[order]
        at_text[order] = np.cumsum(n_text[order]) - n_text[order]
        return Words(np.concatenate(ids), at_ids, n_ids, np.concatenate(text), at_text, n_text)

    def chunks(self, chunks: list[str]):
        """The words of the chunks, each distinct one encoded once, with the word numbers of
        all chunks in a row and where each chunk's begin and how many they are."""
        number = numbering()
        of, n = [], []
        for c in chunks:
            words = self.split.findall(c)
            n.append(len(words))
            of.extend(map(number.__getitem__, words))
        n = np.array(n, dtype=np.int64)
        return self.words(list(number)), np.array(of, dtype=np.int64), np.cumsum(n) - n, n


def numbering() -> defaultdict:
    """A dictionary that numbers its keys as they are asked for."""
    number = defaultdict()
    number.default_factory = number.__len__
    return number


def numbered(number: defaultdict, text: str) -> np.ndarray:
    """The numbers of a text's chunks. A chunk that begins with its only white space, one
    space, is known by what follows; any other stands in a tuple. Where no space meets
    other white space a text may be cut at its spaces alone: then a piece holds
    several chunks, of which no match crosses the border either."""
    if MIXED.search(text):
        return np.array([number[(c,)] for c in CHUNK.findall(text)], dtype=np.int64)
    first, *rest = text.split(" ")
    codes = [number[(first,)]] if first else []
    codes.extend(map(number.__getitem__, rest))
    return np.array(codes, dtype=np.int64)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id",
               text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode every text: ``(key, n_tokens, ids_sha256, decoded_sha256)``
    and, ``with_ids``, the ids and the decoded bytes themselves."""

    def run(batches):
        encoder = Encoder(path, pattern)
        number, held, size = numbering(), [], 0

        def flush():
            table, of, at, n = encoder.chunks(
                [" " + c if isinstance(c, str) else c[0] for c in number])
            for keys, texts in held:
                counts, digests, rows, back = [], [], [], []
                for codes in texts:
                    ids, decoded, count = hashlib.sha256(), hashlib.sha256(), 0
                    kept = []
                    for piece in table.of(of[ragged(at[codes], n[codes])]):
                        ids.update(piece[0])
                        decoded.update(piece[1])
                        count += len(piece[0]) // 4
                        if with_ids:
                            kept.append(piece)
                    counts.append(count)
                    digests.append((ids.hexdigest(), decoded.hexdigest()))
                    rows.append(b"".join(p[0] for p in kept))
                    back.append(b"".join(p[1] for p in kept))
                out = [keys, pa.array(counts, pa.int64()),
                       pa.array([d for d, _ in digests], pa.string()),
                       pa.array([d for _, d in digests], pa.string())]
                if with_ids:
                    out += [pa.array(rows, pa.binary()), pa.array(back, pa.binary())]
                yield pa.RecordBatch.from_arrays(out, names=names)

        names = [key, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
        for batch in text_runs(batches, text, BATCH_BYTES):
            held.append((batch.column(0), [numbered(number, t).astype(np.int32)
                                           for t in texts_of(batch.column(1))]))
            size += batch.column(1).nbytes
            if size >= RUN_BYTES:
                yield from flush()
                number, held, size = numbering(), [], 0
        if held:
            yield from flush()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + ", ids binary, decoded binary" * with_ids)
