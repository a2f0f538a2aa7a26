"""Removal of long repeated passages by suffix arrays over shards of the corpus.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too. With
``Words`` as the unit a word goes if ``PASSAGE`` words that cover it stand anywhere else too;
below, what is told of bytes holds for the symbols of the unit. ``report`` finds strings of both
units in one pass: bytes go, and the words of repeated passages are counted.

1. Anchors. Winnowing picks the least hash of ``gram`` bytes in every window of half
   the positions of such a string. Equal strings of ``LENGTH`` bytes hold equal windows, so a window whose least
   hash is picked once in the corpus proves that no string around it repeats. What is
   left are candidate starts; unrelated text has none.
2. Shards. A candidate start is dealt by the least hash inside its whole string: equal
   strings have equal keys, and starts that share a key are one segment of text. Equal
   segments fold into one with a count; all starts of a segment that occurs twice are
   repeats. Only keys with a segment that occurs once go on, unless it is the key's only
   segment and holds the least hash at one place: its strings cannot be equal.
3. Order. Keys are packed into shards of about ``SHARD`` bytes; each shard's suffix array and
   common prefixes come from external induced sorting (``induced_sort``), or for words, which
   are numbered in each shard, from doubling. Neighbours
   with a common prefix of ``LENGTH`` bytes are repeats. A key of more bytes than a shard is
   split, so that no task sorts more than a shard and one key: its starts are dealt by the
   128-bit digests of their strings and counted.

Equal texts fold first (by a 128-bit digest), so groups of copies cost one text.

Defined cases: null text counts as empty; texts shorter than ``LENGTH`` lose nothing; matches
never cross texts; repeated rows are copies of each other; an empty table gives no rows;
other columns are ignored (``removed`` keeps them).
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import release, slices, staged, text_runs
from folio.llm.induced_sort import common_prefix, rank_in_memory, suffix_order

#: Bytes of a string, and words of one: a passage of over 50.
LENGTH = 400
PASSAGE = 51
#: Bytes sorted together: keys are added until so many are reached.
SHARD = 1 << 20
#: A key with more bytes than this is split by its strings.
LARGEST_KEY = SHARD
BATCH_BYTES = 4 << 20
#: Bytes of texts whose anchors are found together.
TOGETHER = 1 << 16
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Bytes:
    """Lengths count bytes."""

    gram = 32

    @staticmethod
    def split(data: bytes):
        """The symbols of a text."""
        return data

    @staticmethod
    def split_all(texts: list[bytes]):
        """The symbols of several texts in a row, where each begins and the end."""
        return b"".join(texts), np.append(0, np.cumsum([len(x) for x in texts]))

    @staticmethod
    def numbers(symbols) -> np.ndarray:
        """A number for each symbol; equal symbols have equal ones."""
        return np.frombuffer(symbols, dtype=np.uint8).astype(np.uint64)

    @staticmethod
    def joined(symbols) -> bytes:
        """Bytes that tell the symbols."""
        return symbols

    @staticmethod
    def strings(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each string of ``length`` symbols in what ``joined`` gave, its first byte and
        its bytes."""
        at = np.arange(len(data) - length + 1)
        return at, np.full(len(at), length)

    @staticmethod
    def coded(data: bytes, names: dict) -> np.ndarray:
        """The symbols in what ``joined`` gave as numbers from 2 on, the same ones for all
        that share ``names``."""
        return np.frombuffer(data, dtype=np.uint8).astype(np.int32) + 2

    @staticmethod
    def order(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array of numbers and common prefixes, exact for ``length`` of them."""
        return suffix_order(text, length)

    @staticmethod
    def places(data: bytes):
        """The first byte of each symbol of a text, and its end."""
        return range(len(data) + 1)


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@functools.lru_cache(maxsize=1)
def _weights(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(int(K1), n), _powers(pow(int(K1), -1, 1 << 64), n)


class Spans:
    """The words of a text by their first bytes and ends."""

    def __init__(self, data: bytes, begin: np.ndarray, end: np.ndarray):
        self.data, self.begin, self.end = data, begin, end

    def __len__(self) -> int:
        return len(self.begin)

    def __getitem__(self, some: slice) -> Spans:
        return Spans(self.data, self.begin[some], self.end[some])


class Words:
    """Lengths count words; white space between them does not matter. Han characters and
    kana, which no white space divides into words, are words by themselves."""

    gram = 8
    #: The definition; ``split`` finds the same words in whole arrays of bytes.
    word = re.compile(rb"[\xE3-\xE9][\x80-\xBF]{2}|[^\x20\x09-\x0D\xE3-\xE9]+")

    @staticmethod
    def split(data: bytes) -> Spans:
        x = np.frombuffer(data, dtype=np.uint8)
        out = (x == 32) | (x - np.uint8(9) < 5)
        begins = np.zeros(len(x) + 1, dtype=bool)
        lead = np.flatnonzero(x - np.uint8(0xE3) < 7)
        if len(lead):
            inner = np.append(x & 0xC0 == 0x80, [False, False])
            whole = lead[inner[lead + 1] & inner[lead + 2]]
            out[lead] = True
            out[whole] = False
            begins[whole] = True
            begins[whole + 3] = True
        inside = np.append(~out, False)
        begins[1:] |= out
        begins[0] = True
        begin = np.flatnonzero(begins & inside)
        stop = np.flatnonzero(begins | ~inside)  # where a word ends if one came before
        return Spans(data, begin, stop[np.searchsorted(stop, begin, side="right")])

    @classmethod
    def split_all(cls, texts: list[bytes]):
        symbols = cls.split(b" ".join(texts))
        return symbols, np.searchsorted(symbols.begin, np.append(0, np.cumsum(
            [len(x) + 1 for x in texts])))

    @staticmethod
    def numbers(symbols: Spans) -> np.ndarray:
        if not len(symbols):
            return np.zeros(0, dtype=np.uint64)
        low, high = int(symbols.begin[0]), int(symbols.end[-1])
        powers, inverse = _weights(1 << max(16, (high - low).bit_length()))
        x = np.frombuffer(symbols.data, dtype=np.uint8)[low:high].astype(np.uint64)
        x = np.append(np.uint64(0), np.cumsum((x + np.uint64(1)) * powers[:len(x)]))
        begin = symbols.begin - low
        return (x[symbols.end - low] - x[begin]) * inverse[begin]

    @classmethod
    def joined(cls, symbols: Spans) -> bytes:
        words = cls.word.findall(symbols.data[symbols.begin[0]:symbols.end[-1]])
        return b" " + b" ".join(words) + b" "

    @staticmethod
    def strings(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
        return at[:-length], at[length:] - at[:-length] + 1

    @staticmethod
    def coded(data: bytes, names: dict) -> np.ndarray:
        words = data[1:-1].split(b" ")
        return np.array([names.setdefault(w, len(names) + 2) for w in words], dtype=np.int64)

    @staticmethod
    def order(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        order = rank_in_memory(text, length)
        return order, np.append(0, common_prefix(text, order[:-1], order[1:], length))

    @classmethod
    def places(cls, data: bytes):
        return [*cls.split(data).begin.tolist(), len(data)]


#: What one pass looks for: units and the symbols of their strings.
Strings = list[tuple[type, int]]


def gram_hashes(symbols, unit=Bytes) -> np.ndarray:
    """A 64-bit hash of the ``unit.gram`` symbols at each position that has them."""
    gram, n = unit.gram, len(symbols) - unit.gram + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    x = unit.numbers(symbols) + np.uint64(1)
    x = (x * K2) ^ (x << np.uint64(17))
    # Doubling: a hash of 2, 4, ... bytes from two hashes of half the length.
    width = 1
    while width < gram:
        x = (x[:-width] * K1) ^ (x[width:] + (x[width:] >> np.uint64(31)))
        width *= 2
    x = (x ^ (x >> np.uint64(30))) * K2
    return x ^ (x >> np.uint64(27))


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones (blockwise running minima)."""
    n = len(x) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=x.dtype)
    top = np.iinfo(x.dtype).max
    whole = np.full(-(-len(x) // width) * width, top, dtype=x.dtype)
    whole[:len(x)] = x
    rows = whole.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def winnow(length: int, unit=Bytes) -> int:
    """Positions in a winnowing window: half of those inside a string of ``length`` symbols."""
    if length < 2 * unit.gram:
        raise ValueError(f"strings must have {2 * unit.gram} symbols at least")
    return (length - unit.gram + 1) // 2


def anchors(texts: list[bytes], length: int = LENGTH, unit=Bytes) -> tuple[np.ndarray, ...]:
    """``(sizes, text, hash, first, last, times)``: the symbols of each text; for each distinct
    anchor hash of a text, ordered by text, the first and last window it is the least of at
    first, and 1 or 2 (the hash is found once in the text, or more often)."""
    symbols, starts = unit.split_all(texts)
    sizes, width = np.diff(starts), winnow(length, unit)
    x = gram_hashes(symbols, unit)
    least = window_least(x, width)
    # Windows that lie in one text, of those long enough.
    whole = np.flatnonzero(sizes >= length)
    if not len(whole):
        none = np.zeros(0, dtype=np.int64)
        return sizes, none, none, none, none, none
    low, high = starts[whole], starts[whole + 1] - unit.gram - width + 1
    edge = np.append(least[1:] != least[:-1], True)
    inside = np.zeros(len(least) + 1, dtype=np.int8)
    inside[low] += 1
    inside[high + 1] -= 1
    inside = np.cumsum(inside[:-1]).astype(bool)
    begins, ends = np.append(True, edge[:-1]), edge
    begins[low], ends[high] = True, True
    begin, end = np.flatnonzero(begins & inside), np.flatnonzero(ends & inside)
    text = whole[np.searchsorted(low, begin, side="right") - 1]
    # Distinct hashes of a text, each with the first of its runs.
    value = least[begin]
    order = np.lexsort((value, text))
    new = np.append(True, (np.diff(text[order]) != 0) | (np.diff(value[order]) != 0))
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(order)))
    first = order[at]
    text, value = text[first], value[first]
    # Few hashes share their low bits with an anchor; only those are looked up.
    shared = np.zeros(1 << 16, dtype=bool)
    shared[value.astype(np.uint16)] = True
    place = np.flatnonzero(shared[x.astype(np.uint16)])
    own = np.searchsorted(starts, place, side="right") - 1
    place, own = (a[place + unit.gram <= starts[own + 1]] for a in (place, own))
    mixed = value + text.astype(np.uint64) * K1
    by = np.argsort(mixed)
    look = x[place] + own.astype(np.uint64) * K1
    slot = np.minimum(np.searchsorted(mixed, look, sorter=by), len(by) - 1)
    found = np.bincount(by[slot][mixed[by[slot]] == look], minlength=len(value))
    return (sizes, text, value.view(np.int64), begin[first] - starts[text],
            end[first] - starts[text], np.minimum(np.maximum(found, runs), 2))


def candidate_starts(n: int, first: np.ndarray, last: np.ndarray, length: int = LENGTH, unit=Bytes
                     ) -> tuple[np.ndarray, np.ndarray]:
    """Ranges (firsts, lasts) of starts in ``n`` symbols whose string holds no window whose least hash occurs
    once in the corpus; such windows run from ``first`` to ``last``."""
    room = length - unit.gram + 1 - winnow(length, unit)
    order = np.argsort(first)
    firsts = np.append(0, np.maximum.accumulate(last[order] + 1))
    lasts = np.append(np.minimum(first[order] - room - 1, n - length), n - length)
    keep = firsts <= lasts
    return firsts[keep], lasts[keep]


def segments_of(symbols, ranges, length: int = LENGTH, unit=Bytes):
    """(key, start, end, alone) of the runs of starts in ``ranges`` with one least hash; a segment
    is symbols[start:end + length], ``alone`` if it holds that hash at one place."""
    for a, b in ranges:
        x = gram_hashes(symbols[a:b + length], unit)
        least = window_least(x, length - unit.gram + 1)
        cuts = np.append(np.flatnonzero(np.diff(least)) + 1, len(least))
        begin = 0
        for end in cuts.tolist():
            key = least[begin]
            alone = np.count_nonzero(x[begin:end + length - unit.gram] == key) == 1
            yield int(key.view(np.int64)), a + begin, a + end - 1, alone
            begin = end


def repeated_starts(segments: list[bytes], length: int = LENGTH, unit=Bytes
                    ) -> list[list[tuple[int, int]]]:
    """For each segment, runs (first, last) of starts whose string occurs elsewhere in these
    segments, by the suffix array of their concatenation."""
    parts, starts, names, at = [], [], {}, 0
    for s in segments:
        coded = unit.coded(s, names)
        parts += [coded, np.ones(1, dtype=coded.dtype)]
        starts.append((at, at + len(coded) - length + 1))
        at += len(coded) + 1
    text = np.concatenate([*parts, np.zeros(1, dtype=parts[0].dtype)])
    order, lcp = unit.order(text, length)
    # The longest prefix that a suffix has in common with any other it has with a neighbour.
    near = np.zeros(len(text), dtype=np.int64)
    near[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    out = []
    for a, b in starts:
        own = np.append(np.append(False, near[a:b] >= length), False)
        edge = np.flatnonzero(own[1:] != own[:-1])
        out.append([(int(x), int(y) - 1) for x, y in zip(edge[::2], edge[1::2])])
    return out


def _text(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def _tkey(col: str = "text"):
    return F.unhex(F.md5(_text(col)))


def _bytes_of(column) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _lists(columns, types) -> list[pa.Array]:
    """Columns of lists from the arrays of each row."""
    return [pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum([len(x) for x in c])), pa.int32()),
        pa.array(np.concatenate([np.zeros(0, np.int64), *c]).astype(t)))
        for c, t in zip(columns, types)]


def texts_with_anchors(docs: DataFrame, text: str, looked_for: Strings) -> DataFrame:
    """One row per document: digest, and for the units ``which`` the number of symbols and the
    anchors. The text itself is not kept."""

    def run(batches):
        for batch in text_runs(batches, "text", BATCH_BYTES):
            texts = _bytes_of(batch.column(1))
            cuts = list(slices(np.array([len(x) for x in texts]), TOGETHER))
            found = []
            for unit, length in looked_for:
                parts = [anchors(texts[a:b], length, unit) for a, b in cuts]
                sizes, row, *rest = (np.concatenate(x) for x in zip(*parts))
                row += np.repeat([a for a, _ in cuts], [len(x[1]) for x in parts])
                found.append((sizes, row, *rest))
            row = np.concatenate([x[1] for x in found])
            which = np.repeat(np.arange(len(found)), [len(x[1]) for x in found])
            order = np.argsort(row, kind="stable")
            offsets = pa.array(np.searchsorted(row[order], np.arange(len(texts) + 1)), pa.int32())
            lists = [which, *(np.concatenate([x[k] for x in found]) for k in range(2, 6))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tolist() for x in np.stack([x[0] for x in found], 1)],
                                           pa.list_(pa.int64())),
                 *(pa.ListArray.from_arrays(offsets, pa.array(x[order].astype(t)))
                   for x, t in zip(lists, (np.int8, np.int64, np.int32, np.int32, np.int32)))],
                names=["tkey", "n_symbols", "which", "hashes", "a", "b", "times"])

    return docs.select(_tkey(text).alias("tkey"), _text(text).alias("text")).mapInArrow(
        run, "tkey binary, n_symbols array<long>, which array<byte>, hashes array<long>, "
        "a array<int>, b array<int>, times array<int>")


def candidates(texts: DataFrame, looked_for: Strings) -> DataFrame:
    """``(u, tkey, copies, which, firsts, lasts)`` of the texts with candidate starts."""
    seen = texts.select("u", "copies", F.explode(F.arrays_zip("which", "hashes", "a", "b", "times"))
                        .alias("x")).select("u", "copies", "x.*")
    once = seen.groupBy("which", "hashes").agg(
        F.sum(F.col("times").cast("long") * F.col("copies")).alias("times"), F.min("u").alias("u"),
        F.min("a").alias("a"), F.min("b").alias("b")).where("times = 1")
    unique = once.groupBy("u").agg(F.collect_list(F.struct("which", "a", "b")).alias("unique"))

    def run(batches):
        for batch in batches:
            lists = batch.column(4)
            sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
            ends = np.cumsum(sizes)
            which, first, last = (x.to_numpy(zero_copy_only=False).astype(np.int64)
                                  for x in lists.flatten().flatten())
            found = []
            for n, a, b in zip(batch.column(3).to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                own = [[], [], []]
                for k, (unit, length) in enumerate(looked_for):
                    if n[k] >= length:
                        some = a + np.flatnonzero(which[a:b] == k)
                        ranges = candidate_starts(n[k], first[some], last[some], length, unit)
                        for x, y in zip(own, (np.full(len(ranges[0]), k), *ranges)):
                            x.append(y)
                found.append([np.concatenate([np.zeros(0, np.int64), *x]) for x in own])
            keep = pa.array([len(x[0]) > 0 for x in found])
            found = [x for x in found if len(x[0])]
            yield pa.RecordBatch.from_arrays(
                [*(c.filter(keep) for c in batch.columns[:3]),
                 *_lists(zip(*found) if found else [[]] * 3, (np.int8, np.int32, np.int32))],
                names=["u", "tkey", "copies", "which", "firsts", "lasts"])

    long = functools.reduce(lambda x, y: x | y, (
        F.col("n_symbols")[k] >= length for k, (_, length) in enumerate(looked_for)))
    return texts.where(long).join(unique, "u", "left").select(
        "u", "tkey", "copies", "n_symbols", "unique").mapInArrow(
        run, "u long, tkey binary, copies long, which array<byte>, firsts array<int>, "
        "lasts array<int>")


def segment_rows(found: DataFrame, looked_for: Strings) -> DataFrame:
    """``(which, key, seg, data, last, alone, u, start, copies)``, ``last`` the last start of a
    segment, for the texts ``(u, copies, which, firsts, lasts, text)``."""

    def run(batches):
        for batch in text_runs(batches, "text", BATCH_BYTES):
            rows = []
            for u, copies, which, firsts, lasts, data in zip(
                    *(c.to_pylist() for c in batch.columns[:5]), _bytes_of(batch.column(5))):
                for k in sorted(set(which)):
                    unit, length = looked_for[k]
                    symbols = unit.split(data)
                    ranges = [(a, b) for w, a, b in zip(which, firsts, lasts) if w == k]
                    for key, a, b, alone in segments_of(symbols, ranges, length, unit):
                        piece = unit.joined(symbols[a:b + length])
                        rows.append((k, key, hashlib.md5(bytes([k]) + piece).digest(), piece,
                                     b - a, alone, u, a, copies))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int8(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.bool_(),
                        pa.int64(), pa.int32(), pa.int64()))],
                    names=["which", "key", "seg", "data", "last", "alone", "u", "start", "copies"])

    return found.select("u", "copies", "which", "firsts", "lasts", "text").mapInArrow(
        run, "which byte, key long, seg binary, data binary, last int, alone boolean, u long, "
        "start int, copies long")


def repeats_in_shards(open_segments: DataFrame, partitions: int, looked_for: Strings,
                      shard_bytes: int) -> DataFrame:
    """``(seg, first, last)``: runs of repeated starts in segments ``(which, key, seg, data)``. A
    shard has one unit and is closed at the first key after ``shard_bytes``, so it holds whole keys."""

    def flush(held, which):
        unit, length = looked_for[which]
        runs = repeated_starts([d for _, d in held], length, unit)
        rows = [(s, a, b) for (s, _), r in zip(held, runs) for a, b in r]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int32(),
                                                             pa.int32()))],
                names=["seg", "first", "last"])

    def run(batches):
        held, last, size = [], (None, None), 0
        for batch in batches:
            for which, key, seg, data in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (which != last[0] or key != last[1] and size >= shard_bytes):
                    yield from flush(held, last[0])
                    held, size = [], 0
                last = which, key
                held.append((seg, data))
                size += len(data) + 1
        if held:
            yield from flush(held, last[0])

    return open_segments.select("which", "key", "seg", "data").repartition(
        partitions, "which", "key").sortWithinPartitions("which", "key").mapInArrow(
        run, "seg binary, first int, last int")


def repeats_by_string(spark: SparkSession, hot: DataFrame, looked_for: Strings) -> DataFrame:
    """The same for keys larger than a shard: each segment's strings fold by their digests, with
    the places they start at, and are dealt by digest."""

    def run(batches):
        for batch in text_runs(batches, "data", BATCH_BYTES):
            for which, seg, data in zip(*(c.to_pylist() for c in batch.columns)):
                unit, length = looked_for[which]
                places: dict[bytes, list[int]] = {}
                for at, (first, size) in enumerate(zip(*(x.tolist() for x in unit.strings(
                        data, length)))):
                    places.setdefault(hashlib.md5(bytes([which]) + data[first:first + size]).digest(),
                                      []).append(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seg] * len(places), pa.binary()),
                     pa.array(list(places), pa.binary()),
                     pa.array(list(places.values()), pa.list_(pa.int32()))],
                    names=["seg", "string", "firsts"])

    strings = staged(spark, hot.select("which", "seg", "data").mapInArrow(
        run, "seg binary, string binary, firsts array<int>"), "suffix")
    twice = strings.groupBy("string").agg(F.sum(F.size("firsts")).alias("n")).where(
        "n > 1").select("string")
    starts = strings.join(twice, "string").groupBy("seg").agg(
        F.array_sort(F.flatten(F.collect_list("firsts"))).alias("firsts"))
    # Neighbouring starts have one difference between place and rank.
    return starts.select("seg", F.explode(F.transform("firsts", lambda at, i: F.struct(
        (at - i).alias("run"), at.alias("at")))).alias("x")).groupBy("seg", "x.run").agg(
        F.min("x.at").alias("first"), F.max("x.at").alias("last")).select("seg", "first", "last")


def repeated_spans(spark: SparkSession, docs: DataFrame, looked_for: Strings, text: str = "text",
                   shard_bytes: int = SHARD, largest_key: int = LARGEST_KEY
                   ) -> tuple[DataFrame, DataFrame]:
    """(repeated starts ``(u, which, first, last)`` of the distinct texts, the texts that have
    candidates ``(u, tkey, text)``)."""
    rows = texts_with_anchors(docs, text, looked_for)
    texts = staged(spark, rows.groupBy("tkey").agg(
        F.count(F.lit(1)).alias("copies"), F.first("n_symbols").alias("n_symbols"),
        F.first(F.struct("which", "hashes", "a", "b", "times")).alias("x")).select(
        "tkey", "copies", "n_symbols", "x.*", F.monotonically_increasing_id().alias("u")), "suffix")
    found = staged(spark, candidates(texts, looked_for), "suffix")
    release(spark)
    bodies = docs.select(_tkey(text).alias("tkey"), _text(text).alias("text")).groupBy("tkey").agg(
        F.first("text").alias("text"))
    found = staged(spark, bodies.join(found, "tkey"), "suffix")
    segments = staged(spark, segment_rows(found, looked_for), "suffix")
    folded = staged(spark, segments.groupBy("seg").agg(
        F.sum("copies").alias("times"), *(F.first(c).alias(c) for c in (
            "which", "key", "last", "alone")),
        F.first(F.octet_length("data") + 1).alias("size"),
        F.min(F.struct("u", "start")).alias("one")), "suffix")
    release(spark)

    keys = folded.groupBy("which", "key").agg(
        F.min("times").alias("least"), F.sum("size").alias("size"),
        ((F.count(F.lit(1)) == 1) & F.min("alone")).alias("alone")).where(
        "least = 1 and not alone").select("which", "key", "size")
    keys = staged(spark, keys, "suffix")
    cool = keys.where(F.col("size") <= largest_key)
    total = cool.agg(F.sum("size")).collect()[0][0] or 0
    shards = -(-total // shard_bytes)
    parts = [folded.where("times > 1").select(
        "seg", F.lit(0).alias("first"), "last")]

    def bodies_of(some: DataFrame) -> DataFrame:
        """``(which, key, seg, data)`` of the distinct segments of some keys."""
        ones = folded.join(some, ["which", "key"]).select(
            "which", "key", "seg", "one.u", "one.start")
        return segments.select("seg", "data", "u", "start").join(ones, ["seg", "u", "start"])

    if total:
        parts.append(repeats_in_shards(bodies_of(cool), shards, looked_for, shard_bytes))
    hot = keys.where(F.col("size") > largest_key)
    if hot.limit(1).count():
        parts.append(repeats_by_string(spark, bodies_of(hot), looked_for))
    runs = parts[0]
    for p in parts[1:]:
        runs = runs.unionByName(p)
    spans = runs.join(segments.select("seg", "which", "u", "start"), "seg").select(
        "u", "which", (F.col("start") + F.col("first")).alias("first"),
        (F.col("start") + F.col("last")).alias("last"))
    return spans, found.select("u", "tkey", "text")


def merged(firsts, lasts, length: int) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of symbols covered by the strings that start in the ranges."""
    out: list[list[int]] = []
    for a, b in sorted(zip(firsts, lasts)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [tuple(x) for x in out]


def cut_texts(spark: SparkSession, docs: DataFrame, looked_for: Strings, text: str = "text",
              shard_bytes: int = SHARD, largest_key: int = LARGEST_KEY) -> DataFrame:
    """``(tkey, n_removed, n_spans, kept_sha256, kept, covered)`` of the distinct texts with repeats.
    Strings of the first unit are cut: ``kept`` holds the remaining bytes, and white space goes
    with the word before it. ``covered`` counts the symbols of each unit that are repeated."""
    spans, found = repeated_spans(spark, docs, looked_for, text, shard_bytes, largest_key)
    release(spark)
    lists = spans.distinct().groupBy("u").agg(
        F.collect_list(F.struct("which", "first", "last")).alias("runs"))

    def run(batches):
        for batch in text_runs(batches, "text", BATCH_BYTES):
            out = []
            for runs, data in zip(batch.column(1).to_pylist(), _bytes_of(batch.column(2))):
                gone = []
                for k, (_, length) in enumerate(looked_for):
                    own = [r for r in runs if r["which"] == k]
                    gone.append(merged([r["first"] for r in own], [r["last"] for r in own], length))
                kept, at = [], 0
                places = looked_for[0][0].places(data) if gone[0] else []
                for a, b in gone[0]:
                    kept.append(data[at:places[a]])
                    at = places[b]
                kept = b"".join(kept) + data[at:]
                out.append((len(data) - len(kept), len(gone[0]), hashlib.sha256(kept).hexdigest(),
                            kept, [sum(b - a for a, b in x) for x in gone]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))))],
                names=["tkey", "n_removed", "n_spans", "kept_sha256", "kept", "covered"])

    return found.join(lists, "u").select("tkey", "runs", "text").mapInArrow(
        run, "tkey binary, n_removed long, n_spans long, kept_sha256 string, kept binary, "
        "covered array<long>")


def report(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
           length: int = LENGTH, shard_bytes: int = SHARD, largest_key: int = LARGEST_KEY,
           passage: int = PASSAGE) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept_sha256, repeated, n_passage_words, has_passage)`` of
    every document; ``repeated`` tells that it loses bytes. The last two are of words: how many are
    covered by ``passage`` words that stand anywhere else too, and whether any is."""
    cut = cut_texts(spark, docs, [(Bytes, length), (Words, passage)], text, shard_bytes, largest_key)
    utf8 = _text(text).cast("binary")
    whole = docs.select(F.col(key).alias(key), _tkey(text).alias("tkey"),
                        F.octet_length(utf8).cast("long").alias("n_bytes"),
                        F.sha2(utf8, 256).alias("whole"))
    none = F.lit(0).cast("long")
    return whole.join(cut.drop("kept"), "tkey", "left").select(
        key, "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        (F.coalesce("n_removed", none) > 0).alias("repeated"),
        F.coalesce(F.col("covered")[1], none).alias("n_passage_words"),
        (F.coalesce(F.col("covered")[1], none) > 0).alias("has_passage"))


def removed(spark: SparkSession, docs: DataFrame, text: str = "text", length: int = LENGTH,
            shard_bytes: int = SHARD, largest_key: int = LARGEST_KEY, unit=Bytes) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``. Bytes of a character that is
    only partly covered stay out, so the text is valid."""
    cut = cut_texts(spark, docs, [(unit, length)], text, shard_bytes, largest_key)

    def run(batches):
        for batch in text_runs(batches, "kept", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.decode("utf-8", "ignore") for b in
                                            batch.column(1).to_pylist()])],
                names=["__tkey", "__kept"])

    kept = cut.select("tkey", "kept").mapInArrow(run, "__tkey binary, __kept string")
    joined = docs.withColumn("__tkey", _tkey(text)).join(kept, "__tkey", "left")
    return joined.select(*(F.coalesce("__kept", F.col(f"`{c}`")).alias(c) if c == text
                           else F.col(f"`{c}`") for c in docs.columns))
