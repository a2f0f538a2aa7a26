"""Quality rules: divergence of a document's histograms from its language's.

Two histograms are compared with the language's reference by the Jensen-Shannon
distance (base 2, 0 to 1): character classes, and the language's common short
words. The references are counts over all documents. A document shorter than a
guard is not judged by a histogram: ``MIN_CHARS`` letters and signs for the
classes, ``MIN_WORDS`` words for the words.

Base columns are exact counts on the whole text. ``kept`` is false when a base
rule fails or a distance is above its limit.

Defined cases: a null or empty text has no words and fails the base rule; a null
language has the reference of all documents together; repeated rows get equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import staged, texts_of, text_runs

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOLS = "#*$%&|<>"
BATCH_BYTES = 4 << 20
MIN_BASE_WORDS = 10
REPEAT_PERCENT = 20
SPAN = 5

#: Classes of characters; a character belongs to the first that fits.
CLASSES = ("newline", "space", "lower", "upper", "digit", "symbol", "stop", "mark", "other")
#: Common words of a language are its most frequent ones of so many letters at most.
SHORT_LETTERS = 5
COMMON = 48
MIN_CHARS = 200
MIN_WORDS = 40
MAX_CLASS_DISTANCE = 0.25
#: Limit for the words: ``WORD_BASE + WORD_NOISE / sqrt(n_words)``, since the distance
#: of a mere sample falls with the root of its size. Set on labelled documents.
WORD_BASE = 0.2
WORD_NOISE = 1.6

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def class_table() -> np.ndarray:
    """Class number of each code point."""
    def of(c: str) -> str:
        if c == "\n":
            return "newline"
        if c.isspace():
            return "space"
        kind = unicodedata.category(c)
        if c in SYMBOLS or kind in ("Sm", "Sc", "So"):
            return "symbol"
        if c in ".,;:":
            return "stop"
        if kind == "Lu":
            return "upper"
        if kind[0] in "LM":
            return "lower"
        if kind[0] == "N":
            return "digit"
        return "mark" if kind[0] == "P" else "other"

    return np.array([CLASSES.index(of(chr(c))) for c in range(0x110000)], dtype=np.uint8)


def class_counts(texts: list[str], table: np.ndarray) -> np.ndarray:
    """(documents, classes) counts."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), size)
    return np.bincount(doc * len(CLASSES) + table[points],
                       minlength=len(texts) * len(CLASSES)).reshape(len(texts), -1)


def repeated_words(codes: list[np.ndarray]) -> np.ndarray:
    """Words of each document inside a window of ``SPAN`` words found twice or more there."""
    size = np.array([len(c) for c in codes], dtype=np.int64)
    flat = np.concatenate([*codes, np.zeros(0, dtype=np.int64)]).astype(np.uint64)
    doc = np.repeat(np.arange(len(codes), dtype=np.int64), size)
    out = np.zeros(len(codes), dtype=np.int64)
    n = len(flat) - SPAN + 1
    if n <= 0:
        return out
    h = doc[:n].astype(np.uint64)
    for k in range(SPAN):
        h = (h ^ flat[k:n + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    inside = np.flatnonzero(doc[:n] == doc[SPAN - 1:])
    order = inside[np.argsort(h[inside], kind="stable")]
    a, b = order[:-1], order[1:]
    same = h[a] == h[b]
    a, b = a[same], b[same]
    for k in range(SPAN):  # equal hashes are not taken on trust
        ok = (flat[a + k] == flat[b + k]) & (doc[a] == doc[b])
        a, b = a[ok], b[ok]
    covered = np.zeros(len(flat) + 1, dtype=np.int64)
    starts = np.unique(np.concatenate([a, b]))
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + SPAN, -1)
    hit = np.cumsum(covered[:-1]) > 0
    return np.bincount(doc[hit], minlength=len(codes)).astype(np.int64)


def dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


def base_counts(texts: list[str]) -> tuple[dict[str, np.ndarray], list[np.ndarray], list[str]]:
    """The base columns, each text's words as numbers, and the words by number."""
    number: dict[str, int] = {}
    words = [WORD.findall(t) for t in texts]
    codes = [np.array([number.setdefault(w, len(number)) for w in ws], dtype=np.int64)
             for ws in words]
    length = np.array([len(w) for w in number] + [0], dtype=np.int64)
    return {
        "n_words": np.array([len(c) for c in codes], dtype=np.int64),
        "word_chars": np.array([int(length[c].sum()) for c in codes], dtype=np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], dtype=np.int64),
        "n_dup_lines": np.array([dup_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": repeated_words(codes),
    }, codes, list(number)


def short_form(word: str) -> str:
    """The word in lower case without signs around it; empty if it is not a short word."""
    core = word.strip(".,;:!?\"'()").lower()
    return core if 0 < len(core) <= SHORT_LETTERS and core.isalpha() else ""


def references(docs: DataFrame) -> DataFrame:
    """Counts over all documents: ``(lang, kind, item, n)``, kind ``class``, ``word``
    or ``words`` (all words). Each task sends one row per item it has seen."""

    def run(batches):
        table, seen = class_table(), Counter()
        for batch in text_runs(batches, "text", BATCH_BYTES):
            texts, langs = texts_of(batch.column(1)), batch.column(0).to_pylist()
            classes = class_counts(texts, table)
            total: dict[str | None, Counter] = {}
            for lang, text, row in zip(langs, texts, classes.tolist()):
                words = total.setdefault(lang, Counter())
                words.update(WORD.findall(text))
                for name, n in zip(CLASSES, row):
                    seen[lang, "class", name] += n
            for lang, words in total.items():
                for w, n in words.items():
                    seen[lang, "words", ""] += n
                    if short := short_form(w):
                        seen[lang, "word", short] += n
        if seen:
            (keys, counts) = zip(*seen.items())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.string()) for x in zip(*keys)), pa.array(counts, pa.int64())],
                names=["lang", "kind", "item", "n"])

    return docs.select("lang", "text").mapInArrow(
        run, "lang string, kind string, item string, n long").groupBy(
        "lang", "kind", "item").agg(F.sum("n").alias("n"))


def load_references(docs: DataFrame) -> dict[str | None, tuple[np.ndarray, dict[str, int],
                                                               np.ndarray]]:
    """For each language: class histogram, common words by number, their histogram
    (the last bin holds all other words). ``None`` stands for all documents.

    The driver gets at most ``COMMON + classes + 1`` rows a language.
    """
    counts = staged(docs.sparkSession, references(docs), "quality")
    both = counts.unionByName(counts.where(F.col("lang").isNotNull()).withColumn(
        "lang", F.lit(None).cast("string"))).groupBy("lang", "kind", "item").agg(
        F.sum("n").alias("n"))
    top = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    rows = both.withColumn("r", F.row_number().over(top)).where(F.col("r") <= COMMON).collect()
    out = {}
    for lang in {r["lang"] for r in rows}:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: r["r"])
        of = {r["item"]: r["n"] for r in own if r["kind"] == "class"}
        words = [(r["item"], r["n"]) for r in own if r["kind"] == "word"]
        total = sum(r["n"] for r in own if r["kind"] == "words")
        out[lang] = (np.array([of.get(c, 0) for c in CLASSES], dtype=float),
                     {w: i for i, (w, _) in enumerate(words)},
                     np.array([n for _, n in words] + [total - sum(n for _, n in words)],
                              dtype=float))
    return out


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` from ``q``; 0 for an empty row."""
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1e-300)
    q = q / max(q.sum(), 1e-300)
    m = (p + q) / 2

    def entropy(x):
        return -(x * np.log2(np.where(x > 0, x, 1))).sum(axis=-1)

    js = entropy(m) - (entropy(p) + entropy(np.broadcast_to(q, p.shape))) / 2
    return np.sqrt(np.clip(js, 0, 1)) * (p.sum(axis=-1) > 0)


def judge(docs: DataFrame, reference: dict | None = None,
          max_class: float = MAX_CLASS_DISTANCE, word_base: float = WORD_BASE,
          word_noise: float = WORD_NOISE) -> DataFrame:
    """Base columns, both distances and the verdict of every document."""
    reference = load_references(docs) if reference is None else reference
    shared = docs.sparkSession.sparkContext.broadcast(reference)

    def run(batches):
        table, refs = class_table(), shared.value
        for batch in text_runs(batches, "text", BATCH_BYTES):
            texts, langs = texts_of(batch.column(2)), batch.column(1).to_pylist()
            base, codes, words = base_counts(texts)
            classes, n = class_counts(texts, table), base["n_words"]
            shorts = [short_form(w) for w in words]
            by_class, by_word = np.zeros(len(texts)), np.zeros(len(texts))
            for lang in set(langs):
                chars, common, histogram = refs.get(lang) or refs[None]
                bin_of = np.array([common.get(s, len(common)) for s in shorts] + [0])
                rows = [i for i, x in enumerate(langs) if x == lang]
                by_class[rows] = distance(classes[rows].astype(float), chars)
                by_word[rows] = distance(np.array(
                    [np.bincount(bin_of[codes[i]], minlength=len(histogram)) for i in rows],
                    dtype=float), histogram)
            by_class[classes.sum(axis=1) < MIN_CHARS] = 0
            by_word[n < MIN_WORDS] = 0
            failed = (n < MIN_BASE_WORDS) | (100 * base["n_repeat_words"] > REPEAT_PERCENT * n)
            kept = ~failed & (by_class <= max_class) & (
                by_word <= word_base + word_noise / np.sqrt(np.maximum(n, 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(base[c]) for c in STATS), pa.array(failed),
                 pa.array(kept), pa.array(by_class), pa.array(by_word)],
                names=["doc_id", *STATS, "base_failed", "kept", "class_distance",
                       "word_distance"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "lang", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in STATS)
        + ", base_failed boolean, kept boolean, class_distance double, word_distance double")
