"""Language identification: script ranges, then Viterbi over per-word scores.

A word's letters give its scripts; only languages whose training text uses one
of them in earnest stay candidates. A candidate's score is the log probability
of the word's character n-grams (1 to 3 letters, with word edges) under the
language's smoothed model. Viterbi with a penalty for every switch labels each
word, so a text in several languages falls into spans. The document's language
is that of the most letters, its score the mean posterior over its words.

The models are n-gram counts in ``BUCKETS`` hashed bins a language, fitted on a
bounded sample of labelled documents: of each language about ``sample`` rows, those whose
hash of ``doc_id`` falls in the language's share, whole texts. (What is broadcast for
that is one row per language.)

Defined cases: a null or empty text, or one without a letter, is ``und`` with
score 0; without any labelled row every text is ``und``; a letter of a script
that no language was trained on leaves all candidates; repeated rows get equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import bound_batches, ragged, texts_of, text_runs

UNDETERMINED = "und"
BUCKETS = 1 << 16
SAMPLE = 1500
SWITCH_PENALTY = 6.0
SMOOTHING = 0.5
#: A language uses a script if it has this share of its training letters.
SCRIPT_SHARE = 0.02
#: A text in which no language has this score is rejected by ``known``.
LEAST_SCORE = 0.25
BATCH_BYTES = 4 << 20

#: Script ranges by first code point (fixed values of the Unicode blocks).
SCRIPTS = (
    ("latin", 0x0000), ("greek", 0x0370), ("cyrillic", 0x0400), ("armenian", 0x0530),
    ("hebrew", 0x0590), ("arabic", 0x0600), ("indic", 0x0900), ("thai", 0x0E00),
    ("georgian", 0x10A0), ("hangul", 0x1100), ("latin", 0x1E00), ("greek", 0x1F00),
    ("kana", 0x3040), ("han", 0x3400), ("hangul", 0xAC00), ("other", 0xD7B0), ("han", 0x20000),
    ("other", 0x30000),
)
NAMES = tuple(dict.fromkeys(name for name, _ in SCRIPTS))


def held_out(key: str = "doc_id"):
    """True for the third of the documents that no model may learn from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its script's number. Built once on the
    driver; tasks get the two arrays of a byte a code point."""
    letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)),
                         dtype=bool, count=0x110000)
    starts = np.array([s for _, s in SCRIPTS])
    number = np.array([NAMES.index(name) for name, _ in SCRIPTS], dtype=np.int8)
    return letter, number[np.searchsorted(starts, np.arange(0x110000), side="right") - 1]


class Words:
    """The distinct words of a run of texts: letters, scripts, hashed n-grams."""

    def __init__(self, words: list[str], letter: np.ndarray, script: np.ndarray):
        lower = [w.lower() for w in words]
        size = np.array([len(w) for w in lower], dtype=np.int64)
        points = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        word = np.repeat(np.arange(len(words), dtype=np.int64), size)
        is_letter = letter[points]
        points, word = points[is_letter].astype(np.uint64), word[is_letter]
        self.n = len(words)
        self.letters = np.bincount(word, minlength=self.n)
        self.scripts = np.bincount(word * len(NAMES) + script[points],
                                   minlength=self.n * len(NAMES)).reshape(self.n, -1)
        self.grams, self.owner = self._grams(points, word)

    def _grams(self, points, word):
        """Edge, letters, edge of every word; all runs of one to three of them."""
        n = self.letters
        start = np.cumsum(n + 2) - (n + 2)
        line = np.ones(int((n + 2).sum()), dtype=np.uint64)
        line[ragged(start + 1, n)] = points
        owner = np.repeat(np.arange(self.n, dtype=np.int64), n + 2)
        grams, owners = [], []
        h = np.zeros(len(line), dtype=np.uint64)
        for k in range(3):
            m = len(line) - k
            if m <= 0:
                break
            h = (h[:m] ^ line[k:]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
            ok = owner[:m] == owner[k:]
            grams.append((h[ok] % np.uint64(BUCKETS)).astype(np.int64))
            owners.append(owner[:m][ok])
        return np.concatenate(grams), np.concatenate(owners)


def numbered(texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
    """Each text's words as numbers, and the words by number."""
    number: dict[str, int] = {}
    codes = [np.array([number.setdefault(w, len(number)) for w in t.split()], dtype=np.int64)
             for t in texts]
    return codes, list(number)


def training_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` labelled documents of each language, never a held-out one.

    Counts come first (keys and labels only); then a row stays if the hash of its key
    falls in its language's share, so no text is sorted or shuffled for the choice.
    """
    rows = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & F.col("doc_id").isNotNull() & ~held_out())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = counts.select("lang", (F.lit(float(sample)) / F.col("n")).alias("share"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return (rows.join(F.broadcast(share), "lang").where(place < F.col("share"))
            .select("lang", "text"))


class Model:
    """Languages, log probabilities (bucket, language), scripts (language, script)."""

    def __init__(self, langs: list[str], logp: np.ndarray, uses: np.ndarray):
        self.langs, self.logp, self.uses = langs, logp, uses

    @classmethod
    def of_counts(cls, langs: list[str], grams: np.ndarray, scripts: np.ndarray) -> Model:
        smooth = grams + SMOOTHING
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        return cls(langs, np.log(smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32),
                   share >= SCRIPT_SHARE)

    def sent(self, spark: SparkSession):
        """A broadcast of plain lists and arrays, which needs no module of this package on
        the executors: the model's parts, then the letter tables."""
        bound_batches(spark)
        return spark.sparkContext.broadcast(
            (self.langs, self.logp, self.uses, *letter_tables()))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Count n-grams and scripts in parallel; the driver gets one table of fixed size."""
    bound_batches(docs.sparkSession)
    tables = docs.sparkSession.sparkContext.broadcast(letter_tables())

    def run(batches):
        letter, script = tables.value
        grams, scripts = {}, {}
        for batch in text_runs(batches, "text", BATCH_BYTES):
            texts, langs = texts_of(batch.column(1)), batch.column(0).to_pylist()
            for lang in set(langs):
                codes, words = numbered([t for t, x in zip(texts, langs) if x == lang])
                if not words:
                    continue
                found = Words(words, letter, script)
                times = np.bincount(np.concatenate(codes), minlength=len(words))
                grams[lang] = grams.get(lang, 0) + np.bincount(
                    found.grams, weights=times[found.owner], minlength=BUCKETS)
                scripts[lang] = scripts.get(lang, 0) + times @ found.scripts
        for lang in grams:
            used = np.flatnonzero(grams[lang])
            bins = np.concatenate([used, -1 - np.arange(len(NAMES))])
            counts = np.concatenate([grams[lang][used], scripts[lang]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bins)), pa.array(bins),
                 pa.array(counts.astype(np.int64))], names=["lang", "bin", "n"])

    rows = (training_sample(docs, sample).mapInArrow(run, "lang string, bin long, n long")
            .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow().to_pydict())
    langs = sorted(set(rows["lang"]))
    grams = np.zeros((BUCKETS, len(langs)))
    scripts = np.zeros((len(langs), len(NAMES)))
    at = np.array([langs.index(x) for x in rows["lang"]], dtype=np.int64)
    bins, n = np.array(rows["bin"], dtype=np.int64), np.array(rows["n"], dtype=float)
    grams[bins[bins >= 0], at[bins >= 0]] = n[bins >= 0]
    scripts[at[bins < 0], -1 - bins[bins < 0]] = n[bins < 0]
    return Model.of_counts(langs, grams, scripts)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """(words, languages) log likelihoods; languages outside the word's scripts are
    held down by what a letter in a foreign script is worth."""
    logp = np.zeros((words.n, len(model.langs)))
    for k in range(len(model.langs)):
        logp[:, k] = np.bincount(words.owner, weights=model.logp[words.grams, k],
                                 minlength=words.n)
    logp[words.letters == 0] = 0
    fits = (words.scripts > 0).astype(float) @ model.uses.T.astype(float) > 0
    fits[~fits.any(axis=1)] = True
    return np.where(fits, logp, logp - 10.0 * (1 + words.letters[:, None]))


def viterbi(scores: np.ndarray, size: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every row of ``scores``; ``size`` rows belong to each text.

    All texts take a step together, the longest first, so that a step works on the
    texts that still have words.
    """
    n_lang = scores.shape[1]
    out = np.zeros(len(scores), dtype=np.int64)
    back = np.zeros(scores.shape, dtype=np.int16)
    first = np.cumsum(size) - size
    order = np.argsort(-size, kind="stable")
    live = np.searchsorted(-size[order], -np.arange(1, (size.max() if len(size) else 0) + 1),
                           side="right")
    begin, stay = first[order], np.arange(n_lang, dtype=np.int16)
    if not len(live) or not live[0]:
        return out
    best = scores[begin[:live[0]]].copy()
    final = best.copy()
    for t in range(1, len(live)):
        best = best[:live[t]]
        top = best.argmax(axis=1)
        jump = best[np.arange(len(best)), top] - penalty
        switch = jump[:, None] > best
        rows = begin[:live[t]] + t
        back[rows] = np.where(switch, top[:, None], stay)
        best = np.where(switch, jump[:, None], best) + scores[rows]
        final[:live[t]] = best
    label = final.argmax(axis=1)
    for t in range(len(live) - 1, -1, -1):
        rows = begin[:live[t]] + t
        out[rows] = label[:live[t]]
        label[:live[t]] = back[rows, label[:live[t]]] if t else label[:live[t]]
    return out


class Labels:
    """The words of a run of texts with their languages, and each text's own."""

    def __init__(self, texts: list[str], model: Model, letter, script, penalty: float):
        codes, words = numbered(texts)
        n, n_lang = len(texts), len(model.langs)
        self.size = np.array([len(c) for c in codes], dtype=np.int64)
        self.pred, self.score = np.full(n, -1), np.zeros(n)
        flat = np.concatenate([*codes, np.zeros(0, dtype=np.int64)])
        self.words = np.zeros(len(flat), dtype=np.int64)
        if not words or not n_lang:
            return
        found = Words(words, letter, script)
        scores = word_scores(found, model)
        self.words = viterbi(scores[flat], self.size, penalty)
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        doc = np.repeat(np.arange(n), self.size)
        letters = found.letters[flat]
        by_lang = np.bincount(doc * n_lang + self.words, weights=letters,
                              minlength=n * n_lang).reshape(n, n_lang)
        some = by_lang.sum(axis=1) > 0
        self.pred[some] = by_lang[some].argmax(axis=1)
        mine = odds[flat, np.maximum(self.pred, 0)[doc]] * letters
        self.score[some] = np.clip(np.bincount(doc, weights=mine, minlength=n)[some]
                                   / by_lang.sum(axis=1)[some], 0, 1)

    def names(self, langs: list[str]) -> list[str]:
        return [langs[p] if p >= 0 else UNDETERMINED for p in self.pred]

    def spans(self, langs: list[str]) -> list[list[dict]]:
        """Each text's runs of words of one language."""
        out, at = [], 0
        for s in self.size.tolist():
            own = self.words[at:at + s]
            cut = np.append(0, np.flatnonzero(np.diff(own)) + 1) if s and langs else []
            out.append([{"lang": langs[own[i]], "first_word": int(i), "n_words": int(j - i)}
                        for i, j in zip(cut, [*cut[1:], s])])
            at += s
        return out


def detect(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
           penalty: float = SWITCH_PENALTY, with_spans: bool = False) -> DataFrame:
    """``(key, lang_pred, score)`` and, ``with_spans``, runs of words of one language as
    ``array<struct<lang, first_word, n_words>>``."""
    shared = model.sent(docs.sparkSession)
    spans_arrow = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()),
                                      ("n_words", pa.int32())]))

    def run(batches):
        model, tables = Model(*shared.value[:3]), shared.value[3:]
        for batch in text_runs(batches, text, BATCH_BYTES):
            found = Labels(texts_of(batch.column(1)), model, *tables, penalty)
            out = [batch.column(0), pa.array(found.names(model.langs), pa.string()),
                   pa.array(found.score)]
            if with_spans:
                out.append(pa.array(found.spans(model.langs), spans_arrow))
            yield pa.RecordBatch.from_arrays(
                out, names=[key, "lang_pred", "score"] + ["spans"] * with_spans)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double"
        + ", spans array<struct<lang: string, first_word: int, n_words: int>>" * with_spans)


def known(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang",
          least_score: float = LEAST_SCORE, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The documents with a language: ``und`` ones and those below ``least_score`` go, ``lang`` is
    set to the prediction, every other column stays as it is."""
    shared = model.sent(docs.sparkSession)

    def run(batches):
        model, tables = Model(*shared.value[:3]), shared.value[3:]
        for batch in text_runs(batches, text, BATCH_BYTES):
            at = batch.schema.get_field_index(text)
            found = Labels(texts_of(batch.column(at)), model, *tables, penalty)
            keep = pa.array((found.pred >= 0) & (found.score >= least_score))
            new = batch.set_column(batch.schema.get_field_index(lang), lang,
                                   pa.array(found.names(model.langs), pa.string()))
            yield new.filter(keep)

    return docs.mapInArrow(run, docs.schema)
