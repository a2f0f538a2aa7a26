"""Personal data by candidate generation and gradient-boosted selection.

High-recall generators propose spans, which may overlap. Four kinds (email, ip,
card, phone) have exact checks: what passes is a base span and always stays. All
candidates also get features of format (length, digits, letters, marks, changes between
them) and of context (neighbouring characters, digits nearby, cue words of other kinds).
Boosted trees are fitted on one half of all candidates (by hash).
Labels come from what the features leave out: the exact checks of the four kinds (digit
sums, ranges of numbers, counts), and for the other generators a cue word of their own kind
just before the span. So the trees learn from cued spans what such a span looks like, and find
those without a cue as well. On the other half a threshold per generator is calibrated to
``PRECISION``, where the trees' own mean probability counts as ``PRIOR`` candidates beside
those held out: one rule at every size. Candidates of the other generators above their
threshold are added, but for those inside a base span or partly over one.

DataFrame, SQL and Spark ML (JVM) only. Positions are code points: a pattern's
matches and the pieces between them are taken from one text, and running sums of
their lengths, per document and kind, give the starts.

Defined cases: a null or empty text has no spans and the digest of the empty
string; repeated rows are separate documents; no candidates at all, or of one
label only, leave the base spans; an empty table gives no rows; other columns are
ignored (``redact`` keeps them).
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import staged

PRECISION = 0.95
PRIOR = 10
CONTEXT = 32
#: Working columns beside those of the documents.
ROW, FOUND, BASE, ALL = "__pii_row", "__pii_found", "__pii_base", "__pii_all"
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

_LOCAL = "A-Za-z0-9._%+-"
#: Generators: name, kind, quick test of a text, pattern. The alternatives with \\G and
#: possessive repeats match what the plain patterns match, in linear time.
GENERATORS = (
    ("email", "email", "@",
     rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", "ip", r"[0-9]\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "card", r"[0-9](?:[ -]?[0-9]){11}", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("local_phone", "phone", r"[0-9]{3}[ .-][0-9]{4}",
     r"(?<![0-9+.() -])\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}(?![0-9-])"),
    ("spelled_email", "email", r"[\[( ]dot[\]) ]",
     r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}"
     r" ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}"),
    ("secret", "secret", r"[0-9][A-Za-z0-9_+/-]{7}|[A-Za-z0-9_+/-]{7}[0-9]",
     r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+"),
)
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
#: Cue words before a span by kind. A generator's own are its labels and not its features.
CUES = {"phone": r"(?i)\b(?:phone|tel|call|fax|mobile|cell)\b",
        "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach)\b",
        "card": r"(?i)\b(?:card|visa|pay|account)\b",
        "ip": r"(?i)\b(?:ip|host|server|address)\b",
        "secret": r"(?i)(?:token|key|secret|passw(?:or)?d|passwd|pwd|bearer)[\s\"']{0,3}[=:]?"
                  r"[\s\"']{0,3}$"}


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _proposals(text: Column, name: str, test: str, pattern: str) -> Column:
    """One struct per match: the lengths and the texts around it, in order."""
    pieces = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                      F.split(text, pattern, -1).alias("g"))
    found = _once(pieces, lambda p: F.transform(
        F.arrays_zip(p["m"].alias("m"), F.slice(p["g"], 1, F.size(p["m"])).alias("before"),
                     F.slice(p["g"], 2, F.size(p["m"])).alias("after")),
        lambda z: F.struct(
            F.lit(name).alias("generator"), F.length(z["before"]).alias("gap"), z["m"].alias("span"),
            F.right(z["before"], F.lit(CONTEXT)).alias("before"),
            F.left(z["after"], F.lit(CONTEXT)).alias("after"))))
    quick = text.contains(test) if test == "@" else text.rlike(test)
    return F.when(quick, found)


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits; the rightmost digit is not doubled."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: _once(
        F.try_add(d.cast("int") * (1 + i % 2), F.lit(0)), lambda x: x - F.when(x > 9, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def candidates(numbered: DataFrame) -> DataFrame:
    """All proposals of ``(row, found)`` with position, format and context."""
    c = numbered.select("row", F.posexplode("found").alias("i", "f")).select("row", "i", "f.*")
    along = Window.partitionBy("row", "generator").orderBy("i")
    size = F.length("span")
    kind = F.element_at(F.create_map(*(F.lit(x) for n, k, _, _ in GENERATORS for x in (n, k))),
                        F.col("generator"))
    digits = F.regexp_replace("span", "[^0-9]", "")
    c = c.withColumns({
        "end": F.sum(F.col("gap") + size).over(along), "kind": kind,
        "digits": digits, "n_chars": size, "n_digits": F.length(digits)})
    c = c.withColumn("start", F.col("end") - F.col("n_chars"))
    luhn = F.when(F.col("n_digits").between(12, 19), _luhn(F.col("digits"))).otherwise(False)
    octets = F.col("span").rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$")
    name = F.col("generator")
    valid = (F.when(name == "email", True).when(name == "ip", octets).when(name == "card", luhn)
             .when(name == "phone", F.col("n_digits").between(9, 15)).otherwise(False))
    cues = {k: F.col("before").rlike(v) for k, v in CUES.items()}
    own = F.lit(False)
    for k, cue in cues.items():
        own = F.when(F.col("kind") == k, cue).otherwise(own)
    base = name.isin(*BASE_KINDS)
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        "span", "[0-9]+", "0"), "[A-Z]+", "A"), "[a-z]+", "a")
    features = {
        "n_letters": F.length(F.regexp_replace("span", "[^A-Za-z]", "")),
        "n_marks": F.length(F.regexp_replace("span", "[A-Za-z0-9]", "")),
        "n_distinct": F.size(F.array_distinct(F.split("span", ""))),
        "n_changes": F.length(kinds),
        "plus": F.col("span").startswith("+").cast("int"),
        "left_word": F.col("before").rlike("[A-Za-z0-9]$").cast("int"),
        "right_word": F.col("after").rlike("^[A-Za-z0-9]").cast("int"),
        "quoted": (F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("int"),
        "digits_near": F.length(F.regexp_replace(F.concat("before", "after"), "[^0-9]", "")),
        **{f"cue_{k}": (cue & (base | (F.col("kind") != k))).cast("int") for k, cue in cues.items()},
        **{f"is_{n}": (name == n).cast("int") for n, _, _, _ in GENERATORS},
    }
    valid = F.coalesce(valid, F.lit(False))
    return c.withColumns(features | {
        "valid": valid, "label": F.when(base, valid).otherwise(own).cast("double")}).drop(
        "before", "after", "gap", "digits", "span")


FEATURES = ["n_chars", "n_digits", "n_letters", "n_marks", "n_distinct", "n_changes", "plus",
            "left_word", "right_word", "quoted", "digits_near", *(f"cue_{k}" for k in CUES),
            *(f"is_{n}" for n, _, _, _ in GENERATORS)]


def fit(found: DataFrame):
    """(boosted trees, threshold per generator), or None where nothing can be learnt. Every
    candidate counts: the trees learn from one half, the thresholds come from the other."""
    chosen = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found).select(
        "generator", "features", "label",
        (F.pmod(F.xxhash64("start", "row"), F.lit(2)) == 0).alias("learn"))
    learn = chosen.where("learn").cache()
    counts = learn.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p")).collect()[0]
    if not counts["n"] or counts["p"] in (0, counts["n"]):
        learn.unpersist()
        return None
    model = GBTClassifier(maxIter=8, maxDepth=4, seed=1, stepSize=0.3).fit(learn)
    learn.unpersist()
    score = vector_to_array("probability")[1]
    bins = (model.transform(chosen.where(~F.col("learn")))
            .groupBy("generator", F.floor(score * 50).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p"),
                 F.sum(score).alias("s")).collect())
    held = {(r["generator"], r["bin"]): (r["n"], r["p"], r["s"]) for r in bins}
    return model, {name: limit for name, _, _, _ in GENERATORS if name not in BASE_KINDS
                   for limit in [threshold({b: v for (g, b), v in held.items() if g == name})]
                   if limit is not None}


def threshold(bins: dict[int, tuple[float, float, float]]) -> float | None:
    """The least score from 0.5 on at which the precision of what lies above it reaches
    ``PRECISION``; ``bins`` has (candidates, true ones, sum of scores) by fiftieths of the score."""
    limit, n, p, s = None, 0, 0.0, 0.0
    for b in range(50, 24, -1):
        n, p, s = (x + y for x, y in zip((n, p, s), bins.get(b, (0, 0.0, 0.0))))
        mean = s / n if n else min(b / 50, 1.0)
        if (p + PRIOR * mean) / (n + PRIOR) >= PRECISION:
            limit = b / 50
    return limit


def selected(found: DataFrame, fitted) -> DataFrame:
    """``(row, kind, start, end, base)``: base spans and what the trees add."""
    is_base = F.col("valid") & F.col("generator").isin(*BASE_KINDS)
    base = found.where(is_base).select("row", "kind", "start", "end", F.lit(True).alias("base"))
    if not fitted or not fitted[1]:
        return base
    model, limits = fitted
    limit = F.element_at(F.create_map(*(F.lit(x) for k in limits.items() for x in k)),
                         F.col("generator"))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        found.where(~is_base & F.col("generator").isin(*limits))))
    more = scored.where(vector_to_array("probability")[1] >= limit).select(
        "row", "kind", "start", "end").distinct()
    b = base.select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"))
    wider = ((F.col("start") <= F.col("s")) & (F.col("e") <= F.col("end"))
             & (F.col("e") - F.col("s") < F.col("end") - F.col("start")))
    more = more.join(b, (F.col("row") == F.col("r")) & (F.col("start") < F.col("e"))
                     & (F.col("s") < F.col("end")) & ~wider, "left_anti")
    return base.unionByName(more.withColumn("base", F.lit(False)))


def numbered(spark: SparkSession, docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with a row number and the proposals of every generator, written
    once."""
    value = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<generator:string,gap:int,span:string,before:string,"
                           "after:string>>")
    found = F.concat(*(F.coalesce(_proposals(value, n, t, p), none)
                       for n, _, t, p in GENERATORS))
    return staged(spark, docs.select(*(F.col(f"`{c}`") for c in keep),
                                     F.monotonically_increasing_id().alias(ROW),
                                     found.alias(FOUND)), "pii")


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["k"] + 1), s["start"], s["end"])), ",")


def spans_of(spark: SparkSession, docs: DataFrame, text: str, keep: list[str]
             ) -> tuple[DataFrame, DataFrame]:
    """(numbered documents, one row of span lists per document with any)."""
    rows = numbered(spark, docs, text, keep)
    found = staged(spark, candidates(rows.select(F.col(ROW).alias("row"),
                                                 F.col(FOUND).alias("found"))), "pii")
    spans = selected(found, fit(found))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    one = F.struct(F.col("start"), order.alias("k"), F.col("end"))
    return rows, spans.groupBy(F.col("row").alias(ROW)).agg(
        F.collect_list(F.when(F.col("base"), one)).alias(BASE),
        F.collect_list(one).alias(ALL),
        *(F.sum(F.when(F.col("base") & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{k}")
          for k in BASE_KINDS))


def find(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text"
         ) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document."""
    rows, spans = spans_of(spark, docs, text, [key])
    return rows.select(ROW, key).join(spans, ROW, "left").select(
        key, *(F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}")
               for k in BASE_KINDS),
        F.sha2(F.coalesce(_listed(F.col(BASE)), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_listed(F.col(ALL)), F.lit("")).alias("spans"))


def redact(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; a span that begins
    inside the one before it goes with that one."""
    rows, spans = spans_of(spark, docs, text, docs.columns)
    value = F.col(text)
    covered = F.aggregate(
        F.array_sort(ALL), F.array().cast("array<struct<start:bigint,k:int,end:bigint>>"),
        lambda got, s: F.when(
            F.coalesce(F.try_element_at(got, F.lit(-1))["end"], F.lit(0)) > s["start"],
            F.concat(F.slice(got, 1, F.size(got) - 1), F.array(F.struct(
                F.try_element_at(got, F.lit(-1))["start"].alias("start"),
                F.try_element_at(got, F.lit(-1))["k"].alias("k"),
                F.greatest(F.try_element_at(got, F.lit(-1))["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(got, F.array(F.struct(
            s["start"].cast("bigint").alias("start"), s["k"].alias("k"),
            s["end"].cast("bigint").alias("end"))))))
    mark = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def cut(c):
        ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(c, lambda s: s["end"]))
        return F.concat(
            F.array_join(F.transform(F.arrays_zip(F.slice(ends, 1, F.size(c)).alias("a"), c.alias("s")),
                                     lambda z: F.concat(
                F.substr(value, (z["a"] + 1).cast("int"), (z["s"]["start"] - z["a"]).cast("int")),
                F.element_at(mark, z["s"]["k"] + 1))), ""),
            F.substr(value, (F.element_at(ends, -1) + 1).cast("int")))

    out = F.when(F.col(ALL).isNull() | value.isNull(), value).otherwise(_once(covered, cut))
    return rows.join(spans.select(ROW, ALL), ROW, "left").select(
        *(out.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
