"""Bibliographic cleaning expressions (E2, E4-E9), all native HOFs and regexes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import (
    clean_list, col_, dedupe_ci, is_icelandic, join_or_null, whitespace_norm,
)

# ---------------------------------------------------------------------------
# Vocabulary matched in catalog records.
# ---------------------------------------------------------------------------
DATE_FORMATS = ["d.M.yyyy", "yyyy-M-d", "yyyy-M", "yyyy"]
DEGREE_RULES = [
    ("phd", ["doktor", "phd"]),
    ("master", ["meist", "master", "msc"]),
    ("bachelor", ["bachelor", "b.sc", "bsc"]),
    ("phd", ["doctoral"]),
    ("diploma", ["diploma", "diplóma"]),
]
ABSTRACT_PREFIXES = ["íslenskt ágrip:", "íslenskt ágrip", "ágrip:", "ágrip"]
NOTE_PREFIXES = ["athugasemdir", "athugasemd", "athugsemd"]
NOTE_PHRASES = ["ritgerðin er lokuð", "vantar forsíðu"]
NOTE_KEYWORDS = ["closed"]
GRADUATE_DIPLOMA = "graduate diploma"
MASTERS_LABEL = "Master's"
THESIS_LABEL = "Thesis"
DROPPED_KEYWORD = "thesis"
PERSON_YEAR = r"(?<!\d)((?:19|20)\d{2})(?:\s*[-–]\s*((?:19|20)\d{2})?)?(?!\d)"
# ---------------------------------------------------------------------------


def parse_date4(c: Column | str) -> Column:
    """The first of d.m.Y, Y-m-d, Y-m, Y that parses; else NULL."""
    v = col_(c)
    return F.coalesce(*[F.try_to_date(v, fmt) for fmt in DATE_FORMATS])


def split_title(title: Column | str) -> tuple[Column, Column]:
    """(title_is, title_en) by whether the title reads as Icelandic."""
    t = whitespace_norm(title)
    ice = is_icelandic(t)
    return F.when(ice, t), F.when(~ice, t)


def degree_level(value: Column | str) -> Column:
    """E5: degree level from one free-text value (substring tests in order)."""
    low = F.lower(col_(value))
    expr = None
    for level, words in DEGREE_RULES:
        cond = None
        for w in words:
            c = low.contains(w)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, level) if expr is None else expr.when(cond, level)
    return F.when(col_(value).isNotNull() & (col_(value) != ""), expr)


def degree_from_list(values: Column) -> Column:
    """E5 over a list: the first value that classifies."""
    levels = F.transform(F.coalesce(values, F.array().cast("array<string>")), degree_level)
    return F.try_element_at(F.filter(levels, lambda x: x.isNotNull()), F.lit(1))


def thesis_types(values: Column, level: Column) -> Column:
    """Deduped type labels; for master's theses drop graduate diplomas,
    collapse anything mentioning 'master' to "Master's", and order Thesis,
    Master's, then the rest. Joined '; '; NULL when there were no types."""
    norm = dedupe_ci(values)
    relabeled = F.transform(
        F.filter(norm, lambda x: ~F.lower(x).contains(GRADUATE_DIPLOMA)),
        lambda x: F.when(F.lower(x).contains("master"), F.lit(MASTERS_LABEL)).otherwise(x),
    )
    cleaned = dedupe_ci(relabeled)
    has_thesis = F.exists(cleaned, lambda x: F.lower(x) == "thesis")
    has_master = F.exists(cleaned, lambda x: F.lower(x) == "master's")
    rest = F.filter(cleaned, lambda x: ~F.lower(x).isin("thesis", "master's"))
    ordered = F.concat(
        F.when(has_thesis, F.array(F.lit(THESIS_LABEL))).otherwise(F.array().cast("array<string>")),
        F.when(has_master, F.array(F.lit(MASTERS_LABEL))).otherwise(F.array().cast("array<string>")),
        rest,
    )
    chosen = F.when(F.coalesce(level, F.lit("")) == "master", ordered).otherwise(norm)
    raw = F.filter(F.coalesce(values, F.array().cast("array<string>")),
                   lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(raw) > 0, F.array_join(chosen, "; "))


def split_keywords(values: Column) -> Column:
    """Split on ';' or ',', normalise, drop blanks and the bare word
    'thesis', dedupe case-insensitively keeping the first spelling."""
    parts = F.flatten(F.transform(F.coalesce(values, F.array().cast("array<string>")),
                                  lambda v: F.split(v, "[;,]")))
    kept = F.filter(clean_list(parts), lambda x: F.lower(x) != DROPPED_KEYWORD)
    return dedupe_ci(kept)


def _starts_with_any(x: Column, prefixes: list[str]) -> Column:
    return F.lower(x).rlike("^(?:" + "|".join(prefixes) + ")")


def abstracts_and_note(descriptions: Column) -> tuple[Column, Column, Column]:
    """(abstract_is, abstract_en, note) from the description list."""
    d = clean_list(F.coalesce(descriptions, F.array().cast("array<string>")))
    abs_rx = "(?iU)^(?:" + "|".join(ABSTRACT_PREFIXES) + ")"
    is_abs = lambda x: x.rlike(abs_rx)
    marked = F.transform(
        F.filter(d, is_abs),
        lambda x: F.regexp_replace(F.regexp_replace(x, abs_rx, ""), r"(?U)^\s+|\s+$", ""),
    )
    abstract_marked = F.try_element_at(F.filter(marked, lambda x: x != ""), F.lit(-1))
    rest1 = F.filter(d, lambda x: ~is_abs(x))

    is_note_prefix = lambda x: _starts_with_any(x, NOTE_PREFIXES)
    phrases = NOTE_PHRASES + NOTE_KEYWORDS

    def is_note(x: Column) -> Column:
        cond = is_note_prefix(x)
        for p in phrases:
            cond = cond | F.lower(x).contains(p)
        return cond

    def note_text(x: Column) -> Column:
        after = F.regexp_replace(F.regexp_replace(x, "^[^:]*:", ""), r"(?U)^\s+|\s+$", "")
        return F.when(is_note_prefix(x) & x.contains(":") & (after != ""), after).otherwise(x)

    notes = F.transform(F.filter(rest1, is_note), note_text)
    rest2 = F.filter(rest1, lambda x: ~is_note(x))
    first_ice = F.try_element_at(F.filter(rest2, lambda x: is_icelandic(x)), F.lit(1))
    first_other = F.try_element_at(F.filter(rest2, lambda x: ~is_icelandic(x)), F.lit(1))
    return F.coalesce(abstract_marked, first_ice), first_other, join_or_null(notes)


def first_deduped(values: Column) -> Column:
    """First cleaned, non-blank value (what a ci-dedupe keeps first)."""
    return F.try_element_at(clean_list(F.coalesce(values, F.array().cast("array<string>"))),
                            F.lit(1))


def person_name(raw: Column | str) -> tuple[Column, Column, Column]:
    """(name, year_born, year_died) from 'Name, 1950-2010' / 'Name (1950)'.

    The first year match gives born/died; every match and any parenthesised
    part is removed, whitespace collapsed, and ' ,;-' trimmed from the ends.
    """
    cleaned = F.coalesce(whitespace_norm(raw), F.lit(""))
    born = F.nullif(F.regexp_extract(cleaned, PERSON_YEAR, 1), F.lit("")).try_cast("int")
    died = F.nullif(F.regexp_extract(cleaned, PERSON_YEAR, 2), F.lit("")).try_cast("int")
    name = F.regexp_replace(cleaned, PERSON_YEAR, " ")
    name = F.regexp_replace(name, r"\([^)]*\)", " ")
    name = F.coalesce(whitespace_norm(name), F.lit(""))
    name = F.regexp_replace(name, r"^[ ,;\-]+|[ ,;\-]+$", "")
    return name, born, died
