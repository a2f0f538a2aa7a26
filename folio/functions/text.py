"""Generic text expressions (Column -> Column), all JVM-side.

Java regex notes: ``(?U)`` turns on Unicode character classes (``\\s``,
``\\w``, ``\\d``, ``\\b``) and implies Unicode case folding, so every
case-insensitive pattern here is written ``(?iU)``.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line breaks recognised by Python's str.splitlines().
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squash_ws(c: Column | str) -> Column:
    """Collapse whitespace runs to one space and trim; blank stays ''."""
    return F.trim(F.regexp_replace(col_(c), r"(?U)\s+", " "))


def whitespace_norm(c: Column | str) -> Column:
    """Collapse whitespace, trim, blank -> NULL."""
    return F.nullif(squash_ws(c), F.lit(""))


def text_lines(c: Column | str) -> Column:
    """Non-empty whitespace-normalised lines of a text, in order."""
    parts = F.split(F.coalesce(col_(c), F.lit("")), LINE_BREAKS)
    return F.filter(F.transform(parts, squash_ws), lambda ln: ln != "")


def strip_chars(c: Column, chars: str) -> Column:
    """Python's str.strip(chars) for a small set of literal characters."""
    cls = "".join("\\" + ch if ch in r"\^-]" else ch for ch in chars)
    return F.regexp_replace(c, f"^[{cls}]+|[{cls}]+$", "")


# The letters that count as Icelandic-specific.
ICELANDIC_CHARS = "áðéíóúýþæö"


def is_icelandic(c: Column | str) -> Column:
    """Lower-cased text contains an Icelandic letter."""
    return F.lower(col_(c)).rlike(f"[{ICELANDIC_CHARS}]")


def clean_list(arr: Column) -> Column:
    """Normalise each element's whitespace and drop blanks / NULLs."""
    return F.filter(F.transform(arr, whitespace_norm), lambda x: x.isNotNull())


def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Where full case folding differs from lower case: (one character for one, one for several),
    by the rule of the Unicode tables that Python carries."""
    one, many = {}, {}
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        low, folded = char.lower(), char.casefold()
        if len(low) == 1 and low != folded:
            (one if len(folded) == 1 else many)[low] = folded
    return one, many


FOLD_ONE, FOLD_MANY = _folds()


def fold(c: Column | str) -> Column:
    """Full case folding: texts that differ in case only become equal (``Maß``, ``MASS``;
    ``ﬁ``, ``FI``; a final sigma and any other). Lower case, one ``translate``, and only
    where a character folds to several a map over the characters."""
    low = F.translate(F.lower(col_(c)), "".join(FOLD_ONE), "".join(FOLD_ONE.values()))
    table = F.create_map(*(F.lit(x) for pair in FOLD_MANY.items() for x in pair))
    spread = F.array_join(F.transform(
        F.split(low, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    return F.when(low.rlike("[" + "".join(FOLD_MANY) + "]"), spread).otherwise(low)


def dedupe_ci(arr: Column) -> Column:
    """Whitespace-normalise, drop blanks, keep the first spelling of each
    case-folded value, preserving order."""
    pairs = F.transform(clean_list(arr), lambda x: F.struct(x.alias("v"), fold(x).alias("f")))
    none = F.array().cast("array<struct<v: string, f: string>>")
    first = F.aggregate(pairs, none, lambda acc, x: F.when(
        F.exists(acc, lambda y: y["f"] == x["f"]), acc).otherwise(F.concat(acc, F.array(x))))
    return F.transform(first, lambda x: x["v"])


def join_or_null(arr: Column, sep: str = "; ") -> Column:
    """``sep``-joined string, NULL for an empty or NULL array."""
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))
