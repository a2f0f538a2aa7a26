"""File-level expressions: size labels, file types, form detection, URLs,
access state (E10, E11, E13, E14, E15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import col_

# ---------------------------------------------------------------------------
# Repository vocabulary that must match the source exactly.
# ---------------------------------------------------------------------------
FULLTEXT_DESCRIPTION = "heildartexti"
NOT_THESIS_DESCRIPTIONS = [
    "yfirlýsing",
    "beiðni um lokun",
    "viðauki",
    "fylgiskjöl",
    "forsíða",
    "titilsíða",
    "kápa",
    "teikning",
    "heimildaskrá",
    "efnisyfirlit",
]
FORM_FILENAME = (
    r"yfirl[yý]s|\byfirl\b|bei[ðd]ni\s*um\s*lokun|lokunarbei[ðd]ni|landsb[oó]kasafn|declaration"
)
BUNDLE_DESCRIPTIONS = {"COMPLETE_TEXT": "Heildartexti", "DECLARATION": "Yfirlýsing"}
MIME_TYPES = {
    "application/pdf": "PDF",
    "application/zip": "ZIP",
    "application/msword": "DOC",
    "text/plain": "TXT",
}
SIZE_LABEL = r"(?iU)^\s*([\d.,]+)\s*(B|KB|MB|GB)\s*$"
OPEN_ACCESS = "Opinn"
DECLARATION_DESCRIPTIONS = ["yfirlýsing", "yfirlysing"]
EMBARGO_DATE = r"(\d{2}\.\d{2}\.\d{4})"
HANDLE_PREFIX = "1946"
# ---------------------------------------------------------------------------

# Where the repository lives is deployment configuration, not a fixed value.
SITE_BASE = "https://repository.example"


def size_bytes(label: Column | str) -> Column:
    """E10: '86,08 MB' -> bytes. Dots are thousands separators and the comma is
    the decimal point; the product is truncated. Anything else -> NULL."""
    c = col_(label)
    number = F.regexp_extract(c, SIZE_LABEL, 1)
    unit = F.upper(F.regexp_extract(c, SIZE_LABEL, 2))
    value = F.regexp_replace(F.regexp_replace(number, r"\.", ""), ",", ".").try_cast("double")
    factor = (
        F.when(unit == "B", 1)
        .when(unit == "KB", 1024)
        .when(unit == "MB", 1024 ** 2)
        .when(unit == "GB", 1024 ** 3)
    )
    return F.when(c.rlike(SIZE_LABEL), (value * factor).try_cast("bigint"))


def filetype(mime: Column | str, filename: Column | str) -> Column:
    """Known MIME type, else the upper-cased extension, else NULL."""
    m, f = col_(mime), col_(filename)
    mapping = F.create_map(*[x for kv in MIME_TYPES.items() for x in map(F.lit, kv)])
    ext = F.when(f.contains("."), F.upper(F.substring_index(f, ".", -1)))
    return F.coalesce(F.try_element_at(mapping, F.lower(m)), ext)


def describe_bundle(raw: Column | str) -> Column:
    """Bundle description mapped to the item-page vocabulary; others verbatim."""
    r = col_(raw)
    mapping = F.create_map(*[x for kv in BUNDLE_DESCRIPTIONS.items() for x in map(F.lit, kv)])
    return F.coalesce(F.try_element_at(mapping, r), r)


def description_key(description: Column | str) -> Column:
    # Python's strip() removes any whitespace, Spark's trim() only spaces.
    stripped = F.regexp_replace(F.coalesce(col_(description), F.lit("")), r"(?U)^\s+|\s+$", "")
    return F.lower(stripped)


def is_fulltext(description: Column | str) -> Column:
    return description_key(description) == FULLTEXT_DESCRIPTION


def form_description(description: Column | str) -> Column:
    return description_key(description).isin(NOT_THESIS_DESCRIPTIONS)


def form_filename(filename: Column | str) -> Column:
    """E14, filename half."""
    return F.coalesce(col_(filename), F.lit("")).rlike("(?iU)" + FORM_FILENAME)


def looks_like_thesis(description: Column | str, filename: Column | str) -> Column:
    return ~form_description(description) & ~form_filename(filename)


def thesis_score(description: Column | str, filename: Column | str) -> Column:
    """+2 full text, -2 a form description, -5 a form-like filename."""
    desc = F.when(is_fulltext(description), 2).when(form_description(description), -2).otherwise(0)
    return desc + F.when(form_filename(filename), -5).otherwise(0)


def embargo_date(access: Column | str) -> Column:
    """The dd.mm.yyyy date inside an access label, NULL when none."""
    return F.try_to_date(F.regexp_extract(col_(access), EMBARGO_DATE, 1), "dd.MM.yyyy")


def is_open(access: Column | str, as_of: dt.date | str) -> Column:
    """NULL access (unknown), 'Opinn', or an embargo that has lapsed.
    ``as_of`` is an argument so results do not depend on the clock."""
    a = col_(access)
    return a.isNull() | (a == OPEN_ACCESS) | (embargo_date(a) <= F.lit(as_of).cast("date"))


def item_url(thesis_id: Column | str, base: str = SITE_BASE,
             handle_prefix: str = HANDLE_PREFIX) -> Column:
    """The item's handle page."""
    return F.concat(F.lit(f"{base}/handle/{handle_prefix}/"), col_(thesis_id).cast("string"))


def abs_url(href: Column | str, base: str = SITE_BASE) -> Column:
    """E15: '/x' -> base + '/x'; anything else unchanged."""
    h = col_(href)
    return F.when(h.startswith("/"), F.concat(F.lit(base), h)).otherwise(h)


def set_spec(handle: Column | str) -> Column:
    """A collection handle 'a/b' or 'a b' -> 'com_a_b'; set names ('com_...',
    'col_...') stay as they are."""
    h = F.trim(col_(handle))
    parts = r"^(\d+)[/\s]+(\d+)$"
    return F.when(h.rlike(parts), F.regexp_replace(h, parts, "com_$1_$2")).otherwise(h)


def bitstream_seq(url: Column | str) -> Column:
    """Sequence number in a /bitstream/<a>/<b>/<seq>/ path, else 9999."""
    seq = F.regexp_extract(F.coalesce(col_(url), F.lit("")), r"/bitstream/\d+/\d+/(\d+)/", 1)
    return F.coalesce(F.nullif(seq, F.lit("")).try_cast("int"), F.lit(9999))
