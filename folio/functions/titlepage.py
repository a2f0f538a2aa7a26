"""Title-page field expressions (E16-E23), over an ``array<string>`` of lines.

Everything is a native regex or higher-order function, so extraction runs
inside whole-stage codegen with no Python worker. Patterns are bounded
(``{3,70}``, ``{0,4}``) and run per line, never over a whole document, which
keeps Java's backtracking linear in the line length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.text import strip_chars

# ---------------------------------------------------------------------------
# Wording that title pages use. These must match the source
# documents exactly, so they are stated here verbatim and in one place.
# ---------------------------------------------------------------------------
NAME_LETTERS = "A-Za-zÁÉÍÓÚÝÞÆÖÐáéíóúýþæöð"
UNIVERSITY_TAIL = r"\s+(?:university of iceland|reykjav[ií]k university|háskól\w+)\b.*$"
UNIT_PREFIXES = {"faculty": "faculty of", "school": "school of", "department": "department of"}
UNIT_WORD = "(?:deild(?:ar|in|inni|arinnar)?|svið[si]?|skor(?:ar|inni)?)"
DEGREE_NAMES = [
    "Magister Scientiarum",
    "Master of Science",
    "Master of Arts",
    "Master of Engineering",
    "Master of Project Management",
    "Magister Paedagogiae",
]
SUBJECT_CLASS = f"[{NAME_LETTERS}&,\\- ]{{3,60}}"
SUBJECT_EN = (
    r"(?iU)\b(?:degree in|Master of (?:Science|Arts|Engineering|Project Management) in)\s+"
    f"({SUBJECT_CLASS})"
)
SUBJECT_IS = rf"(?iU)meistarapr[óo]fs?\s*(?:\([^)]*\))?\s*í\s+({SUBJECT_CLASS})"
ROLE_HEADINGS = {
    "committee": r"(?iU)^(ms|msc|m\.s\.|master'?s?)\s*committee\s*:?$",
    "examiner": r"(?iU)^(master'?s? examiner|prófdómari)\s*:?$",
    "advisors": (
        r"(?iU)^(advisors?|supervisors?|leiðbeinand[iu]r?|leiðbeinendur|umsjónarkennari)\s*:?$"
    ),
}
PERSON_STOP = (
    r"(?iU)^(faculty|school|department|university|háskóli|reykjav[ií]k|akureyri|"
    r"master|ms committee|advisor|supervisor|leiðbein|examiner|prófdómari|"
    r"faculty representative|fulltrúi)|(deild|svið)\s*$"
)
PERSON_NAME = r"(?U)^[A-ZÁÉÍÓÚÝÞÆÖ][^\d]{4,60}$"
YEAR = r"(?U)\b((?:19|20)\d{2})\b"
ECTS = r"(?iU)\b(\d{1,3})\s*ECTS\b"
STATES_DEGREE = r"(?iU)master|magister|meistara|\bm\.?\s?sc\b"
# The unit pattern: up to four words that end in a comma or hyphen, then the unit word.
UNIT_IS = (
    f"(?iU)((?:[{NAME_LETTERS}]{{2,}}[-,]+\\s*(?:og\\s+)?){{0,4}}"
    f"[{NAME_LETTERS}]{{2,}}{UNIT_WORD})"
)
# ---------------------------------------------------------------------------
DEGREE = "(?iU)\\b(" + "|".join(DEGREE_NAMES) + ")\\b"


def unit_en(lines: Column, kind: str) -> Column:
    """Text after 'faculty of' / 'school of' / 'department of' on the first
    line that has it, cut where the university's name begins."""
    prefix = UNIT_PREFIXES[kind]
    pattern = f"(?iU){prefix}\\s+(.{{3,70}})"
    # A plain substring test first: the regex runs only on lines that can match.
    line = F.try_element_at(
        F.filter(lines, lambda ln: F.lower(ln).contains(prefix) & ln.rlike(pattern)), F.lit(1)
    )
    raw = F.regexp_extract(line, pattern, 1)
    return strip_chars(F.regexp_replace(raw, "(?iU)" + UNIVERSITY_TAIL, ""), " ,.")


def unit_names(lines: Column) -> Column:
    """E17 helper: every Icelandic unit name on the page, in reading order,
    at least 9 characters long."""
    candidates = F.filter(
        lines, lambda ln: F.lower(ln).rlike("deild|svið|skor")
    )
    found = F.flatten(
        F.transform(candidates, lambda ln: F.regexp_extract_all(ln, F.lit(UNIT_IS), 1))
    )
    names = F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.filter(names, lambda x: F.length(x) >= 9)


def unit_kinds(names: Column) -> tuple[Column, Column]:
    """(deild, svid) -- the first unit name of each kind, decided by the
    word the name ends on."""
    svid_rx = r"(?iU)svið[si]?$"
    deild = F.try_element_at(F.filter(names, lambda x: ~x.rlike(svid_rx)), F.lit(1))
    svid = F.try_element_at(F.filter(names, lambda x: x.rlike(svid_rx)), F.lit(1))
    return deild, svid


def ects(joined: Column) -> Column:
    """First 1-3 digit number before 'ECTS'."""
    return F.nullif(F.regexp_extract(joined, ECTS, 1), F.lit("")).try_cast("int")


def degree_stated(joined: Column) -> Column:
    """Leftmost full degree name."""
    return F.nullif(F.regexp_extract(joined, DEGREE, 1), F.lit(""))


def subject(lines: Column) -> Column:
    """On the first line where it appears, the English then the Icelandic form."""
    candidates = F.filter(
        lines, lambda ln: F.lower(ln).rlike("degree in|master of|meistarapr")
    )
    per_line = F.transform(
        candidates,
        lambda ln: F.coalesce(
            F.nullif(F.regexp_extract(ln, SUBJECT_EN, 1), F.lit("")),
            F.nullif(F.regexp_extract(ln, SUBJECT_IS, 1), F.lit("")),
        ),
    )
    hit = F.try_element_at(F.filter(per_line, lambda x: x.isNotNull()), F.lit(1))
    return strip_chars(hit, " ,.")


ANY_HEADING = "|".join(f"(?:{p})" for p in ROLE_HEADINGS.values())


def block_breaks(lines: Column) -> Column:
    """E21 helper: per line, does it end a block of names (a stop line, a
    heading, or a line not shaped like a name)? Computed once per page."""
    return F.transform(
        lines,
        lambda ln: ln.rlike(PERSON_STOP) | ln.rlike(ANY_HEADING) | ~ln.rlike(PERSON_NAME),
    )


def heading_at(lines: Column, role: str) -> Column:
    """1-based position of the first heading for ``role``; 0 when absent."""
    return F.array_position(F.transform(lines, lambda ln: ln.rlike(ROLE_HEADINGS[role])), True)


def people_block(lines: Column, breaks: Column, at: Column) -> Column:
    """Names listed under the heading at ``at``.

    The block runs until the first break line after the heading. NULL when
    there is no heading or the block is empty.
    """
    start = (at + 1).cast("int")
    room = F.greatest(F.size(lines), F.lit(1))
    stop = F.array_position(F.slice(breaks, start, room), True)
    names = F.when(stop == 0, F.slice(lines, start, room)).otherwise(
        F.slice(lines, start, (stop - 1).cast("int"))
    )
    return F.when((at > 0) & (F.size(names) > 0), F.array_join(names, "; "))


def year_on_page(lines: Column) -> Column:
    """Last 19xx/20xx year among the last 15 lines."""
    last = F.slice(lines, F.greatest(F.lit(1), F.size(lines) - 14), 15)
    years = F.regexp_extract_all(F.array_join(last, " "), F.lit(YEAR), 1)
    return F.try_element_at(years, F.lit(-1)).try_cast("int")


def states_degree(text: Column) -> Column:
    """Does the text mention a master's-level degree at all."""
    return F.coalesce(text, F.lit("")).rlike(STATES_DEGREE)
