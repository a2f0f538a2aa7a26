"""DuckDB oracle SQL, one statement per query key.

Each oracle embeds the query's binding as a CTE and computes the expected
result from the *base columns* the binding was built from -- never by parsing
the generated text. Patterns stay in the RE2 subset (no lookaround).
"""

from __future__ import annotations

from folio import bindings as B
from folio.functions.files import DECLARATION_DESCRIPTIONS
from folio.operators.progress import context_digest


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({B.as_duckdb(sql)})" for name, sql in ctes.items())


# Expected title-page fields for B3, straight from the base columns.
_B3_EXPECTED = """
expected AS (
  SELECT k AS thesis_id,
    CASE WHEN k % 17 <> 0 AND k % 4 <> 3 THEN nation END AS faculty,
    CASE WHEN k % 17 <> 0 AND k % 4 <> 3 THEN 'Region ' || CAST(region AS VARCHAR) END AS school,
    CASE WHEN k % 17 <> 0 AND k % 4 <> 3 AND k % 3 = 0 THEN lower(seg) END AS department,
    CASE WHEN k % 17 <> 0 AND k % 4 = 3
         THEN lower(translate(nation, '0123456789_', 'abcdefghij')) || 'deild' END AS deild,
    CASE WHEN k % 17 <> 0 AND k % 4 = 3
         THEN 'Heilbrigðis- og ' || lower(seg) || CASE WHEN k % 8 = 3 THEN 'sviðs' ELSE 'svið' END
    END AS svid,
    CAST(CASE WHEN k % 17 <> 0 THEN ects END AS INTEGER) AS ects,
    CASE WHEN k % 17 = 0 THEN NULL
         WHEN k % 4 = 3 THEN CASE WHEN k % 8 = 7 THEN 'Magister Scientiarum' END
         WHEN k % 3 = 0 THEN 'Master of Science'
         WHEN k % 3 = 1 THEN 'Master of Arts'
         ELSE 'Master of Engineering' END AS degree,
    CASE WHEN k % 17 <> 0 THEN seg END AS subject,
    CASE WHEN k % 17 <> 0 AND k % 4 <> 3 THEN author || '; ' || member END AS committee,
    CASE WHEN k % 17 = 0 THEN NULL
         WHEN k % 4 = 3 OR k % 2 = 0 THEN examiner END AS examiner,
    CASE WHEN k % 17 = 0 THEN NULL
         WHEN k % 4 = 3 THEN advisor
         WHEN k % 5 = 1 THEN advisor || '; ' || member
         ELSE advisor END AS advisors,
    CAST(CASE WHEN k % 17 <> 0 THEN yr END AS INTEGER) AS year_on_page,
    CAST(n_pages AS INTEGER) AS n_pages,
    CAST(length(text) AS INTEGER) AS text_chars
  FROM b3
)
"""


def _b3(select: str) -> str:
    return _with(b3=B.B3_TITLEPAGES) + ",\n" + _B3_EXPECTED + select


ORACLES: dict[str, str] = {
    "titlepage_fields": _b3(
        "SELECT thesis_id, ects, degree, subject, year_on_page, n_pages, text_chars FROM expected"
    ),
    "titlepage_units": _b3(
        "SELECT thesis_id, faculty, school, department, deild, svid FROM expected"
    ),
    "titlepage_people": _b3("SELECT thesis_id, committee, examiner, advisors FROM expected"),
    "faculty_summary": _b3(
        """SELECT faculty, count(*) AS n, CAST(median(n_pages) AS DOUBLE) AS pages,
                  CAST(median(ects) AS DOUBLE) AS ects
           FROM expected WHERE faculty IS NOT NULL GROUP BY faculty ORDER BY n DESC, faculty"""
    ),
}


# --- files, election, queue, ledger -----------------------------------------

_NOT_THESIS = ("'yfirlýsing', 'beiðni um lokun', 'viðauki', 'fylgiskjöl', 'forsíða', "
               "'titilsíða', 'kápa', 'teikning', 'heimildaskrá', 'efnisyfirlit'")
_FORM_NAME = ("(?i)yfirl[yý]s|\\byfirl\\b|bei[ðd]ni\\s*um\\s*lokun|lokunarbei[ðd]ni"
              "|landsb[oó]kasafn|declaration")

_FILES_ROLE = f"""
scored AS (
  SELECT b4.*,
    CASE WHEN lower(trim(coalesce(description, ''))) = 'heildartexti' THEN 2
         WHEN lower(trim(coalesce(description, ''))) IN ({_NOT_THESIS}) THEN -2 ELSE 0 END
    + CASE WHEN regexp_matches(coalesce(filename, ''), '{_FORM_NAME}') THEN -5 ELSE 0 END AS score
  FROM b4
),
win AS (
  SELECT thesis_id, pos AS win_pos FROM (
    SELECT thesis_id, pos, score,
      row_number() OVER (PARTITION BY thesis_id
                         ORDER BY score DESC, coalesce(size_bytes, 0) DESC, pos ASC) AS rn
    FROM scored WHERE filetype = 'PDF') t
  WHERE rn = 1 AND score > -7
),
tf AS (
  SELECT s.*, CASE WHEN s.pos = w.win_pos THEN 'primary' ELSE 'secondary' END AS role
  FROM scored s LEFT JOIN win w ON w.thesis_id = s.thesis_id
)
"""

_DECLARATIONS = ", ".join(f"'{d}'" for d in DECLARATION_DESCRIPTIONS)

# The candidate of a thesis is the least key row over its PDFs; no row is numbered.
_CANDIDATE = f"""
f AS (
  SELECT thesis_id, best.url AS pdf_url, CAST(best.open AS INTEGER) AS open_pdfs,
    CASE WHEN best.open THEN best.bytes END AS open_size, best.bytes AS any_size
  FROM (
    SELECT thesis_id, min(struct_pack(
      not_primary := role IS DISTINCT FROM 'primary',
      not_full := description IS DISTINCT FROM 'Heildartexti',
      form := lower(coalesce(description, '')) IN ({_DECLARATIONS}),
      smaller := -coalesce(size_bytes, -1),
      name := coalesce(filename, ''), link := coalesce(url, ''),
      url := url, bytes := size_bytes,
      open := CASE WHEN access IS NULL OR access = 'Opinn' THEN true
                   ELSE coalesce(CAST(try_strptime(right(access, 10), '%d.%m.%Y') AS DATE)
                                 <= DATE '2000-01-01', false) END)) AS best
    FROM tf WHERE filetype = 'PDF' GROUP BY thesis_id)
)
"""

_LEDGER = """
classified AS (
  SELECT *,
    CASE
      WHEN http_status IS NULL OR http_status >= 400
        THEN coalesce('download failed: HTTPError ' || CAST(http_status AS VARCHAR),
                      'download failed: URLError')
      WHEN coalesce(expected_bytes, 0) > 0 AND received_bytes <> expected_bytes
        THEN 'download failed: OSError'
      WHEN coalesce(magic, '') <> '%PDF-' THEN 'not a PDF (restricted or a landing page)'
      WHEN NOT coalesce(readable, false) THEN 'unreadable PDF: PdfReadError: EOF marker not found'
      WHEN coalesce(text_chars, 0) = 0 AND n_pages IS NULL THEN 'no text and no page count'
    END AS reason
  FROM b10
),
classified2 AS (
  SELECT *, reason IS NULL AS ok,
    CASE WHEN reason IS NULL THEN NULL
         WHEN http_status IN (403, 404, 410) THEN true
         WHEN http_status IS NULL OR http_status >= 400
              OR (coalesce(expected_bytes, 0) > 0 AND received_bytes <> expected_bytes) THEN false
         WHEN coalesce(magic, '') <> '%PDF-' THEN true
         ELSE false END AS permanent
  FROM classified
),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY thesis_id ORDER BY at_ts DESC, event_id DESC) AS rn
    FROM classified2) t
  WHERE rn = 1
),
ledger AS (
  SELECT thesis_id,
    'https://repository.example/handle/1946/' || CAST(thesis_id AS VARCHAR) AS item_url,
    pdf_url, reason, permanent, at_ts AS failed_at
  FROM latest WHERE NOT ok
)
"""


def _files(select: str) -> str:
    return _with(b4=B.B4_FILES) + ",\n" + _FILES_ROLE + select


def _queue(where: str, tail: str = "", extra: dict | None = None) -> str:
    ctes = dict(b4=B.B4_FILES, b6=B.B6_METADATA, parsed=B.B6_PARSED, b10=B.B10_OUTCOMES)
    ctes.update(extra or {})
    return (
        _with(**ctes) + ",\n" + _FILES_ROLE + ",\n" + _CANDIDATE + ",\n" + _LEDGER
        + """
SELECT m.thesis_id, f.pdf_url,
       coalesce(f.open_size, f.any_size, CAST(9223372036854775807 AS BIGINT)) AS cost
FROM b6 m LEFT JOIN f ON f.thesis_id = m.thesis_id
WHERE """ + where + "\nORDER BY cost, m.thesis_id " + tail
    )


_ONLINE_DEFAULT = """f.pdf_url IS NOT NULL
  AND (m.degree_level = 'master' OR m.degree_level IS NULL)
  AND NOT EXISTS (SELECT 1 FROM parsed p WHERE p.thesis_id = m.thesis_id)
  AND NOT EXISTS (SELECT 1 FROM ledger l WHERE l.thesis_id = m.thesis_id AND l.permanent)"""

ORACLES.update({
    "elect_primary_scored": _files("SELECT thesis_id, pos, filename, role FROM tf"),
    "elect_primary_tiered": _with(b4=B.B4_FILES) + f""",
tiered AS (
  SELECT b4.*,
    CASE WHEN lower(trim(coalesce(description, ''))) = 'heildartexti' THEN 1
         WHEN lower(trim(coalesce(description, ''))) NOT IN ({_NOT_THESIS})
              AND NOT regexp_matches(coalesce(filename, ''), '{_FORM_NAME}') THEN 0 END AS tier
  FROM b4
),
win AS (
  SELECT thesis_id, pos AS win_pos FROM (
    SELECT thesis_id, pos,
      row_number() OVER (PARTITION BY thesis_id
                         ORDER BY tier DESC, coalesce(size_bytes, -1) DESC, pos ASC) AS rn
    FROM tiered WHERE upper(coalesce(filetype, '')) = 'PDF' AND tier IS NOT NULL) t
  WHERE rn = 1
)
SELECT b.thesis_id, b.pos, b.filename,
       CASE WHEN b.pos = w.win_pos THEN 'primary' ELSE 'secondary' END AS role
FROM b4 b LEFT JOIN win w ON w.thesis_id = b.thesis_id""",
    "queue_candidates": _files(",\n" + _CANDIDATE + "SELECT * FROM f"),
    "queue_candidate_window": _files(",\n" + _CANDIDATE + "SELECT * FROM f"),
    "queue_plan": _queue(_ONLINE_DEFAULT + " AND f.open_pdfs > 0"),
    "queue_plan_ids": _queue(
        "f.pdf_url IS NOT NULL AND f.open_pdfs > 0 "
        "AND m.thesis_id IN (SELECT thesis_id FROM b10)"),
    "queue_plan_cached": _queue(
        "m.thesis_id IN (SELECT doc_id FROM documents) "
        "AND (m.degree_level = 'master' OR m.degree_level IS NULL)"),
    "queue_plan_topk": _queue(
        _ONLINE_DEFAULT + " AND coalesce(f.open_size, f.any_size, 0) <= 5000000", "LIMIT 100"),
    "fetch_outcome": _with(b10=B.B10_OUTCOMES) + ",\n" + _LEDGER
        + "SELECT event_id, thesis_id, ok, reason, permanent FROM classified2",
    "failure_ledger_latest": _with(b10=B.B10_OUTCOMES) + ",\n" + _LEDGER + "SELECT * FROM ledger",
    "failure_report": _with(b10=B.B10_OUTCOMES) + ",\n" + _LEDGER
        + "SELECT reason, permanent, count(*) AS n FROM ledger GROUP BY reason, permanent",
    "election_audit": _files(""",
per_item AS (
  SELECT thesis_id,
    count(*) FILTER (WHERE filetype = 'PDF') AS pdfs,
    max(CASE WHEN role = 'primary' THEN pos END) AS primary_pos,
    bool_or(lower(trim(coalesce(description, ''))) = 'heildartexti'
            AND regexp_matches(coalesce(filename, ''), '""" + _FORM_NAME + """')) AS conflict
  FROM tf GROUP BY thesis_id
),
size_pick AS (
  SELECT thesis_id, pos AS size_pos FROM (
    SELECT thesis_id, pos, row_number() OVER (PARTITION BY thesis_id
      ORDER BY coalesce(size_bytes, 0) DESC, pos ASC) AS rn
    FROM tf WHERE filetype = 'PDF') t WHERE rn = 1
)
SELECT count(*) AS items,
  count(*) FILTER (WHERE pdfs >= 2) AS multi_pdf_items,
  count(*) FILTER (WHERE pdfs >= 2 AND s.size_pos IS DISTINCT FROM p.primary_pos) AS size_alone_differs,
  count(*) FILTER (WHERE conflict) AS description_name_conflicts
FROM per_item p LEFT JOIN size_pick s ON s.thesis_id = p.thesis_id"""),
})


# --- catalog records, upserts, keywords ---------------------------------------

_LIVE = "NOT deleted AND k % 50 <> 7"
_DATE = ("CASE WHEN length(dc_date) = 10 THEN dc_date WHEN length(dc_date) = 7 "
         "THEN dc_date || '-01' ELSE dc_date || '-01-01' END")
_AUTHORS = "concat_ws('; ', creator1, nullif(trim(creator2), ''))"


def _b1(select: str) -> str:
    return _with(b1=B.B1_RECORDS) + "\n" + select


def _name(offset_sql: str) -> str:
    return f"'oai_dc_' || set_spec || '_' || lpad(CAST({offset_sql} AS VARCHAR), 6, '0') || '.xml'"


_EXTRA_PAGES = """
  UNION ALL SELECT DISTINCT 'oai_dc_' || set_spec || '_999997.xml', 'error',
    'badResumptionToken: The token is invalid', 0 FROM b1
  UNION ALL SELECT DISTINCT 'oai_dc_' || set_spec || '_999998.xml', 'empty', CAST(NULL AS VARCHAR), 0 FROM b1
  UNION ALL SELECT DISTINCT 'oai_dc_' || set_spec || '_999999.xml', 'corrupt', 'malformed XML', 0 FROM b1
"""

# Per replay version: the derived metadata values, straight from base columns.
_B11_DERIVED = f"""
derived AS (
  SELECT k, ver,
    CASE WHEN k % 3 = 0 THEN title END AS title_is,
    CASE WHEN k % 3 <> 0 THEN title END AS title_en,
    CASE WHEN d1 IS NOT NULL THEN substring(d1, 8) END AS abstract_is,
    d2 AS abstract_en,
    nullif(concat_ws('; ', CASE WHEN d3 IS NOT NULL THEN 'lokað til 2030' END, d4), '') AS note,
    CASE WHEN t1 IS NULL THEN NULL
         ELSE CASE k % 5 WHEN 0 THEN 'master' WHEN 1 THEN 'bachelor' WHEN 2 THEN 'phd'
                         WHEN 3 THEN 'diploma' END END AS degree_level,
    CASE WHEN t1 IS NULL THEN NULL
         ELSE CASE k % 5 WHEN 0 THEN 'Thesis; Master' || chr(39) || 's'
                         WHEN 1 THEN 'Bachelor' || chr(39) || 's thesis'
                         WHEN 2 THEN 'Doctoral thesis'
                         WHEN 3 THEN 'Graduate diploma; Master' || chr(39) || 's'
                         ELSE 'Text' END END AS thesis_type,
    r1 AS related_url,
    CASE WHEN s1 IS NOT NULL THEN lower(s2) || coalesce('; ' || s3, '') END AS raw_keywords,
    c1 AS institution,
    c1 AS university
  FROM b11 WHERE {_LIVE}
)
"""
_MD_FIELDS = ["title_is", "title_en", "abstract_is", "abstract_en", "degree_level",
              "thesis_type", "note", "related_url", "raw_keywords", "institution", "university"]

ORACLES.update({
    "oai_dc_records": _b1(f"""
SELECT k AS id, {_DATE} AS date_accepted, title, {_AUTHORS} AS authors,
  concat_ws('|', s1, s2, s3) AS subjects, concat_ws('|', d1, d2, d3, d4) AS descriptions,
  concat_ws('|', c1, c2) AS contributors, concat_ws('|', t1, t2) AS types,
  concat_ws('|', r1) AS relations
FROM b1 WHERE {_LIVE}"""),
    "page_lineage": _b1(f"""
SELECT file_name, 'oai_dc' AS prefix, set_spec, CAST(page_offset AS BIGINT) AS page_offset FROM (
  SELECT DISTINCT {_name('page_offset')} AS file_name, set_spec, page_offset FROM b1
  UNION ALL SELECT DISTINCT {_name('999997')}, set_spec, 999997 FROM b1
  UNION ALL SELECT DISTINCT {_name('999998')}, set_spec, 999998 FROM b1
  UNION ALL SELECT DISTINCT {_name('999999')}, set_spec, 999999 FROM b1) t"""),
    "page_error_routing": _b1(f"""
SELECT file_name, page_status, page_error, CAST(n_records AS INTEGER) AS n_records FROM (
  SELECT {_name('page_offset')} AS file_name, 'ok' AS page_status,
         CAST(NULL AS VARCHAR) AS page_error, count(*) AS n_records
  FROM b1 GROUP BY set_spec, page_offset
  {_EXTRA_PAGES}) t"""),
    "year_filter": _b1(f"""
SELECT k AS id, {_DATE} AS date_accepted FROM b1
WHERE {_LIVE} AND CAST(substring(dc_date, 1, 4) AS INTEGER) BETWEEN 1996 AND 1998"""),
    "id_semi_filter": _b1(f"""
SELECT k AS id, title FROM b1
WHERE {_LIVE} AND k IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')"""),
    "limit_per_set": _b1(f"""
SELECT set_spec, id FROM (
  SELECT set_spec, k AS id,
    row_number() OVER (PARTITION BY set_spec ORDER BY page_offset, pos) AS rn
  FROM b1 WHERE {_LIVE}) t
WHERE rn <= 50"""),
    "thesis_insert_only": _with(b1=B.B1_RECORDS, st=B.B1_THESIS_STATE) + f"""
SELECT id, date_accepted, title, authors FROM st
UNION ALL
SELECT k, CAST({_DATE} AS DATE), title, {_AUTHORS} FROM b1
WHERE {_LIVE} AND k NOT IN (SELECT id FROM st)""",
    "metadata_last_non_null": _with(b11=B.B11_RECORDS) + ",\n" + _B11_DERIVED + "SELECT k AS thesis_id, "
        + ", ".join(f"arg_max({c}, ver) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _MD_FIELDS)
        + " FROM derived GROUP BY k",
    "keyword_dictionary": _with(b11=B.B11_RECORDS) + f"""
SELECT DISTINCT lower(s2) AS keyword_norm, lower(s2) AS keyword FROM b11 WHERE {_LIVE} AND s1 IS NOT NULL
UNION
SELECT DISTINCT lower(s3), s3 FROM b11 WHERE {_LIVE} AND s1 IS NOT NULL AND s3 IS NOT NULL""",
    "thesis_keyword_links": _with(b11=B.B11_RECORDS) + f"""
SELECT k AS thesis_id, lower(s2) AS keyword_norm, 0 AS sort_order
FROM b11 WHERE ver = 2 AND {_LIVE} AND s1 IS NOT NULL
UNION ALL
SELECT k, lower(s3), 1 FROM b11 WHERE ver = 2 AND {_LIVE} AND s1 IS NOT NULL AND s3 IS NOT NULL""",
})


# --- document text, people ----------------------------------------------------

_B9_EXPECTED = """
c AS (
  SELECT thesis_id,
    CASE WHEN thesis_id % 9 IN (0, 2) THEN NULL ELSE total END AS n_pages,
    CASE WHEN thesis_id % 9 IN (0, 1, 2) THEN NULL ELSE kept_n END AS kept,
    body
  FROM b9
)
"""

_B7_EXPECTED = """
p AS (
  SELECT id, name, year_born, year_died, base, id % 4 <> 0 AS dirty,
    CASE WHEN id % 4 IN (1, 2) THEN yb ELSE year_born END AS eff_born,
    CASE WHEN id % 4 = 2 THEN yd ELSE year_died END AS eff_died,
    base AS k_name,
    coalesce(CASE WHEN id % 4 IN (1, 2) THEN yb WHEN id % 4 = 3 THEN NULL ELSE year_born END, -1)
      AS k_born
  FROM b7
),
g AS (
  SELECT k_name, k_born,
    coalesce(min(id) FILTER (WHERE NOT dirty), min(id) FILTER (WHERE dirty)) AS survivor
  FROM p GROUP BY k_name, k_born
),
m AS (
  SELECT p.*, CASE WHEN dirty THEN g.survivor END AS target
  FROM p JOIN g ON g.k_name = p.k_name AND g.k_born = p.k_born
)
"""

ORACLES.update({
    "doc_text_marker": _with(b9=B.B9_RAW_TEXT) + ",\n" + _B9_EXPECTED + """
SELECT thesis_id, n_pages, kept, CAST(length(body) AS INTEGER) AS text_chars, md5(body) AS text_md5
FROM c""",
    "text_cache_staleness": _with(b9=B.B9_RAW_TEXT) + ",\n" + _B9_EXPECTED + """,
w AS (SELECT user_id AS thesis_id FROM events UNION SELECT doc_id FROM labels)
SELECT w.thesis_id,
  CASE WHEN c.thesis_id IS NULL THEN 'missing'
       WHEN c.n_pages IS NULL OR c.kept IS NULL OR c.kept < least(20, c.n_pages) THEN 'stale'
       ELSE 'fresh' END AS state,
  CASE WHEN c.thesis_id IS NULL THEN 'fetch'
       WHEN c.n_pages IS NULL OR c.kept IS NULL OR c.kept < least(20, c.n_pages) THEN 'fetch'
       ELSE 'cache' END AS action
FROM w LEFT JOIN c ON c.thesis_id = w.thesis_id""",
    "assemble_first_pages": _with(b8=B.B8_PAGE_ROWS) + """
SELECT thesis_id, CAST(count(*) AS INTEGER) AS n_pages,
  CAST(count(*) FILTER (WHERE page_no <= 3) AS INTEGER) AS kept,
  md5(coalesce(string_agg(CASE WHEN failed THEN '' ELSE coalesce(text, '') END, chr(10) ORDER BY page_no)
               FILTER (WHERE page_no <= 3), '')) AS text_md5,
  count(*) FILTER (WHERE page_no <= 3) > 0
    AND count(*) FILTER (WHERE page_no <= 3 AND failed) = count(*) FILTER (WHERE page_no <= 3) AS failed
FROM b8 GROUP BY thesis_id""",
    "clean_people": _with(b7=B.B7_PEOPLE) + ",\n" + _B7_EXPECTED + """
SELECT id, CASE WHEN dirty THEN base ELSE name END AS name,
  CASE WHEN dirty THEN eff_born ELSE year_born END AS year_born,
  CASE WHEN dirty THEN eff_died ELSE year_died END AS year_died
FROM m WHERE NOT dirty OR target = id""",
    "clean_people_links": _with(b7=B.B7_PEOPLE, l=B.B7_LINKS) + ",\n" + _B7_EXPECTED + """
SELECT DISTINCT l.thesis_id,
  coalesce(CASE WHEN m.dirty AND m.target <> m.id THEN m.target END, l.person_id) AS person_id, l.role
FROM l LEFT JOIN m ON m.id = l.person_id""",
    "clean_people_changed": _with(b7=B.B7_PEOPLE) + """
SELECT count(*) FILTER (WHERE id % 4 <> 0) AS changed FROM b7""",
})


# --- reports, progress ----------------------------------------------------------

ORACLES.update({
    "run_summary": _with(b3=B.B3_TITLEPAGES, b10=B.B10_OUTCOMES) + ",\n" + _B3_EXPECTED + ",\n"
        + _LEDGER + """
SELECT t.processed, t.with_unit,
  CASE WHEN t.processed > 0 THEN (10000 * t.with_unit) // t.processed END AS with_unit_bp,
  f.failed
FROM (SELECT count(*) AS processed,
             count(*) FILTER (WHERE faculty IS NOT NULL OR deild IS NOT NULL) AS with_unit
      FROM expected) t,
     (SELECT count(*) AS failed FROM ledger) f""",
    "reconcile_document_wins": _with(b3=B.B3_TITLEPAGES, b6=B.B6_METADATA) + ",\n" + _B3_EXPECTED + """
SELECT coalesce(m.thesis_id, e.thesis_id) AS thesis_id,
  coalesce(CASE WHEN e.degree IS NOT NULL THEN 'master' END, m.degree_level) AS degree_level,
  CASE WHEN e.degree IS NOT NULL THEN 'document' WHEN m.degree_level IS NOT NULL THEN 'metadata' END
    AS source,
  CASE WHEN e.degree IS NOT NULL AND m.degree_level IS NOT NULL THEN m.degree_level = 'master' END
    AS agrees
FROM b6 m FULL OUTER JOIN expected e ON e.thesis_id = m.thesis_id""",
    "schema_evolution_union": _with(b4=B.B4_FILES) + f""",
tiered AS (
  SELECT b4.*,
    CASE WHEN lower(trim(coalesce(description, ''))) = 'heildartexti' THEN 1
         WHEN lower(trim(coalesce(description, ''))) NOT IN ({_NOT_THESIS})
              AND NOT regexp_matches(coalesce(filename, ''), '{_FORM_NAME}') THEN 0 END AS tier
  FROM b4
),
win AS (
  SELECT thesis_id, pos AS win_pos FROM (
    SELECT thesis_id, pos,
      row_number() OVER (PARTITION BY thesis_id
                         ORDER BY tier DESC, coalesce(size_bytes, -1) DESC, pos ASC) AS rn
    FROM tiered WHERE upper(coalesce(filetype, '')) = 'PDF' AND tier IS NOT NULL) t
  WHERE rn = 1
)
SELECT thesis_id, pos, 'old' AS snapshot, CAST(NULL AS VARCHAR) AS role FROM b4
UNION ALL
SELECT b.thesis_id, b.pos, 'new',
       CASE WHEN b.pos = w.win_pos THEN 'primary' ELSE 'secondary' END
FROM b4 b LEFT JOIN win w ON w.thesis_id = b.thesis_id""",
    "harvest_progress": _b1("""
, pages AS (SELECT DISTINCT set_spec, page_offset FROM b1),
sets AS (
  SELECT set_spec, set_spec IN ('col_1946_2', 'col_1946_4') AS open_,
    list(page_offset ORDER BY page_offset DESC) AS offsets
  FROM pages GROUP BY set_spec
)
SELECT 'oai_dc' AS prefix, set_spec,
  CAST(len(offsets) - CAST(open_ AS INTEGER) AS BIGINT) AS pages,
  CASE WHEN open_ THEN offsets[2] ELSE offsets[1] END AS last_offset,
  CASE WHEN open_ THEN 'oai_dc///' || set_spec || '/' || CAST(offsets[2] + 100 AS VARCHAR) END
    AS next_token,
  CASE WHEN open_ THEN offsets[2] + 100 ELSE offsets[1] + 1 END AS next_offset,
  NOT open_ AS complete
FROM sets"""),
    "pending_index": _with(b6=B.B6_METADATA) + """
SELECT thesis_id FROM b6
WHERE thesis_id NOT IN (SELECT DISTINCT l_orderkey FROM lineitem)
ORDER BY thesis_id""",
})


# --- rich records -----------------------------------------------------------------

_XOAI_FILES = """
SELECT bs.k AS thesis_id, CAST(bs.pos - 1 AS INTEGER) AS pos,
  coalesce(bs.bs_name, bs.bs_original) AS filename,
  bs.bs_size AS size_bytes,
  CASE bs.bs_description WHEN 'COMPLETE_TEXT' THEN 'Heildartexti' WHEN 'DECLARATION' THEN 'Yfirlýsing'
       ELSE bs.bs_description END AS description,
  CASE bs.bs_format WHEN 'application/zip' THEN 'ZIP' WHEN 'application/pdf' THEN 'PDF'
       ELSE upper(regexp_extract(coalesce(bs.bs_name, bs.bs_original), '[^.]*$')) END AS filetype,
  bs.bs_url AS url,
  CAST(bs.pos AS INTEGER) AS sid
FROM (""" + B.B2_BITSTREAMS + """) bs
JOIN (""" + B.B2_RECORDS + """) r ON r.k = bs.k
WHERE NOT r.deleted AND r.has_handle
"""

_DEGREE_FILLED = """
filled AS (
  SELECT m.thesis_id,
    coalesce(m.degree_level, CASE r.degree WHEN 'Meistaragráða' THEN 'master'
      WHEN 'Graduate diploma' THEN 'diploma' WHEN 'Doctoral' THEN 'phd' END) AS degree_level,
    r.degree AS degree_raw
  FROM b6 m LEFT JOIN (SELECT k, degree FROM b2 WHERE NOT deleted AND has_handle AND degree IS NOT NULL) r
    ON r.k = m.thesis_id
)
"""

ORACLES.update({
    "xoai_records": _with(b2=B.B2_RECORDS) + """
SELECT k AS id, author AS authors, concat_ws('; ', advisor1, advisor2) AS advisors, degree
FROM b2 WHERE NOT deleted AND has_handle""",
    "xoai_bitstreams": _with(x=_XOAI_FILES) + "\nSELECT * FROM x",
    "degree_fill": _with(b6=B.B6_METADATA, b2=B.B2_RECORDS) + ",\n" + _DEGREE_FILLED
        + "SELECT * FROM filled",
    "degree_audit": _with(b6=B.B6_METADATA, b2=B.B2_RECORDS) + ",\n" + _DEGREE_FILLED + """,
bf AS (SELECT degree_level, count(*) AS n FROM b6 GROUP BY degree_level),
af AS (SELECT degree_level, count(*) AS n FROM filled GROUP BY degree_level)
SELECT coalesce(bf.degree_level, af.degree_level) AS degree_level,
  coalesce(bf.n, 0) AS before, coalesce(af.n, 0) AS after
FROM bf FULL OUTER JOIN af ON bf.degree_level IS NOT DISTINCT FROM af.degree_level""",
    "files_replace_carry_access": _with(b4=_XOAI_FILES, st=B.B4_FILES) + ",\n" + _FILES_ROLE + """,
known AS (
  SELECT thesis_id, filename, max(access) AS access FROM st WHERE access IS NOT NULL
  GROUP BY thesis_id, filename
)
SELECT thesis_id, filename, size_bytes, access, description, filetype,
  CAST(NULL AS VARCHAR) AS role, url
FROM st WHERE thesis_id NOT IN (SELECT thesis_id FROM tf)
UNION ALL
SELECT t.thesis_id, t.filename, t.size_bytes, k.access, t.description, t.filetype, t.role, t.url
FROM tf t LEFT JOIN known k ON k.thesis_id = t.thesis_id AND k.filename = t.filename""",
})


# Streams must land exactly where the batch jobs do.
ORACLES.update({
    "stream_pages_ingest": ORACLES["oai_dc_records"],
    "stream_replay_idempotent": ORACLES["metadata_last_non_null"],
    "stream_failure_ledger": ORACLES["failure_ledger_latest"],
})


# --- item-page grid -----------------------------------------------------------------

_B5_FILES = """
SELECT thesis_id, CAST(pos - 1 AS INTEGER) AS pos, filename, size_label,
  CASE WHEN size_label = 'óþekkt' THEN NULL
       ELSE CAST(trunc(CAST(replace(replace(regexp_extract(size_label, '^([0-9.,]+)', 1), '.', ''), ',', '.')
                            AS DOUBLE) * 1048576) AS BIGINT) END AS size_bytes,
  access_label AS access, description_label AS description, filetype, url AS href
FROM b5
"""

ORACLES.update({
    "html_file_grid": _with(b5=B.B5_ROWS) + ",\ng AS (" + _B5_FILES + ")\nSELECT * FROM g",
    "file_index_status": _with(b5=B.B5_ROWS) + """
SELECT o.o_orderkey AS thesis_id, TIMESTAMP '2024-01-01 12:00:00' AS indexed_at,
  CAST(count(b5.thesis_id) AS INTEGER) AS file_count
FROM orders o LEFT JOIN b5 ON b5.thesis_id = o.o_orderkey GROUP BY o.o_orderkey""",
    "file_index_files": _with(b5=B.B5_ROWS) + ",\nb4 AS (" + _B5_FILES + f"""),
tiered AS (
  SELECT b4.*,
    CASE WHEN lower(trim(coalesce(description, ''))) = 'heildartexti' THEN 1
         WHEN lower(trim(coalesce(description, ''))) NOT IN ({_NOT_THESIS})
              AND NOT regexp_matches(coalesce(filename, ''), '{_FORM_NAME}') THEN 0 END AS tier
  FROM b4
),
win AS (
  SELECT thesis_id, pos AS win_pos FROM (
    SELECT thesis_id, pos,
      row_number() OVER (PARTITION BY thesis_id
                         ORDER BY tier DESC, coalesce(size_bytes, -1) DESC, pos ASC) AS rn
    FROM tiered WHERE upper(coalesce(filetype, '')) = 'PDF' AND tier IS NOT NULL) t
  WHERE rn = 1
)
SELECT b.thesis_id, b.filename, b.size_bytes, b.access,
  CASE WHEN b.href LIKE '/%' THEN 'https://repository.example' || b.href ELSE b.href END AS url,
  CASE WHEN b.pos = w.win_pos THEN 'primary' ELSE 'secondary' END AS role
FROM b4 b LEFT JOIN win w ON w.thesis_id = b.thesis_id""",
})

ORACLES["people_load"] = _with(b2=B.B2_RECORDS) + """,
m AS (
  SELECT k AS thesis_id, 'author' AS role, 0 AS sort_order, author AS name FROM b2
  WHERE NOT deleted AND has_handle
  UNION ALL
  SELECT k, 'advisor', 0, advisor1 FROM b2 WHERE NOT deleted AND has_handle AND advisor1 IS NOT NULL
  UNION ALL
  SELECT k, 'advisor', CASE WHEN advisor1 IS NULL THEN 0 ELSE 1 END, advisor2 FROM b2
  WHERE NOT deleted AND has_handle
)
SELECT thesis_id, role, CAST(min(sort_order) AS INTEGER) AS sort_order, name || '|' AS person_id, name,
  CAST(NULL AS INTEGER) AS year_born
FROM m GROUP BY thesis_id, role, name"""

# --- pages in, state kept by earlier runs ------------------------------------------------------

_OFFLINE = ORACLES["text_cache_staleness"].replace("""
  CASE WHEN c.thesis_id IS NULL THEN 'fetch'
       WHEN c.n_pages IS NULL OR c.kept IS NULL OR c.kept < least(20, c.n_pages) THEN 'fetch'
       ELSE 'cache' END AS action
FROM w LEFT JOIN c""", """
  'cache' AS action
FROM w JOIN c""")

ORACLES.update({
    "rejected_pages": _b1(f"""
SELECT * FROM (SELECT '' AS file_name, '' AS page_status, '' AS page_error, 0 AS n_records
  {_EXTRA_PAGES}) t WHERE page_status IN ('error', 'corrupt')""").replace(
        "SELECT * FROM (SELECT ''", "SELECT file_name, page_status, page_error FROM (SELECT ''"),
    "scan_pages_inventory": "SELECT file_name, page_status, n_records FROM ("
        + ORACLES["page_error_routing"] + ") t",
    "scan_doc_text": "SELECT thesis_id, n_pages, kept FROM (" + ORACLES["doc_text_marker"] + ") t",
    "stream_replay_bronze": _with(b11=B.B11_RECORDS) + f"""
SELECT {_name('page_offset')} AS file_name, count(*) AS n_records
FROM b11 WHERE {_LIVE} GROUP BY set_spec, page_offset""",
    "metadata_merge_state": ORACLES["metadata_last_non_null"],
    "keyword_dictionary_state": ORACLES["keyword_dictionary"],
    "keyword_links_state": ORACLES["thesis_keyword_links"],
    "failure_ledger_merge_state": ORACLES["failure_ledger_latest"],
    "file_index_replace_state": "WITH now AS (" + ORACLES["file_index_files"] + """)
SELECT thesis_id, CASE WHEN thesis_id % 3 = 0 THEN filename ELSE 'old_' || filename END AS filename,
  size_bytes, access, url, role
FROM now WHERE thesis_id % 3 = 0 OR thesis_id % 2 = 0""",
    "file_index_status_state": "WITH now AS (" + ORACLES["file_index_status"] + """)
SELECT thesis_id, CASE WHEN thesis_id % 3 = 0 THEN indexed_at ELSE TIMESTAMP '2020-01-01 00:00:00' END
  AS indexed_at, file_count
FROM now WHERE thesis_id % 3 = 0 OR thesis_id % 2 = 0""",
    "titlepage_replace_clears_failure": "WITH l AS (" + ORACLES["failure_ledger_latest"] + """)
SELECT * FROM l
WHERE thesis_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)""",
    "queue_plan_retry_failed": _queue(
        _ONLINE_DEFAULT.rsplit("AND NOT EXISTS", 1)[0] + " AND f.open_pdfs > 0"),
    "text_cache_offline": _OFFLINE,
    "pending_index_ids": _with(b6=B.B6_METADATA, b10=B.B10_OUTCOMES) + """
SELECT thesis_id FROM b6 WHERE thesis_id IN (SELECT thesis_id FROM b10) ORDER BY thesis_id""",
    "pages_without_grid": """SELECT o_orderkey AS thesis_id FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
})

# State that carries order, versioned tables and merged micro-batches.
ORACLES.update({
    "silver_metadata_batches": "SELECT n_batches, t.* FROM ("
        + ORACLES["metadata_last_non_null"] + ") t, (VALUES (1), (4), (7)) b(n_batches)",
    "metadata_reversed": ORACLES["metadata_last_non_null"],
    "keyword_dictionary_reversed": ORACLES["keyword_dictionary"],
    "keyword_links_reversed": ORACLES["thesis_keyword_links"],
    "degree_fill_reversed": ORACLES["degree_fill"],
    "stream_ledger_crash": ORACLES["failure_ledger_latest"],
    "files_versions": ORACLES["files_replace_carry_access"],
    "file_index_versions": ORACLES["file_index_replace_state"],
    "file_index_status_versions": ORACLES["file_index_status_state"],
    "titlepage_versions": _b3("""SELECT thesis_id,
        CASE WHEN thesis_id % 2 = 0 THEN faculty ELSE 'old ' || faculty END AS faculty,
        CAST(CASE WHEN thesis_id % 2 = 0 THEN n_pages ELSE -1 END AS INTEGER) AS n_pages
        FROM expected"""),
})


# Dumps, harvests with gaps, people over two runs, case folding.
EARLY, LATE = (context_digest(years=y, output="catalog") for y in ("1990-1995", "1996-2000"))
_HARVESTS = _with(b1=B.B1_RECORDS) + f""",
pages AS (SELECT DISTINCT set_spec, page_offset FROM b1),
ends AS (SELECT set_spec, max(page_offset) AS final FROM pages GROUP BY set_spec),
kept AS (
  SELECT '{EARLY}' AS context, set_spec, page_offset FROM pages WHERE page_offset % 700 <> 300
  UNION ALL SELECT '{LATE}', set_spec, page_offset FROM pages WHERE page_offset < 5000),
last AS (SELECT context, set_spec, max(page_offset) AS last FROM kept GROUP BY context, set_spec),
missing AS (
  SELECT k.context, 'oai_dc' AS prefix, k.set_spec, k.page_offset AS after_offset,
    k.page_offset + 100 AS missing_offset
  FROM kept k JOIN last l ON l.context = k.context AND l.set_spec = k.set_spec
  WHERE k.page_offset + 100 <= l.last AND NOT EXISTS (SELECT 1 FROM kept o WHERE
    o.context = k.context AND o.set_spec = k.set_spec AND o.page_offset = k.page_offset + 100))
"""
ORACLES.update({
    "dump_records": ORACLES["oai_dc_records"],
    "dump_problems": _b1("""
SELECT status, problem, count(DISTINCT set_spec) AS n FROM b1, (VALUES
  ('error', 'badResumptionToken: The token is invalid'), ('corrupt', 'malformed XML'))
  p(status, problem) GROUP BY status, problem"""),
    "dump_tokens": _b1("""
SELECT 'oai_dc///' || set_spec || '/' || CAST(page_offset + 100 AS VARCHAR) AS token
FROM (SELECT DISTINCT set_spec, page_offset FROM b1) p
WHERE page_offset < (SELECT max(page_offset) FROM b1 q WHERE q.set_spec = p.set_spec)"""),
    "harvest_missing": _HARVESTS + "SELECT * FROM missing",
    "harvest_resume": _HARVESTS + """
SELECT context, prefix, set_spec, resume_offset, missing FROM (
  SELECT l.context, 'oai_dc' AS prefix, l.set_spec,
    coalesce(min(m.missing_offset), CASE WHEN l.last < any_value(e.final) THEN l.last + 100 END)
      AS resume_offset, count(m.missing_offset) AS missing
  FROM last l JOIN ends e ON e.set_spec = l.set_spec
  LEFT JOIN missing m ON m.context = l.context AND m.set_spec = l.set_spec
  GROUP BY l.context, l.set_spec, l.last) t
WHERE resume_offset IS NOT NULL""",
    "harvest_counts": _b1(f"""
SELECT 'oai_dc' AS prefix, set_spec, count(DISTINCT page_offset) + 3 AS pages,
  count(*) FILTER (WHERE {_LIVE}) AS records FROM b1 GROUP BY set_spec"""),
    "file_load_counts": _with(b5=B.B5_ROWS, b6=B.B6_METADATA, b2=B.B2_RECORDS, x=_XOAI_FILES)
        + ",\n" + _DEGREE_FILLED + """
SELECT 'item pages' AS load, (SELECT count(*) FROM orders) AS theses,
  (SELECT count(*) FROM b5) AS files, 0 AS degrees
UNION ALL SELECT 'bundles', (SELECT count(DISTINCT thesis_id) FROM x), (SELECT count(*) FROM x),
  (SELECT count(*) FROM filled WHERE degree_raw IS NOT NULL)""",
    "scan_doc_text_whole": ORACLES["doc_text_marker"],
    "people_runs": ORACLES["clean_people"],
    "people_links_runs": ORACLES["clean_people_links"],
    "keyword_folding": _with(b12=B.B12_KEYWORDS) + """
SELECT b.thesis_id, b.word AS keyword_norm, 0 AS sort_order, f.spelling AS keyword
FROM b12 b JOIN (SELECT word, arg_min(spelling, thesis_id) AS spelling FROM b12 GROUP BY word) f
  ON f.word = b.word""",
})
