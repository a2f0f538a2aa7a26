"""Harvest pages -> records.

A page is one row ``(file_name, xml)``. ``from_xml`` parses it against a
minimal explicit schema (only the elements a job reads), ``posexplode`` turns
it into records, and higher-order functions clean the repeated values -- a
narrow, per-page map with no shuffle. Record order is ``(file_name, pos)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import col_

HANDLE_PREFIX = "1946"
DC_FIELDS = ["title", "creator", "subject", "description", "contributor", "type",
             "relation", "date", "identifier"]
PAGE_NAME_PREFIXES = ["oai_dc", "xoai"]

XML_OPTIONS = {
    "ignoreNamespace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
}

_DC = ", ".join(f"{f}: ARRAY<STRING>" for f in DC_FIELDS)
RECORD_FIELDS = (
    "header: STRUCT<_status: STRING, identifier: STRING, datestamp: STRING, setSpec: ARRAY<STRING>>, "
    f"metadata: STRUCT<dc: STRUCT<{_DC}>>"
)
OAI_DC_SCHEMA = (
    f"ListRecords STRUCT<record: ARRAY<STRUCT<{RECORD_FIELDS}>>, "
    "resumptionToken: STRUCT<_VALUE: STRING>>, "
    "error STRUCT<_code: STRING, _VALUE: STRING>, _corrupt_record STRING"
)


def strip_ws(c: Column) -> Column:
    """Python's str.strip(): any Unicode whitespace at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_values(arr: Column) -> Column:
    """Each value stripped; blank and missing values dropped; order kept."""
    return F.filter(F.transform(F.coalesce(arr, F.array().cast("array<string>")), strip_ws),
                    lambda x: x.isNotNull() & (x != ""))


def parse_pages(pages: DataFrame, schema: str = OAI_DC_SCHEMA) -> DataFrame:
    """``pages(file_name, xml)`` -> ``pages + p`` (the parsed page struct).

    The one-element ``explode`` keeps the parse in a step of its own: filters on
    the result are not pushed below it, so a page is parsed once.
    """
    return pages.select(
        "*", F.explode(F.array(F.from_xml(F.col("xml"), schema, XML_OPTIONS))).alias("p"))


def rejected_pages(pages: DataFrame, schema: str = OAI_DC_SCHEMA) -> DataFrame:
    """The pages that carry no records because they are bad: name, status, error."""
    return route_page_errors(parse_pages(pages, schema)).where(
        F.col("page_status").isin("error", "corrupt")).select(
        "file_name", "page_status", "page_error")


def route_page_errors(parsed: DataFrame, fail_on_error: bool = False) -> DataFrame:
    """Classify each parsed page.

    ``ok`` pages carry records; ``empty`` is an OAI ``noRecordsMatch`` (zero
    rows, not an error); ``error`` is any other OAI error code, reported as
    ``code: message``; ``corrupt`` is markup that does not parse. With
    ``fail_on_error`` the first bad page fails the job (``raise_error``).
    """
    code = F.col("p.error._code")
    message = F.coalesce(F.nullif(strip_ws(F.col("p.error._VALUE")), F.lit("")),
                         F.lit("OAI-PMH request failed"))
    status = (
        F.when(F.col("p._corrupt_record").isNotNull() | F.col("p").isNull(), "corrupt")
        .when(code == "noRecordsMatch", "empty")
        .when(code.isNotNull(), "error")
        .otherwise("ok")
    )
    detail = (
        F.when(status == "error", F.concat(code, F.lit(": "), message))
        .when(status == "corrupt", F.lit("malformed XML"))
    )
    out = parsed.withColumn("page_status", status).withColumn("page_error", detail)
    if fail_on_error:
        out = out.withColumn(
            "page_status",
            F.when(F.col("page_status").isin("error", "corrupt"),
                   F.raise_error(F.concat(F.col("file_name"), F.lit(": "), F.col("page_error")))
                   ).otherwise(F.col("page_status")),
        )
    return out


def norm_dc_date(c: Column | str) -> Column:
    """Anchored 'YYYY[-MM[-DD]]' prefix -> 'YYYY-MM-DD', missing parts 01."""
    v = strip_ws(col_(c))
    rx = r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?"
    y, m, d = (F.regexp_extract(v, rx, i) for i in (1, 2, 3))
    return F.when(
        v.rlike(rx),
        F.concat_ws("-", y, F.coalesce(F.nullif(m, F.lit("")), F.lit("01")),
                    F.coalesce(F.nullif(d, F.lit("")), F.lit("01"))),
    )


def record_id(dc_identifiers: Column, header_identifier: Column,
              handle_prefix: str = HANDLE_PREFIX) -> Column:
    """First '<prefix>/<digits>' among the dc identifiers in order, then the
    header identifier."""
    rx = f"{handle_prefix}/(\\d+)"
    cands = F.concat(dc_identifiers, F.array(F.coalesce(header_identifier, F.lit(""))))
    hits = F.filter(F.transform(cands, lambda x: F.regexp_extract(x, rx, 1)), lambda x: x != "")
    return F.try_element_at(hits, F.lit(1)).try_cast("bigint")


def parse_oai_dc(pages: DataFrame, handle_prefix: str = HANDLE_PREFIX,
                 fail_on_error: bool = True) -> DataFrame:
    """``pages(file_name, xml)`` -> one row per live record.

    An error page or a malformed one fails the job; with ``fail_on_error`` off
    it is left to ``rejected_pages``. Deleted records and records without a handle id are dropped. Lists keep
    document order; ``pos`` is the record's position in its page.
    """
    routed = route_page_errors(parse_pages(pages), fail_on_error).where(
        F.col("page_status") == "ok")
    recs = routed.select(
        "file_name", F.posexplode(F.col("p.ListRecords.record")).alias("pos", "r")
    )
    return dc_records(recs, handle_prefix)


def dc_records(recs: DataFrame, handle_prefix: str = HANDLE_PREFIX) -> DataFrame:
    """Parsed records ``(file_name, pos, r)`` as J3 gives them."""
    recs = recs.where(F.coalesce(F.col("r.header._status"), F.lit("")) != "deleted")
    dc = {f: clean_values(F.col(f"r.metadata.dc.{f}")) for f in DC_FIELDS}
    header_id = F.nullif(strip_ws(F.col("r.header.identifier")), F.lit(""))
    out = recs.select(
        "file_name",
        "pos",
        record_id(dc["identifier"], header_id, handle_prefix).alias("id"),
        norm_dc_date(F.try_element_at(dc["date"], F.lit(1))).alias("date_accepted"),
        F.try_element_at(dc["title"], F.lit(1)).alias("title"),
        F.when(F.size(dc["creator"]) > 0, F.array_join(dc["creator"], "; ")).alias("authors"),
        dc["creator"].alias("creators"),
        dc["subject"].alias("subjects"),
        dc["description"].alias("descriptions"),
        dc["contributor"].alias("contributors"),
        dc["type"].alias("types"),
        dc["relation"].alias("relations"),
    )
    return out.where(F.col("id").isNotNull())


#: All that progress needs of a page: its token and its error.
TOKEN_SCHEMA = ("ListRecords STRUCT<resumptionToken: STRUCT<_VALUE: STRING>>, "
                "error STRUCT<_code: STRING, _VALUE: STRING>, _corrupt_record STRING")


def page_tokens(pages: DataFrame, *carried: str) -> DataFrame:
    """Per good page: its resumption token (NULL on the last page of a set)."""
    ok = route_page_errors(parse_pages(pages, TOKEN_SCHEMA)).where(F.col("page_status") == "ok")
    return ok.select(
        "file_name", *carried,
        F.nullif(strip_ws(F.col("p.ListRecords.resumptionToken._VALUE")), F.lit("")).alias("token"),
    )


def lineage_columns(file_name: Column, prefixes: list[str] = PAGE_NAME_PREFIXES) -> list[Column]:
    """A cache name ``<prefix>_<set>_<offset:06d>.xml`` back to its parts."""
    alts = "|".join(prefixes)
    rx = f"^({alts})_(.+)_(\\d{{6,}})\\.xml$"
    return [
        F.nullif(F.regexp_extract(file_name, rx, 1), F.lit("")).alias("prefix"),
        F.nullif(F.regexp_extract(file_name, rx, 2), F.lit("")).alias("set_spec"),
        F.nullif(F.regexp_extract(file_name, rx, 3), F.lit("")).try_cast("bigint")
        .alias("page_offset"),
    ]


def page_lineage(pages: DataFrame, prefixes: list[str] = PAGE_NAME_PREFIXES) -> DataFrame:
    """J2 over a page table."""
    return pages.select("file_name", *lineage_columns(F.col("file_name"), prefixes))


def safe_name_part(c: Column | str) -> Column:
    """The cache-name form of a prefix or set: runs outside [A-Za-z0-9_.-]
    become '_', edge underscores trimmed, empty -> 'all'."""
    v = F.regexp_replace(F.coalesce(col_(c), F.lit("all")), r"[^A-Za-z0-9_.-]+", "_")
    v = F.regexp_replace(v, r"^_+|_+$", "")
    return F.when(v == "", F.lit("all")).otherwise(v)


def year_filter(records: DataFrame, year_start: int | None, year_end: int | None) -> DataFrame:
    """inclusive year range on date_accepted; either side may be open.
    A record without a year is dropped as soon as either bound is set."""
    if year_start is None and year_end is None:
        return records
    year = F.regexp_extract(F.coalesce("date_accepted", F.lit("")), r"^(\d{4})", 1)
    y = F.nullif(year, F.lit("")).try_cast("int")
    keep = y.isNotNull()
    if year_start is not None:
        keep &= y >= year_start
    if year_end is not None:
        keep &= y <= year_end
    return records.where(keep)


def limit_per_set(records: DataFrame, n: int) -> DataFrame:
    """L1: the first ``n`` records of each harvested set, by (offset, pos).

    ``row_number() <= n`` is planned as a group limit that runs before the
    shuffle as well as after it, so a large set ships at most ``n`` rows per
    task, never the whole set.
    """
    r = records.select("*", *lineage_columns(F.col("file_name")))
    w = Window.partitionBy("prefix", "set_spec").orderBy("page_offset", "pos")
    return r.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")
