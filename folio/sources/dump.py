"""Harvest dumps: files of many GB that hold page after page (J3 at scale).

A dump is read in pieces that end at ``</record>``, by the text source's own separator, so
one file is scanned by as many tasks as it has splits and no task holds more than a
record. The markup before a record (of the page that it opens, and what closes the one
before) comes with the piece; page errors, tokens and records that are never closed are
read from it by a second, narrow pass, without parsing a record.

A piece's place is ``pos = (block, row)``: the first byte of its split and its rank among the
task's pieces, so ``(file_name, pos)`` is document order at no shuffle. ``</record>`` inside
a comment or CDATA section would cut a record there; such a record is reported as corrupt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.sources.oai_dc import RECORD_FIELDS, XML_OPTIONS, dc_records, strip_ws

RECORD_END = "</record>"
RECORD_SCHEMA = f"STRUCT<{RECORD_FIELDS}, _corrupt_record: STRING>"


def scan_dump(spark: SparkSession, path: str) -> DataFrame:
    """``(file_name, pos, head, xml, unclosed)``: one row a piece. ``xml`` is the record (NULL in
    a piece without one), ``head`` the markup before it, ``unclosed`` how many records
    the piece opens before its own."""
    pieces = spark.read.option("lineSep", RECORD_END).text(path).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("pos"), "value")
    opened = F.regexp_count("value", F.lit(r"<record[\s>]"))
    # The last opening tag is the record's own; greedy matching finds it.
    own = F.regexp_extract("value", r"(?s)^.*(<record[\s>].*)$", 1)
    return pieces.select(
        "file_name", "pos",
        F.when(opened > 0, F.regexp_extract("value", r"(?s)^(.*?)<record[\s>]", 1)).otherwise(
            F.col("value")).alias("head"),
        F.when(opened > 0, F.concat(own, F.lit(RECORD_END))).alias("xml"),
        F.greatest(opened - 1, F.lit(0)).alias("unclosed"))


def _parsed(scan: DataFrame) -> DataFrame:
    """The pieces with their record as ``r``. The one-element ``explode`` keeps the parse in
    one place."""
    return scan.where(F.col("xml").isNotNull()).select(
        "file_name", "pos", F.explode(F.array(F.from_xml("xml", RECORD_SCHEMA, XML_OPTIONS))).alias("r"))


def parse_dump(scan: DataFrame) -> DataFrame:
    """The records of a dump, as ``parse_oai_dc`` gives those of pages."""
    good = _parsed(scan).where(F.col("r._corrupt_record").isNull() & F.col("r").isNotNull())
    return dc_records(good)


def dump_problems(scan: DataFrame) -> DataFrame:
    """``(file_name, pos, status, problem)``: page errors, and records that are not whole."""
    message = F.coalesce(F.nullif(strip_ws(F.col("e.message")), F.lit("")),
                         F.lit("OAI-PMH request failed"))
    found = F.regexp_extract_all("head", F.lit(r"(?s)<error[^>]*>[^<]*"), F.lit(0))
    errors = scan.select("file_name", "pos", F.explode(found).alias("x")).select(
        "file_name", "pos", F.struct(
            F.regexp_extract("x", r"code=[\"']([^\"']*)[\"']", 1).alias("code"),
            F.regexp_extract("x", r"(?s)>([^<]*)", 1).alias("message")).alias("e")).where(
        F.col("e.code") != "noRecordsMatch").select(
        "file_name", "pos", F.lit("error").alias("status"),
        F.concat("e.code", F.lit(": "), message).alias("problem"))
    unclosed = scan.where(F.col("unclosed") > 0).select(
        "file_name", "pos", F.explode(F.sequence(F.lit(1), F.col("unclosed"))).alias("n")).select(
        "file_name", "pos", F.lit("corrupt").alias("status"),
        F.lit("malformed XML").alias("problem"))
    broken = _parsed(scan).where(F.col("r._corrupt_record").isNotNull()).select(
        "file_name", "pos", F.lit("corrupt").alias("status"),
        F.lit("malformed XML").alias("problem"))
    return errors.unionByName(unclosed).unionByName(broken)


def dump_tokens(scan: DataFrame) -> DataFrame:
    """``(file_name, pos, token)``: the resumption tokens of a dump, in document order."""
    found = F.regexp_extract_all("head", F.lit(r"(?s)<resumptionToken[^>]*>([^<]*)"), F.lit(1))
    return scan.select("file_name", "pos", F.explode(found).alias("token")).select(
        "file_name", "pos", F.nullif(strip_ws(F.col("token")), F.lit("")).alias("token")).where(
        F.col("token").isNotNull())
