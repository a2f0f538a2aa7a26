"""Scans and parsers on literal inputs."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from folio.sources.doc_text import assemble_text, split_marker
from folio.sources.oai_dc import (
    parse_oai_dc, parse_pages, rejected_pages, route_page_errors,
)
from folio.sources.pages import scan_pages

PAGE = """<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>
<record><header><identifier>oai:x:1946/11</identifier></header><metadata>
<oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/" xmlns:dc="http://purl.org/dc/elements/1.1/">
<dc:title>A title</dc:title><dc:creator>Example, Ann</dc:creator><dc:creator> </dc:creator>
<dc:date>2019-05</dc:date><dc:identifier>http://hdl.handle.net/1946/11</dc:identifier>
</oai_dc:dc></metadata></record>
<record><header status="deleted"><identifier>oai:x:1946/12</identifier></header></record>
<resumptionToken>oai_dc///col_1/100</resumptionToken></ListRecords></OAI-PMH>"""
EMPTY = ('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">'
         '<error code="noRecordsMatch">none</error></OAI-PMH>')
BAD = ('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/">'
       '<error code="badArgument">wrong</error></OAI-PMH>')


def test_scan_pages_prefix_and_fallback(spark):
    d = tempfile.mkdtemp(prefix="folio-pages-")
    for name, body in [("oai_dc_col_1_000000.xml", PAGE), ("xoai_col_1_000000.xml", EMPTY),
                       ("notes.txt", "x")]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(body)
    got = sorted(r.file_name for r in scan_pages(spark, d, "oai_dc").collect())
    assert got == ["oai_dc_col_1_000000.xml"]
    old = tempfile.mkdtemp(prefix="folio-pages-old-")
    with open(os.path.join(old, "page1.xml"), "w", encoding="utf-8") as f:
        f.write(PAGE)
    assert scan_pages(spark, old, "oai_dc").count() == 1


def test_parse_and_route(spark):
    pages = spark.createDataFrame([("a.xml", PAGE), ("b.xml", EMPTY), ("c.xml", BAD),
                                   ("d.xml", "<OAI-PMH><ListRecords>")], "file_name string, xml string")
    with pytest.raises(Exception, match="badArgument: wrong|malformed XML"):
        parse_oai_dc(pages).collect()
    recs = parse_oai_dc(pages, fail_on_error=False).collect()
    assert [(r.id, r.date_accepted, r.title, r.authors) for r in recs] == [
        (11, "2019-05-01", "A title", "Example, Ann")]
    routed = {r.file_name: (r.page_status, r.page_error)
              for r in route_page_errors(parse_pages(pages)).collect()}
    assert routed == {"a.xml": ("ok", None), "b.xml": ("empty", None),
                      "c.xml": ("error", "badArgument: wrong"), "d.xml": ("corrupt", "malformed XML")}
    assert sorted(r.file_name for r in rejected_pages(pages).collect()) == ["c.xml", "d.xml"]


def test_marker_cases(spark):
    rows = [(1, "%%PAGES\t106\t20\nbody"), (2, "%%PAGES\t106\nbody"), (3, "plain"),
            (4, "%%PAGES\tx\t3\nbody"), (5, "%%PAGES\t6\t6\n")]
    df = spark.createDataFrame(rows, "thesis_id bigint, raw string")
    got = {r.thesis_id: (r.n_pages, r.kept, r.text) for r in split_marker(df).collect()}
    assert got == {1: (106, 20, "body"), 2: (106, None, "body"), 3: (None, None, "plain"),
                   4: (None, None, "body"), 5: (6, 6, "")}


def test_failed_page_keeps_place(spark):
    rows = [(1, 1, "one", False), (1, 2, "two", True), (1, 3, "three", False),
            (2, 1, "x", True), (2, 2, "y", True)]
    df = spark.createDataFrame(rows, "thesis_id bigint, page_no int, text string, failed boolean")
    got = {r.thesis_id: (r.n_pages, r.kept, r.text, r.failed)
           for r in assemble_text(df, n=2).collect()}
    assert got == {1: (3, 2, "one\n", False), 2: (2, 2, "\n", True)}
    whole = assemble_text(df, n=None).where(F.col("thesis_id") == 1).collect()[0]
    assert whole.text == "one\n\nthree"
