"""Queries over several lots of records or files read their pages once."""

import re

import pytest

from folio import catalog
from folio.sources import html_grid

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "degree_fill_reversed", "files_replace_carry_access", "file_index_replace_state",
    "file_index_files", "file_index_status_state", "keyword_dictionary_reversed",
    "keyword_dictionary_state", "people_load"])
def test_what_is_read_twice_is_stored(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF))
    assert "from_xml(" not in plan and "MapInArrow" not in plan


def test_dump_files_follow_the_data(spark, monkeypatch):
    monkeypatch.setattr(catalog.dump, "scan_dump", lambda _, path: path)
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "4000")
    try:
        path = catalog._dump(spark, SF)
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert len(spark.read.text(path).inputFiles()) > 2


HEAD = ('<table class="t-data-grid"><thead><tr><th>Skráarnafn</th></tr></thead><tbody>')


def test_plain_rows_read_as_any_other_row(spark):
    plain = ('<tr><td>a &amp; b</td><td> 1 MB</td><td></td><td>d</td><td>PDF</td>'
             '<td><a href="/x?a=1&amp;b=2">Opna</a></td></tr>\n')
    odd = re.sub("<td>", "<TD class='c'>", plain)
    one = [(["a & b", "1 MB", "", "d", "PDF", "Opna"], "/x?a=1&b=2")]
    for rows, n in ((plain, 1), (odd, 1), (plain + odd + plain, 3), ("<tr></tr>" + plain, 1)):
        html = HEAD + rows + "</tbody></table>"
        assert html_grid._read(html) == (True, one * n)
        assert html_grid._read(html, False) == (True, [])
    assert html_grid._read(HEAD.replace("Skr", "skr") + plain) == (True, one)
    assert html_grid._read(HEAD.replace("Skr", "x") + plain, False) == (False, [])
