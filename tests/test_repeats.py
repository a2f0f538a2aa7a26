"""Literal cases: records met twice, odd markup, state kept by earlier runs."""

import datetime as dt

from pyspark.sql import functions as F

from folio.functions.files import bitstream_seq, set_spec
from folio.operators.ledger import classify_fetch, text_cache_state
from folio.operators.people import clean_people, load_people
from folio.sources.doc_text import assemble_text
from folio.sources.html_grid import pages_without_grid, parse_file_grid
from folio.sources.pages import scan_doc_text
from folio.sources.xoai import explode_bitstreams, last_record_files, parse_xoai
from folio.streaming.ingest import checkpoint_dir, read_bronze, run_to_bronze


def xoai_page(*records):
    return ("<OAI-PMH><ListRecords>" + "".join(
        '<record><header/><metadata><metadata><element name="dc">'
        + "".join(f'<element name="contributor"><element name="author">{a}</element></element>'
                  for a in [authors])
        + '</element><element name="bundles"><element name="bundle"><field name="name">ORIGINAL</field>'
        '<element name="bitstreams">'
        + "".join(f'<element name="bitstream"><field name="name">{f}</field></element>' for f in files)
        + f'</element></element></element><element name="others"><field name="handle">1946/{i}</field>'
        "</element></metadata></metadata></record>"
        for i, authors, files in records) + "</ListRecords></OAI-PMH>")


def value(v):
    return f'<field name="value">{v}</field>'


def pages(spark, *xml):
    return spark.createDataFrame([(f"xoai_all_{i:06d}.xml", x) for i, x in enumerate(xml)],
                                 "file_name string, xml string")


def test_values_at_any_depth(spark):
    deep = value("Own") + '<element name="a">' + value("One") + '<element name="b">' + value(
        "Two") + '<element name="c">' + value("Three") + "</element></element></element>"
    got = parse_xoai(pages(spark, xoai_page((5, deep, [])))).collect()[0]
    assert got.authors == ["Own", "One", "Two", "Three"]


def test_last_record_of_a_thesis_wins(spark):
    two = pages(spark, xoai_page((7, value("Old, 1950-"), ["a.pdf", "b.pdf"])),
                xoai_page((7, value("New, 1960-"), ["c.pdf"]), (8, value("New, 1960-"), [])),
                xoai_page((7, value("Last"), [])))
    rich = parse_xoai(two)
    files = last_record_files(explode_bitstreams(rich)).collect()
    assert [(r.thesis_id, r.filename) for r in files] == [(7, "c.pdf")]
    people, links = load_people(rich)
    assert sorted(r.id for r in people.collect()) == ["Last|", "New|1960"]
    assert sorted((r.thesis_id, r.person_id) for r in links.collect()) == [
        (7, "Last|"), (8, "New|1960")]


def test_ids_stay_unique_for_many_names(spark):
    names = [f"Name {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(1200)]
    rich = spark.createDataFrame(
        [(i, "p", i, names, names[:3] * 2) for i in (1, 2)],
        "id long, file_name string, pos int, authors array<string>, advisors array<string>")
    people, links = load_people(rich)
    assert people.count() == people.select("id").distinct().count() == 1200
    assert links.count() == 2 * (1200 + 3)
    cleaned = clean_people(people, links)[1]
    assert "sort_order" in cleaned.columns and cleaned.count() == links.count()


GRID = """<table class="x t-data-grid y"><thead><tr><th>Skr&aacute;arnafn</th><th>S</th><th>A</th>
<th>L</th><th>F</th></tr></thead><tbody><tr><td>R&#237;t &amp; ger&eth;.pdf<td>1,5 MB<td>Opinn<td>
<td>PDF<td><a href='/b?x=1&amp;y=2'>Opna</a></tr></tbody><tbody><tr><td>b.pdf</td><td>2 KB</td>
<td>Loka&eth;ur</td><td></td><td>PDF</td><td><a href=/c>x</a></td></tr></tbody></table>"""


def test_grid_markup(spark):
    other = GRID.replace("t-data-grid", "t-data-grid-pager")
    rows = [(1, GRID), (2, other), (3, GRID.replace('"', "'")), (4, "<p>none</p>"), (5, None)]
    df = spark.createDataFrame(rows, "thesis_id long, html string")
    got = [(r.thesis_id, r.pos, r.filename, r.size_bytes, r.access, r.href)
           for r in parse_file_grid(df).orderBy("thesis_id", "pos").collect()]
    want = [(0, "R\u00edt & ger\u00f0.pdf", 1572864, "Opinn", "/b?x=1&y=2"),
            (1, "b.pdf", 2048, "Loka\u00f0ur", "/c")]
    assert got == [(i, *w) for i in (1, 3) for w in want]
    assert sorted(r.thesis_id for r in pages_without_grid(df).collect()) == [2, 4, 5]


def test_set_spec_and_sequence(spark):
    rows = [("1946/2064", "com_1946_2064"), ("1946 6870", "com_1946_6870"),
            ("col_1946_1", "col_1946_1"), ("com_1946_2", "com_1946_2")]
    df = spark.createDataFrame(rows, "h string, want string")
    assert df.where(set_spec("h") != F.col("want")).count() == 0
    seq = spark.createDataFrame([("/bitstream/1946/5/12/a.pdf",), ("/x",), (None,)], "u string")
    assert [r[0] for r in seq.select(bitstream_seq("u")).collect()] == [12, 9999, 9999]


def test_first_pages_are_counted_not_numbered(spark):
    rows = [(1, p, f"p{p}", False) for p in (0, 4, 9)]
    df = spark.createDataFrame(rows, "thesis_id long, page_no int, text string, failed boolean")
    got = assemble_text(df, n=2).collect()[0]
    assert (got.n_pages, got.kept, got.text) == (3, 2, "p0\np4")


def test_unexpected_failures_and_no_response(spark):
    row = (1, None, None, None, None, None, 0, None)
    df = spark.createDataFrame(
        [(*row, "KeyError"), (*row, None), (1, 404, 1, 1, "%PDF-", True, 5, 3, None)],
        "thesis_id int, http_status int, expected_bytes long, received_bytes long, magic string, "
        "readable boolean, text_chars int, n_pages int, unexpected string")
    got = [(r.reason, r.permanent) for r in classify_fetch(df).collect()]
    assert got == [("unexpected: KeyError", False), ("download failed: URLError", False),
                   ("download failed: HTTPError 404", True)]


def test_staleness_whole_documents_and_offline(spark):
    cache = spark.createDataFrame([(1, 106, 8), (2, 106, 106), (3, 6, None)],
                                  "thesis_id long, n_pages int, kept int")
    wanted = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "thesis_id long")
    whole = {r.thesis_id: r.state for r in text_cache_state(cache, wanted, pages=None).collect()}
    assert whole == {1: "stale", 2: "fresh", 3: "stale", 4: "missing"}
    off = {r.thesis_id: r.action for r in text_cache_state(cache, wanted, offline=True).collect()}
    assert off == {1: "cache", 2: "cache", 3: "cache"}


def test_texts_named_by_id(spark, tmp_path):
    for name in ("12.txt", "7.txt", "notes.txt"):
        (tmp_path / name).write_text("a\nb")
    got = {r.thesis_id: r.raw for r in scan_doc_text(spark, str(tmp_path)).collect()}
    assert got == {7: "a\nb", 12: "a\nb"}


def test_raw_page_stream_and_retried_batches(spark, tmp_path):
    rows = [(f"p{i}", f"<a>{i}\n</a>", dt.datetime(2024, 1, 1)) for i in range(6)]
    df = spark.createDataFrame(rows, "page string, value string, t timestamp").drop("t")
    df.repartition("page").write.partitionBy("page").text(str(tmp_path / "in"))
    for files in (2, 3):
        run_to_bronze(spark, str(tmp_path / "in"), "value string, page string", lambda b: b,
                      str(tmp_path / "bronze"), checkpoint_dir(str(tmp_path / "c"), files=files),
                      max_files_per_trigger=files, wholetext=True)
    got = read_bronze(spark, str(tmp_path / "bronze"), ["page"]).collect()
    assert sorted((r.page, r.value.strip()) for r in got) == [(p, v) for p, v, _ in rows]
    assert checkpoint_dir("c", a=1) != checkpoint_dir("c", a=2)
