from pyspark.sql import functions as F

from folio.functions.text import FOLD_MANY, FOLD_ONE, dedupe_ci, fold
from folio.operators import people, progress
from folio.session import new_work_dir
from folio.sources import dump, oai_dc


def rec(i, title="t", extra=""):
    return (f"<record><header{extra}><identifier>oai:x:1946/{i}</identifier></header><metadata>"
            f"<oai_dc:dc xmlns:oai_dc='u'><dc:title>{title}</dc:title></oai_dc:dc></metadata></record>")


def page(*records, token=None, tail=""):
    told = f"<resumptionToken>{token}</resumptionToken>" if token else ""
    return (f"<?xml version='1.0'?><OAI-PMH><ListRecords>{''.join(records)}{told}</ListRecords>"
            f"{tail}</OAI-PMH>")


def test_records_of_a_dump_in_splits(spark):
    work = new_work_dir(spark, "dump")
    pages = [page(*(rec(100 * p + i, f"title &lt;{i}&gt; {'long ' * 200}") for i in range(50)),
                  token=f"oai///s/{p}") for p in range(6)]
    bad = ["<OAI-PMH><error code='badArgument'>no</error></OAI-PMH>",
           "<OAI-PMH><error code='noRecordsMatch'>none</error></OAI-PMH>",
           page(rec(9000, "gone", " status='deleted'"), "<record><header><broken></header></record>"),
           "<OAI-PMH><ListRecords><record><header>"]
    spark.createDataFrame([("\n".join(pages[:3] + bad + pages[3:]),)], "x string").coalesce(
        1).write.text(f"{work}/d")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = dump.scan_dump(spark, f"{work}/d")
        assert scan.rdd.getNumPartitions() > 5
        got = dump.parse_dump(scan).orderBy("file_name", "pos").select("id", "title").collect()
        problems = sorted(map(tuple, dump.dump_problems(scan).select("status", "problem").collect()))
        tokens = [r[0] for r in dump.dump_tokens(scan).orderBy("file_name", "pos").select(
            "token").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    want = oai_dc.parse_oai_dc(spark.createDataFrame(
        [(f"oai_dc_s_{i:06d}.xml", p) for i, p in enumerate(pages)], "file_name string, xml string")
        ).orderBy("file_name", "pos").select("id", "title").collect()
    assert got == want and len(got) == 300
    assert problems == [("corrupt", "malformed XML")] * 2 + [("error", "badArgument: no")]
    assert tokens == [f"oai///s/{p}" for p in range(6)]


def test_fold_equals_the_rule(spark):
    texts = ["Maß", "MASS", "ﬁn", "ΛΌΓΟΣ", "λόγος", "İstanbul", "ǅ", "", "plain", "ſ", "ŉ",
             *FOLD_MANY, *FOLD_ONE]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(fold("t")).collect()] == [t.casefold() for t in texts]
    df = spark.createDataFrame([(["Straße ", "STRASSE", "x", "strasse", "X"],)], "a array<string>")
    assert df.select(dedupe_ci(F.col("a"))).first()[0] == ["Straße", "x"]


def test_progress_knows_its_context_and_gaps(spark):
    here, other = progress.context_digest(a=1, b=[2]), progress.context_digest(a=1, b=[3])
    assert here == progress.context_digest(b=[2], a=1) != other
    rows = [(f"oai_dc_s_{o:06d}.xml", page(rec(o), token=f"x/{o + 100}"), here)
            for o in (0, 100, 300, 600)] + [("oai_dc_t_000000.xml", page(rec(1)), here)]
    pages = spark.createDataFrame(rows, "file_name string, xml string, context string")
    assert sorted(tuple(r) for r in progress.missing_pages(pages).select(
        "set_spec", "after_offset", "missing_offset").collect()) == [
        ("s", 100, 200), ("s", 300, 400)]
    assert [tuple(r) for r in progress.resume_points(pages, here).collect()] == [
        ("oai_dc", "s", 200, 2)]
    assert progress.resume_points(pages, other).count() == 0


def test_two_loads_with_a_cleaning_between_equal_one(spark):
    schema = "id long, name string, year_born int, year_died int"
    loads = [[(2, "Ann (Jr)", None, None), (5, "Bo, 1950-", None, None), (9, "Cy", None, None)],
             [(1, "Bo (1950–2001)", None, None), (3, "Ann", None, None), (4, "Ann (Sr)", None, None)],
             [(0, "Ann", None, None), (7, "Cy (x)", None, None), (2, "Ann (Jr)", None, None)]]
    every = spark.createDataFrame([r for load in loads for r in load], schema).dropDuplicates()
    want, moves = people.clean_more(None, None, every)
    state = forward = None
    for load in loads:
        state, forward = (spark.createDataFrame(d.collect(), d.schema) for d in people.clean_more(
            state, forward, spark.createDataFrame(load, schema)))
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, want.collect()))
    assert dict(map(tuple, forward.collect())) == dict(map(tuple, moves.collect())) == {
        2: 0, 4: 0, 5: 1, 7: 9}
    links = spark.createDataFrame([(1, 2, "a"), (1, 4, "a"), (1, 3, "a"), (2, 5, "b")],
                                  "thesis_id long, person_id long, role string")
    assert sorted(map(tuple, people.resolve_links(links, forward).collect())) == [
        (1, 0, "a"), (1, 3, "a"), (2, 1, "b")]


def test_grid_markup_as_found_in_pages(spark):
    from folio.sources import html_grid

    head = "<table id=a class='x t-data-grid'><thead><tr><th>Skráar<b>nafn</b></th></tr></thead>"
    row = ("<tr><td>{0}</td><td> 1,5&nbsp;MB</td><td>Opinn</td><td>a &amp; <i>b</i></td>"
           "<td>PDF</td><td><a href=\"/f?x=1&amp;y='{0}'\">Opna</a></td></tr>")
    pages = [
        # Two bodies count, foot and head rows don't; rows and cells need no end tags.
        head + "<tbody>" + row.format("one.pdf") + "</tbody><tbody><tr><td>two.pdf<td>1 KB<td>Lokað"
        "<td><td>PDF<tr><td>short</tbody><tfoot>" + row.format("foot.pdf") + "</tfoot></table>"
        + row.format("outside"),
        # The header has to stand in a thead.
        "<table class=t-data-grid><tbody><tr><th>Skráarnafn</th></tr>" + row.format("no.pdf")
        + "</tbody></table>",
        head + "<tbody></tbody></table>",
        "<p>t-data-grid Skráarnafn</p>", None, "",
        "<!-- <table class='t-data-grid'> --><script>'<table class=\"t-data-grid\">'</script>"
        + head.replace("class='x t-data-grid'", 'CLASS="t-data-grid"') + "<tbody>" + row.format(
            "<!-- c -->three<br>.pdf"),
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "thesis_id long, html string")
    got = html_grid.parse_file_grid(df).orderBy("thesis_id", "pos").collect()
    assert [(r["thesis_id"], r["pos"], r["filename"], r["description"], r["href"]) for r in got] == [
        (0, 0, "one.pdf", "a & b", "/f?x=1&y='one.pdf'"), (0, 1, "two.pdf", "", None),
        (6, 0, "three .pdf", "a & b", "/f?x=1&y='<!-- c -->three<br>.pdf'")]
    assert got[0]["size_bytes"] == int(1.5 * 1048576)
    assert sorted(r[0] for r in html_grid.pages_without_grid(df).collect()) == [1, 3, 4, 5]
