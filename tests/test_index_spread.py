"""Item pages of one split are parsed by many tasks."""

from folio import catalog


def test_pages_of_one_split_are_dealt_out_before_the_parse(spark, monkeypatch):
    page = ("<table class='t-data-grid'><thead><tr><th>Skráarnafn</th></tr></thead><tbody><tr><td>a.pdf</td>"
            "<td>1 KB</td><td>Opinn</td><td></td><td>PDF</td></tr></tbody></table>")
    pages = spark.createDataFrame([(i, page) for i in range(200)],
                                  "thesis_id long, html string").coalesce(1)
    parsed = []
    parse = catalog.html_grid.parse_file_grid
    monkeypatch.setattr(catalog.html_grid, "parse_file_grid",
                        lambda p: parsed.append(p) or parse(p))
    files = catalog.indexed_files(spark, pages)
    assert files.where("role = 'primary'").count() == 200
    # One exchange by id lies between the single split and the parse.
    assert "hashpartitioning(thesis_id" in parsed[0]._jdf.queryExecution().toString()
