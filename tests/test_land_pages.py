"""Raw pages landed packed, one a file, and files scanned by the tasks, without a list in the driver."""

import pathlib

import pytest

from folio.session import new_work_dir
from folio.sources.pages import land_pages, scan_doc_text, scan_page_folders
from folio.streaming.ingest import checkpoint_dir, read_bronze, run_to_bronze

PAGES = [("oai_dc_a_000000.xml", "<a>á</a>"), ("oai_dc_b:1=%/x [y]+z.xml", " <b/>\n"),
         ("oai_dc_twice.xml", "1"), ("oai_dc_twice.xml", "2"), ("xoai_a.xml", None), (None, "none")]


def _landed(spark, tasks):
    path = f"{new_work_dir(spark, 'land')}/pages"
    land_pages(spark.createDataFrame(PAGES, "file_name string, xml string").coalesce(tasks), path)
    return path


@pytest.mark.parametrize("tasks", [1, 4])
def test_each_page_is_a_file_and_comes_back(spark, tasks):
    path = _landed(spark, tasks)
    assert len([p for p in pathlib.Path(path).iterdir() if p.suffix == ".gz"]) == len(PAGES)
    got = sorted((r.file_name, r.xml.strip()) for r in scan_page_folders(spark, path).collect())
    assert got == sorted((n, x.strip()) for n, x in PAGES if n and n.startswith("oai_dc_"))


def test_landed_pages_are_streamed_under_their_names(spark):
    path = _landed(spark, 2)
    names = ("spark.sql.sources.parallelPartitionDiscovery.parallelism",
             "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    work, seen = new_work_dir(spark, "st"), []

    def told(rows):
        seen.extend(int(rows.sparkSession.conf.get(n)) for n in names)
        return rows.selectExpr("page", "trim(TRAILING '\n' FROM value) AS value")

    run_to_bronze(spark, path, "value string", told, f"{work}/bronze",
                  checkpoint_dir(f"{work}/checkpoint"), wholetext=True)
    got = {(r.page, r.value.strip()) for r in read_bronze(
        spark, f"{work}/bronze", ["page", "value"]).collect()}
    assert got == {(n, (x or "").strip()) for n, x in PAGES}
    # A listing used to take a task a folder, up to 10,000, and a task 32 files at most.
    assert seen == [4 * spark.sparkContext.defaultParallelism, 64 << 10]
    assert [spark.conf.get(n) for n in names] == before


@pytest.mark.parametrize("layout", ["folders", "files"])
def test_texts_are_scanned_without_a_list_in_the_driver(spark, tmp_path, layout):
    texts = {1: "one\n", 20: "two\r\n\n", 3: "", 4: "á" * 5000}
    for i, text in texts.items():
        folder = tmp_path / f"thesis_id={i}" if layout == "folders" else tmp_path
        folder.mkdir(exist_ok=True)
        (folder / ("part-0.txt" if layout == "folders" else f"{i}.txt")).write_bytes(text.encode())
        (folder / ".part-0.txt.1").write_text("unseen")
        (folder / "_SUCCESS").write_text("")
    got = scan_doc_text(spark, str(tmp_path))
    # The driver's list held every file, about a kilobyte each.
    assert got.inputFiles() == []
    assert {r.thesis_id: r.raw for r in got.collect()} == texts


def test_pages_of_a_batch_of_few_files_are_dealt_out(spark):
    from folio.catalog import _dealt_records

    pages = spark.createDataFrame([("oai_dc_a_000000.xml", "<a/>")], "file_name string, xml string")
    plan = _dealt_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(file_name" in plan
