"""Raw files landed in folders: the layout of the partitioned text writer, without its processes."""

import pathlib

from folio.session import new_work_dir
from folio.sources.pages import land_folders, scan_doc_text, scan_page_folders


def _files(path):
    return {(str(p.parent.relative_to(path)), p.read_bytes())
            for p in pathlib.Path(path).rglob("part-*")}


def test_landed_files_are_those_of_the_partitioned_writer(spark):
    work = new_work_dir(spark, "land")
    rows = spark.createDataFrame(
        [("oai_dc_a_000000.xml", "<a>á</a>"), ("oai_dc_b:1=%/x [y].xml", "<b/>\n"), (None, "none"),
         ("", "empty"), ("xoai_a.xml", None), ("oai_dc_twice.xml", "1"), ("oai_dc_twice.xml", "1")],
        "page string, value string").coalesce(1)
    land_folders(rows, f"{work}/own")
    rows.write.partitionBy("page").text(f"{work}/spark")
    assert _files(f"{work}/own") == _files(f"{work}/spark")
    assert sorted(map(tuple, scan_page_folders(spark, f"{work}/own").collect())) == sorted(
        map(tuple, scan_page_folders(spark, f"{work}/spark").collect()))


def test_a_landed_text_is_one_file_and_comes_back_whole(spark):
    work = new_work_dir(spark, "land")
    rows = spark.range(40).selectExpr("id AS thesis_id", "concat('line 1\n', id) AS value")
    land_folders(rows, f"{work}/texts", " ")
    # No checksum files, each of which cost a process and a rename of its own.
    assert len([p for p in pathlib.Path(work).rglob("*") if p.is_file()]) == 40
    assert sorted(map(tuple, scan_doc_text(spark, f"{work}/texts").collect())) == [
        (i, f"line 1\n{i} ") for i in range(40)]
