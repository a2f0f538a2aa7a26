"""Title-page extraction on literal pages (invented names)."""

from folio.operators.titlepage import extract_titlepage

ENGLISH = """A Study of Glacier Flow
Jane Doefield
60 ECTS thesis submitted in partial fulfillment of a
Magister Scientiarum degree in Geophysics, Applied
MS Committee
Ann Example
Bob Placeholder
Master's Examiner
Carl Sample
Advisor
Dana Testperson
Faculty of Earth Sciences University of Iceland
School of Engineering and Natural Sciences
University of Iceland
Reykjavik, May 2019
"""

ICELANDIC = """Rannsókn á jöklum
Jón Prófason
Ritgerð til meistaraprófs (M.Sc.) í Jarðeðlisfræði
30 ECTS
Leiðbeinendur
Guðrún Dæmadóttir
HÁSKÓLI ÍSLANDS Jarðvísindadeild
Verkfræði- og náttúruvísindasvið
Reykjavík, 2020
"""


def _one(spark, text, n_pages=10):
    df = spark.createDataFrame([(1, n_pages, text)], "thesis_id bigint, n_pages int, text string")
    return extract_titlepage(df).collect()[0].asDict()


def test_english_page(spark):
    r = _one(spark, ENGLISH)
    assert r["faculty"] == "Earth Sciences"
    assert r["school"] == "Engineering and Natural Sciences"
    assert r["department"] is None
    assert r["ects"] == 60
    assert r["degree"] == "Magister Scientiarum"
    assert r["subject"] == "Geophysics, Applied"
    assert r["committee"] == "Ann Example; Bob Placeholder"
    assert r["examiner"] == "Carl Sample"
    assert r["advisors"] == "Dana Testperson"
    assert r["year_on_page"] == 2019
    assert r["deild"] is None and r["svid"] is None
    assert r["text_chars"] == len(ENGLISH)


def test_icelandic_page(spark):
    r = _one(spark, ICELANDIC)
    assert r["faculty"] is None
    assert r["deild"] == "Jarðvísindadeild"
    assert r["svid"] == "Verkfræði- og náttúruvísindasvið"
    assert r["subject"] == "Jarðeðlisfræði"
    assert r["ects"] == 30
    assert r["advisors"] == "Guðrún Dæmadóttir"
    assert r["year_on_page"] == 2020


def test_empty_text_keeps_page_count(spark):
    r = _one(spark, "", n_pages=12)
    assert r["n_pages"] == 12 and r["text_chars"] == 0
    assert all(r[k] is None for k in ("faculty", "ects", "degree", "committee", "year_on_page"))


def test_no_text_and_no_pages_gives_no_row(spark):
    df = spark.createDataFrame([(1, None, None)], "thesis_id bigint, n_pages int, text string")
    assert extract_titlepage(df).count() == 0


def test_heading_without_names_is_null(spark):
    r = _one(spark, "Advisors:\nFaculty of Law\n")
    assert r["advisors"] is None
    assert r["faculty"] == "Law"


def test_title_texts_of_one_split_are_read_by_many_tasks(spark):
    from folio import catalog

    # A small table is a single split; its texts must not be matched in a single task.
    texts = catalog.title_texts(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert catalog.B.doc_text_from_titlepages(
            spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 1
        assert texts.rdd.getNumPartitions() == 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
