"""File election cases (invented file names)."""

from folio.operators.election import elect_primary_scored, elect_primary_tiered

SCHEMA = "thesis_id bigint, pos int, filename string, description string, filetype string, size_bytes bigint"


def _primary(spark, rows, fn=elect_primary_scored):
    df = spark.createDataFrame(rows, SCHEMA)
    out = fn(df).where("role = 'primary'").select("thesis_id", "pos").collect()
    return {r.thesis_id: r.pos for r in out}


def test_full_text_beats_larger_declaration(spark):
    rows = [(1, 0, "scan.pdf", "Yfirlýsing", "PDF", 900), (1, 1, "thesis.pdf", "Heildartexti", "PDF", 100)]
    assert _primary(spark, rows) == {1: 1}


def test_swapped_pair_decided_by_filename(spark):
    rows = [(2, 0, "declaration of access.pdf", "Heildartexti", "PDF", 10),
            (2, 1, "My Thesis.pdf", "Yfirlýsing", "PDF", 5)]
    assert _primary(spark, rows) == {2: 1}


def test_only_forms_elect_nobody(spark):
    rows = [(3, 0, "yfirlysing.pdf", "Yfirlýsing", "PDF", 10)]
    assert _primary(spark, rows) == {}


def test_ties_go_to_first_listed(spark):
    rows = [(4, 0, "a.pdf", None, "PDF", 10), (4, 1, "b.pdf", None, "PDF", 10)]
    assert _primary(spark, rows) == {4: 0}


def test_non_pdf_never_primary(spark):
    rows = [(5, 0, "a.zip", "Heildartexti", "ZIP", 10)]
    assert _primary(spark, rows) == {}


def test_tiered_prefers_fulltext_then_non_form(spark):
    rows = [(6, 0, "big.pdf", None, "pdf", 999), (6, 1, "t.pdf", "Heildartexti", "PDF", 1),
            (7, 0, "Yfirlysing.pdf", None, "PDF", 50), (7, 1, "t.pdf", None, "PDF", None)]
    assert _primary(spark, rows, elect_primary_tiered) == {6: 1, 7: 1}
