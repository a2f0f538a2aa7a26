"""Column expressions against literal cases."""

from pyspark.sql import functions as F

from folio.functions import files as ff
from folio.functions import metadata as md
from folio.sources.oai_dc import norm_dc_date, safe_name_part


def _vals(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_size_labels(spark):
    got = _vals(spark, ["86,08 MB", "86.08 MB", "512 B", "1,5 KB", "2 GB", "  3 mb ", "", "text",
                        None], ff.size_bytes)
    assert got == [int(86.08 * 1024 ** 2), 8608 * 1024 ** 2, 512, 1536, 2 * 1024 ** 3,
                   3 * 1024 ** 2, None, None, None]


def test_dc_date(spark):
    got = _vals(spark, ["2019-05", "2019", "2019-05-17T00:00", "May 2019", None], norm_dc_date)
    assert got == ["2019-05-01", "2019-01-01", "2019-05-17", None, None]


def test_parse_date4(spark):
    import datetime as dt
    got = _vals(spark, ["17.5.2019", "2019-05-17", "2019-05", "2019", "junk"], md.parse_date4)
    assert got == [dt.date(2019, 5, 17), dt.date(2019, 5, 17), dt.date(2019, 5, 1),
                   dt.date(2019, 1, 1), None]


def test_degree_level(spark):
    got = _vals(spark, ["Doktorsritgerð", "Meistaraprófsritgerð", "B.Sc. thesis", "Doctoral",
                        "Diplóma", "Other", None], md.degree_level)
    assert got == ["phd", "master", "bachelor", "phd", "diploma", None, None]


def test_person_name(spark):
    df = spark.createDataFrame([("Example, Anna, 1950-2010",), ("Test Person (1971)",),
                                ("Plain Name",), ("(1980-)",)], "v string")
    rows = df.select(*md.person_name(F.col("v"))).collect()
    assert [tuple(r) for r in rows] == [("Example, Anna", 1950, 2010), ("Test Person", 1971, None),
                                        ("Plain Name", None, None), ("", 1980, None)]


def test_split_keywords(spark):
    df = spark.createDataFrame([(["Ice; snow", "ICE, Thesis", " ", "water"],)], "v array<string>")
    assert df.select(md.split_keywords(F.col("v"))).collect()[0][0] == ["Ice", "snow", "water"]


def test_abstracts_and_note(spark):
    vals = ["Íslenskt ágrip: Um ís", "An English abstract", "Athugasemd: Lokað til 2030",
            "Ritgerðin er lokuð", "Annað íslenskt"]
    df = spark.createDataFrame([(vals,)], "v array<string>")
    r = df.select(*md.abstracts_and_note(F.col("v"))).collect()[0]
    assert tuple(r) == ("Um ís", "An English abstract", "Lokað til 2030; Ritgerðin er lokuð")


def test_thesis_types_master(spark):
    df = spark.createDataFrame([(["Master's thesis", "Thesis", "Graduate diploma", "Other"],)],
                               "v array<string>")
    got = df.select(md.thesis_types(F.col("v"), F.lit("master"))).collect()[0][0]
    assert got == "Thesis; Master's; Other"


def test_set_spec_and_names(spark):
    got = _vals(spark, ["com/1946 2064", None, "__"], safe_name_part)
    assert got == ["com_1946_2064", "all", "all"]


def test_form_filename(spark):
    got = _vals(spark, ["Yfirlysing.pdf", "yfirl.pdf", "efnisyfirlit.pdf", "Landsbókasafn.pdf",
                        "thesis.pdf"], ff.form_filename)
    assert got == [True, True, False, True, False]
