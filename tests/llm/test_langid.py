import numpy as np
from folio.llm import langid
from folio.session import read_table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_defined_cases(spark, make_docs):
    docs = read_table(spark, SF, "documents")
    model = langid.fit(docs)
    got = langid.detect(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(
        langid.held_out())
    rows = got.collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)

    by_lang = {r["lang"]: r["text"] for r in docs.where("n_chars > 1500").select(
        "lang", "text").collect()}
    mixed = by_lang["en"][:600].rsplit(" ", 1)[0] + " " + by_lang["de"][:300]
    odd = make_docs([(1, None), (2, ""), (3, "123 -- !!"), (4, mixed), (None, by_lang["fr"]),
                     (5, "слово"), (5, "слово"), (6, by_lang["es"] * 40)])
    out = langid.detect(odd, model, with_spans=True).collect()
    by_id = {r["doc_id"]: r for r in out}
    assert len(out) == 8
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3))
    assert by_id[4]["lang_pred"] == "en"
    spans = by_id[4]["spans"]
    assert {"en", "de"} <= {s["lang"] for s in spans}
    assert sum(s["n_words"] for s in spans) == len(mixed.split())
    assert by_id[None]["lang_pred"] == "fr" and by_id[6]["lang_pred"] == "es"

    kept = langid.known(odd, model)
    assert kept.columns == odd.columns
    assert {4, None, 6} <= {r["doc_id"] for r in kept.collect()} <= {4, None, 5, 6}


def test_without_labels_or_rows(spark, make_docs):
    docs = make_docs([(1, "some words"), (2, None)])
    model = langid.fit(docs)
    assert [r["lang_pred"] for r in langid.detect(docs, model).collect()] == ["und", "und"]
    assert langid.known(docs, model).count() == 0
    assert langid.detect(docs.limit(0), langid.fit(docs.limit(0))).count() == 0


def test_what_is_broadcast_needs_no_module_of_the_package(spark):
    import pickle

    model = langid.Model(["a"], np.zeros((4, 1), np.float32), np.ones((1, 2), bool))
    raw = pickle.dumps(model.sent(spark).value)
    assert b"folio" not in raw
