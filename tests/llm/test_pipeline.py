import __spark_entry__ as entry
import corpus_pipeline
from folio.llm.common import staged
from folio.session import read_table

SF = "/root/testdata/sf0.001"


def test_stages_run_in_order_and_keep_the_columns(spark):
    docs = read_table(spark, SF, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, SF), name)
        assert docs.columns == columns
        counts.append(docs.count())
        rows = docs.select("text", "n_chars").collect()
        assert all(len(r["text"]) == r["n_chars"] for r in rows)
    assert counts == sorted(counts, reverse=True) and counts[2] < counts[1]
    assert counts[2] == counts[3] == counts[4]
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]


def test_empty_and_null_documents(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "some words here")]).select(
        "doc_id", "text", "lang", "source", "n_chars")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = staged(spark, stage(spark, some, SF), name)
            assert out.count() <= 4


def test_passages_of_over_fifty_words_are_cut(spark, make_docs):
    passage = " ".join(f"w{i}" for i in range(51))
    texts = [f"here {passage} ends", f"another text has {passage}", f"only {passage[:-1]}x y"]
    docs = make_docs(list(enumerate(texts))).select("doc_id", "text", "lang", "source", "n_chars")
    out = {r["doc_id"]: (r["text"], r["n_chars"])
           for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect()}
    assert out == {0: ("here ends", 9), 1: ("another text has ", 17), 2: (texts[2], len(texts[2]))}


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert any(q.startswith(f"op{n}_") for q in names)
