import re

import numpy as np

from folio.llm import quality
from folio.session import read_table

SF = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    hit = {p + k for at in seen.values() if len(at) > 1 for p in at for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit))


def test_base_columns_equal_brute_force(spark, make_docs):
    docs = read_table(spark, SF, "documents")
    odd = make_docs([(-1, None), (-2, ""), (-3, "a b c d e " * 9), (-4, "x\x1cy\x85z\n\n x\nx\n "),
                     (-5, "a " * 30000), (None, "q"), (None, "q"), (-6, "a b c d e f a b c d e")])
    both = docs.select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang"))
    texts = {r["doc_id"]: r["text"] or "" for r in both.collect()}
    out = quality.judge(both).collect()
    assert len(out) == len(texts) + 1
    for r in out:
        want = brute(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.STATS) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_verdict_follows_the_quality_labels(spark):
    docs = read_table(spark, "/root/testdata/sf0.1", "documents")
    labels = read_table(spark, "/root/testdata/sf0.1", "labels")
    rows = quality.judge(docs).where("not base_failed").join(labels, "doc_id").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) >= 0.995 and np.mean(bad) <= 0.1


def test_empty_table(spark, make_docs):
    assert quality.judge(make_docs([(1, "x")]).limit(0)).count() == 0
