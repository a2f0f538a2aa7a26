import random

import pytest

from folio.llm import jaccard_join as J
from folio.session import read_table


def brute(texts):
    """Links of each text, and the classes as sets of positions."""
    sets = []
    for t in texts:
        words = (t or "").split()
        k = min(5, len(words))
        sets.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    top = list(range(len(texts)))
    links = [0] * len(texts)

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    by_token = {}
    for i, s in enumerate(sets):
        for x in s:
            by_token.setdefault(x, []).append(i)
    for a, s in enumerate(sets):
        for b in sorted({j for x in s for j in by_token[x] if j > a}):
            both = len(s & sets[b])
            if both >= 0.8 * (len(s) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                top[find(a)] = find(b)
    classes = {}
    for i in range(len(texts)):
        classes.setdefault(find(i), set()).add(i)
    return links, set(map(frozenset, classes.values()))


def held(spark, docs, texts):
    got = {r["doc_id"]: r for r in J.join(spark, docs).collect()}
    links, classes = brute(texts)
    assert [got[i]["links"] for i in range(len(texts))] == links
    mine = {}
    for i in range(len(texts)):
        mine.setdefault(got[i]["class_id"], set()).add(i)
    assert set(map(frozenset, mine.values())) == classes
    assert all(min(c) == k for k, c in mine.items())


def test_links_and_classes_of_the_documents(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    texts = [r["text"] for r in docs.orderBy("doc_id").select("text").collect()]
    held(spark, docs, texts)


def test_groups_larger_than_a_block_split_and_count(spark, make_docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "BLOCK_BYTES", 4000)
    rng = random.Random(3)

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    body, passage = words(120), words(60)
    texts = [" ".join(body[:i % 100] + words(1) + body[i % 100:]) for i in range(40)]  # near
    texts += [" ".join(words(40) + passage + words(40)) for _ in range(40)]  # share a passage
    texts += [" ".join(body)] * 12 + [None, "", "   ", "one two", "one two", "one two three"]
    held(spark, make_docs(list(enumerate(texts))), texts)


def test_one_of_each_keeps_the_least(spark, make_docs):
    a, b = "the same words in a row here and there", "quite another text of words it is"
    docs = make_docs([(5, a), (3, a), (3, a), (None, b), (None, b), (8, None), (8, None), (9, ""),
                      (4, b + " x y")])
    out = J.one_of_each(spark, docs)
    assert out.columns == docs.columns
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"]) for r in out.collect()
                 if r["text"])
    assert got == [(-1, b), (3, a), (4, b + " x y")]
    assert J.one_of_each(spark, docs.limit(0)).count() == 0


@pytest.mark.parametrize("recall", [0.5, 0.9, 0.9999])
def test_runs_grow_with_the_recall(recall):
    q = 0.2031878699799799
    assert q ** J.runs_for(recall) <= 1 - recall + 1e-12
