import numpy as np

from folio.llm import ann
from folio.session import read_table

SF = "/root/testdata/sf0.01"


def exact(ids, x, own, query, k=5):
    score = (x * query).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((query ** 2).sum()))
    rows = np.flatnonzero(ids != own)
    best = rows[np.lexsort((ids[rows], -score[rows]))][:k]
    return [(int(ids[j]), score[j]) for j in best]


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 200)
    monkeypatch.setattr(ann, "QUERIES", 4)
    table = read_table(spark, SF, "embeddings")
    rows = table.select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows])
    got = {}
    for r in ann.search(spark, table, lambda i: i % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        want = exact(ids, x, q, x[ids == q][0])
        own = sorted(got[q])
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(a[2] >= b[2] for a, b in zip(own, own[1:]))
        hits += len({v for v, _ in want} & {v for _, v, _ in own})
        total += 5
        for _, v, s in own:
            assert abs(s - (x[ids == v][0] @ x[ids == q][0]) / np.linalg.norm(x[ids == v][0])
                       / np.linalg.norm(x[ids == q][0])) < 1e-12
    assert hits >= 0.9 * total


def test_odd_vectors_copies_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (7, [0.0, 0.0, 0.0]), (8, None), (9, [nan, 1.0, 1.0]), (10, []),
            (11, [1.0, None, 1.0]), (12, [inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
            (13, [1.0, 1.0]), (50, [2.0, 0.0, 0.0]), (50, [2.0, 0.0, 0.0])]
    rows += [(100 + i, [3.0, 0.0, 0.0]) for i in range(300)] + [(51, [0.0, 1.0, 0.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows],
                                  "vec_id long, embedding array<float>, label int")
    out = ann.search(spark, table, lambda i: i % 50 == 0)
    got = {}
    for r in out.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert [v for _, v in sorted(got[0])] == [50, 50, 100, 101, 102]
    assert [v for _, v in sorted(got[100])] == [0, 50, 50, 101, 102]
    assert [v for _, v in sorted(got[50])] == [0, 100, 101, 102, 103]
    few = ann.search(spark, table.where("vec_id in (0, 51)"), lambda i: i % 50 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 51)]
    assert ann.search(spark, table.limit(0), lambda i: i % 50 == 0).count() == 0
