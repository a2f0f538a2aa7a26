import math

import numpy as np
import pytest

from folio.llm import topk

SCHEMA = "vec_id long, embedding array<float>, slice int, kind int, row long, score long, rank int"


def found(spark, rows, every=10, **opts):
    df = spark.createDataFrame([(i, v, None, 1, 2, None, 4) for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.search(spark, df, lambda i: i % every == 0, **opts).collect()),
                  key=str)


def brute(rows, every=10, k=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v and all(
        x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, c)), j is None, j or 0)
                        for b, (j, c) in enumerate(kept) if a != b)[:k]
        out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(scores, 1)]
    return sorted(out, key=str)


def vectors(n, dims, seed=0, spread=1.0):
    x = np.random.default_rng(seed).normal(0, spread, (n, dims)).astype(np.float32)
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_equals_brute_force_with_odd_rows_ties_and_a_common_vector(spark):
    rows = vectors(400, 20, spread=0.01)  # small integers: many ties
    rows += [(1000 + i, rows[10][1]) for i in range(200)]
    rows += [(20, rows[21][1]), (20, rows[21][1]), (None, rows[10][1])]
    rows += [(30, None), (40, []), (50, [float("nan")] + [0.0] * 19),
             (60, [float("-inf")] + [0.0] * 19), (70, [None] + [0.0] * 19)]
    assert found(spark, rows) == brute(rows)


def test_many_slices_and_numbers_beyond_doubles(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_SLICE", 16)
    rows = vectors(300, 24, seed=3)
    assert found(spark, rows, slice_bytes=20_000) == brute(rows)
    rows = [(i, [x * 6000 for x in v]) for i, v in rows]
    assert max(abs(x) for _, v in rows for x in v) > 2 ** 14
    assert found(spark, rows, slice_bytes=20_000) == brute(rows)


def test_fewer_candidates_than_k_and_empty_table(spark):
    rows = vectors(4, 3)
    assert found(spark, rows) == brute(rows) and len(found(spark, rows)) == 3
    assert found(spark, rows[:1]) == [] and found(spark, []) == []
    assert found(spark, [(0, [0.0]), (1, [0.0]), (2, [0.0])]) == brute(
        [(0, [0.0]), (1, [0.0]), (2, [0.0])])
    with pytest.raises(ValueError):
        found(spark, [(0, [1.0]), (1, [1.0, 2.0])])


def test_bounds_spare_most_of_the_work_on_vectors_with_uneven_mass():
    rng = np.random.default_rng(1)
    x = (rng.normal(0, 1, (4000, 64)) * np.repeat(2.0 ** -np.arange(8), 8) * 256).astype(np.int64)
    held = topk.Slice(np.arange(4000), np.arange(4000), x, True)
    for i in range(0, 4000, 400):
        ids, scores = held.best(x[i], i, 5)
        want = sorted((-int(x[i] @ x[j]), j) for j in range(4000) if j != i)[:5]
        assert list(zip((-scores).tolist(), ids.tolist())) == want
    assert held.compared < 0.4 * 10 * 8 * 4000
