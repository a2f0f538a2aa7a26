import hashlib
import math

import numpy as np
import pytest

from folio.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, row long, part int, code string, key int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, None, 3, None, None) for i, v, l in rows], SCHEMA)


def good(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], l) for i, v, l in rows
            if good(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def pick(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(pick(c[p], books[p])[1], []).append(c[p])
            for e, g in groups.items():
                books[p][e] = [sum(x) // len(g) for x in zip(*g)]
    found = [[pick(c[p], books[p]) for p in range(parts)] for c in cut]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()
                            ).hexdigest()
    out = [(k[0], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), k[2])
           for k, f in zip(kept, found)]
    label = {}
    for _, _, error, l in out:
        label[l] = label.get(l, 0) + error
    return sorted([(i, c, e, label[l], digest) for i, c, e, l in out], key=str)


def codes(spark, rows, **opts):
    return sorted(map(tuple, vector_codes.report(spark, table(spark, rows), **opts).collect()),
                  key=str)


def vectors(n, dims, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, spread, (n, dims)).astype(np.float32)
    return [(i, x[i].tolist(), int(rng.integers(0, 3)) if i % 5 else None) for i in range(n)]


def test_equals_brute_force_with_odd_rows_ties_and_a_common_vector(spark):
    rows = vectors(300, 16, spread=0.01)  # small integers: many ties
    rows += [(1000 + i, rows[7][1], 1) for i in range(150)]
    rows += [(None, rows[3][1], 2), (5, rows[5][1], 1), (5, rows[6][1], None)]
    rows += [(2, None, 1), (3, [], 1), (4, [float("nan")] + [0.0] * 15, 1),
             (6, [float("inf")] + [0.0] * 15, 0), (8, [None] + [0.0] * 15, 0)]
    assert codes(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 9, 40])
def test_fewer_vectors_than_entries_and_small_runs(spark, n, monkeypatch):
    monkeypatch.setattr(vector_codes, "RUN_BYTES", 64)
    rows = vectors(n, 8, seed=n)
    assert codes(spark, rows) == brute(rows)
    assert codes(spark, rows, parts=2, entries=3, rounds=2) == brute(rows, 2, 3, 2)


def test_many_labels_are_joined(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    rows = vectors(60, 8)
    assert codes(spark, rows) == brute(rows)


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(4)
    points = rng.integers(-40, 40, (64, 3))
    lo, hi = points.min(axis=0)[None], points.max(axis=0)[None]
    left = 0
    for _ in range(200):
        book = rng.integers(-200, 200, (16, 3))
        short = vector_codes.shortlists(lo, hi, book)[0]
        dist = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        assert short[(dist == dist.min(axis=1)[:, None]).any(axis=0)].all()
        left += 16 - short.sum()
    assert left > 1000


def test_curve_visits_each_cell_beside_the_last():
    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, side, indexing="ij"), axis=-1).reshape(-1, 3)
    walk = grid[vector_codes.curve_order(grid, bits=3)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_empty_table_and_lengths_that_do_not_fit(spark):
    assert codes(spark, []) == [] and codes(spark, [(1, None, 2)]) == []
    with pytest.raises(ValueError):
        codes(spark, [(1, [1.0] * 9, 0)])
    with pytest.raises(ValueError):
        codes(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)])
    with pytest.raises(Exception, match="not below"):
        codes(spark, [(1, [1e9] * 8, 0)])
