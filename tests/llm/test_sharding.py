import math
import zlib
from collections import Counter

import numpy as np

from folio.llm import sharding


def test_matrix_has_the_given_margins_and_spreads_rows():
    counts = [0, 5, 1000, 17, 300]
    m = sharding.communication_matrix(counts, 16, 3)
    assert m.sum(axis=1).tolist() == counts
    assert m.sum(axis=0).tolist() == sharding.shard_sizes(sum(counts), 16).tolist()
    mean = np.mean([sharding.communication_matrix(counts, 16, s) for s in range(300)], axis=0)
    assert abs(mean[2] - 1000 / 16).max() < 3
    assert sharding.communication_matrix([], 16, 1).shape == (0, 16)


def test_large_populations_draw_inside_the_possible_range():
    rng = np.random.Generator(np.random.PCG64(1))
    got = [sharding._hypergeometric(rng, 10**9, 15 * 10**9, 100_000) for _ in range(50)]
    assert abs(np.mean(got) - 6250) < 60


def test_rejection_draws_the_exact_law():
    rng = np.random.Generator(np.random.PCG64(5))
    for good, bad, draws in ((30, 70, 20), (5, 9, 12), (3, 400, 150), (40, 2, 30), (1, 1, 1)):
        n = 20_000
        got = Counter(sharding.hypergeometric_by_rejection(rng, good, bad, draws) for _ in range(n))
        want = {k: math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
                for k in range(max(0, draws - bad), min(good, draws) + 1)}
        assert set(got) <= set(want)
        common = {k: p for k, p in want.items() if n * p >= 5}
        chi = sum((got[k] - n * p) ** 2 / (n * p) for k, p in common.items())
        assert chi < len(common) + 5 * (2 * len(common)) ** 0.5 + 5
    # Means and spreads of populations that the library refuses, drawn nearly whole too.
    for good, bad, draws in ((10**10, 15 * 10**10, 10**6), (10**9, 10**9, 2 * 10**9 - 10**5)):
        got = [sharding.hypergeometric_by_rejection(rng, good, bad, draws) for _ in range(400)]
        total = good + bad
        mean = draws * good / total
        sd = (mean * (bad / total) * ((total - draws) / (total - 1))) ** 0.5
        assert abs(np.mean(got) - mean) < 5 * sd / 20 and 0.8 < np.std(got) / sd < 1.2


def test_log_falling_equals_the_product():
    for n, k in ((50, 7), (50, 50), (2 * 10**6, 10**6), (10**12, 1000), (2 * 10**6, 2 * 10**6 - 5)):
        i = np.arange(k)
        want = math.fsum(np.log1p(-i / n))
        assert abs(sharding._log_falling(n, k) - want) <= 1e-9 * max(1, abs(want))


def test_shards_are_exact_and_slots_gapless(spark, make_docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 10)
    texts = [None, "", "é😀", *["copy"] * 500, *(f"text {i}" for i in range(500))]
    docs = make_docs([(i if i % 7 else None, t) for i, t in enumerate(texts)]).repartition(5)
    rows = sharding.document_rows(docs)
    out = sharding.shuffle_shards(spark, rows).collect()
    sizes = {}
    for r in out:
        sizes.setdefault(r["shard"], []).append(r["slot"])
    assert len(out) == len(texts) and len(sizes) == 16
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in out) == want
    # Copies are spread like any other rows.
    copies = [r["shard"] for r in out if r["text_crc32"] == zlib.crc32(b"copy")]
    assert min(copies.count(s) for s in range(16)) > 10


def test_whole_rows_travel_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (2, None)])
    out = sharding.shuffle_shards(spark, docs)
    assert set(docs.columns) | {"slot"} == set(out.columns) and out.count() == 3
    assert sharding.shuffle_shards(spark, docs.limit(0)).count() == 0
