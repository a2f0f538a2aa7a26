import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from folio.llm import prefix_trie

SCHEMA = ("conv_id long, turn long, role string, text string, idx int, node string, prior int, "
          "level int, words long, w int, rep long")


def nodes(spark, rows, **opts):
    df = spark.createDataFrame([(*r, 1, None, 2, 3, None, 5, 6) for r in rows], SCHEMA)
    return sorted(map(tuple, prefix_trie.report(spark, df, **opts).collect()), key=str)


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
        for d in range(len(built) + 1):
            members.setdefault(tuple(built[:d]), []).append((c, d == len(built)))
    out = {}
    for path in sorted(members, key=len, reverse=True):
        m = members[path]
        kids = [p for p in members if p[:-1] == path and len(p) == len(path) + 1]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved = (len(m) - 1) * words + sum(out[k][6] for k in kids)
        leaves = sum(out[k][5] for k in kids) if kids else 1
        ends = ",".join(str(c) for c in sorted(c for c, last in m if last))
        out[path] = (min(m)[0], len(path), min(members[path[:-1]])[0] if path else None, len(m),
                     len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def talk(seed, convs, longest, texts):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), rng.choice(texts))
            for c in convs for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("width", [1, 3, 8])
def test_equals_brute_force_over_several_blocks(spark, width):
    rows = talk(1, range(0, 70), 6, ["a", "a b  c", "", "d\te"])
    # Long conversations that share long openings, and copies of one of them.
    trunk = [(t, "user", f"turn {t}") for t in range(25)]
    for c, cut in ((100, 25), (101, 20), (102, 11), (103, 25), (104, 25), (121, 25), (122, 25)):
        rows += [(c, *t) for t in trunk[:cut]] + [(c, cut, "bot", f"own {c if c != 104 else 103}")]
    assert nodes(spark, rows, width=width) == brute(rows)


def test_nulls_negative_ids_absent_sources_and_repeated_rows(spark):
    rows = [(7, None, None, None), (7, 1, "user", None), (7, 1, "user", None), (8, 0, "user", ""),
            (None, 0, "user", "lost"), (-3, 0, None, "x y"), (-23, 1, "a", "b"), (41, 0, "u", "v"),
            (0, 0, "user", ""), (5, 2, "é😀", "word " * 5000), (5, 1, "", " \t\n")]
    rows += [(i, 0, "user", "short") for i in range(200, 260)]
    assert nodes(spark, rows, width=2) == brute(rows)
    assert nodes(spark, []) == []


def test_numbers_carry_across_partitions(spark):
    rows = [(1, t, "u", f"w {t}") for t in range(200)] + [(c, 0, "u", "one two") for c in range(
        2, 40)] + [(40, t, "u", "a b c") for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie.numbered(spark, df).groupBy("conv").agg(
            F.max("idx"), F.count_distinct("idx"), F.max("cum")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", conf)
    want = {c: (1, 1, 2) for c in range(2, 40)} | {1: (200, 200, 400), 40: (300, 300, 900)}
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_carried_over_spans_partitions_of_one_conversation():
    def p(pid, first, conv, idx, cum):
        return pid, first, {"conv": conv, "idx": idx, "cum": cum}

    parts = [p(0, 1, 5, 10, 20), p(1, 5, 5, 7, 9), p(2, 5, 5, 1, 1), p(4, 5, 6, 2, 3), p(5, 7, 7, 1, 1)]
    assert prefix_trie.carried_over(parts) == [(1, 5, 10, 20), (2, 5, 17, 29), (4, 5, 18, 30)]


def test_ids_of_a_large_group_are_hashed_in_numeric_order(spark):
    rows = [(c, 0, "u", "same") for c in range(3, 3000, 1) if c % 20 and zlib.crc32(
        str(c).encode()) % 4 == 0]
    got = [r for r in nodes(spark, rows) if r[1] == 1]
    want = hashlib.sha256(",".join(str(r[0]) for r in rows).encode()).hexdigest()
    assert len(got) == 1 and got[0][7] == want and got[0][3] == len(rows)
