import hashlib
import random

import numpy as np
import pytest

from folio.llm import suffix_dedup as S
from folio.llm.induced_sort import suffix_order


@pytest.mark.parametrize("base,memory", [(1 << 22, 1 << 28), (2, 64)])
def test_order_and_common_prefixes_equal_brute_force(base, memory):
    random.seed(1)
    for trial in range(150):
        n, s = random.randint(1, 60), random.choice([1, 2, 3, 8])
        text = [random.randint(1, s) for _ in range(n)] + [0]
        if trial % 5 == 0:
            text = ([1, 2, 2, 1] * 15)[:n] + [0]
        order, lcp = suffix_order(np.array(text), 1000, base, memory)
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == want
        for a, b, got in zip(want, want[1:], lcp[1:].tolist()):
            k = 0
            while text[a + k:a + k + 1] == text[b + k:b + k + 1] != []:
                k += 1
            assert got == k


def brute(texts, length=S.LENGTH):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cases():
    rng = random.Random(5)

    def prose(n):
        return "".join(rng.choice("abcdefghij klmnop é") for _ in range(n))

    passage, edge = prose(900), prose(400)
    texts = [None, "", "short", prose(399), prose(2000), prose(700) + passage + prose(500),
             prose(120) + passage + prose(80), passage, passage[1:], "x" * 401, "y" * 400,
             "ab" * 900, prose(1500) + edge + "1", edge, prose(50) + edge[:399], "é" * 300]
    whole = prose(1200)
    texts += [whole] * 5 + [whole + "!", "?" + whole[:700]]
    twice = prose(450)
    texts += [twice + "-" + twice]
    texts += [prose(rng.randint(0, 60)) + passage + prose(rng.randint(0, 60)) for _ in range(40)]
    return texts


@pytest.mark.parametrize("shard,key", [(S.SHARD, S.LARGEST_KEY), (2000, 3000)])
def test_removed_bytes_equal_brute_force(spark, make_docs, shard, key):
    texts = cases()
    docs = make_docs([(i if i else None, t) for i, t in enumerate(texts)]).repartition(4)
    got = {r["doc_id"] or 0: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in S.report(spark, docs, shard_bytes=shard, largest_key=key).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_cut_documents_keep_their_columns(spark, make_docs):
    texts = cases()[:20]
    docs = make_docs(list(enumerate(texts)) + [(3, None)])
    out = S.removed(spark, docs)
    assert out.columns == docs.columns and out.count() == 21
    by_id = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] != 3}
    assert by_id[0] is None and by_id[4] == texts[4] and by_id[7] == ""
    assert S.report(spark, docs.limit(0)).count() == 0 == S.removed(spark, docs.limit(0)).count()


def brute_words(texts, length=S.PASSAGE):
    places = [[m.span() for m in S.Words.word.finditer((t or "").encode())] for t in texts]
    words = [[(t or "").encode()[a:b] for a, b in p] for t, p in zip(texts, places)]
    seen = {}
    for w in words:
        for i in range(len(w) - length + 1):
            seen[tuple(w[i:i + length])] = seen.get(tuple(w[i:i + length]), 0) + 1
    out = []
    for t, p, w in zip(texts, places, words):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        data = (t or "").encode()
        at = p[0][0] if p else 0
        kept = data[:at]
        for i, g in enumerate(gone):
            end = p[i + 1][0] if i + 1 < len(p) else len(data)
            kept += b"" if g else data[at:end]
            at = end
        out.append((kept + data[at:]).decode() if any(gone) else t)
    return out


@pytest.mark.parametrize("shard,key", [(S.SHARD, S.LARGEST_KEY), (2000, 3000)])
def test_passages_of_words_equal_brute_force(spark, make_docs, shard, key):
    rng = random.Random(7)

    def prose(n):
        return " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
                        for _ in range(n))

    passage, edge, long = prose(51), prose(50), prose(90)
    han = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(70))
    texts = [None, "", prose(50), prose(300), f"{prose(40)} {passage} {prose(30)}",
             f"{prose(7)}\n{passage}\n{prose(80)}", f"{prose(60)} {edge} {prose(60)}",
             f"{edge} {prose(60)}", long, "  " + long.replace(" ", "\n\t") + "\n", "x" + long,
             "a b " * 90, f"{prose(30)} {han}", f"{han} {prose(30)}", "q" * 900, "q" * 900 + " r"]
    texts += [f"{prose(rng.randint(0, 9))} {long} {prose(rng.randint(0, 9))}" for _ in range(40)]
    assert len(passage.encode()) < S.LENGTH
    docs = make_docs(list(enumerate(texts))).repartition(4)
    got = {r["doc_id"]: r["text"] for r in S.removed(
        spark, docs, length=S.PASSAGE, shard_bytes=shard, largest_key=key,
        unit=S.Words).select("doc_id", "text").collect()}
    want = brute_words(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert passage not in want[4] and edge in want[6] and want[9] == "  " and han[5:60] not in want[12]


def test_words_and_anchors_of_many_texts_are_those_of_each():
    rng = random.Random(9)
    alphabet = [32, 9, 13, 14, 8, 97, 98, 0xE3, 0xE9, 0xEA, 0x80, 0xBF, 0xC3]
    for _ in range(3000):
        data = bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        words = S.Words.split(data)
        assert [*zip(words.begin.tolist(), words.end.tolist())] == [
            m.span() for m in S.Words.word.finditer(data)]
    for unit, length in ((S.Bytes, 80), (S.Words, 18)):
        texts = ["".join(rng.choice("ab é中 "[:rng.choice([2, 6])]) for _ in range(n)).encode()
                 for n in [0, 5, 17, 18, 79, 80, 81, 300, 2, 500, 0, 900] * 2]
        sizes, text, *rest = S.anchors(texts, length, unit)
        for i, t in enumerate(texts):
            n, _, *own = S.anchors([t], length, unit)
            assert sizes[i] == n[0] == len(unit.split(t))
            assert [x[text == i].tolist() for x in rest] == [x.tolist() for x in own]


@pytest.mark.parametrize("shard,key", [(S.SHARD, S.LARGEST_KEY), (2000, 3000)])
def test_report_tells_passages_of_over_fifty_words(spark, make_docs, shard, key):
    rng = random.Random(11)

    def prose(n):
        return " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
                        for _ in range(n))

    passage, edge, long, row = prose(51), prose(50), prose(160), prose(9).replace(" ", "")
    texts = [None, "", prose(200), f"{prose(40)} {passage} {prose(30)}",
             f"{prose(7)}\n{passage.replace(' ', '  ')}\n{prose(80)}",
             f"{prose(60)} {edge} {prose(60)}", f"{edge} {prose(60)}",
             f"{prose(60)} {long} {prose(9)}", f"{long} {prose(80)}", prose(70), "a b " * 90,
             f"{prose(5)} {row * 20}", f"{row * 20} {prose(60)}"]
    texts += [texts[9]] + [f"{prose(rng.randint(0, 9))} {passage} {prose(3)}" for _ in range(20)]
    assert len(passage.encode()) < S.LENGTH < len(long.encode())
    docs = make_docs(list(enumerate(texts))).repartition(4)
    got = {r["doc_id"]: r for r in S.report(spark, docs, shard_bytes=shard,
                                            largest_key=key).collect()}
    words = [(t or "").split() for t in texts]
    seen = {}
    for w in words:
        for i in range(len(w) - 50):
            seen[tuple(w[i:i + 51])] = seen.get(tuple(w[i:i + 51]), 0) + 1
    want = [len({j for i in range(len(w) - 50) if seen[tuple(w[i:i + 51])] > 1
                 for j in range(i, i + 51)}) for w in words]
    assert [got[i]["n_passage_words"] for i in range(len(texts))] == want
    assert [got[i]["has_passage"] for i in range(len(texts))] == [n > 0 for n in want]
    assert want[3:9] == [51, 51, 0, 0, 160, 160] and not got[3]["repeated"]
    assert got[7]["repeated"] and got[11]["repeated"] and not want[11]
    assert [(got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"])
            for i in range(len(texts))] == brute(texts)
