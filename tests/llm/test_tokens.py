"""Packing and byte-level BPE against the libraries."""
import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from folio.llm import bpe, packing

TEXTS = ["Hello world, it's   fine.\n\n ok", None, "", "日本語 text \x1c\x85 ñandú 😀", "a" * 3000,
         "word " * 4000, "same", "same", "  x　y  ", "<|endoftext|> 12345 ##"]


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def test_pieces_hold_every_id_once_in_full_windows(spark, make_docs, exact):
    docs = make_docs([(i if i != 3 else None, t) for i, t in enumerate(TEXTS)]).repartition(3)
    got = packing.pack(spark, docs, P.path("byte_bpe_50k.json"), with_ids=True).cache()
    pieces = got.collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    for i, text in enumerate(TEXTS):
        own = sorted(by_doc[i if i != 3 else None], key=lambda p: p["start"])
        ids = np.concatenate([np.frombuffer(p["ids"], dtype="<u4") for p in own]).tolist()
        assert ids == exact(text)
        assert all(p["doc_tokens"] == len(ids) for p in own)
        assert [p["start"] for p in own] == np.cumsum([0, *(p["length"] for p in own)])[:-1].tolist()
        assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] for p in own)
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"], bytes(p["ids"])))
    total = sum(p["length"] for p in pieces)
    assert sorted(windows) == list(range(-(-total // packing.WINDOW)))
    for s, own in windows.items():
        at = 0
        for offset, length, _ in sorted(own):
            assert offset == at
            at += length
        assert at == packing.WINDOW or s == max(windows)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(got).collect()}
    assert set(whole) == set(windows)
    for s, ids in whole.items():
        joined = b"".join(x for _, _, x in sorted(windows[s]))
        assert len(ids) == 4 * packing.WINDOW and ids.startswith(joined)


def test_round_trip_equals_the_rank_library(spark, make_docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = make_docs(list(enumerate(TEXTS)) + [(None, "x")])
    for r in bpe.round_trip(docs, path, P.PATTERN).collect():
        text = "x" if r["doc_id"] is None else TEXTS[r["doc_id"]] or ""
        ids = np.array(library.encode_ordinary(text), dtype="<u4")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_cuts_at_spaces_and_pieces_change_no_id(monkeypatch):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = np.random.Generator(np.random.PCG64(3))
    parts = [" ", " ", "\n", "\t", "\u3000", "\x85", "it's", "Ab", "12345", "#!", "é", "日本", "x" * 300]
    texts = ["", " ", " a", "a ", "  ", " \n", "\n "] + [
        "".join(draw.choice(parts, size=draw.integers(1, 14))) for _ in range(1500)]
    # None of these has a space beside other white space: they are cut at spaces alone.
    texts += [" ".join(draw.choice(["a\nb", "it's\n\nso", "é", "12345\t#"], size=9))
              for _ in range(50)]
    monkeypatch.setattr(bpe, "PIECE_BYTES", 7)
    number = bpe.numbering()
    codes = [bpe.numbered(number, t) for t in texts]
    assert 300 < sum(bool(bpe.MIXED.search(t)) for t in texts) < len(texts) - 300
    table, of, at, n = bpe.Encoder(path, P.PATTERN).chunks(
        [" " + c if isinstance(c, str) else c[0] for c in number])
    for text, c in zip(texts, codes):
        pieces = list(table.of(of[bpe.ragged(at[c], n[c])]))
        ids = np.frombuffer(b"".join(p for p, _ in pieces), dtype="<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert b"".join(p for _, p in pieces).decode() == text


def test_empty_tables(spark, make_docs):
    none = make_docs([(1, "x")]).limit(0)
    assert packing.pack(spark, none, P.path("byte_bpe_50k.json")).count() == 0
    assert bpe.round_trip(none, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0
