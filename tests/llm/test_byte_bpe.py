"""op13 against the tiktoken library, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from abspark.llm import byte_bpe as bb


@pytest.fixture(scope="module")
def bpe():
    return bb.ByteBpe()


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def lists(bpe, texts):
    ids, count = bpe.encode(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]


def test_every_code_point_is_split_as_the_library_does(bpe, library):
    texts = []
    for base in range(0, 0x110000, 256):
        if not 0xD800 <= base < 0xE000:
            texts.append("".join(f"a{chr(c)} {chr(c)}1{chr(c)}" for c in range(base, base + 256)))
    assert lists(bpe, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("block,long,cut", [(1 << 20, 1024, 64), (7, 6, 3)])
def test_random_texts_match_the_library(bpe, library, monkeypatch, block, long, cut):
    monkeypatch.setattr(bb, "SPLIT_CHARS", block)
    monkeypatch.setattr(bb, "LONG", long)
    monkeypatch.setattr(bb, "CUT", cut)
    bpe._forget()
    rng = random.Random(block)
    parts = ["a", "b", "th", "e", " ", "  ", "\n", "\t", "'s", "'ll", "é", "漢", "😀", "1", "22", "!", "=", "\r\n", "Strasse", "the ", "\x1c", "　", "\U00018d85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    assert lists(bpe, texts) == [library.encode_ordinary(t) for t in texts]
    bpe._forget()


def test_long_pieces_match_the_library(bpe, library):
    rng = random.Random(3)
    texts = ["a" * 20_000, "ab" * 3000, "".join(rng.choice("abcdefgh") for _ in range(30_000)), "漢字" * 4000, "=" * 5000, " " * 9000, "\n" * 5000 + "x", "".join(rng.choice("etaoin") for _ in range(1000))]
    assert lists(bpe, texts) == [library.encode_ordinary(t) for t in texts]


def test_memo_is_bounded(bpe, monkeypatch):
    monkeypatch.setattr(bb, "MEMO_PIECES", 50)
    once = lists(bpe, [f"word{i} and more" for i in range(200)])
    assert not bpe.memo
    assert lists(bpe, [f"word{i} and more" for i in range(200)]) == once


def test_vocabulary_of_few_tokens(tmp_path, monkeypatch):
    """A merge may make a pair of lower rank than itself: still the leftmost of least rank, one a round."""
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"pq", b"pqab", b"qa", b"ab", b"pqaba", b"aa", b"aaa"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)))
    small = bb.ByteBpe(str(path))
    library = tiktoken.Encoding("few", pat_str=public_tokenizers.PATTERN, mergeable_ranks=small.ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["".join(rng.choice("pqab") for _ in range(rng.randint(1, 40))) for _ in range(800)]
    wanted = [library.encode_ordinary(t) for t in texts]
    assert lists(small, texts) == wanted
    monkeypatch.setattr(bb, "LONG", 4)
    small._forget()
    assert lists(small, texts) == wanted


def test_query_on_odd_rows(spark, odd_docs, no_docs, library):
    got = sorted(tuple(r) for r in bb.op13_byte_bpe(odd_docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").fillna(-1, ["doc_id"]).collect())
    want = []
    for r in odd_docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((-1 if r.doc_id is None else r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bb.op13_byte_bpe(no_docs).collect() == []


def test_decode_of_stored_ids(spark, odd_docs):
    back = bb.decode(bb.encode(odd_docs)).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((r.text or "").encode() for r in odd_docs.collect())
    null = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bb.decode(null).first().bytes is None
