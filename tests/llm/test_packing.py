"""op4: ids against the tokenizer, windows against the differencing method's own definition."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from abspark.llm.kk_packing import differencing, op4_kk_packing, pack, padded_length, windows_of
from abspark.llm.word_ids import WordIds

from .conftest import prose


def plain_differencing(sizes, windows):
    """Textbook form on whole partitions of (sum, items)."""
    heap = [(i, sorted([(s, [i])] + [(0, [])] * (windows - 1), key=lambda x: -x[0])) for i, s in enumerate(sizes)]
    turn = len(sizes)
    while len(heap) > 1:
        heap.sort(key=lambda p: (-(p[1][0][0] - p[1][-1][0]), p[0]))
        (_, a), (_, b) = heap[:2]
        joined = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b), strict=True)]
        heap = [*heap[2:], (turn, sorted(joined, key=lambda x: -x[0]))]
        turn += 1
    return sorted(s for s, _ in heap[0][1])


@pytest.mark.parametrize("windows", [1, 2, 3, 7])
def test_differencing_matches_the_plain_form(windows):
    rng = np.random.default_rng(windows)
    for n in (1, 2, 5, 24):
        sizes = rng.integers(1, 100, n)
        label = differencing(sizes, windows)
        got = sorted(np.bincount(label, weights=sizes, minlength=windows).astype(int).tolist())
        assert got == plain_differencing(sizes.tolist(), windows)


def test_window_count_rises_above_the_capacity():
    sizes = np.array([60, 60, 60])  # two windows of 100 hold the sum, not the items
    assert len(set(windows_of(sizes, 100).tolist())) == 3
    assert set(windows_of(np.array([50, 50, 60, 40]), 100).tolist()) == {0, 1}


def test_ids_are_the_tokenizers(odd_texts):
    import pyarrow as pa

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [*odd_texts[:9], *odd_texts[10:], "İstanbul İ. it's DON'T. a.b, <|endoftext|>x <|ENDOFTEXT|> ́ é.", "<|EndOfText|>"]
    for memo in (100, 3):
        words = WordIds(memo=memo)
        for _ in range(2):
            ids, begin = words.encode(pa.array(texts, pa.string()))
            for i, t in enumerate(texts):
                assert ids[begin[i] : begin[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids, t


def test_slices_of_an_array_are_read_at_their_own_place():
    import pyarrow as pa

    from abspark.llm.chunks import ascii_words, lossless, spaced

    texts = [prose(i, 30, "de") + " Ü É" for i in range(40)]
    for cut in (ascii_words, lossless, spaced):
        a, b = cut(pa.array(texts).slice(13, 20)), cut(pa.array(texts[13:33]))
        assert [a.words[c] for c in a.codes] == [b.words[c] for c in b.codes]
    ids, _ = WordIds().encode(pa.array(texts).slice(13, 20))
    assert ids.tolist() == WordIds().encode(pa.array(texts[13:33]))[0].tolist()


def check(docs, pieces, capacity=4096):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for r in docs:
        ids[r.doc_id].append([*plain.encode(r.text or "", add_special_tokens=False).ids, 2])
    by, seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
        seq[p.sequence_id].append(p)
    assert set(by) == set(ids)
    for doc, own in by.items():
        if len(ids[doc]) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p.start):
                raw = np.array(ids[doc][0][p.start : p.start + p.length], "<u4").tobytes()
                assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(raw), len(ids[doc][0]))
                at += p.length
            assert at == len(ids[doc][0])
        else:
            assert sum(p.length for p in own) == sum(map(len, ids[doc]))
    lengths = []
    for own in seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= capacity
        lengths.append(at)
    return lengths


def test_every_id_is_in_one_piece(spark, odd_docs, no_docs):
    assert check(odd_docs.collect(), op4_kk_packing(odd_docs).collect())
    assert op4_kk_packing(no_docs).count() == 0
    docs = spark.createDataFrame([(i, prose(i, 5 + 37 * i % 400)) for i in range(120)], "doc_id long, text string").repartition(3)
    check(docs.collect(), pack(docs, capacity=64, windows=16).collect(), 64)


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lengths = check(docs.collect(), op4_kk_packing(docs).collect())
    assert sum(padded_length(n) - n for n in lengths) < 0.01 * sum(lengths)


def test_powers_of_two_are_not_padded():
    assert [padded_length(n) for n in (1, 2, 3, 1024, 4095, 4096)] == [1, 2, 4096, 1024, 4096, 4096]
