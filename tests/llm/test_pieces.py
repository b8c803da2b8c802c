"""op1 and op2: segmentations against enumeration, lossless decoding, held-out accuracy."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from abspark.llm import language_id as lid
from abspark.llm.lattice import Lattice
from abspark.llm.sentencepiece_ffbs import Sampler, decode, encode, op1_sentencepiece_ffbs

from .conftest import prose


@pytest.fixture(scope="module")
def lattice():
    return Lattice()


def segmentations(lattice, word):
    pieces = {t: i for i, t in enumerate(lattice.text) if t and i not in set(lattice.byte.tolist())}

    def rest(x):
        if not x:
            yield ()
        for k in range(1, len(x) + 1):
            if x[:k] in pieces:
                for tail in rest(x[k:]):
                    yield (pieces[x[:k]], *tail)

    return list(rest(word.encode()))


@pytest.mark.parametrize("word", [" there", "xy", " ", "   a"])
def test_forward_sums_all_segmentations(lattice, word):
    logp, byte = lattice.rank_weights(1.0)
    brute = math.fsum(math.exp(sum(logp[i] for i in s)) for s in segmentations(lattice, word))
    e = lattice.edges(["other", word])
    logw = lattice.log_weights(e.piece, logp, byte)[:, None]
    assert e.forward(logw)[e.nodes[2] - 1, 0] == pytest.approx(math.log(brute), abs=1e-9)
    assert e.backward(logw)[e.nodes[1], 0] == pytest.approx(math.log(brute), abs=1e-9)


def test_samples_follow_the_exact_distribution():
    s, n = Sampler(), 20_000
    ids, begin, _ = s.encode(pa.array(["there"] * n), np.arange(n).astype(np.uint64), 3)
    seen = Counter(tuple(ids[begin[i] : begin[i + 1]].tolist()) for i in range(n))
    all_ = segmentations(s.lattice, " there")
    weight = np.array([math.exp(sum(s.logp[i] for i in x)) for x in all_])
    assert set(seen) <= set(all_)
    assert max(abs(seen[x] / n - w) for x, w in zip(all_, weight / weight.sum(), strict=True)) < 0.015


def test_memo_limit_does_not_change_samples():
    texts = pa.array([prose(i, 40) for i in range(30)])
    keys = np.arange(30).astype(np.uint64)
    whole, few = Sampler(), Sampler(memo=7)
    a, b = whole.encode(texts, keys, 5), few.encode(texts, keys, 5)
    c = few.encode(texts.slice(10, 1), keys[10:11], 5)  # another batch, a warm memo
    assert a[0].tolist() == b[0].tolist()
    assert c[0].tolist() == a[0][a[1][10] : a[1][11]].tolist()


def test_round_trip_of_odd_texts(odd_docs, no_docs):
    got = {(r.doc_id, r.text) for r in decode(encode(odd_docs)).select("doc_id", "text").collect()}
    assert got == {(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()}
    assert decode(encode(no_docs)).count() == 0
    out = op1_sentencepiece_ffbs(odd_docs).join(odd_docs.select("doc_id", "text"), "doc_id")
    assert out.filter(F.sha2(F.coalesce("text", F.lit("")), 256) != F.col("decoded_sha256")).count() == 0
    assert out.filter("text is null").select("ids", "n_pieces").first() == (None, 0)


def test_partitioning_does_not_change_samples(odd_docs):
    a = {(r.doc_id, tuple(r.ids or ())) for r in encode(odd_docs.repartition(5)).collect()}
    assert a == {(r.doc_id, tuple(r.ids or ())) for r in encode(odd_docs.coalesce(1)).collect()}


def test_marginal_score_is_the_sum_over_segmentations(spark, lattice):
    docs = spark.createDataFrame([(i, prose(i, 30, lang), lang) for i, lang in enumerate(["en", "de"] * 10)], "doc_id long, text string, lang string")
    model = lid.train(docs)
    scorer = lid._Scorer(model)
    got = scorer.texts(pa.array(["there"]))[0]
    for k in range(2):
        brute = math.log(math.fsum(math.exp(sum(model.logp[i, k] for i in s)) for s in segmentations(lattice, " there")))
        assert got[k] == pytest.approx(brute, abs=1e-9)
    assert np.exp(model.logp).sum(axis=0) == pytest.approx(1.0)


def test_expected_counts_match_enumeration(spark, lattice):
    got = lid._Expected(lattice, 1, 1.0)
    got.add(lid._cut(pa.array(["there there"])), np.array([0]))
    got.flush()
    logp, _ = lattice.rank_weights(1.0)
    all_ = segmentations(lattice, " there")
    weight = np.array([math.exp(sum(logp[i] for i in s)) for s in all_])
    want = np.zeros(lattice.size)
    for s, w in zip(all_, 2 * weight / weight.sum(), strict=True):
        np.add.at(want, list(s), w)
    assert got.sums[0] == pytest.approx(want, abs=1e-9)


def test_held_out_accuracy_and_contract_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = lid.op2_marginal_unigrams(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    test = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in test) >= 0.95 * len(test)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts_have_defined_languages(odd_docs, no_docs):
    rows = lid.op2_marginal_unigrams(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in range(5))
    assert by[9].lang_pred == "en"
    assert lid.op2_marginal_unigrams(no_docs).count() == 0
    assert lid.known_language(odd_docs).columns == odd_docs.columns


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert lid.op2_marginal_unigrams(docs).first().lang_pred == "und"


def test_bounds_do_not_depend_on_other_words():
    words = [" " + w for w in dict.fromkeys(prose(11, 400).split() + ["ab" * 200, "漢字", "x"])]
    together = Sampler()
    together._add(words)
    for i in (0, 1, 7, len(words) // 2, len(words) - 3, len(words) - 1):
        alone = Sampler()
        alone._add([words[i]])
        begin = 0 if i == 0 else int(together.edge_of[together.last[i - 1] + 1])
        stop = int(together.edge_of[together.last[i] + 1])
        for a, b in ((alone.upto, together.upto), (alone.size, together.size), (alone.piece, together.piece)):
            assert np.array_equal(a, b[begin:stop])
