"""op10: base score against a plain count, the tree against a plain tree, proper probabilities."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from abspark.llm import suffix_tree_lm as lm
from abspark.llm.chunks import ascii_words

from .conftest import prose


def words_of(text):
    return [*(text or "").encode().lower().split(), None]


def test_symbols_and_grams():
    stream, begins, tokens = lm.symbols(ascii_words(pa.array(["Ab c", "", None, "\tx\x0b"])))
    assert bytes(stream) == b"ab c \n\n\nx \n"
    assert begins.tolist() == [0, 6, 7, 8, 11] and tokens.tolist() == [0, 3, 5, 6, 7, 8, 10, 11]
    got = lm.grams(stream, begins)
    assert [int(x) for x in got[:3]] == [0x0A << 48 | 0x61, 0x610A << 40 | 0x62, 0x62610A << 32 | 0x20] and int(got[8]) == 0x0A << 48 | 0x78
    stream, begins, _ = lm.symbols(ascii_words(pa.array([], pa.string())))
    assert len(stream) == 0 and len(lm.grams(stream, begins)) == 0


def plain_tree(texts, depth, least, gain):
    """Contexts as byte strings, by the definition."""
    count = defaultdict(Counter)
    for t in texts:
        s = b"\n" + b"".join(w + b" " for w in words_of(t)[:-1]) + b"\n"
        for i in range(1, len(s)):
            for k in range(0, min(depth, i) + 1):
                count[s[i - k : i]][s[i]] += 1
    kept = set()
    for ctx, c in count.items():
        n, up = sum(c.values()), count[ctx[1:]]
        if ctx and n >= least:
            m = sum(up.values())
            if sum(x * math.log((x / n) / (up[b] / m)) for b, x in c.items()) >= gain:
                kept.add(ctx)
    root = np.ones(256)
    for b, x in count[b""].items():
        root[b] += x
    root /= root.sum()

    def p(ctx, b):
        while ctx and ctx not in kept:
            ctx = ctx[1:]
        if not ctx:
            return root[b]
        c, d = count[ctx], len(count[ctx])
        return (c[b] + d * p(ctx[1:], b)) / (sum(c.values()) + d)

    return kept, p


@pytest.fixture(scope="module")
def texts():
    return [prose(i % 37, 40 + i) for i in range(60)] + ["", None, "the the the end"]


def tree_of(spark, texts, folder, least=16, room=None):
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    return lm.grown(spark, lm.staged(lm.corpus_counts(docs), "parts", str(folder)), str(folder), least, 8.0, room)


def test_packed_blocks():
    rng = np.random.default_rng(1)
    for size, most in ((1, 2), (5000, 2**56), (300, 300)):
        key = np.unique(rng.integers(0, most, size, dtype=np.uint64))
        n = rng.integers(1, 70_000, len(key))
        a, b = lm.unpacked(lm.packed(key, n))
        assert (a == key).all() and (b == n).all()


@pytest.mark.parametrize("merge", [2_000_000, 500])
def test_tree_matches_the_plain_tree(spark, texts, tmp_path, monkeypatch, merge):
    monkeypatch.setattr(lm, "_MERGE", merge)  # small: partial counts leave a task early
    tree, rest = tree_of(spark, texts, tmp_path)
    kept, p = plain_tree(texts, lm.DEPTH, 16, 8.0)
    assert rest is None and tree.contexts == len(kept)
    assert max(map(len, kept)) == lm.DEPTH
    stream, begins, _ = lm.symbols(ascii_words(pa.array(["there sted qqq", prose(5, 30)])))
    got = tree.score(lm.grams(stream, begins))
    raw = bytes(stream)
    want = []
    for i in range(len(raw)):
        own = b"\n" + raw[max(b for b in begins.tolist() if b <= i) : i]
        want.append(math.log10(p(own[-lm.DEPTH :], raw[i])))
    assert got == pytest.approx(want, abs=1e-5)


def test_next_symbols_sum_to_one(spark, texts, tmp_path):
    tree, _ = tree_of(spark, texts, tmp_path)
    for context in (b"\n", b"\nth", b" th er", b"zzz"):  # in reading order; the nearest byte goes first
        own = int.from_bytes(context[::-1].ljust(lm.DEPTH, b"\0"), "big")
        grams = np.array([own << 8 | s for s in range(256)], np.uint64)
        assert (10.0 ** tree.score(grams)).sum() == pytest.approx(1.0, abs=1e-4)


def test_tokens_have_probabilities(spark, texts, tmp_path):
    """All words of up to two bytes, and the end: together at most one.  Spelling tells unseen words apart."""
    tree, _ = tree_of(spark, texts, tmp_path)

    def of(words):
        stream, begins, tokens = lm.symbols(ascii_words(pa.array(words)))
        total = np.concatenate([[0.0], np.cumsum(tree.score(lm.grams(stream, begins)))])
        return total[tokens[1:-1:2]] - total[tokens[:-1:2]]  # the first token of each text

    letters = [chr(c) for c in range(33, 127) if not chr(c).isupper()]
    total = (10.0 ** of(letters + [a + b for a in letters for b in letters])).sum()
    total += 10.0 ** tree.score(lm.grams(*lm.symbols(ascii_words(pa.array([""])))[:2]))[0]
    assert 0.01 < total <= 1.0 + 1e-6
    likely, odd, long = of(["thering", "qxzqjxk", "qxzqjxk" * 30])
    assert likely > odd > long


@pytest.mark.parametrize("frequent", [1 << 18, 20, 0])
def test_base_score_is_exact(spark, odd_docs, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    docs = odd_docs.select("doc_id", "text").unionAll(spark.createDataFrame([(200 + i, prose(i, 30)) for i in range(40)], "doc_id long, text string"))
    rows = docs.collect()
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count = Counter(w for r in rows if not fold(r.doc_id) for w in words_of(r.text))
    n, v = sum(count.values()), len(count)
    want = sorted(((r.doc_id, fold(r.doc_id), len(words_of(r.text)), sum(w in count for w in words_of(r.text)), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words_of(r.text)), 5)) for r in rows), key=str)
    got = lm.op10_suffix_tree(docs).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=str) == want
    assert all(r.score < 0 for r in got)


def test_held_out_texts_score_better_than_the_base(spark):
    """On 25 MB; on much less the base's unseen words, one price for all of them together, beat any spelling."""
    rows = lm.op10_suffix_tree(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8)).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_no_documents(no_docs, spark):
    assert lm.op10_suffix_tree(no_docs).count() == 0
    docs = spark.createDataFrame([("a",), ("b",)], "text string").selectExpr("cast(2 as long) doc_id", "text")
    got = lm.score(docs, docs.limit(0)).first()
    assert (got.n_known, got.train_tokens, got.base_score) == (0, 0, 0.0)


def test_rest_of_the_tree_is_joined(spark, texts, monkeypatch):
    """A small broadcast part and the join give the scores of the whole tree."""
    monkeypatch.setattr(lm, "MIN_COUNT", 16)
    monkeypatch.setattr(lm.grown, "__defaults__", (16, 8.0, None))
    monkeypatch.setattr(lm, "BUCKET_GRAMS", 500)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    by = lambda: {r.doc_id: (r.n_known, pytest.approx(r.base_score, abs=1e-6), pytest.approx(r.score, abs=1e-3)) for r in lm.op10_suffix_tree(docs).collect()}
    whole = by()
    for room, bits in ((400, 1 << 26), (0, 1 << 26), (0, 64)):  # so few bits that all grams are looked up
        monkeypatch.setattr(lm, "TREE_ROOM", room)
        monkeypatch.setattr(lm, "MAP_BITS", bits)
        got = {r.doc_id: (r.n_known, r.base_score, r.score) for r in lm.op10_suffix_tree(docs).collect()}
        assert got == whole


def test_retention_does_not_rise_with_the_corpus():
    """A context seen 300 times stays a context beside 50 million other symbols."""
    pair = np.array([ord("b") << 8 | ord("a"), ord("q") << 8 | ord("x")], np.uint64)
    n = np.array([50_000_000, 300])
    up = lm.Level(np.array([ord("a"), ord("x")], np.uint64), n, n / n.sum())
    _, (keys, _, _) = lm.retained(1, pair, n, up, lm.MIN_COUNT, lm.MIN_GAIN)
    assert lm._CONTEXT | 1 << 56 | ord("q") in keys.tolist()
