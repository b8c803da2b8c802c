"""op5 and op6 against brute force, and the reversibility of the line index."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from abspark.llm import simhash_ball as sim
from abspark.llm.common import word_blocks
from abspark.llm.components import components
from abspark.llm.line_dedup import CuckooFilter, LineDedupIndex, line_key, op5_line_dedup

from .conftest import prose


def brute_lines(rows, least=10, chars=1):
    docs = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").encode().lower()
            if len(key.decode()) >= chars:
                docs[key].add(i)
    bad = {k for k, v in docs.items() if len(v) >= least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if x.strip(" \t\n\x0b\x0c\r").encode().lower() not in bad]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(5)
    common = ["Home | About", " home | about\t", "Éa", "éa", "", "x"]
    return [(i, "\n".join(rng.choice(common) if rng.random() < 0.5 else prose(rng.randint(0, 60), 4) for _ in range(rng.randint(0, 8)))) for i in range(60)]


def test_line_dedup_is_exact(spark, line_rows, odd_docs, no_docs):
    docs = spark.createDataFrame(line_rows, "doc_id long, text string")
    assert as_rows(op5_line_dedup(docs)) == brute_lines(line_rows)
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert as_rows(op5_line_dedup(odd_docs)) == brute_lines(odd)
    assert op5_line_dedup(no_docs).count() == 0


def test_keys_touch_ascii_only():
    assert line_key(" \x0bÀB\x1c ".encode()) == "Àb\x1c".encode()


@pytest.mark.parametrize("filter_bytes", [1 << 20, 0])
def test_inserting_and_deleting_documents_is_reversible(spark, line_rows, filter_bytes):
    docs = spark.createDataFrame(line_rows, "doc_id long, text string")
    some, rest = docs.filter("doc_id < 25"), docs.filter("doc_id >= 25")
    index = LineDedupIndex(spark, min_docs=4, shard_keys=4, filter_bytes=filter_bytes)
    index.insert(some)
    counts, kept = as_rows(index.counts()), as_rows(index.apply(docs).select("row.doc_id", "kept"))
    index.insert(rest)
    index.insert(rest)  # a second time changes nothing
    whole = LineDedupIndex(spark, min_docs=4)
    whole.insert(docs)
    assert as_rows(index.counts()) == as_rows(whole.counts())
    assert as_rows(index.apply(docs).select("row.doc_id", "kept")) == as_rows(whole.apply(docs).select("row.doc_id", "kept"))
    index = LineDedupIndex(spark, index.path, shard_keys=4, filter_bytes=filter_bytes, resume=True)
    index.delete(rest.select("doc_id"))
    assert as_rows(index.counts()) == counts
    assert as_rows(index.apply(docs).select("row.doc_id", "kept")) == kept


def test_cuckoo_filter_has_no_false_negatives_and_forgets():
    rng = np.random.default_rng(0)
    hi, lo = rng.integers(-(2**62), 2**62, (2, 5000))
    f = CuckooFilter.sized(5000)
    assert f.insert(hi, lo) and f.contains(hi, lo).all()
    f = CuckooFilter.load(f.dump())
    f.delete(hi[:2500], lo[:2500])
    assert f.contains(hi[2500:], lo[2500:]).all()
    assert f.contains(hi[:2500], lo[:2500]).mean() < 0.01
    assert not CuckooFilter(1).insert(hi[:9], lo[:9])


def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, bits=4):
    label = dict(enumerate(range(len(fps))))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    least = defaultdict(list)
    for i, x in enumerate(ids):
        least[root(i)].append(x)
    return [min((x for x in least[root(i)] if x is not None), default=None) for i in range(len(fps))]


def test_fingerprints_match_the_definition(odd_texts):
    for t in [*odd_texts, prose(3, 3), prose(4, 4), "a a a a a a"]:
        if t is None or len(t) < 50_000:
            assert sim.fingerprint((t or "").encode().lower()) == plain_fingerprint(t)


def test_words_of_long_texts_come_in_blocks():
    data = prose(9, 5000).encode() + b"  x"
    for size in (7, 1000):
        assert [w for b in word_blocks(data, size) for w in b] == data.split()
    assert sim.fingerprint(data) == plain_fingerprint(data.decode())


@pytest.mark.parametrize("group", [1 << 22, 3000])
def test_ball_links_join_all_near_fingerprints(spark, group):
    rng = random.Random(11)
    fps = []
    for _ in range(25):  # chains and dense balls around random centres
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 14)):
            fps.append(x)
            for b in rng.sample(range(64), rng.choice((0, 1, 2, 4, 5))):
                x ^= 1 << b
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = sim.ball_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, group)
    root = {r.node: r.root for r in components(links).collect()}
    found = [root.get(x, x) for x in signed]
    want = brute_components(signed, fps)
    assert len({*zip(found, want, strict=True)}) == len(set(found)) == len(set(want))


def test_simhash_groups_of_odd_documents(spark, odd_docs, no_docs):
    base = prose(20, 120).split()
    rows = [(100 + i, " ".join([*base[:i], "zz", *base[i + 1 :]]) if i else " ".join(base)) for i in range(12)]
    docs = odd_docs.select("doc_id", "text").filter("doc_id is null or doc_id <> 9").unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    got = docs.collect()
    fps = [plain_fingerprint(r.text) for r in got]
    want = sorted(((r.doc_id, f"{f:016x}", c) for r, f, c in zip(got, fps, brute_components([r.doc_id for r in got], fps), strict=True)), key=str)
    assert as_rows(sim.op6_simhash_ball(docs)) == want
    assert sim.op6_simhash_ball(no_docs).count() == 0
    kept = sim.simhash_keep(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({c for _, _, c in ((r.doc_id, 0, x) for r, x in zip(odd_docs.collect(), brute_components([r.doc_id for r in odd_docs.collect()], [plain_fingerprint(r.text) for r in odd_docs.collect()]), strict=True))})


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3), (2001, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}, 2000: 2000, 2001: 2000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
