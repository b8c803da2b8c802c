"""op11 against Lloyd's rounds in Python integers."""

import hashlib

import numpy as np
import pytest

from abspark.llm import heap_kmeans as hk

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, clusters=40, rounds=5, seed=2):
    """(vec_id, cluster, distance) and centroids, by the definition."""
    kept = [(i, [int(np.floor(256 * float(v))) for v in e]) for i, e in rows if e is not None and len(e) == 64 and all(v is not None and np.isfinite(v) for v in e)]
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    c = [v for _, v in order[:clusters]]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, m, strict=True)) for m in c]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        groups = {}
        for (_, n, _), (_, v) in zip(assign(), kept, strict=True):
            groups.setdefault(n, []).append(v)
        for n, vs in groups.items():
            c[n] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return assign(), c


def table(seed, n=260, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, 64)) / 8
    x = (centres[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, 64))).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(n * 3)[:n], x, strict=True)]
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1])]  # repeated rows, one id with two vectors
    rows += [(-5, [0.0] * 64), (-6, [-0.001] * 64), (None, rows[3][1])]
    return rows


def bad():
    nan, inf = float("nan"), float("inf")
    return [(9001, None), (9002, []), (9003, [1.0] * 63), (9004, [1.0] * 65), (9005, [nan] + [1.0] * 63), (9006, [inf] * 64), (9007, [None] + [1.0] * 63)]


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA)


def digest(v):
    return hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()


@pytest.mark.parametrize("block,seed", [(1024, 1), (16, 2)])
def test_query_matches_plain_rounds(spark, monkeypatch, block, seed):
    monkeypatch.setattr(hk, "BLOCK", block)
    rows = table(seed)
    want, centroids = plain(rows)
    total = sum(d for *_, d in want)
    per = {}
    for _, c, d in want:
        per[c] = per.get(c, 0) + d
    full = [(-1 if i is None else i, c, d, per[c], total, digest(centroids[c])) for i, c, d in want]
    got = hk.op11_heap_kmeans(frame(spark, rows + bad())).fillna(-1, ["vec_id"])
    assert sorted(tuple(r) for r in got.collect()) == sorted(full)


def test_few_equal_and_no_vectors(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(9)]
    want, _ = plain(rows)
    assert sorted(tuple(r)[:3] for r in hk.op11_heap_kmeans(frame(spark, rows)).collect()) == sorted(want)
    empty = hk.op11_heap_kmeans(frame(spark, bad()))
    assert empty.collect() == [] and empty.columns[:3] == ["vec_id", "cluster", "distance"]
    one = hk.op11_heap_kmeans(frame(spark, [(7, [0.5] * 64)])).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in one] == [(7, 0, 0)]


def test_large_components_stay_exact_and_larger_ones_raise(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(64) * 40_000).astype(np.float32).tolist()) for i in range(60)]
    want, _ = plain(rows)
    assert sorted(tuple(r)[:3] for r in hk.op11_heap_kmeans(frame(spark, rows)).collect()) == sorted(want)
    with pytest.raises(Exception, match="would not fit a long"):
        hk.op11_heap_kmeans(frame(spark, [(1, [1e6] * 64)])).collect()


def test_later_rounds_scan_only_expired_vectors(spark):
    """Tight groups: once they are found, hardly any gap expires; the result is still exact."""
    rows = table(9, n=1500, spread=0.004)
    got = hk.cluster(frame(spark, rows), clusters=12, rounds=6)
    want, centroids = plain(rows, clusters=12, rounds=6)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in got.vectors.collect()) == sorted((-1 if i is None else i, c, d) for i, c, d in want)
    assert got.centroids.tolist() == centroids
    assert got.scanned[0] == len(rows) and got.scanned[-1] < len(rows) / 4


def test_heap_rows_survive_storage():
    rng = np.random.default_rng(0)
    x = rng.integers(-50, 50, (200, 64))
    block, c = hk.Block(x, 8), hk.Centroids(x[:8].copy(), np.zeros(8))
    assert block.advance(c) == 200
    again = hk.Block.of(block.row(), 64)
    assert again.heaps == block.heaps and (again.cluster == block.cluster).all()
    sums = {i: (int(n), s.tolist()) for i, (n, s) in enumerate(zip(block.counts, block.sums, strict=True)) if n}
    c = c.moved(sums)
    assert again.advance(c) == block.advance(c)
    assert (again.cluster == c.distances(x).argmin(axis=1)).all()
    assert (again.sums == np.array([x[again.cluster == i].sum(axis=0) for i in range(8)])).all()
