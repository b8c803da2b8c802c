"""op3 and op8 against brute force."""

import numpy as np
import pytest

from abspark.llm import nn_descent as nn
from abspark.llm.common import staged
from abspark.llm.permutation_index import PermutationIndex, op8_permutation_index

SCHEMA = "vec_id long, embedding array<float>, label int"


def bad_rows():
    nan, inf = float("nan"), float("inf")
    return [(900, None, 0), (901, [], 0), (902, [0.0] * 8, 0), (903, [nan] + [1.0] * 7, 0), (904, [None] + [1.0] * 7, 0), (905, [inf] * 8, 0), (None, [1.0] * 8, 0), (906, [1.0, 2.0], 0)]


def clusters(seed, dim=8):
    """Copies, tight groups, chains of links and lone vectors."""
    rng = np.random.default_rng(seed)
    rows = []
    for size, noise in ((40, 0.0), (60, 0.01), (50, 0.12), (2, 0.02), (3, 0.1)):
        c = rng.standard_normal(dim)
        for _ in range(size):
            rows.append(c * (1 if noise else 2) + noise * rng.standard_normal(dim))
    a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
    rows += [np.cos(t) * a + np.sin(t) * b for t in np.arange(0, 2.0, 0.2)]  # each linked to its neighbours only
    rows += list(rng.standard_normal((60, dim)))
    x = np.array(rows, np.float32)
    ids = rng.permutation(len(x)).astype(int)
    return ids, x


def brute(ids, x, threshold=0.95):
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    label = ids.copy()
    while True:
        new = np.array([min([label[i], *label[near[i]].tolist()]) for i in range(len(ids))])
        if (new == label).all():
            return near.sum(1), label
        label = new


@pytest.mark.parametrize("block", [512, 16])
def test_links_and_components_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nn, "BLOCK", block)
    ids, x = clusters(4)
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)] + bad_rows()
    rows += [rows[0]]  # a repeated row is the same vector
    got = {r.vec_id: r for r in nn.op3_nn_descent(spark.createDataFrame(rows, SCHEMA)).collect()}
    links, label = brute(ids, x)
    assert len(got) == len(ids) + len(bad_rows())
    assert [got[i].n_links for i in ids.tolist()] == links.tolist()
    assert [got[i].component_id for i in ids.tolist()] == label.tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    for i in (900, 901, 902, 903, 904, 905, 906, None):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_audited_recall(spark):
    ids, x = clusters(7)
    _, recall = nn.near_duplicates(spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], SCHEMA))
    assert recall >= nn.RECALL


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nn.op3_nn_descent(empty).count() == 0
    assert op8_permutation_index(empty).count() == 0


def check_search(ids, x, rows, k, wanted):
    hits = total = 0
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(wanted)
    for q, own in by.items():
        at = np.flatnonzero(ids == q)[0]
        score = (x.astype(float) * x[at].astype(float)).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)).tolist() if ids[i] != q][:k]
        own.sort(key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(order) + 1))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        exact = dict(zip(ids.tolist(), score.tolist(), strict=True))
        assert all(r.score == pytest.approx(exact[r.vec_id], abs=1e-12) for r in own)
        hits += len({r.vec_id for r in own} & {int(ids[i]) for i in order})
        total += len(order)
    return hits / total


@pytest.mark.parametrize("block", [8192, 50])
def test_search_recall_ties_and_order(spark, block):
    ids, x = clusters(9)
    x *= np.random.default_rng(1).uniform(0.2, 5, (len(x), 1)).astype(np.float32)  # norms differ: inner products, not cosines
    x[:40] = x[0]  # ties
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)] + bad_rows()[:6]
    index = PermutationIndex(spark.createDataFrame([*rows, rows[3]], SCHEMA), block=block)
    from pyspark.sql import functions as F

    queries = F.col("vec_id") % 20 == 0
    assert index.fit(queries) >= 0.95
    assert check_search(ids, x, index.search(queries).collect(), 20, [i for i in ids.tolist() if i % 20 == 0]) >= 0.95


def test_few_candidates_and_mixed_dimensions(spark):
    rows = [(20, [1.0, 0.0], 0), (1, [1.0, 1.0], 0), (2, [-1.0, 0.5], 0), (40, [1.0, 2.0, 3.0], 0), (3, [1.0, 0.0, 0.0], 0)]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in op8_permutation_index(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got) == [(20, 1, 1, 1.0), (20, 2, 2, -1.0), (40, 1, 3, 1.0)]


def test_given_table_recall(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = d.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32)
    assert check_search(ids, x, op8_permutation_index(d).collect(), 20, [i for i in ids.tolist() if i % 20 == 0]) >= 0.9


def bridged(groups=6, size=60, dim=32, seed=0):
    """Pairs of tight groups of distinct vectors (cosine about 0.99 inside), linked at about 0.96, the pairs far apart."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
        turn = np.arccos(0.962)
        for c in (a, np.cos(turn) * a + np.sin(turn) * b):
            rows += list(c + 0.1 / np.sqrt(dim) * rng.standard_normal((size, dim)))
    x = np.array(rows, np.float32)
    return rng.permutation(len(x)).astype(int), x


def test_full_lists_lose_no_link_between_groups(spark, tmp_path):
    """Own members fill all lists; links met between two groups still reach the components."""
    ids, x = bridged()
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)]
    classes = staged(nn.packed(spark.createDataFrame(rows, SCHEMA)).selectExpr("vec_id as rep", "dim", "vec", "1L as m"), "classes")
    graph = nn.NeighbourGraph(classes, "<f4", nn.THRESHOLD, str(tmp_path))
    # Every list is full of its own group; all links between groups come after.
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    cos, group = u @ u.T, np.arange(len(x)) // 60
    i, j = np.nonzero((group[:, None] == group) & ~np.eye(len(x), dtype=bool))
    pairs = lambda i, j: spark.createDataFrame(list(zip(ids[i].tolist(), ids[j].tolist(), cos[i, j].tolist(), strict=True)), "u long, v long, cos double")
    for _ in range(3):
        graph.merge(pairs(i, j))
    i, j = np.nonzero((group[:, None] != group) & (cos >= nn.THRESHOLD))
    assert len(i) and cos[i, j].max() < 0.985
    graph.start = lambda restart: pairs(i, j)
    graph.refine(0)
    found = {r.node: r.root for r in graph.components().collect()}
    assert [found[k] for k in ids.tolist()] == brute(ids, x)[1].tolist()


def test_audit_sees_missed_pairs_beside_a_hot_group(spark, tmp_path, monkeypatch):
    """A group that holds most links does not hide that every isolated pair was missed; what is missed gets joined."""
    rng = np.random.default_rng(5)
    hot = rng.standard_normal(32) + 0.02 * rng.standard_normal((300, 32))
    one = rng.standard_normal((40, 32))
    x = np.concatenate([hot, one, one + 0.02 * rng.standard_normal(one.shape)]).astype(np.float32)
    ids = rng.permutation(len(x)).astype(int)
    data = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], SCHEMA)
    classes = staged(nn.packed(data).selectExpr("vec_id as rep", "dim", "vec", "1L as m"), "classes")
    graph = nn.NeighbourGraph(classes, "<f4", nn.THRESHOLD, str(tmp_path))
    low = int(ids[:300].min())
    roots = spark.createDataFrame([(int(i), low) for i in ids[:300]], "node long, root long")
    recall, _ = graph.audit(roots)
    assert recall < 0.1
    # A search that finds nothing at all ends in the comparison of all classes.
    monkeypatch.setattr(nn, "CHUNK", 64)
    monkeypatch.setattr(nn.NeighbourGraph, "refine", lambda self, restart: None)
    monkeypatch.setattr(nn.NeighbourGraph, "components", lambda self: roots.limit(0))
    got, recall = nn.near_duplicates(data)
    links, label = brute(ids, x)
    rows = {r.vec_id: r for r in got.collect()}
    assert [(rows[i].n_links, rows[i].component_id) for i in ids.tolist()] == list(zip(links.tolist(), label.tolist(), strict=True))
    assert recall == 1.0
