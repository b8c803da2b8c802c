"""op12 against a trie of Python tuples."""

import hashlib
import random
import zlib

import pytest

from abspark.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    below = {node: [0, 0] for node in members}
    inner = {node[:-1] for node in members if node}
    for node, m in members.items():
        leaf, saved = node not in inner, (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            below[node[:d]][0] += leaf
            below[node[:d]][1] += saved
    children = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), children.get(n, 0), *below[n], hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
        for n, m in members.items()
    )


def same(spark, rows, schema=SCHEMA, **how):
    got = pt.prefix_trie(spark.createDataFrame(rows, schema), **how).fillna(-1, ["parent_conv_id"])
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == plain(rows)


def talk(seed, convs=80, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(300), convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, ("user", "assistant")[t % 2], rng.choice(("yes", "no", "é漢", "why?", "")) if rng.random() < 0.8 else f"t{rng.random()}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("band,span", [(16, 4096), (2, 4), (3, 6)])
def test_matches_plain_trie(spark, band, span):
    same(spark, talk(band), band=band, span=span)


def test_hot_conversation_and_hot_ends(spark, monkeypatch):
    """One conversation with most turns, many partitions, one node at which very many end."""
    monkeypatch.setattr(pt, "RUN", 3)
    monkeypatch.setattr(pt, "BATCH_ROWS", 50)
    rows = talk(5, convs=30) + [(1000, t, "user", f"turn {t}") for t in range(700)]
    rows += [(c, 0, "user", "the same") for c in range(2000, 2400)]
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same(spark, rows, band=4, span=8)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [
        (0, None, "user", "a", 1, "x"), (0, None, None, "a", 2, "y"), (0, 0, "user", None, 3, None), (0, 0, "user", None, 3, None),
        (0, 1, "b", "tie", 0, ""), (0, 1, "a", "tie", 0, ""), (0, 1, "a", "Tie", 0, ""), (None, 1, "user", "lost", 0, ""),
        (1, 5, "user", "own", 0, ""), (4, -1, "", "", 0, ""), (-3, 0, "user", "neg", 0, ""), (-5, 0, "user", "neg base", 0, ""),
        (7, 0, "ab", "c", 0, ""), (8, 0, "a", "bc", 0, ""), (9, 2, "user", "long " * 60_000, 0, ""),
    ]
    same(spark, rows, SCHEMA + ", depth long, k1 string")


def test_empty_table(spark):
    assert pt.op12_prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
