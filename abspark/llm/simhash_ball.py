"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at most 2h bits apart have a common point within h
bits of each.  So every distinct fingerprint emits the ball of radius h around
it, the variants are shuffled, and fingerprints that meet on a variant are
linked (they are within 2h by the triangle inequality; the bit distance is
verified all the same).

What is shuffled is the variant's leading bits, the fingerprint and the radius
left for the other bits; the task that owns those leading bits expands the
rest of the ball.  That is the same set of variants (2,081 a fingerprint for
h = 2) with 30 to 100 rows a fingerprint in the shuffle in place of 2,081.  A
leading-bit group that would hold more than ``GROUP_VARIANTS`` variants (a
dense cluster of fingerprints) is split by further bits, again and again until
it fits, so no task holds more than that.

Inside a group only links to one member of each meeting are made, reduced to
one link a member, never all pairs; the components follow from these links.

Defined cases: null, empty and white-space-only texts have fingerprint zero
and link like any other; a text of fewer words than a shingle is one shingle;
repeated rows have equal results; null doc_ids never become a component id
unless a component has no other; an empty table gives an empty result; other
columns are carried untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abspark.llm.common import bounded_batches, fold_text, new_folder, staged, word_blocks
from abspark.llm.components import components

WORDS = 4
MAX_BITS = 4
SEED = 42
GROUP_VARIANTS = 1 << 22


def _bit_sums(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _hashes(words: list[bytes], k: int) -> list[int]:
    """XXH64 of every run of ``k`` words: each is a slice of the space-joined words."""
    joined, at, starts, ends = b" ".join(words), 0, [], []
    for w in words:
        starts.append(at)
        at += len(w)
        ends.append(at)
        at += 1
    h = xxhash.xxh64_intdigest
    return [h(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :], strict=False)]


def fingerprint(data: bytes, k: int = WORDS) -> int:
    """SimHash over the ``k``-word shingles of ``data`` (repeats count); zero without words."""
    sums, n, carry = np.zeros(64, np.int64), 0, []
    for words in word_blocks(data):
        run = carry + words
        if len(run) >= k:
            hashes = _hashes(run, k)
            sums += _bit_sums(hashes)
            n += len(hashes)
            run = run[len(run) - k + 1 :]
        carry = run
    if not n:
        if not carry:
            return 0
        sums, n = _bit_sums([xxhash.xxh64_intdigest(b" ".join(carry), SEED)]), 1
    return int(np.packbits(2 * sums > n, bitorder="little").view("<u8")[0])


def fingerprints(words: int = WORDS):
    """Column function: signed 64-bit fingerprint of a text column."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(fold_text(t), words) for t in texts], np.uint64)
        return pd.Series(found.view(np.int64))

    return of


def _masks(bits: int, radius: int) -> list[int]:
    out, layer = [0], [(0, -1)]
    for _ in range(radius):
        layer = [(m | (1 << i), i) for m, last in layer for i in range(last + 1, bits)]
        out += [m for m, _ in layer]
    return out


def _ball_size(bits: int, radius: int) -> int:
    return sum(math.comb(bits, r) for r in range(radius + 1))


def _route(rows: DataFrame, done: int, step: int, radius: int) -> DataFrame:
    """Lengthen the variant prefix of ``rows`` (prefix, fp, r) from ``done`` by ``step`` bits."""
    own = F.shiftrightunsigned("fp", 64 - done - step).bitwiseAND((1 << step) - 1)
    choice = F.array(*[F.lit(m).cast("long") for m in _masks(step, 0)])
    for r in range(1, radius + 1):
        choice = F.when(F.col("r") >= r, F.array(*[F.lit(m).cast("long") for m in _masks(step, r)])).otherwise(choice)
    out = rows.select("fp", "r", (F.shiftleft("prefix", step) if done else F.lit(0).cast("long")).alias("p"), own.alias("own"), F.explode(choice).alias("mask"))
    return out.select(F.col("p").bitwiseOR(F.col("own").bitwiseXOR(F.col("mask"))).alias("prefix"), "fp", (F.col("r") - F.bit_count("mask")).cast("int").alias("r"))


def _meet(fps: np.ndarray, left: np.ndarray, bits: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, member) among distinct ``fps`` whose balls, over the last ``bits`` bits, share a variant."""
    low = fps & np.uint64((1 << bits) - 1) if bits < 64 else fps
    keys, owners = [], []
    for r in np.unique(left):
        own = np.flatnonzero(left == r)
        masks = np.array(_masks(bits, int(r)), np.uint64)
        keys.append((low[own, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(own, len(masks)).astype(np.int32))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    ordered = np.sort(key)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    none = np.zeros(0, np.int64)
    if not len(shared):
        return none, none
    del ordered
    at = np.minimum(np.searchsorted(shared, key), len(shared) - 1)
    hit = shared[at] == key
    at, owner = at[hit], owner[hit]
    first = np.full(len(shared), len(fps), np.int64)
    np.minimum.at(first, at, owner)
    a, b = first[at], owner.astype(np.int64)
    pair = np.unique(a[a != b] * len(fps) + b[a != b])
    a, b = pair // len(fps), pair % len(fps)
    near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    a, b = a[near], b[near]
    label = np.arange(len(fps))
    while True:  # minimum label along the links: members end on their smallest
        low_label = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low_label)
        np.minimum.at(label, b, low_label)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(len(fps)))
    return label[member], member


def ball_links(fps: DataFrame, max_bits: int = MAX_BITS, group_variants: int = GROUP_VARIANTS) -> DataFrame:
    """(a, b) links that join all fingerprints of distinct column ``fp`` at most ``max_bits`` (even) bits apart."""
    spark, radius = fps.sparkSession, max_bits // 2
    n = max(1, fps.count())
    done = min(24, max(4, math.ceil(math.log2(n * _ball_size(64, radius) / (group_variants / 4)))))
    rows = _route(fps.select(F.lit(0).cast("long").alias("prefix"), "fp", F.lit(radius).alias("r")), 0, done, radius)
    ready = None
    while True:
        rest = 64 - done
        parts = []
        size = F.coalesce(*[F.when(F.col("r") == r, F.lit(_ball_size(rest, r))) for r in range(radius + 1)])
        hot = rows.groupBy("prefix").agg(F.sum(size).alias("n")).filter(F.col("n") > group_variants)
        hot = staged(hot.select("prefix"), "simhash-hot")
        split = rest > 8 and not hot.isEmpty()
        fit = rows.join(hot, "prefix", "left_anti") if split else rows
        part = _linked(fit, rest, max_bits)
        parts = part if ready is None else ready.unionAll(part)
        ready = parts
        if not split:
            return ready
        rows = staged(_route(rows.join(hot, "prefix", "left_semi"), done, 8, radius), "simhash-split")
        done += 8


def _linked(rows: DataFrame, rest: int, max_bits: int) -> DataFrame:
    def meet(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy(np.int64).view(np.uint64)
        root, member = _meet(fps, group["r"].to_numpy(), rest, max_bits)
        return pd.DataFrame({"a": fps[member].view(np.int64), "b": fps[root].view(np.int64)})

    return rows.groupBy("prefix").applyInPandas(meet, "a long, b long")


def simhash_groups(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, marks: tuple[Column, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows (doc_id, marks, fp) of every document; groups (fp, component_id, root) of every distinct fingerprint."""
    if max_bits % 2 or max_bits < 0:
        raise ValueError("max_bits is twice the ball radius")
    bounded_batches(docs.sparkSession)
    folder = new_folder(docs.sparkSession, "simhash")
    rows = staged(docs.select("doc_id", *marks, fingerprints(words)("text").alias("fp")), "rows", folder)
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct", folder)
    roots = components(ball_links(distinct.select("fp"), max_bits).distinct())
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, staged(grouped.join(least, "root").select("fp", "component_id", "root"), "groups", folder)


def simhash_dedup(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row: the component's smallest doc_id."""
    rows, groups = simhash_groups(docs, words, max_bits)
    groups = groups.select(F.col("fp").alias("f"), "component_id")
    return rows.join(groups, F.col("fp") == F.col("f")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_simhash_ball(docs: DataFrame) -> DataFrame:
    return simhash_dedup(docs.select("doc_id", "text"))


def simhash_keep(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id (of repeated ids, the smallest text)."""
    # Fingerprints are the dear part: each is made once, and rows are found again by their id and a 128-bit hash of the text.
    def hashes(text: Column) -> tuple[Column, Column]:
        text = F.coalesce(text, F.lit(""))
        return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text, F.lit(2)).alias("h2")

    rows, groups = simhash_groups(docs.select("doc_id", "text"), words, max_bits, hashes(F.col("text")))
    groups = groups.select(F.col("fp").alias("f"), "component_id", "root")
    first = rows.join(groups, F.col("fp") == F.col("f")).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "h1", "h2", "root").distinct()
    every = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    every = every.select("row", *hashes(F.col("row.text"))).withColumnsRenamed({"h1": "r1", "h2": "r2"})
    kept = every.join(first, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("r1") == F.col("h1")) & (F.col("r2") == F.col("h2")))
    one = kept.groupBy("root").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return one.select("row.*")
