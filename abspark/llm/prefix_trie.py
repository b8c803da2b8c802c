"""A trie of conversation prefixes whose subtree totals roll up by depth bands.

Every distinct sequence of first turns is a node.  A sequence is known by the XOR
of 2 x 64-bit hashes of its (place, role, text) turns: a prefix sum that is taken
in blocks, so a conversation of any length is spread over tasks.

Totals over subtrees (leaves, saved tokens) take no round per level.  The depths
are cut into bands of ``BAND``; a conversation's path through a band is one row of
at most ``BAND`` nodes.  Each node gives what it holds to its ancestors within its
band only (summed along the path before the shuffle).  The roots of the bands,
with what their bands hold, are a trie of a ``BAND``-th of the depth, rolled up in
the same way; then each finished root's total goes to its ancestors in the band
above.  So a trie of depth D takes about log(D) / log(BAND) rounds, and no node is
ever copied more than ``BAND`` times a round.

Hot groups: the turns of one conversation are sorted over range partitions and
numbered with an offset per partition; a node's members are counted with partial
sums; the conversations that end at one node are joined to runs of ``RUN`` ids in
the partitions of a range sort, and the runs go through one digest in order, so no
task holds them all.  The join of nodes to their parents is an equi-join of
staged rows, which Spark splits where one parent has very many children; the root's
children are not joined at all.

Defined cases: null role or text is the empty one; turns of one number come in the
order of role, then text; repeated rows are turns of their own; rows without
conv_id take no part; conversations are grouped by five with the remainder taken
towards minus infinity; an empty table has no node, not even a root; long texts
are hashed, never collected; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from abspark.llm.common import bounded_batches, new_folder, staged

BAND = 16
SPAN = 4096  # depths of one block of the prefix sum; whole bands
RUN = 4096  # ids of one run
GROUP = 5
MOST_SHARED = 8  # the largest number of turns taken over, crc32 % 9 at most
BATCH_ROWS = 10_000
_SHARP = 64  # characters of a text that the range partitions look at

NODE = ["depth", "k1", "k2"]


def ordered_turns(conversations: DataFrame, folder: str) -> DataFrame:
    """(conv_id, place from 1, t1, t2, bytes): every turn with its place in its conversation, staged."""
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The partitions look at the first characters only: the driver samples their bounds.
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, _SHARP), F.substring("text", 1, _SHARP))
    in_order = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    hashed = in_order.select(
        "conv_id", F.spark_partition_id().alias("part"), F.xxhash64("role", "text").alias("t1"),
        F.xxhash64(F.lit(7), "text", F.lit(11), "role").alias("t2"), F.octet_length("text").cast("long").alias("bytes"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            first = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
            place = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv)))) + 1
            if conv[0] == last:
                place[: first[1] if len(first) > 1 else len(conv)] += seen
            last, seen = conv[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])

    turns = staged(hashed.mapInArrow(number, "conv_id long, part int, t1 long, t2 long, bytes long, place long"), "turns", folder)
    # A conversation in more than one partition: at most one of them begins in each, so the offsets are no more than partitions.
    ends = turns.groupBy("conv_id", "part").agg(F.max("place").alias("n"))
    by_part = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("conv_id", "part", F.sum("n").over(by_part).alias("before")).filter("before is not null")
    joined = turns.join(F.broadcast(staged(offsets, "offsets", folder)), ["conv_id", "part"], "left")
    return joined.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "t1", "t2", "bytes")


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes over."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_SHARED + 1)


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, t1, t2, bytes, length) of the rebuilt conversations, with one row of depth 0 for each."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    c = F.col("conv_id")
    convs = sizes.select("conv_id", "n", (c - F.pmod(c, F.lit(GROUP))).alias("base"), shared_turns(c).alias("h"))
    convs = convs.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    own = turns.join(convs, "conv_id").filter("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "t1", "t2", "bytes", "length")
    first = turns.filter(F.col("place") <= MOST_SHARED).withColumnRenamed("conv_id", "base")
    taken = first.join(convs, "base").filter("place <= h").select("conv_id", F.col("place").alias("depth"), "t1", "t2", "bytes", "length")
    none = F.lit(0).cast("long")
    roots = convs.select("conv_id", none.alias("depth"), none.alias("t1"), none.alias("t2"), none.alias("bytes"), "length")
    return own.unionByName(taken).unionByName(roots)


def paths(rebuilt: DataFrame, band: int = BAND, span: int = SPAN) -> DataFrame:
    """(conv_id, band, path): each conversation's nodes of one band in order, with their parents' keys."""
    lane = lambda *c: F.when(F.col("depth") > 0, F.xxhash64(*c)).otherwise(0)
    rows = rebuilt.select("*", lane("depth", "t1", "t2").alias("x1"), lane("t2", "depth", "t1").alias("x2"), F.expr(f"depth div {span}").alias("span"))
    whole = rows.groupBy("conv_id", "span").agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"))
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select("conv_id", "span", F.bit_xor("y1").over(earlier).alias("b1"), F.bit_xor("y2").over(earlier).alias("b2")).filter("b1 is not null")
    upto = Window.partitionBy("conv_id", "span").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(before, ["conv_id", "span"], "left")
    for i in ("1", "2"):
        summed = summed.withColumn(f"k{i}", F.bit_xor(f"x{i}").over(upto).bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))))
    node = F.struct("depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "bytes", (F.col("depth") == F.col("length")).alias("ends"))
    return summed.withColumn("band", F.expr(f"depth div {band}")).groupBy("conv_id", "span", "band").agg(F.sort_array(F.collect_list(node)).alias("path")).drop("span")


def rolled_up(nodes: DataFrame, lists: DataFrame, values: list[str], deepest: int, folder: str, band: int = BAND) -> DataFrame:
    """Sums of ``values`` over every node's subtree: (depth, k1, k2, values).

    ``nodes`` has (depth, k1, k2, conv_id, values) with conv_id the smallest
    member; ``lists`` (conv_id, band, path) as of :func:`paths`.
    """
    level = f"band-{deepest}"
    lists = staged(lists.select("conv_id", "band", F.transform("path", lambda p: F.struct(p["depth"].alias("depth"), p["k1"].alias("k1"), p["k2"].alias("k2"))).alias("path")), f"{level}-paths", folder)

    def to_ancestors(given: DataFrame) -> DataFrame:
        """Every row's values to the path of its conversation through its band, down to its own depth."""
        held = given.groupBy("conv_id", "band").agg(F.collect_list(F.struct("depth", *values)).alias("held"))  # one a depth: at most `band`
        met = held.join(lists, ["conv_id", "band"])

        def below(p: Column, v: str) -> Column:
            return F.aggregate("held", F.lit(0).cast("long"), lambda s, h: s + F.when(h["depth"] >= p["depth"], h[v]).otherwise(0))

        reached = F.filter("path", lambda p: p["depth"] <= F.array_max(F.transform("held", lambda h: h["depth"])))
        found = F.explode(F.transform(reached, lambda p: F.struct(p["depth"].alias("depth"), p["k1"].alias("k1"), p["k2"].alias("k2"), *(below(p, v).alias(v) for v in values))))
        return met.select("conv_id", found.alias("a")).select("conv_id", "a.*")

    def summed(rows: DataFrame) -> DataFrame:
        # A node's own row brings its smallest member; all others bring members.
        return rows.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *(F.sum(v).alias(v) for v in values))

    within = summed(to_ancestors(nodes.withColumn("band", F.expr(f"depth div {band}"))))
    if deepest < band:
        return within.select(*NODE, *values)
    within = staged(within, f"{level}-within", folder)
    higher = F.expr(f"depth div {band}").alias("depth")
    roots = within.filter(F.col("depth") % band == 0).select("conv_id", higher, "k1", "k2", *values)
    # The roots' own paths: the first node of every band.
    steps = lists.select("conv_id", (F.col("band")).alias("depth"), F.expr("path[0].k1").alias("k1"), F.expr("path[0].k2").alias("k2"))
    upper = steps.groupBy("conv_id", F.expr(f"depth div {band}").alias("band")).agg(F.sort_array(F.collect_list(F.struct("depth", "k1", "k2"))).alias("path"))
    totals = rolled_up(roots, upper, values, deepest // band, folder, band)
    totals = totals.join(roots.select(*NODE, "conv_id"), NODE).filter("depth > 0")
    above = to_ancestors(totals.select("conv_id", (F.col("depth") * band).alias("depth"), (F.col("depth") - 1).alias("band"), *values))
    return summed(within.select("conv_id", *NODE, *values).unionByName(above.select("conv_id", *NODE, *values))).select(*NODE, *values)


def joined_ends(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, n_ends, ends_sha256): SHA-256 of the comma-joined ascending conv_ids of each node."""
    bounded_batches(ends.sparkSession, BATCH_ROWS)
    order = [*NODE, "conv_id"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one node's ids: whatever a batch holds of it, at most RUN."""
        for batch in batches:
            key = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            if not len(key):
                continue
            cut = np.flatnonzero((key[1:, :3] != key[:-1, :3]).any(axis=1)) + 1
            cut = np.unique(np.concatenate([[0], cut, np.arange(0, len(key), RUN)]))
            ids = [",".join(map(str, part.tolist())) for part in np.split(key[:, 3], cut[1:])]
            size = np.diff(np.append(cut, len(key)))
            yield pa.RecordBatch.from_arrays([*(pa.array(key[cut, i]) for i in range(4)), pa.array(size), pa.array(ids)], names=[*order, "n", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, digest = None, 0, None
        names = [*NODE, "n_ends", "ends_sha256"]
        for batch in batches:
            out = []
            for *key, _, size, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if now is not None:
                        out.append((*now, n, digest.hexdigest()))
                    now, n, digest = key, 0, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
                n += size
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, n, digest.hexdigest())], names=names)

    dealt = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = dealt.mapInArrow(runs, "depth long, k1 long, k2 long, conv_id long, n long, ids string")
    return parts.repartition(*NODE).sortWithinPartitions(*order).mapInArrow(digests, "depth long, k1 long, k2 long, n_ends long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int = BAND, span: int = SPAN) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, n_ends, ends_sha256."""
    spark = conversations.sparkSession
    bounded_batches(spark, BATCH_ROWS)
    folder = new_folder(spark, "prefix-trie")
    turns = ordered_turns(conversations, folder)
    lists = staged(paths(rebuilt_turns(turns), band, span), "paths", folder)
    steps = lists.select("conv_id", F.explode("path").alias("p")).select("conv_id", "p.*")
    nodes = staged(steps.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("bytes").alias("bytes")), "nodes", folder)
    top = nodes.agg(F.max("depth").alias("deepest"), F.min("conv_id").alias("least")).first()
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    known = nodes.join(children, NODE, "left").select("*", F.coalesce("n_children", F.lit(0)).alias("__n")).drop("n_children").withColumnRenamed("__n", "n_children")
    known = staged(known, "known", folder)
    values = ["n_leaves", "saved_tokens"]
    own = known.select(*NODE, "conv_id", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    totals = rolled_up(own, lists, values, top.deepest or 0, folder, band)
    parents = known.filter("n_children > 0 and depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = known.join(parents, ["depth", "p1", "p2"], "left")
    ends = joined_ends(steps.filter("ends"))
    out = found.join(totals, NODE).join(ends, NODE, "left")
    return out.select(
        "conv_id", "depth",
        F.when(F.col("depth") == 1, F.lit(top.least)).otherwise(F.col("parent_conv_id")).cast("long").alias("parent_conv_id"),
        "n_convs", "n_children", *values, F.coalesce("n_ends", F.lit(0)).alias("n_ends"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_prefix_trie(conversations: DataFrame) -> DataFrame:
    return prefix_trie(conversations).drop("n_ends")
