"""Generic relational building blocks used by the domain operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


# Largest side (bytes of its rows as text) that a join may broadcast after its size was checked.
BROADCAST_MAX_BYTES = 32 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows of ``df`` written as text: one aggregate, nothing kept."""
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    return df.agg(F.sum(F.octet_length(row))).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only after its measured size proved it small.

    Spark's own broadcast choice rests on estimates, and at runtime AQE will
    not broadcast a side whose shuffle partitions are mostly empty, which is
    what a tiny key table looks like.  Here the side's bytes are summed first
    (wide rows such as polygons count by their width) and it is hinted only
    under ``max_bytes``; beyond that the join is left to the planner
    (sort-merge / shuffled hash).  Nothing is cached.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def key_semi_join(df: DataFrame, keys: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Keep rows of ``df`` whose key tuple occurs in ``keys``.

    ``on`` pairs a column of ``df`` with a column of ``keys``.  The key set is
    made distinct first and a NULL key never matches, which is what a
    ``CONCAT(k1, ' | ', k2 ...) IN (SELECT DISTINCT CONCAT(...))`` filter does
    (CONCAT is NULL when any part is NULL), without the string building.

    A small key set is broadcast; where ``df`` is partitioned by one of the keys,
    the broadcast also prunes partitions.  A larger one is joined on one hash of
    the whole tuple (the parts are compared beside it), so that Spark's runtime
    filter can build one Bloom filter of the tuples and apply it to ``df`` before
    the shuffle.  Both kinds of runtime filter are only made from a side with a
    selective predicate, hence the comparison on the first text key; it holds for
    every value that is not NULL.
    """
    k = keys.select(*[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(on)])
    texts = [f"__k{i}" for i, (_, r) in enumerate(on) if isinstance(keys.schema[r].dataType, StringType)]
    if texts:
        k = k.where(F.col(texts[0]) >= "")
    pairs = [(df[left], f"__k{i}") for i, (left, _) in enumerate(on)]
    if measured_bytes(k.distinct()) <= BROADCAST_MAX_BYTES:
        k = F.broadcast(k.distinct())
        cond = reduce(and_, [c == k[name] for c, name in pairs])
    else:
        cond = F.xxhash64(*[c for c, _ in pairs]) == F.xxhash64(*[k[name] for _, name in pairs])
        for c, name in pairs:
            cond = cond & F.coalesce(c == k[name], F.lit(False))
    return df.join(k, cond, "left_semi")


def key_flag(df: DataFrame, keys: DataFrame, on: Sequence[tuple[str, str]], flag: str) -> DataFrame:
    """Add boolean ``flag``: does the row's key tuple occur in ``keys``? (NULL key -> False)."""
    k = broadcast_if_small(keys.select(*[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(on)]).distinct()
                           .withColumn(flag, F.lit(True)))
    cond = None
    for i, (left, _) in enumerate(on):
        c = df[left] == k[f"__k{i}"]
        cond = c if cond is None else cond & c
    out = df.join(k, cond, "left").drop(*[f"__k{i}" for i in range(len(on))])
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


# Partitions over which rows with a NULL join key are spread.
NULL_KEY_BUCKETS = 256


def left_join_spread_null_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
                               spread_by: Sequence[str] = ()) -> DataFrame:
    """``left LEFT JOIN right ON left.a = right.b AND ...`` for big inputs with possibly-NULL keys.

    A row with a NULL key never matches, but a shuffled join still sends all
    such rows to one reducer (they hash alike): one hot partition when, say,
    a third of the ids are missing.  Each such row gets a salt in
    1..NULL_KEY_BUCKETS (a hash of the join keys and the ``spread_by``
    columns, so task retries place it the same way) and every other row salt
    0; the salt is one more join key.  On the right it is 0 for every row, as
    an expression over the keys: a literal would let the optimizer turn the
    equality into a filter on the left and leave the salt out of the shuffle.
    NULL-key rows spread over that many partitions and still match nothing;
    the result equals the plain left join, in one plan.
    """
    has_null = None
    for lk, _ in pairs:
        c = left[lk].isNull()
        has_null = c if has_null is None else has_null | c
    spread = [left[c] for c in dict.fromkeys([*(lk for lk, _ in pairs), *spread_by])]
    salt = F.when(has_null, F.pmod(F.xxhash64(*spread), F.lit(NULL_KEY_BUCKETS)) + 1).otherwise(F.lit(0)).cast("bigint")
    lft = left.withColumn("__null_salt", salt)
    rgt = right.withColumn("__null_salt_r", F.pmod(F.xxhash64(*[right[rk] for _, rk in pairs]), F.lit(1)).cast("bigint"))
    # The salt comes last: both sides are sorted by the keys in this order, and a first key of one value decides nothing.
    on = reduce(and_, [lft[lk] == rgt[rk] for lk, rk in pairs]) & (lft["__null_salt"] == rgt["__null_salt_r"])
    return lft.join(rgt, on, "left").drop("__null_salt", "__null_salt_r")


def left_join_on_leading_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
                              residual: Sequence[tuple[str, str]], spread_by: Sequence[str] = ()) -> DataFrame:
    """As :func:`left_join_spread_null_keys`, for a ``right`` that already lies by the columns of ``pairs``.

    Only those are join keys, as they are on the right, so that it needs no
    shuffle; ``residual`` pairs are compared beside them.  ``pairs`` starts with a
    whole number: where any key is NULL it becomes a number out of
    NULL_KEY_BUCKETS, other NULL keys of ``pairs`` an empty text, and the
    comparison of the real keys beside the join keys keeps such rows unmatched.
    """
    every = [*pairs, *residual]
    has_null = reduce(or_, [left[lk].isNull() for lk, _ in every])
    spread = [left[c] for c in dict.fromkeys([*(lk for lk, _ in every), *spread_by])]
    salt = F.pmod(F.xxhash64(*spread), F.lit(NULL_KEY_BUCKETS))
    (first, first_right), *others = pairs
    lft = left.withColumn("__spread_key", F.when(has_null, -1 - salt).otherwise(left[first]).cast(left.schema[first].dataType))
    on = lft["__spread_key"] == right[first_right]
    for i, (lk, rk) in enumerate(others):
        lft = lft.withColumn(f"__spread_key{i}", F.coalesce(lft[lk], F.lit("")))
        on = on & (lft[f"__spread_key{i}"] == right[rk])
    # A comparison with NULL is no match; the coalesce keeps it out of the join keys.
    on = reduce(and_, [F.coalesce(lft[lk] == right[rk], F.lit(False)) for lk, rk in every], on)
    return lft.join(right, on, "left").drop("__spread_key", *[f"__spread_key{i}" for i in range(len(others))])


def first_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row that sorts first on ``order`` (ascending, NULLs first).

    Written as an aggregate of ``min(struct(order..., rest...))`` rather than a
    ``row_number`` window: the aggregate combines map-side, so a hot key does
    not pull all its rows into one sort.  The remaining columns break ties,
    which makes the choice deterministic.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in list(order) + rest])).alias("__first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in list(order) + rest]).select(*df.columns)


def ordered_concat(c, sep: str = ", ", distinct: bool = False) -> Column:
    """``ARRAY_TO_STRING(ARRAY_AGG(x ORDER BY x), sep)`` as an aggregate (NULLs skipped)."""
    col = F.col(c) if isinstance(c, str) else c
    arr = F.collect_set(col) if distinct else F.collect_list(col)
    return F.array_join(F.array_sort(arr), sep)
