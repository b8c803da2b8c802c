"""Approximate nearest neighbours by a permutation index.

Every vector is represented by its ``PREFIX`` nearest pivots in order.  Pivots
are a bounded sample of the rows (``PIVOTS`` of them, the documented fit); every
row is indexed.  The rows are dealt into blocks of about ``BLOCK`` by a hash of
their id; a block's inverted files list, for each pivot, the vectors that have
it in their prefix and its position there.  A query walks the files of its own
prefix, sums up the footrule (a pivot missing in a vector counts as the last
position), takes the candidates of smallest footrule in each block, and reranks
them by the exact inner product in double precision.

The candidate share is fitted: starting from ``SHARE``, it is doubled until an
audit of at most ``AUDIT`` queries against brute force over every row reaches a
recall of ``RECALL``.

Largest inner product is turned into smallest angle by one more component,
sqrt(M^2 - |x|^2) with M the largest norm, so pivots rank vectors of unequal
norms rightly.

Defined cases: null, empty and zero vectors and those with a null or
non-finite component take no part, nor do rows without an id; vectors of
different dimensions are never compared; rows that repeat id and vector count
once, a query never meets rows of its own id; ties in the footrule and in the
score go to the smaller vec_id; a query with fewer candidates than ``k`` gets
all; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from abspark.llm.common import staged
from abspark.llm.vectors import matrix, packed, width

PIVOTS = 512
PREFIX = 64
BLOCK = 8192
QUERY_BLOCK = 4096
SHARE = 0.1
RECALL = 0.95
AUDIT = 128
K = 20
SEED = 8


class Pivots:
    """Pivots by dimension: sampled rows, filled up with random directions where the sample has too few."""

    def __init__(self, sample: list[tuple[int, bytes]], kind: str, largest: float, count: int = PIVOTS):
        self.sample, self.kind, self.largest, self.count = sample, kind, largest, count
        self.made: dict[int, np.ndarray] = {}

    def _lifted(self, x: np.ndarray) -> np.ndarray:
        scaled = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1, keepdims=True)))
        return np.concatenate([scaled, rest], axis=1)

    def of(self, dim: int) -> np.ndarray:
        if dim not in self.made:
            x = self._lifted(matrix([v for d, v in self.sample if d == dim] or [], self.kind)) if any(d == dim for d, _ in self.sample) else np.zeros((0, dim + 1))
            fill = np.random.default_rng([SEED, dim]).standard_normal((self.count - len(x), dim + 1))
            x = np.concatenate([x, fill])
            self.made[dim] = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        return self.made[dim]

    def prefixes(self, x: np.ndarray, queries: bool, length: int = PREFIX) -> np.ndarray:
        """The nearest pivots of each row, nearest first, ties to the smaller pivot number."""
        p = self.of(x.shape[1])
        lifted = np.concatenate([x, np.zeros((len(x), 1))], axis=1) if queries else self._lifted(x)
        return np.argsort(-(lifted @ p.T), axis=1, kind="stable")[:, : min(length, len(p))].astype(np.int32)


def footrule_gain(prefix: np.ndarray, queries: np.ndarray, pivots: int):
    """For each query, every row's sum of (length - position difference) over shared pivots: the larger, the smaller the footrule."""
    n, length = prefix.shape
    order = np.argsort(prefix.ravel(), kind="stable")  # the inverted files: by pivot, then by row
    row, position = (order // length).astype(np.int32), (order % length).astype(np.int32)
    start = np.searchsorted(prefix.ravel()[order], np.arange(pivots + 1))
    for q in queries:
        gain = np.zeros(n, np.int64)
        for at, pivot in enumerate(q.tolist()):
            a, b = start[pivot], start[pivot + 1]
            gain[row[a:b]] += length - np.abs(position[a:b] - at)
        yield gain


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (x * q).sum(axis=1)  # row by row alike, so that equal vectors have equal scores


def search_block(ids, x, query_ids, q, pivots: Pivots, share: float, k: int) -> pd.DataFrame:
    """The ``k`` best of a block for every query; rows sorted by id."""
    n = len(ids)
    take = min(n, max(2 * k, int(np.ceil(share * n))))
    out = []
    prefix, wanted = pivots.prefixes(x, False), pivots.prefixes(q, True)
    for query, vector, gain in zip(query_ids, q, footrule_gain(prefix, wanted, len(pivots.of(x.shape[1]))), strict=True):
        key = gain * n + np.arange(n - 1, -1, -1)  # ties: the smaller id
        at = np.argpartition(-key, take - 1)[:take] if take < n else np.arange(n)
        at = at[ids[at] != query]
        score = _scores(x[at], vector)
        best = _best(ids[at], score, k)
        out.append(pd.DataFrame({"query_id": query, "vec_id": ids[at][best], "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _tiles(rows: DataFrame, own: str, others: int, blocks: int, name: str) -> DataFrame:
    block = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(blocks)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
    return rows.select(*[F.col(c).alias(c) for c in ("vec_id", "dim", "vec")], block.alias(own), copies.alias(name))


class PermutationIndex:
    """Fitted pivots and the vector table; ``search`` answers a query set in blocks."""

    def __init__(self, vectors: DataFrame, block: int = BLOCK, share: float = SHARE, recall: float = RECALL, count: int = PIVOTS):
        self.kind = width(vectors)
        self.key_type = vectors.schema["vec_id"].dataType
        self.rows = staged(packed(vectors).dropDuplicates(["vec_id", "vec"]), "vectors")
        self.block, self.share, self.recall, self.audited = block, share, recall, None
        kind = self.kind

        @F.pandas_udf("double")
        def norm(v: pd.Series) -> pd.Series:
            return pd.Series([float(np.linalg.norm(np.frombuffer(bytes(b), kind).astype(float))) for b in v], dtype=float)

        self.n, largest = self.rows.agg(F.count("*"), F.max(norm("vec"))).first()
        sample = self.rows.orderBy(F.xxhash64("vec_id", F.lit(SEED + 1)), "vec_id").limit(count).collect() if self.n else []
        self.pivots = Pivots([(r.dim, bytes(r.vec)) for r in sample], kind, largest or 1.0, count)

    def fit(self, queries: Column, k: int = K, audit: int = AUDIT) -> float:
        """Double the candidate share until the audited recall is reached (at a share of 1 the search is exact)."""
        chosen = self.rows.filter(queries).orderBy(F.xxhash64("vec_id", F.lit(SEED + 2)), "vec_id").limit(audit)
        chosen = staged(chosen, "audit")
        exact = staged(self._run(chosen, k, 1.0), "audit-exact")
        while True:
            found = self._run(chosen, k, self.share)
            hits = exact.join(found, ["query_id", "vec_id"], "left_semi").count()
            total = exact.count()
            self.audited = hits / total if total else 1.0
            if self.audited >= self.recall or self.share >= 1.0:
                return self.audited
            self.share = min(1.0, 2 * self.share)

    def search(self, queries: Column, k: int = K) -> DataFrame:
        return self._run(self.rows.filter(queries), k, self.share)

    def _run(self, queries: DataFrame, k: int, share: float) -> DataFrame:
        pivots, kind = self.pivots, self.kind
        blocks = max(1, -(-self.n // self.block))
        groups = max(1, -(-queries.count() // QUERY_BLOCK))
        left = _tiles(self.rows, "b", groups, blocks, "g").groupBy("dim", "b", "g")
        right = _tiles(queries, "g", blocks, groups, "b").groupBy("dim", "b", "g")
        schema = T.StructType([T.StructField("query_id", self.key_type), T.StructField("vec_id", self.key_type), T.StructField("score", T.DoubleType())])

        def tile(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
            if not len(rows) or not len(wanted):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            rows = rows.sort_values("vec_id")
            return search_block(rows["vec_id"].to_numpy(), matrix(rows["vec"], kind), wanted["vec_id"].to_numpy(), matrix(wanted["vec"], kind), pivots, share, k)

        found = left.cogroup(right).applyInPandas(tile, schema)
        nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_permutation_index(embeddings: DataFrame) -> DataFrame:
    index = PermutationIndex(embeddings)
    queries = F.col("vec_id") % 20 == 0
    index.fit(queries)
    return index.search(queries)
