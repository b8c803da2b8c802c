"""Centroid clustering with heap-ordered bounds, in exact integers.

Lloyd's rounds over vectors of integer components.  A vector's gap is the lower
bound of its distance to any other centroid less the upper bound of that to its
own.  When centroids move, all gaps of one cluster shrink by the same amount: its
own centroid's drift and the largest drift of another.  So each cluster keeps one
heap of gaps, each entered with the drift its cluster had accumulated by then
added, and a round pops only those that are no longer above what has accumulated
since.  Popped vectors are compared with every centroid, exactly, and go into the
heap of their new cluster; all others are still nearest to their centroid, by
more than rounding could hide.

The vectors lie in blocks of ``BLOCK``, one row a block: components, clusters,
heaps and the cluster sums, which change by the moved vectors only.  A round is
one narrow pass from the last round's table to the next (no shuffle of vectors);
the sums of the blocks meet as one row per component, cluster and partition.  A
lost executor repeats its blocks' round from that table.  The driver holds the
centroids, never vectors.

Defined cases: vectors that are null, of another dimension or hold a null or
non-finite component take no part; rows without an id are clustered but start no
centroid; repeated rows are vectors of their own; of rows with one id the one with
the smaller components comes first as a start; fewer vectors than centroids: as
many centroids as vectors; equal distances go to the smaller number; an empty
table gives an empty table; other columns are not read.  A scaled component
beyond +-2**27 raises: its squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abspark.llm.common import bounded_batches, new_folder, staged, thrifty

CENTROIDS = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED = 2
BLOCK = 1024
LIMIT = 2**27
_FLOAT_EXACT = 2**25  # largest magnitude times sqrt(dim): then all of |x|^2 - 2xc + |c|^2 stays below 2**53
_SLACK = 1e-9  # relative room for rounding in bounds


@dataclass
class Centroids:
    """What a round's tasks need: the centroids and the drift every cluster has accumulated."""

    at: np.ndarray  # (clusters, dim) int64
    drift: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Exact squared distances of rows to all centroids."""
        c = self.at
        if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) * np.sqrt(x.shape[1]) <= _FLOAT_EXACT:
            x, c = x.astype(np.float64), c.astype(np.float64)  # integers all the way, so exact
        else:
            return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)

    def moved(self, sums: dict[int, tuple[int, list[int]]]) -> Centroids:
        """The next round's: every non-empty cluster's floored mean, and the drift so far."""
        at = self.at.copy()
        for cluster, (count, total) in sums.items():
            at[cluster] = [t // count for t in total]
        step = np.sqrt(((at - self.at) ** 2).sum(axis=1).astype(np.float64)) * (1 + _SLACK)
        order = np.argsort(-step)
        other = np.full(len(step), step[order[0]])
        other[order[0]] = step[order[1]] if len(step) > 1 else 0.0
        return Centroids(at, self.drift + step + other)


class Block:
    """Vectors, their clusters, a heap of (gap + drift, row) for each cluster, and the clusters' sums."""

    def __init__(self, x: np.ndarray, clusters: int):
        self.x, self.cluster = x, np.full(len(x), -1, np.int32)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(clusters)]
        self.sums, self.counts = np.zeros((clusters, x.shape[1]), np.int64), np.zeros(clusters, np.int64)

    def expired(self, centroids: Centroids) -> np.ndarray:
        """Rows whose gap the drift has used up, taken off their heaps."""
        out = []
        for heap, drift in zip(self.heaps, centroids.drift.tolist(), strict=True):
            while heap and heap[0][0] <= drift:
                out.append(heapq.heappop(heap)[1])
        return np.array(out, np.int64)

    def scan(self, rows: np.ndarray, centroids: Centroids) -> None:
        d = centroids.distances(self.x[rows])
        best = d.argmin(axis=1)
        near = np.sqrt(d[np.arange(len(rows)), best].astype(np.float64))
        far = np.sqrt(np.partition(d, 1, axis=1)[:, 1].astype(np.float64)) if d.shape[1] > 1 else np.full(len(rows), np.inf)
        drift = centroids.drift[best]
        key = far - near + drift - _SLACK * (np.where(np.isinf(far), 0.0, far) + near + drift)
        old = self.cluster[rows]
        for sign, cluster, who in ((-1, old, old >= 0), (1, best, old != best)):
            who &= old != best
            np.add.at(self.sums, cluster[who], sign * self.x[rows[who]])
            np.add.at(self.counts, cluster[who], sign)
        self.cluster[rows] = best
        for c, k, row in zip(best.tolist(), key.tolist(), rows.tolist(), strict=True):
            heapq.heappush(self.heaps[c], (k, row))

    def advance(self, centroids: Centroids) -> int:
        """One round's assignment; the number of vectors that were scanned."""
        rows = np.arange(len(self.x)) if len(self.cluster) and self.cluster[0] < 0 else self.expired(centroids)
        if len(rows):
            self.scan(rows, centroids)
        return len(rows)

    def distance(self, centroids: Centroids) -> np.ndarray:
        return ((self.x - centroids.at[self.cluster]) ** 2).sum(axis=1)

    # ---- as a row ----------------------------------------------------------
    def row(self) -> dict:
        kind = "<i2" if np.abs(self.x).max(initial=0) < 2**15 else "<i4"
        keys = np.array([k for heap in self.heaps for k, _ in heap], "<f8")
        rows = np.array([i for heap in self.heaps for _, i in heap], "<i4")
        return {
            "kind": kind, "x": self.x.astype(kind).tobytes(), "cluster": self.cluster.astype("<i4").tobytes(),
            "heap_size": [len(h) for h in self.heaps], "heap_key": keys.tobytes(), "heap_row": rows.tobytes(),
            "sums": self.sums.ravel().tolist(), "counts": self.counts.tolist(),
        }

    @classmethod
    def of(cls, row: dict, dim: int) -> Block:
        x = np.frombuffer(row["x"], row["kind"]).reshape(-1, dim).astype(np.int64)
        block = cls(x, len(row["counts"]))
        block.cluster = np.frombuffer(row["cluster"], "<i4").copy()
        keys, rows = np.frombuffer(row["heap_key"], "<f8").tolist(), np.frombuffer(row["heap_row"], "<i4").tolist()
        at = 0
        for c, size in enumerate(row["heap_size"]):
            block.heaps[c] = list(zip(keys[at : at + size], rows[at : at + size], strict=True))
            at += size
        block.sums, block.counts = np.array(row["sums"], np.int64).reshape(-1, dim), np.array(row["counts"], np.int64)
        return block


def _schema(id_type: T.DataType) -> T.StructType:
    binary, longs = T.BinaryType(), T.ArrayType(T.LongType())
    fields = {"ids": T.ArrayType(id_type), "kind": T.StringType(), "x": binary, "cluster": binary, "heap_size": T.ArrayType(T.IntegerType()),
              "heap_key": binary, "heap_row": binary, "sums": longs, "counts": longs, "scanned": T.LongType()}
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def kept(column: str = "embedding", dim: int = DIM):
    """Exactly ``dim`` components, none null or non-finite."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(c) == dim) & ~F.coalesce(bad, F.lit(True)), F.lit(False))


def _scaled(values: np.ndarray, scale: int) -> np.ndarray:
    x = np.floor(scale * values.astype(np.float64))
    if np.abs(x).max(initial=0) > LIMIT:
        raise ValueError(f"a component beyond +-{LIMIT // scale}: squared distances would not fit a long")
    return x.astype(np.int64)


@dataclass
class Clustering:
    """(vec_id, cluster, distance) of every vector, the final centroids, and how many vectors each of the rounds scanned."""

    vectors: DataFrame
    centroids: np.ndarray
    scanned: list[int]


def starts(vectors: DataFrame, clusters: int = CENTROIDS, seed: int = SEED, scale: int = SCALE) -> np.ndarray:
    """The vectors of smallest SHA-256 of ``seed:vec_id``, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.filter(F.col("vec_id").isNotNull()).orderBy(order, "embedding").limit(clusters).collect()
    return _scaled(np.array([r.embedding for r in rows], np.float64).reshape(len(rows), -1 if rows else 0), scale)


def cluster(df: DataFrame, clusters: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE, dim: int = DIM) -> Clustering:
    """``rounds`` rounds of assignment and update from the hashed starts, then one more assignment."""
    spark = df.sparkSession
    bounded_batches(spark, BLOCK)
    vectors = df.filter(kept(dim=dim)).select("vec_id", "embedding")
    first = starts(vectors, clusters, seed, scale)
    id_type = df.schema["vec_id"].dataType
    out = T.StructType([T.StructField("vec_id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not len(first):
        return Clustering(spark.createDataFrame([], out), first, [])
    centroids, schema, folder = Centroids(first, np.zeros(len(first))), _schema(id_type), new_folder(spark, "heap-kmeans")
    arrow = {f.name: f.dataType for f in schema}

    def rows_out(ids: pa.Array, block: Block, scanned: int) -> pa.RecordBatch:
        row = block.row() | {"scanned": scanned}
        lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        kinds = {"kind": pa.string(), "heap_size": pa.list_(pa.int32()), "sums": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()), "scanned": pa.int64()}
        return pa.RecordBatch.from_arrays([lists, *(pa.array([row[name]], kinds.get(name, pa.binary())) for name in arrow if name != "ids")], names=list(arrow))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                flat = pa.concat_arrays([part.column(1)]).flatten().to_numpy(zero_copy_only=False)
                block = Block(_scaled(flat, scale).reshape(-1, dim), len(first))
                yield rows_out(pa.concat_arrays([part.column(0)]), block, block.advance(centroids))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Block]]:
        for batch in thrifty(batches):
            plain = batch.select([name for name in arrow if name != "ids"]).to_pylist()
            for i, row in enumerate(plain):
                yield batch.column("ids")[i].values, Block.of(row, dim)

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in blocks(batches):
            scanned = block.advance(centroids)  # before the row is made
            yield rows_out(ids, block, scanned)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(len(first) * dim, np.int64), np.zeros(len(first), np.int64)
        for batch in batches:
            total += batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
            count += batch.column("counts").flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
        on = np.flatnonzero(np.repeat(count, dim))
        yield pa.RecordBatch.from_arrays([pa.array(on // dim), pa.array(on % dim), pa.array(total[on]), pa.array(np.repeat(count, dim)[on])], names=["cluster", "place", "total", "n"])

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in blocks(batches):
            block.advance(centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(block.cluster), pa.array(block.distance(centroids))], names=["vec_id", "cluster", "distance"])

    scanned = []
    state = vectors.mapInArrow(begin, schema)
    for i in range(rounds):
        state = staged(state, f"round-{i}", folder)
        scanned.append(state.agg(F.sum("scanned")).first()[0])
        parts = state.select("sums", "counts").mapInArrow(sums, "cluster long, place long, total long, n long")
        found: dict[int, tuple[int, list[int]]] = {}
        # At most clusters x dim rows, whatever the table holds.
        for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).orderBy("cluster", "place").collect():
            found.setdefault(r.cluster, (r.n, []))[1].append(int(r.total))
        centroids = centroids.moved(found)
        if i < rounds - 1:
            state = state.mapInArrow(advance, schema)
    return Clustering(staged(state.mapInArrow(last, out), "vectors", folder), centroids.at, scanned)


def op11_heap_kmeans(embeddings: DataFrame) -> DataFrame:
    found = cluster(embeddings)
    spark = embeddings.sparkSession
    per_cluster = {r.cluster: int(r.inertia) for r in found.vectors.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    rows = [(c, inertia, sum(per_cluster.values()), hashlib.sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest()) for c, inertia in per_cluster.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row a centroid: broadcast by its bound.
    return found.vectors.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
