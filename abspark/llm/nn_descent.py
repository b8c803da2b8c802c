"""Embedding near-dedup by NN-descent.

1. Equal vectors become one class with a multiplicity.
2. The neighbour graph starts from random-projection order: classes sorted by
   the signs of a few projections are linked to those next to them, for several
   random sets of projections (range-partitioned, so no bucket is a group).
3. NN-descent: around every class its neighbours and a bounded sample of
   reverse neighbours are joined with each other (pairs of two old neighbours
   are skipped); better pairs enter the lists.  A class whose whole list is at
   or above the threshold is saturated: its list is enlarged to twice the size,
   up to ``LARGEST``.  No threshold link that was met is lost to a full list: the
   starts' links and a spanning forest of those in every join are kept beside.
   Rounds go on until few lists change.
4. Audit: classes drawn from every component, and every class of the small
   ones, are compared with all classes in blocks until ``LINKED`` classes of
   small components have links (or all drawn are compared).  While the share of
   the links that lie in one component, averaged per component, is below
   ``RECALL``, the graph gets new random starts and more rounds; if that does
   not reach it, all classes are compared with all, in blocks.  Links that the
   comparison meets between components join them.
5. Edges of at least the threshold are kept (cosines are doubles throughout)
   and give the components.  What a list of any size may lack, links between
   members of one component, is counted exactly, in blocks: members within half
   the threshold's angle of the component's first vector are all linked to each
   other (triangle inequality), all others are compared with every member.

Lists, reverse samples and blocks are bounded, so no task holds a group; counts
rather than pairs leave the blocks, so a group of copies makes no row per pair.

Defined cases: null, empty and zero vectors, those with a null or non-finite
component and rows without an id link with nothing (n_links 0, component_id
their own id, kept); vectors of different dimensions never link; rows that
repeat id and vector are one vector in one row; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abspark.llm.common import new_folder, staged
from abspark.llm.components import components
from abspark.llm.vectors import matrix, packed, unit, width

THRESHOLD = 0.95
LIST = 8
LARGEST = 4 * LIST  # of an enlarged list; threshold links beyond it are kept as ties
TABLES = 6
NEXT = 3
ROUNDS = 4
SETTLED = 0.02
CHUNK = 8192
LINKED = 200
RECALL = 0.99
RESTARTS = 3
BLOCK = 512
SEED = 3


def _pairs(a: pa.Array, b: pa.Array, cos: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a, b, pa.array(cos)], names=["u", "v", "cos"])


def _forest(near: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the symmetric ``near`` (its diagonal is not read)."""
    left, right = [], []
    todo = near.sum(axis=1) > near.diagonal()
    while todo.any():
        queue = [int(np.argmax(todo))]
        todo[queue[0]] = False
        for i in queue:
            new = np.flatnonzero(near[i] & todo).tolist()
            todo[new] = False
            left += [i] * len(new)
            right += new
            queue += new
            if not todo.any():
                break
    return left, right


class NeighbourGraph:
    """Neighbour lists of ``classes`` (rep, m, dim, vec)."""

    def __init__(self, classes: DataFrame, kind: str, threshold: float, folder: str, size: int = LIST):
        self.classes, self.kind, self.threshold, self.folder, self.size = classes, kind, threshold, folder, size
        self.n = classes.count()
        self.id_type = classes.schema["rep"].dataType.simpleString()
        self.lists: DataFrame | None = None  # u, v, cos, fresh, room
        self.ties: list[DataFrame] = []  # (u, v): threshold links that were met, whether or not a list has room
        self.step = 0
        # The sign codes grow with log2(n), and so does the search.
        self.tables, self.rounds = max(TABLES, int(np.log2(max(2, self.n))) - 6), max(ROUNDS, int(np.log2(max(2, self.n))) // 3)

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        self.step += 1
        return staged(df, f"{name}-{self.step}", self.folder)

    def start(self, restart: int) -> DataFrame:
        """Pairs (u, v, cos) next to each other in random-projection order."""
        kind, bits = self.kind, max(1, min(30, int(np.log2(max(2, self.n))) - 3))
        tables = self.tables
        first = restart * tables

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column(1).to_numpy()
                raw = batch.column(2).to_pylist()
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    x = unit(matrix([raw[i] for i in at], kind))
                    for t in range(first, first + tables):
                        plane = np.random.default_rng([SEED, t, dim]).standard_normal((dim, bits + 1))
                        side = x @ plane
                        sign = ((side[:, :-1] > 0) << np.arange(bits)).sum(axis=1)
                        ids = batch.column(0).take(pa.array(at))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), t, np.int32)), pa.array(np.full(len(at), dim, np.int32)), pa.array(sign.astype(np.int64)), pa.array(side[:, -1]), ids, pa.array([raw[i] for i in at], pa.binary())],
                            names=["t", "dim", "sign", "side", "rep", "vec"],
                        )

        def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tail = None
            for batch in batches:
                if tail is not None:
                    batch = pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
                tail = batch.slice(max(0, batch.num_rows - NEXT))
                t, dims, raw = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(5).to_pylist()
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    x = unit(matrix([raw[i] for i in at], kind))
                    for gap in range(1, NEXT + 1):
                        a, b = at[:-gap], at[gap:]
                        same = t[a] == t[b]
                        if same.any():
                            cos = (x[:-gap][same] * x[gap:][same]).sum(axis=1)
                            yield _pairs(batch.column(4).take(pa.array(a[same])), batch.column(4).take(pa.array(b[same])), cos)

        rows = self.classes.select("rep", "dim", "vec").mapInArrow(keyed, f"t int, dim int, sign long, side double, rep {self.id_type}, vec binary")
        order = ["t", "dim", "sign", "side", "rep"]
        n = max(2, int(self.classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(beside, f"u {self.id_type}, v {self.id_type}, cos double")

    def merge(self, pairs: DataFrame) -> int:
        """Put ``pairs`` into the lists; returns how many entries are new."""
        both = pairs.select("u", "v", "cos").unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"), "cos")).filter("u <> v")
        new = both.select("u", "v", "cos", F.lit(True).alias("fresh"), F.lit(self.size).alias("room"))
        if self.lists is not None:
            new = self.lists.select("u", "v", "cos", F.lit(False).alias("fresh"), "room").unionAll(new)
        one = new.groupBy("u", "v").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"), F.max("room").alias("room"))
        entry = F.struct((-F.col("cos")).alias("far"), "v", "fresh")
        grouped = one.groupBy("u").agg(F.sort_array(F.collect_list(entry)).alias("all"), F.max("room").alias("room"))
        # A saturated list takes twice as many from now on.
        full = (F.size("all") >= F.col("room")) & (-F.element_at("all", F.col("room"))["far"] >= self.threshold)
        room = F.when(F.col("room") > F.size("all"), F.col("room")).when(full, F.least(F.col("room") * 2, F.lit(LARGEST))).otherwise(F.col("room"))
        kept = grouped.select("u", room.alias("room"), "all").select("u", "room", F.explode(F.slice("all", F.lit(1), F.col("room"))).alias("e"))
        self.lists = self._staged(kept.select("u", "e.v", (-F.col("e.far")).alias("cos"), "e.fresh", "room"), "lists")
        return self.lists.filter("fresh").count()

    def descend(self) -> int:
        """One round: join the neighbours of every class with each other."""
        lists, kind, threshold = self.lists, self.kind, self.threshold
        degree = lists.groupBy("v").agg(F.count("*").alias("degree"))
        back = lists.join(degree, "v")
        # About as many reverse neighbours as the list has room for, chosen by a hash.
        chance = F.pmod(F.xxhash64("u", "v", F.lit(self.step)), F.lit(1 << 20)) / float(1 << 20)
        back = back.filter(chance < F.lit(float(self.size)) / F.col("degree")).select(F.col("v").alias("u"), F.col("u").alias("v"), "fresh")
        around = lists.select("u", "v", "fresh").unionAll(back).groupBy("u", "v").agg(F.max("fresh").alias("fresh"))
        worst = lists.groupBy(F.col("u").alias("rep")).agg(F.when(F.count("*") >= F.max("room"), F.min("cos")).otherwise(-1.0).alias("worst"))
        known = self.classes.select("rep", "dim", "vec").join(worst, "rep")
        joined = around.join(known, F.col("v") == F.col("rep")).groupBy("u").agg(F.collect_list(F.struct("v", "fresh", "worst", "dim", "vec")).alias("near"))

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists_ = batch.column(0)
                flat, begin = lists_.flatten(), lists_.offsets.to_numpy() - lists_.offsets[0].as_py()
                fresh = flat.field(1).to_numpy(zero_copy_only=False).astype(bool)
                worst_, dims, raw = flat.field(2).to_numpy(), flat.field(3).to_numpy(), flat.field(4).to_pylist()
                x = np.zeros((len(raw), int(dims.max(initial=1))))
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    x[at, :dim] = unit(matrix([raw[i] for i in at], kind))
                left, right, cosines, tie = [], [], [], []
                for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
                    own = x[a:b]
                    cos = own @ own.T
                    better = np.triu(cos > np.minimum(worst_[a:b, None], worst_[None, a:b]), 1)
                    better &= (fresh[a:b, None] | fresh[None, a:b]) & (dims[a:b, None] == dims[None, a:b])
                    i, j = np.nonzero(better)
                    left.append(i + a)
                    right.append(j + a)
                    cosines.append(cos[i, j])
                    # What connects the links met here, for lists too full to take them.
                    i, j = (np.array(e, np.int64) for e in _forest((cos >= threshold) & (dims[a:b, None] == dims[None, a:b])))
                    left.append(i + a)
                    right.append(j + a)
                    cosines.append(cos[i, j])
                    tie += [np.zeros(len(left[-2]), bool), np.ones(len(i), bool)]
                if left:
                    ids = flat.field(0)
                    pairs = _pairs(ids.take(pa.array(np.concatenate(left))), ids.take(pa.array(np.concatenate(right))), np.concatenate(cosines))
                    yield pairs.append_column("tie", pa.array(np.concatenate(tie)))

        found = self._staged(joined.select("near").mapInArrow(local, f"u {self.id_type}, v {self.id_type}, cos double, tie boolean"), "found")
        self.ties.append(found.filter("tie").select("u", "v"))
        found = found.filter("not tie")
        return self.merge(found.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.max("cos").alias("cos")))

    def refine(self, restart: int) -> None:
        pairs = self._staged(self.start(restart), "start")
        self.ties.append(pairs.filter(F.col("cos") >= self.threshold).select("u", "v"))
        self.merge(pairs)
        for _ in range(self.rounds):
            if self.descend() <= SETTLED * self.size * self.n:
                break

    def components(self) -> DataFrame:
        links = self.lists.filter(F.col("cos") >= self.threshold).select("u", "v")
        for more in self.ties:
            links = links.unionAll(more)
        return components(links.toDF("a", "b"))

    def audit(self, roots: DataFrame, whole: bool = False) -> tuple[float, DataFrame | None]:
        """Recall of the threshold links, averaged per component, and links met between components (a, b).

        About ``LIST`` classes of every component are drawn (all of a smaller
        one) and compared with every class, ``CHUNK`` at a time, until ``LINKED``
        of small components have links; ``whole`` compares all classes.
        """
        kind, threshold, id_type = self.kind, self.threshold, self.id_type
        rows = self.classes.join(roots, F.col("rep") == F.col("node"), "left").select("rep", "dim", "vec", F.coalesce("root", "rep").alias("root"))
        size = rows.groupBy(F.col("root").alias("r")).agg(F.count("*").alias("size"))
        places = 1 << 20
        rows = rows.join(size, F.col("root") == F.col("r")).select("rep", "dim", "vec", "root", "size", F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(places)).alias("place"))
        rows = self._staged(rows, "audit")
        drawn = rows if whole else rows.filter(F.pmod(F.xxhash64("rep", F.lit(SEED + 1)), F.lit(places)) * F.col("size") < LIST * places)
        n = drawn.count()
        chunks = max(1, -(-n // CHUNK))
        true, small, links = {}, 0, []
        for at in range(chunks):
            part = drawn.filter((F.col("place") >= at * places // chunks) & (F.col("place") < (at + 1) * places // chunks)).select("rep", "dim", "vec", "root", "size").toArrow().combine_chunks()
            if not part.num_rows:
                continue
            sent = self.classes.sparkSession.sparkContext.broadcast(part)

            def compare(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                own = sent.value
                reps, own_root = (own.column(c).combine_chunks() for c in (0, 3))
                known = pc.unique(own_root)
                code, own_dims, raw = pc.index_in(own_root, known).to_numpy(zero_copy_only=False), own.column(1).to_numpy(), own.column(2).to_pylist()
                units = {dim: (np.flatnonzero(own_dims == dim), unit(matrix([raw[i] for i in np.flatnonzero(own_dims == dim)], kind))) for dim in np.unique(own_dims).tolist()}
                t, j = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
                for batch in batches:
                    for start in range(0, batch.num_rows, BLOCK):
                        cut = batch.slice(start, BLOCK)
                        dims, vecs = cut.column(1).to_numpy(), cut.column(2).to_pylist()
                        self_at = pc.fill_null(pc.index_in(cut.column(0), reps), -1).to_numpy(zero_copy_only=False)
                        root = pc.fill_null(pc.index_in(cut.column(3), known), -1).to_numpy(zero_copy_only=False)
                        for dim in np.unique(dims).tolist():
                            if dim not in units:
                                continue
                            here, (there, x) = np.flatnonzero(dims == dim), units[dim]
                            left, right = np.nonzero(unit(matrix([vecs[i] for i in here], kind)) @ x.T >= threshold)
                            left, right = here[left], there[right]
                            other = self_at[left] != right
                            left, right = left[other], right[other]
                            same = root[left] == code[right]
                            t += np.bincount(right, minlength=len(t))
                            j += np.bincount(right[same], minlength=len(t))
                            left, right = left[~same], right[~same]
                            if len(left):
                                ends = pa.table([cut.column(3).take(pa.array(left)), own_root.take(pa.array(right))], names=["a", "b"]).group_by(["a", "b"]).aggregate([]).combine_chunks()
                                none = np.zeros(len(ends), np.int64)
                                yield pa.RecordBatch.from_arrays([ends["a"].combine_chunks(), ends["b"].combine_chunks(), pa.array(none - 1), pa.array(none), pa.array(none)], names=["a", "b", "i", "t", "j"])
                i = np.flatnonzero(t)
                if len(i):
                    none = pa.nulls(len(i), own_root.type)
                    yield pa.RecordBatch.from_arrays([none, none, pa.array(i), pa.array(t[i]), pa.array(j[i])], names=["a", "b", "i", "t", "j"])

            met = self._staged(rows.select("rep", "dim", "vec", "root").mapInArrow(compare, f"a {id_type}, b {id_type}, i long, t long, j long"), "met")
            sums = met.filter("i >= 0").groupBy("i").agg(F.sum("t").alias("t"), F.sum("j").alias("j")).toArrow()  # CHUNK rows at most
            sent.destroy()
            links.append(met.filter("i < 0").select("a", "b").distinct())
            of, sizes = part["root"].to_pylist(), part["size"].to_numpy()
            for i, t, j in zip(*(sums[c].to_pylist() for c in ("i", "t", "j")), strict=True):
                true.setdefault(of[i], []).append(j / t)
                small += int(sizes[i] <= LIST)
            if not whole and small >= LINKED:
                break
        recall = float(np.mean([np.mean(x) for x in true.values()])) if true else 1.0
        between = None
        for part in links:
            between = part if between is None else between.unionAll(part)
        return recall, between

    def complete(self, roots: DataFrame, between: DataFrame | None) -> DataFrame:
        """``roots`` with components joined that ``between`` (a, b) links; a lone class has no row in ``roots``."""
        if between is None or between.isEmpty():
            return roots
        over = components(between).withColumnRenamed("root", "top")
        old = roots.select("node", "root").unionAll(between.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots.select("node"), "node", "left_anti").select("node", F.col("node").alias("root")))
        over = over.withColumnRenamed("node", "r")
        return self._staged(old.join(over, F.col("root") == F.col("r"), "left").select("node", F.coalesce("top", "root").alias("root")), "roots")


def _link_counts(members: DataFrame, kind: str, threshold: float, id_type: str) -> DataFrame:
    """(rep, links): linked vectors of every class, exact within its component.  members: rep, m, dim, vec, root."""
    half = float(np.cos(np.arccos(threshold) / 2)) + 1e-12

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        size, out = a.map(len).to_numpy(), np.zeros(len(a))
        for n in np.unique(size).tolist():
            own = size == n
            out[own] = (unit(matrix(a[own], kind)) * unit(matrix(b[own], kind))).sum(axis=1)
        return pd.Series(out)

    first = members.filter("rep = root").select(F.col("root").alias("r"), F.col("vec").alias("pivot"))
    rows = members.join(first, F.col("root") == F.col("r")).withColumn("core", cosine("vec", "pivot") >= half).drop("pivot", "r")
    stats = rows.groupBy("root").agg(F.count("*").alias("n"), F.count_if(~F.col("core")).alias("rest"), F.coalesce(F.sum(F.when(F.col("core"), F.col("m"))), F.lit(0)).alias("w"))
    rows = rows.join(stats, "root")
    sure = rows.filter("core").select("rep", (F.col("w") - F.col("m")).alias("links"))
    own = rows.select("rep", (F.col("m") - 1).alias("links"))
    open_ = rows.filter("rest > 0")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    deal = lambda n: F.pmod(F.xxhash64("rep", F.lit(SEED)), n).cast("int")
    fields = ("rep", "m", "vec", "core", "root")
    left = open_.select(*[F.col(c).alias(c) for c in fields], deal(blocks("n")).alias("a"), F.explode(F.sequence(F.lit(0), blocks("rest") - 1)).alias("b"))
    right = open_.filter("not core").select(*[F.col(c).alias(c) for c in fields], F.explode(F.sequence(F.lit(0), blocks("n") - 1)).alias("a"), deal(blocks("rest")).alias("b"))

    def compare(all_: pd.DataFrame, rest: pd.DataFrame) -> pd.DataFrame:
        if not len(all_) or not len(rest):
            return pd.DataFrame({"rep": [], "links": []})
        near = unit(matrix(all_["vec"], kind)) @ unit(matrix(rest["vec"], kind)).T >= threshold
        near &= all_["rep"].to_numpy()[:, None] != rest["rep"].to_numpy()[None, :]
        core = all_["core"].to_numpy(bool)
        of_rest = all_["m"].to_numpy() @ near
        of_core = near[core] @ rest["m"].to_numpy()
        return pd.DataFrame({"rep": np.concatenate([rest["rep"].to_numpy(), all_["rep"].to_numpy()[core]]), "links": np.concatenate([of_rest, of_core]).astype(np.int64)})

    met = left.groupBy("root", "a", "b").cogroup(right.groupBy("root", "a", "b")).applyInPandas(compare, f"rep {id_type}, links long")
    return sure.unionAll(own).unionAll(met).groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, float]:
    """(vec_id, n_links, component_id, kept) per vector, and the audited recall."""
    spark = embeddings.sparkSession
    folder, kind = new_folder(spark, "nn-descent"), width(embeddings)
    vectors = staged(packed(embeddings).distinct(), "vectors", folder)
    classes = staged(vectors.groupBy("dim", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")), "classes", folder)
    graph = NeighbourGraph(classes, kind, threshold, folder)
    for restart in range(RESTARTS):
        graph.refine(restart)
        roots = staged(graph.components(), f"roots-{restart}", folder)
        recall, between = graph.audit(roots)
        if recall >= RECALL:
            break
    else:
        # The search falls short: every class is compared with every other.
        _, between = graph.audit(roots, whole=True)
        recall = 1.0
    roots = graph.complete(roots, between)
    members = classes.join(roots, F.col("rep") == F.col("node")).drop("node")
    links = _link_counts(members, kind, threshold, graph.id_type)
    found = classes.select("rep", "m", "dim", "vec").join(roots, F.col("rep") == F.col("node"), "left").join(links, "rep", "left")
    found = found.select("dim", "vec", F.coalesce("links", F.col("m") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    linked = vectors.join(found, ["dim", "vec"]).select("vec_id", "n_links", "component_id")
    ids = embeddings.select("vec_id").join(vectors.select("vec_id"), "vec_id", "left_anti").distinct()
    alone = ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), recall


def op3_nn_descent(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)[0]
