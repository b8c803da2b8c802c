"""Incremental line dedup: sharded cuckoo filters over exact reference counts.

``LineDedupIndex`` keeps, in Parquet under the shared folder,

* a membership log (doc_id, key, sign): +1 when a document's key was
  inserted, -1 when the document was deleted;
* exact reference counts (key, n_docs), the sum of that log by key;
* one cuckoo filter per shard of the key space, holding the keys whose count
  has reached ``min_docs``.  A key that crosses the threshold upwards is
  inserted in its shard's filter, one that falls below is deleted from it, so
  inserting documents and deleting them again restores the former state.

``apply`` probes the filters first (they have no false negatives), and only
the lines that hit are checked against the exact counts.  The filters travel
to the tasks while their measured size is at most ``filter_bytes``; beyond
that every line is checked by the join, with the same result.

A key is the 128-bit xxh3 digest of the line stripped of ``[\\x20\\x09-\\x0D]``
at both ends with A-Z lower-cased.

Defined cases: a null text is one empty line, as is an empty text; empty keys
are shorter than ``min_chars`` and always stay; rows that share a doc_id
(null included) are one document for the counts and each keeps its own row; a
line repeated in a document counts once; an empty table gives an empty table;
other columns are carried untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abspark.llm.common import bounded_batches, new_folder, text_bytes

MIN_DOCS = 10
MIN_CHARS = 1
SLOTS = 4
SHARD_KEYS = 1 << 15
FILTER_BYTES = 32 << 20
_KICKS = 400


def line_key(line: bytes) -> bytes:
    """bytes.strip() and bytes.lower() touch ASCII only: exactly the key of the contract."""
    return line.strip().lower()


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pair = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2)
    return pair[:, 0].astype(np.int64), pair[:, 1].astype(np.int64)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; every key has two candidate buckets (partial-key hashing)."""

    def __init__(self, buckets: int, cells: np.ndarray | None = None):
        self.mask = buckets - 1
        self.cells = np.zeros((buckets, SLOTS), np.uint16) if cells is None else cells

    @staticmethod
    def sized(n: int) -> CuckooFilter:
        need = max(4, int(n / (SLOTS * 0.8)) + 1)
        return CuckooFilter(1 << (need - 1).bit_length())

    @staticmethod
    def load(blob: bytes) -> CuckooFilter:
        cells = np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy()
        return CuckooFilter(len(cells), cells)

    def dump(self) -> bytes:
        return self.cells.tobytes()

    def _places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low = lo.view(np.uint64)
        tag = (low & np.uint64(0xFFFF)).astype(np.uint16)
        tag[tag == 0] = 1
        first = ((low >> np.uint64(20)) & np.uint64(self.mask)).astype(np.int64)
        return tag, first, self._other(first, tag)

    def _other(self, bucket, tag):
        return (bucket ^ (tag.astype(np.int64) * 0x5BD1E995 >> 4)) & self.mask

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """False when a key finds no place (the caller rebuilds a larger filter from the exact counts)."""
        tag, first, second = self._places(hi, lo)
        rng = np.random.default_rng(len(lo))
        for t, a, b in zip(tag, first.tolist(), second.tolist(), strict=True):
            for bucket in (a, b):
                free = np.flatnonzero(self.cells[bucket] == 0)
                if len(free):
                    self.cells[bucket, free[0]] = t
                    break
            else:
                bucket = a
                for _ in range(_KICKS):
                    slot = int(rng.integers(SLOTS))
                    t, self.cells[bucket, slot] = self.cells[bucket, slot], t
                    bucket = int(self._other(np.int64(bucket), np.uint16(t)))
                    free = np.flatnonzero(self.cells[bucket] == 0)
                    if len(free):
                        self.cells[bucket, free[0]] = t
                        break
                else:
                    return False
        return True

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        tag, first, second = self._places(hi, lo)
        for t, a, b in zip(tag, first.tolist(), second.tolist(), strict=True):
            for bucket in (a, b):
                held = np.flatnonzero(self.cells[bucket] == t)
                if len(held):
                    self.cells[bucket, held[0]] = 0
                    break

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        tag, first, second = self._places(hi, lo)
        return (self.cells[first] == tag[:, None]).any(1) | (self.cells[second] == tag[:, None]).any(1)


def document_keys(docs: DataFrame, min_chars: int, probe: dict[int, bytes] | None = None, shards: int = 1) -> DataFrame:
    """(doc_id, hi, lo): the distinct keys of each row's text; with ``probe`` only those its filters may hold."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType())])
    sent = spark.sparkContext.broadcast(probe) if probe is not None else None

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {k: CuckooFilter.load(v) for k, v in sent.value.items()} if sent is not None else None
        for batch in batches:
            rows, digests = [], []
            for i, text in enumerate(text_bytes(batch.column(1))):
                own = {digest(k) for k in map(line_key, text.split(b"\n")) if _long_enough(k, min_chars)}
                digests.extend(own)
                rows.extend([i] * len(own))
            if not rows:
                continue
            hi, lo = _halves(digests)
            at = np.array(rows)
            if filters is not None:
                hit = np.zeros(len(at), bool)
                shard = hi & (shards - 1)
                for k, f in filters.items():
                    own = np.flatnonzero(shard == k)
                    hit[own] = f.contains(hi[own], lo[own])
                at, hi, lo = at[hit], hi[hit], lo[hit]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(hi), pa.array(lo)], names=["doc_id", "hi", "lo"])

    return docs.select("doc_id", "text").mapInArrow(keys, schema)


def _shard(shards: int):
    """``shards`` is a power of two."""
    return F.expr(f"cast(hi & {shards - 1} as int)")


class LineDedupIndex:
    def __init__(self, spark: SparkSession, path: str | None = None, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                 shard_keys: int = SHARD_KEYS, filter_bytes: int = FILTER_BYTES, resume: bool = False):
        """``resume`` goes on with the index stored at ``path`` by an earlier session."""
        self.spark, self.path = spark, path or new_folder(spark, "line-dedup")
        self.min_docs, self.min_chars = min_docs, min_chars
        self.shard_keys, self.filter_bytes = shard_keys, filter_bytes
        self.version, self.logs, self.shards = 0, [], 0
        if resume:
            states = spark.read.parquet(f"{self.path}/state").collect()  # a row per change
            last = max(states, key=lambda r: r.version)
            self.version, self.shards, self.min_docs, self.min_chars = last.version, last.shards, last.min_docs, last.min_chars
            self.logs = sorted(r.version for r in states)
            self.log_schema = spark.read.parquet(f"{self.path}/log/{self.version}").schema

    # -- stored tables -------------------------------------------------------
    def _read(self, name: str, schema: str | T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def counts(self) -> DataFrame:
        """(hi, lo, n_docs), exact, of every key in a live document."""
        return self._read(f"counts/{self.version}", "hi long, lo long, n_docs long")

    def filters(self) -> DataFrame:
        return self._read(f"filters/{self.version}", "shard int, cells binary")

    def members(self) -> DataFrame:
        """(doc_id, hi, lo) of live documents: the membership log summed."""
        log = self._read(f"log/{self.logs[0]}", self.log_schema)
        for n in self.logs[1:]:
            log = log.unionAll(self._read(f"log/{n}", self.log_schema))
        return log.groupBy("doc_id", "hi", "lo").agg(F.sum("sign").alias("n")).filter("n > 0").drop("n")

    # -- changes -------------------------------------------------------------
    def insert(self, docs: DataFrame) -> None:
        """Count the lines of ``docs``; a (document, key) pair already live is not counted again."""
        keys = document_keys(docs, self.min_chars).distinct()
        if self.logs:
            old = self.members()
            keys = keys.join(old, keys.doc_id.eqNullSafe(old.doc_id) & (keys.hi == old.hi) & (keys.lo == old.lo), "left_anti")
        self._change(keys, 1)

    def delete(self, doc_ids: DataFrame) -> None:
        """Take the documents whose ids are in column doc_id of ``doc_ids`` out of every count."""
        if self.logs:
            old, gone = self.members(), doc_ids.select("doc_id").distinct()
            self._change(old.join(gone, old.doc_id.eqNullSafe(gone.doc_id), "left_semi"), -1)

    def _write(self, df: DataFrame, name: str) -> None:
        """A change that broke off before its state was written is written over by the next."""
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")

    def _change(self, keys: DataFrame, sign: int) -> None:
        n = self.version + 1
        rows = keys.withColumn("sign", F.lit(sign).cast("int"))
        self._write(rows, f"log/{n}")
        self.log_schema = rows.schema
        delta = self._read(f"log/{n}", self.log_schema).groupBy("hi", "lo").agg(F.sum("sign").alias("d"))
        if self.version:
            old = self.counts().withColumnRenamed("n_docs", "was")
            both = old.join(delta, ["hi", "lo"], "full")
        else:
            both = delta.withColumn("was", F.lit(0).cast("long"))
        both = both.select("hi", "lo", F.coalesce("was", F.lit(0)).alias("was"), (F.coalesce("was", F.lit(0)) + F.coalesce("d", F.lit(0))).cast("long").alias("n_docs"))
        self._write(both.filter("n_docs > 0 or was > 0"), f"moves/{n}")
        moves = self._read(f"moves/{n}", "hi long, lo long, was long, n_docs long")
        self._write(moves.filter("n_docs > 0").select("hi", "lo", "n_docs"), f"counts/{n}")
        had, self.version = self.filters() if self.version else None, n
        self.logs.append(n)
        self._update_filters(moves, had, n)
        # Written last: it makes the change part of the index.
        state = self.spark.range(1).selectExpr(f"{n} as version", f"{self.shards} as shards", f"{self.min_docs} as min_docs", f"{self.min_chars} as min_chars")
        state.write.mode("append").parquet(f"{self.path}/state")

    def _update_filters(self, moves: DataFrame, had: DataFrame | None, n: int) -> None:
        frequent = self.counts().filter(F.col("n_docs") >= self.min_docs)
        need = max(1, -(-frequent.count() // self.shard_keys))
        schema = "shard int, cells binary"
        if had is None or need > self.shards:
            self.shards = 1 << (need - 1).bit_length()
            had = None
        if had is None:
            built = self._built(frequent)
        else:
            edge = f"n_docs >= {self.min_docs}"
            crossed = moves.filter(f"({edge}) <> (was >= {self.min_docs})").select(
                _shard(self.shards).alias("shard"), "hi", "lo", F.expr(edge).alias("up"))

            def changed(key, left, right):
                import pandas as pd

                cuckoo = CuckooFilter.load(left["cells"].iloc[0]) if len(left) else CuckooFilter.sized(len(right))
                up = right["up"].to_numpy(bool)
                hi, lo = right["hi"].to_numpy(np.int64), right["lo"].to_numpy(np.int64)
                cuckoo.delete(hi[~up], lo[~up])
                fits = cuckoo.insert(hi[up], lo[up])
                return pd.DataFrame({"shard": [key[0]], "cells": [cuckoo.dump() if fits else None]})

            now = had.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(changed, schema)
            self._write(now, f"filters-tried/{n}")
            now = self._read(f"filters-tried/{n}", schema)
            full = now.filter("cells is null").select("shard")
            again = self._built(frequent.withColumn("shard", _shard(self.shards)).join(full, "shard", "left_semi"))
            built = now.filter("cells is not null").unionAll(again)
        self._write(built, f"filters/{n}")

    def _built(self, frequent: DataFrame) -> DataFrame:
        """Filters from the exact counts: a shard holds about ``shard_keys`` keys whatever the corpus size."""

        def build(key, rows):
            import pandas as pd

            hi, lo = rows["hi"].to_numpy(np.int64), rows["lo"].to_numpy(np.int64)
            size = len(rows)
            while not (cuckoo := CuckooFilter.sized(size)).insert(hi, lo):
                size *= 2
            return pd.DataFrame({"shard": [key[0]], "cells": [cuckoo.dump()]})

        return frequent.select(_shard(self.shards).alias("shard"), "hi", "lo").groupBy("shard").applyInPandas(build, "shard int, cells binary")

    # -- use -----------------------------------------------------------------
    def dropped_keys(self, docs: DataFrame) -> DataFrame:
        """(doc_id, drops): the digests of each document's keys found in at least ``min_docs`` live documents."""
        held = self.filters()
        size = held.agg(F.sum(F.length("cells"))).first()[0] or 0
        probe = {r.shard: bytes(r.cells) for r in held.collect()} if size <= self.filter_bytes else None
        found = document_keys(docs, self.min_chars, probe, self.shards)
        exact = self.counts().filter(F.col("n_docs") >= self.min_docs).select("hi", "lo")
        return found.join(exact, ["hi", "lo"]).groupBy("doc_id").agg(F.collect_set(F.struct("hi", "lo")).alias("drops"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """Columns (row, n_lines, n_dropped, kept): ``row`` is the input row as a struct, ``kept`` the text that stays."""
        bounded_batches(self.spark)
        drops = self.dropped_keys(docs).select(F.col("doc_id").alias("k"), "drops")
        rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
        rows = rows.join(drops, F.col("row.doc_id").eqNullSafe(F.col("k")), "left")

        @F.pandas_udf("n_lines long, n_dropped long, kept string")
        def cut(text, high, low):
            import pandas as pd

            out = []
            for t, h, w in zip(text, high, low, strict=True):
                lines = (t or "").split("\n")
                if h is None or len(h) == 0:
                    out.append((len(lines), 0, t or ""))
                    continue
                pairs = np.stack([np.asarray(h, np.int64), np.asarray(w, np.int64)], 1).astype(">i8").tobytes()
                bad = {pairs[i : i + 16] for i in range(0, len(pairs), 16)}
                kept = [x for x in lines if digest(line_key(x.encode())) not in bad]
                out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
            return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])

        return rows.withColumn("cut", cut(F.col("row.text"), F.col("drops.hi"), F.col("drops.lo"))).select("row", "cut.n_lines", "cut.n_dropped", "cut.kept")


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    index = LineDedupIndex(docs.sparkSession, min_docs=min_docs, min_chars=min_chars)
    index.insert(docs)
    return index.apply(docs)


def op5_line_dedup(docs: DataFrame) -> DataFrame:
    out = line_dedup(docs.select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
