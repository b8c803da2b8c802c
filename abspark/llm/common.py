"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from abspark.session import ensure_checkpoint_dir

#: ASCII white space `[\x20\x09-\x0D]`; `bytes.split()` and `bytes.strip()` use exactly this set.
WHITE = b" \t\n\x0b\x0c\r"

#: Rows of one Arrow batch: bounds a Python worker's memory (texts are long).
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Lower the session's Arrow batch size where it is larger than ``rows`` or ``size`` bytes."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key)
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back (cuts the lineage)."""
    path = f"{folder}/{name}" if folder else new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column (null: empty)."""
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def word_blocks(data: bytes, block: int = 1 << 20) -> Iterator[list[bytes]]:
    """White-space separated words of A-Z lower-cased ``data``, a bounded block at a time."""
    if len(data) <= block:
        yield data.lower().split()
        return
    at, rest = 0, b""
    while at < len(data):
        part = rest + data[at : at + block].lower()
        at += block
        words = part.split()
        rest = b""
        if at < len(data) and words and part[-1] not in WHITE:
            rest = words.pop()
        yield words
    if rest:
        yield [rest]


def fold_text(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on an unsigned 64-bit array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return freed memory to the system: workers live on beside the executor's heap, whatever they run next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def thrifty(batches: Iterator, every: int = 4) -> Iterator:
    for i, batch in enumerate(batches):
        yield batch
        if i % every == every - 1:
            give_back()
    give_back()


_MEMO: dict[tuple, object] = {}


def process_memo(key: tuple, make: Callable[[], object]):
    """What ``make`` gives, kept for the worker process's next tasks of the same kind; another kind takes its place."""
    if key not in _MEMO:
        _MEMO.clear()  # before the new one is made: one operator's memory at a time
        give_back()
        _MEMO[key] = make()
    return _MEMO[key]
