"""Vector columns for the embedding operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abspark.llm.common import bounded_batches

#: A stored vector: the column's own numbers, widened to doubles only in the tasks.
WIDTHS = {T.FloatType: "<f4", T.DoubleType: "<f8"}


def width(df: DataFrame, column: str = "embedding") -> str:
    return WIDTHS.get(type(df.schema[column].dataType.elementType), "<f8")


def usable(column: str = "embedding"):
    """Not null, not empty, no null or non-finite component, not zero."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(c) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(c, lambda x: x != 0), F.lit(False))


def packed(df: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, dim, vec) of the usable rows with an id; ``vec`` holds the components as little-endian bytes."""
    bounded_batches(df.sparkSession)
    kind = width(df, column)
    schema = T.StructType([T.StructField("vec_id", df.schema[key].dataType), T.StructField("dim", T.IntegerType()), T.StructField("vec", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            begin = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            raw, step = flat.tobytes(), flat.itemsize
            vectors = [raw[a * step : b * step] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(begin).astype(np.int32)), pa.array(vectors, pa.binary())], names=["vec_id", "dim", "vec"])

    return df.filter(F.col(key).isNotNull() & usable(column)).select(key, column).mapInArrow(run, schema)


def matrix(vectors, kind: str) -> np.ndarray:
    """Rows of equal dimension as doubles."""
    rows = [bytes(v) for v in vectors]
    if not rows:
        return np.zeros((0, 1))
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
