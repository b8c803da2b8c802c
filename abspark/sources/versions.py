"""Tables that are replaced as a whole: readers see the old rows or the new ones, never half of either.

A table is a folder with ``data/<version>`` folders and a log ``versions/``.
Replacing it writes a new data folder and then appends one row (version, folder)
to the log: a single small file that the committer renames into place.  Until then
every reader resolves to the version before; a write that dies leaves a folder
that nobody refers to.  A job may replace the table it reads, because it reads
another folder.  Works on any path Spark writes; one writer per table at a time
(of two, the later commit wins, whole).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG = "version long, folder string, written_at timestamp"


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/versions"


def _data(path: str, folder: str) -> str:
    return f"{path.rstrip('/')}/data/{folder}"


def history(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(version, folder) of the committed versions, oldest first."""
    try:
        rows = spark.read.schema(LOG).parquet(_log(path)).select("version", "folder").orderBy("version", "folder").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [(r.version, r.folder) for r in rows]


def exists(spark: SparkSession, path: str) -> bool:
    return bool(history(spark, path))


def read(spark: SparkSession, path: str, version: int | None = None, schema: StructType | None = None) -> DataFrame:
    """The table's current rows, or those of an older ``version`` that is still kept."""
    known = [(v, folder) for v, folder in history(spark, path) if version is None or v == version]
    if not known:
        raise FileNotFoundError(f"no version {'' if version is None else f'{version} '}of a table in {path}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    found = reader.parquet(_data(path, known[-1][1]))
    return found.select(*schema.names) if schema is not None else found


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (),
            options: Callable[[DataFrameWriter], DataFrameWriter] = lambda w: w) -> DataFrame:
    """Write ``df`` as the table's next version and make it current; returns it as read back."""
    spark = df.sparkSession
    known = history(spark, path)
    version = known[-1][0] + 1 if known else 0
    folder = f"v{version:08d}-{uuid.uuid4().hex}"
    writer = options(df.write)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(_data(path, folder))
    commit = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(folder).alias("folder"),
                                   F.current_timestamp().alias("written_at"))
    commit.coalesce(1).write.mode("append").parquet(_log(path))
    return spark.read.schema(df.schema).parquet(_data(path, folder)).select(*df.columns)


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete the data of all but the last ``keep`` versions; readers that still use them must have ended."""
    if keep < 1:
        raise ValueError("the current version stays")
    context = spark.sparkContext
    gone = [folder for _, folder in history(spark, path)[:-keep]]
    for folder in gone:
        place = context._jvm.org.apache.hadoop.fs.Path(_data(path, folder))
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return gone
