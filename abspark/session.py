"""Spark session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "abspark") -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A scratch folder is made only for a local master (tests) that sets none;
    on a cluster a machine-local folder would lose rows, so that is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not context.getCheckpointDir():
            context.setCheckpointDir(current)
        return current
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="abspark-ckpt-")
    context.setCheckpointDir(path)
    return path


# HotSpot never compiles a method of more bytes: a stage whose generated code is longer
# would be interpreted row by row.  Beyond it Spark runs the stage's operators one by one,
# their expressions split into methods that are compiled.
COMPILED_METHOD_BYTES = "8000"


def limit_methods(spark: SparkSession) -> None:
    """Generated stages only up to the size that the JVM compiles (wide derived orders, great-circle zones)."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD_BYTES)


# More shuffle partitions than this cost the driver more in map-output
# bookkeeping than they save; AQE splits what is still too large.
MAX_SHUFFLE_PARTITIONS = 20_000


def scale_conf(shuffled_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster run, sized from the largest shuffle.

    ``shuffled_bytes`` is the volume of the largest shuffle, i.e. of the
    reduced order or session fact after its filters and column pruning, not
    of the raw tables.  Shuffle partitions target ``target_partition_bytes``
    each, within 200 .. MAX_SHUFFLE_PARTITIONS; AQE coalesces small
    partitions and splits skewed ones at runtime.  The session time zone is
    UTC: dates are taken from timestamps.  The broadcast threshold is left at
    Spark's default because the pipeline checks the sizes of the sides it
    broadcasts itself.
    """
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(200, shuffled_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.codegen.hugeMethodLimit": COMPILED_METHOD_BYTES,
        # Key sets too large to broadcast: a Bloom filter of up to 16 MB on the fact's scan.
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4g",
        "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "10000000",
        "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "10000000",
        "spark.sql.optimizer.runtime.bloomFilter.numBits": str(1 << 27),
        "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 27),
        "spark.sql.session.timeZone": "UTC",
    }
