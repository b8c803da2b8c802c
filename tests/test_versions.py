"""Replaced tables are whole at every moment; stage tables are clustered by test."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from abspark.config import FIXTURE_CONFIG
from abspark.plans.pipeline import ExperimentPipeline
from abspark.sources import versions
from abspark.sources.tables import derive_from_star_schema


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_a_killed_write_leaves_the_old_rows(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert not versions.exists(spark, path)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    versions.replace(spark.range(10), path)
    bad = spark.range(0, 4000, 1, 8).withColumn("id", F.when(F.col("id") == 3999, F.raise_error(F.lit("killed"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="killed"):
        versions.replace(bad.select(F.col("id").cast("bigint").alias("id")), path)
    assert ids(versions.read(spark, path)) == list(range(10))
    # A writer that died after its data and before its commit.
    spark.range(5).write.parquet(f"{path}/data/v00000001-dead")
    assert ids(versions.read(spark, path)) == list(range(10))
    versions.replace(spark.range(3), path)
    assert ids(versions.read(spark, path)) == [0, 1, 2]


def test_a_table_may_replace_itself_and_older_versions_stay_until_expired(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.replace(spark.range(100), path)
    before = versions.read(spark, path)
    after = versions.replace(versions.read(spark, path).where("id % 2 = 0"), path)
    assert ids(after) == ids(versions.read(spark, path)) == list(range(0, 100, 2))
    assert ids(before) == ids(versions.read(spark, path, version=0)) == list(range(100))
    assert len(versions.expire(spark, path)) == 1
    assert ids(versions.read(spark, path)) == list(range(0, 100, 2))
    assert len(glob.glob(f"{tmp_path}/t/data/v*")) == 1


def test_partitioned_and_empty_tables(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(10).select((F.col("id") % 3).cast("int").alias("day"), "id", F.col("id").cast("string").alias("s"))
    got = versions.replace(df, path, ("day",))
    assert got.dtypes == df.dtypes and sorted(got.collect()) == sorted(df.collect())
    assert got.where("day = 1")._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull(day") == 1
    assert versions.replace(df.limit(0), path).count() == 0
    assert versions.read(spark, path, schema=df.schema).columns == df.columns


def test_stage_tables_are_clustered_by_test(spark, tmp_path):
    """Row groups of the users' table hold few tests each; the result is in its presentation order."""
    pipe = ExperimentPipeline(derive_from_star_schema(spark, "/root/testdata/sf0.01"), FIXTURE_CONFIG, out=str(tmp_path))
    _, sig = pipe.kpis_per_user, pipe.significance_combined
    keys = [*pipe.SORTED["significance_combined"]]
    rows = sig.select(*keys).collect()
    assert rows == sig.select(*keys).orderBy(*keys).collect() and len(sig.inputFiles()) == 1
    # The same layout with small row groups: ranges of (entity, country, test) follow each other in every file.
    path = f"{tmp_path}/small"
    by = pipe.CLUSTERED["kpis_per_user"]
    versions.replace(pipe.kpis_per_user.coalesce(1).sortWithinPartitions(*by), path, options=lambda w: w.option("parquet.block.size", 4096).option("parquet.page.size", 512).option("parquet.page.size.row.check.min", 10).option("parquet.block.size.row.check.min", 10))
    for file in versions.read(spark, path).inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        at = [meta.schema.column(i).path for i in range(meta.num_columns)].index("entity_id")
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        assert len(stats) > 3
        assert all(a.max <= b.min for a, b in zip(stats, stats[1:]))
        last = max(s.max for s in stats)
        assert sum(s.min <= last <= s.max for s in stats) < len(stats)  # a filter on one entity skips groups
