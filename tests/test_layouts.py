"""Layouts and contracts of the sources: pruned partitions, Bloom filters, bucket joins, named errors, rejects."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from abspark.config import FIXTURE_CONFIG
from abspark.operators import relational
from abspark.plans.pipeline import ExperimentPipeline
from abspark.sources import schemas, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    """The first two days of every month: fewer partitions to write."""
    found = tables.derive_from_star_schema(spark, SF)
    day = {"platform_orders": "created_date_utc"}
    return replace(found, **{n: getattr(found, n).where(F.dayofmonth(day.get(n, "created_date")) <= 2) for n in tables.PARTITIONS})


@pytest.fixture(scope="module")
def folder(sources, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("partitioned"))
    tables.write_sources(sources, path, partitioned=True)
    return path


@pytest.fixture
def conf(spark):
    held = {}

    def put(key, value):
        held.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in held.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scans(plan):
    """The file scans of a plan that has run."""
    name = plan.nodeName()
    inner = plan.executedPlan() if name.startswith("AdaptiveSparkPlan") else plan.plan() if "QueryStage" in name else None
    if inner is not None:
        yield from scans(inner)
    if name.startswith("Scan parquet"):
        yield plan
    for i in range(plan.children().size()):
        yield from scans(plan.children().apply(i))


def same(a, b):
    assert a.count() == b.count() and a.exceptAll(b.select(a.columns)).count() == 0


def files_read(df, source):
    df.collect()
    found = [s for s in scans(df._jdf.queryExecution().executedPlan()) if f"/{source}]" in s.simpleString(2000)]
    return [s.metrics().apply("numFiles").value() for s in found]


def test_date_and_entity_partitions_are_pruned(spark, sources, folder, conf):
    conf("spark.sql.maxMetadataStringLength", "4000")
    late = replace(FIXTURE_CONFIG, start_floor="1995-01-05")
    pipe = ExperimentPipeline(tables.from_parquet_dir(spark, folder), FIXTURE_CONFIG)
    plan = pipe.experiment_orders._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "/orders_sessions]" in line)
    filters = scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "created_date" in filters and ">= 1995-01-01" in filters  # static
    assert "dynamicpruning" in filters and "entity_id" in filters  # by the tests' keys
    files = spark.read.parquet(f"{folder}/orders_sessions")
    all_files = len(files.inputFiles())
    # Tests of two entities: the other entities' partitions are not opened.
    keys = spark.createDataFrame([("FP_E0", "c0"), ("TB_E2", "c2")], "entity_id string, country_code string")
    two = relational.key_semi_join(tables.from_parquet_dir(spark, folder).orders_sessions.where("created_date >= '1996-01-01'"), keys,
                                   [("entity_id", "entity_id"), ("country_code", "country_code")])
    kept = files.where("created_date >= '1996-01-01' and entity_id in ('FP_E0', 'TB_E2')").select(F.input_file_name()).distinct().count()
    assert files_read(two, "orders_sessions") == [kept] and 0 < kept < all_files / 2
    # The same rows as from sources that are not partitioned.
    same(pipe.experiment_orders, ExperimentPipeline(sources, FIXTURE_CONFIG).experiment_orders)
    assert ExperimentPipeline(tables.from_parquet_dir(spark, folder), late).valid_experiments.count() >= 0


def test_large_key_sets_filter_the_fact_by_a_bloom_filter(spark, sources, folder, conf, monkeypatch):
    want = ExperimentPipeline(sources, FIXTURE_CONFIG).experiment_orders
    monkeypatch.setattr(relational, "BROADCAST_MAX_BYTES", 0)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    got = ExperimentPipeline(tables.from_parquet_dir(spark, folder), FIXTURE_CONFIG).experiment_orders
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # One filter for each key set, on the hash of the whole tuple, right above the order scan.
    above = next(line for line in plan.splitlines() if "might_contain" in line and "delivery_status" in line)
    assert above.count("might_contain") >= 3 and "xxhash64(entity_id" in above and "variant" in above and "zone_id" in above
    same(got, want)


def test_order_tables_in_buckets_meet_without_a_shuffle(spark, sources, tmp_path, conf):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucket_test LOCATION '{tmp_path}'")
    try:
        tables.write_catalog(sources, "bucket_test", buckets=4)
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = ExperimentPipeline(tables.from_catalog(spark, "bucket_test"), FIXTURE_CONFIG).experiment_orders
        plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
        joins = [line for line in plan if "SortMergeJoin" in line and "platform_order_code" in line]
        assert len(joins) == 2  # warehouse orders, platform orders
        exchanges = [line for line in plan if "Exchange hashpartitioning" in line]
        assert not any("platform_order_code" in line or "__d_code" in line or "__p_code" in line for line in exchanges)
        plain = ExperimentPipeline(sources, FIXTURE_CONFIG).experiment_orders
        assert any("platform_order_code" in line for line in plain._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line)
        same(got, plain)
    finally:
        spark.sql("DROP DATABASE bucket_test CASCADE")


@pytest.mark.parametrize("name", tables.SOURCE_NAMES)
def test_every_source_has_a_contract(spark, sources, name):
    df = getattr(sources, name)
    same(schemas.conform(df.withColumn("more", F.lit(1)), name), df)
    first = schemas.source_schema(name).fieldNames()[0]
    with pytest.raises(schemas.ContractError, match=f"{name}: .*{first} is missing") as e:
        schemas.conform(df.drop(first), name)
    assert e.value.source == name
    with pytest.raises(schemas.ContractError, match=f"{first} is binary"):
        schemas.conform(df.withColumn(first, F.lit(b"x")), name)
    good, bad = schemas.split_rejects(df, name)
    assert bad.count() == 0 and good.count() == df.count()


def test_nested_columns_and_widening(spark):
    df = spark.createDataFrame([("A", ("c", 2.0, 1.0), (3,))], "global_entity_id string, delivery_location struct<note:string,latitude:float,longitude:float>, value struct<mov_customer_fee_local:int>")
    got = schemas.conform(df.withColumn("order_id", F.lit("o")), "warehouse_orders").first()
    assert (got.delivery_location.longitude, got.delivery_location.latitude, got.value.mov_customer_fee_local) == (1.0, 2.0, 3.0)
    with pytest.raises(schemas.ContractError) as e:
        schemas.conform(df.withColumn("delivery_location", F.struct(F.lit("x").alias("latitude"))), "warehouse_orders")
    assert e.value.problems == ["order_id is missing", "delivery_location.longitude is missing", "delivery_location.latitude is string, not double"]


def test_partition_values_that_look_like_numbers_stay_text(spark, sources, tmp_path):
    odd = sources.courier_timings.limit(20).withColumn("entity_id", F.lit("007"))
    path = f"{tmp_path}/courier_timings"
    odd.write.partitionBy(*tables.PARTITIONS["courier_timings"]).parquet(path)
    got = tables._read_source(spark, path, "courier_timings")
    assert {r.entity_id for r in got.collect()} == {"007"}


def test_rows_that_break_rules_are_set_apart(spark, sources, tmp_path):
    from abspark.plans.run import run, variant_folder
    from abspark.sources import versions

    o = sources.orders_sessions
    broken = o.limit(3).withColumn("entity_id", F.lit(None).cast("string")).unionByName(
        o.limit(2).withColumn("gfv_local", F.lit(float("nan"))))
    path = f"{tmp_path}/sources"
    tables.write_sources(replace(sources, orders_sessions=o.unionByName(broken)), path)
    run(spark, f"{tmp_path}/out", sources=path, cfg=FIXTURE_CONFIG, set_apart=True)
    folder = variant_folder(f"{tmp_path}/out", FIXTURE_CONFIG)
    rejects = versions.read(spark, f"{folder}/rejects/orders_sessions").collect()
    assert sorted(len(r.broken_rules) for r in rejects) == [1] * 5
    assert sum("gfv_local" in r.broken_rules[0] for r in rejects) == 2
    assert versions.read(spark, f"{folder}/rejects/vendors").count() == 0
    same(versions.read(spark, f"{folder}/tables/clean_orders"), ExperimentPipeline(sources, FIXTURE_CONFIG).clean_orders)
