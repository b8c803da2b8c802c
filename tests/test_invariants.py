"""Invariants of the pipeline on sf0.01."""

import pytest
from pyspark.sql import functions as F

from abspark.operators import questions
from abspark.plans import registry
from abspark.sources import versions

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pipe(spark):
    return registry.pipeline(spark, SF)


def test_clean_is_subset_of_augmented(pipe):
    keys = ["entity_id", "test_id", "order_id", "vendor_id", "perseus_client_id"]
    assert pipe.clean_orders.select(keys).subtract(pipe.order_profit.select(keys)).count() == 0
    assert pipe.clean_orders.where("keep_drop_flag <> 'Keep'").count() == 0


def test_one_variant_per_user(pipe):
    per_user = pipe.kpis_per_user.groupBy("entity_id", "country_code", "test_id", "perseus_client_id").agg(
        F.count_distinct("variant").alias("n"))
    assert per_user.where("n > 1").count() == 0
    assert pipe.kpis_per_user.where("target_group = 'Unknown'").count() == 0


def test_bins_sum_to_rows(pipe):
    rows = questions.records_in_treatment(pipe)
    in_range = rows.where("perc_in_treatment > 0 AND perc_in_treatment <= 1").count()
    total = questions.records_in_treatment_bins(pipe).agg(F.sum("freq")).first()[0]
    assert total == in_range


def test_share_gate_applied(pipe):
    assert pipe.significance_combined.where("perc_treatment_orders <= 0.01").count() == 0
    assert set(r.granularity for r in pipe.significance_combined.select("granularity").distinct().collect()) <= {
        "exp", "ts"}


def test_one_pass_statistics_equal_per_granularity(pipe):
    from abspark.operators import stats

    both = stats.significance_both(stats.kpi_histogram(pipe.gated_kpis_exp), pipe.cfg)
    for g, src in (("exp", pipe.gated_kpis_exp), ("ts", pipe.gated_kpis_ts)):
        one = stats.significance(src, g, pipe.cfg)
        a = both.where(F.col("granularity") == g)
        assert a.exceptAll(one).count() == 0 and one.exceptAll(a).count() == 0


def _read(spark, folder, name):
    return versions.read(spark, f"{folder}/tables/{name}")


def test_runner_on_uris_writes_both_variants_side_by_side(spark, tmp_path):
    from dataclasses import replace

    from abspark.config import FIXTURE_CONFIG
    from abspark.plans.pipeline import ExperimentPipeline
    from abspark.plans.run import QUESTIONS, run, variant_folder
    from abspark.sources.tables import derive_from_star_schema, write_sources

    sources, out = f"file://{tmp_path}/sources", f"file://{tmp_path}/out"
    write_sources(derive_from_star_schema(spark, "/root/testdata/sf0.001"), sources)
    for cfg in (FIXTURE_CONFIG, replace(FIXTURE_CONFIG, sub_vertical_filter=False)):
        run(spark, out, sources=sources, cfg=cfg)
        folder = variant_folder(out, cfg)
        kpis = _read(spark, folder, "kpis_per_user")
        assert kpis.columns[-1] == "data_pull_timestamp" and kpis.where("data_pull_timestamp is null").count() == 0
        for name in ExperimentPipeline.STAGE_TABLES:
            _read(spark, folder, name)
        for q in QUESTIONS:
            versions.read(spark, f"{folder}/questions/{q}")
        bins = versions.read(spark, f"{folder}/questions/treatment_share_bins").collect()
        assert [r.bin for r in bins] == list(range(1, 21))
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_each_fact_is_scanned_once_in_a_whole_run(spark, tmp_path, monkeypatch):
    from abspark.config import FIXTURE_CONFIG
    from abspark.plans import pipeline as module
    from abspark.sources.tables import derive_from_star_schema, from_parquet_dir, write_sources

    sources = f"{tmp_path}/sources"
    write_sources(derive_from_star_schema(spark, "/root/testdata/sf0.001"), sources)
    scans = {"orders_sessions": 0, "ga_sessions": 0, "warehouse_orders": 0, "courier_timings": 0}
    stage = module.ExperimentPipeline._stage

    def counted(self, df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        if name in self.STAGE_TABLES:
            for fact in scans:
                scans[fact] += plan.count(f"{sources}/{fact}]")
        return stage(self, df, name)

    monkeypatch.setattr(module.ExperimentPipeline, "_stage", counted)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    module.ExperimentPipeline(from_parquet_dir(spark, sources), FIXTURE_CONFIG, out=f"{tmp_path}/out").write()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert scans == {"orders_sessions": 1, "ga_sessions": 1, "warehouse_orders": 1, "courier_timings": 1}


def test_catalog_tables_are_sources(spark, tmp_path):
    from abspark.sources.tables import SOURCE_NAMES, derive_from_star_schema, from_catalog

    src = derive_from_star_schema(spark, "/root/testdata/sf0.001").as_dict()
    for name in SOURCE_NAMES:
        src[name].limit(3).createOrReplaceTempView(f"cat_{name}")
        spark.catalog.tableExists(f"cat_{name}")
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_test LOCATION '%s'" % tmp_path)
    src["entities"].write.mode("overwrite").saveAsTable("shop_test.entities_v2")
    for name in SOURCE_NAMES:
        if name != "entities":
            src[name].limit(1).write.mode("overwrite").saveAsTable(f"shop_test.{name}")
    got = from_catalog(spark, "shop_test", {"entities": "entities_v2"})
    assert got.entities.count() == src["entities"].count() and got.vendors.count() == 1
    spark.sql("DROP DATABASE shop_test CASCADE")


def test_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest as pt

    from abspark.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pt.raises(ValueError, match="checkpoint"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))
