"""Events without a vendor do not meet in one task."""

import re

import pytest
from pyspark.sql import functions as F

from abspark.config import FIXTURE_CONFIG
from abspark.operators import sessions
from abspark.plans.pipeline import ExperimentPipeline
from abspark.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    return tables.derive_from_star_schema(spark, SF)


def test_events_without_vendor_are_spread(spark, sources, monkeypatch):
    p = ExperimentPipeline(sources, FIXTURE_CONFIG)
    found = p.experiment_sessions_stg
    assert found.where("vendor_code is null").count() > 0
    monkeypatch.setattr(sessions, "broadcast_if_small", lambda df: df)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = sessions.session_events(sources.ga_sessions, p.visited_geography, p.visited_groups, p.visited_schemes, FIXTURE_CONFIG)
        plan = big.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert re.search(r"Exchange hashpartitioning\(vendor_code#\d+, .*__null_salt", plan)
    same(found, big.select(*found.columns))
    assert found.where(F.col("vendor_code").isNull() & (F.col("target_group") != "Unknown")).isEmpty()
