"""Setups that a fact never names do not meet it, and order steps derive no sessions."""

import pytest

from abspark.config import FIXTURE_CONFIG
from abspark.operators import orders, relational
from abspark.plans import pipeline as module
from abspark.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    return tables.derive_from_star_schema(spark, SF)


def same(a, b):
    assert a.count() == b.count() > 0 and a.exceptAll(b.select(a.columns)).count() == 0


def test_setups_that_no_fact_names_are_left_out(spark, sources, monkeypatch):
    plain = module.ExperimentPipeline(sources, FIXTURE_CONFIG)
    assert not plain.many_setups
    monkeypatch.setattr(module, "SETUP_PARTS", 1 << 40)  # every size counts as many
    few = module.ExperimentPipeline(sources, FIXTURE_CONFIG)
    assert few.many_setups
    # The supplier tests and their zones: no order and no session is of them.
    named = {(r.entity_id, r.test_id) for r in sources.orders_sessions.selectExpr("entity_id", "experiment_id as test_id").distinct().collect()}
    every = {(r.entity_id, r.test_id) for r in few.target_groups.collect()}
    assert every - named
    for table in (few.ordered_groups, few.ordered_schemes, few.zone_grid, few.visited_groups, few.visited_schemes, few.visited_geography):
        tests = {(r.entity_id, r.test_id) for r in table.select("entity_id", "test_id").collect()}
        assert tests and not tests & (every - named)
    shapes = few.zone_grid.select("shape_id").distinct().count()
    assert few.zone_cover.select("shape_id").distinct().count() == shapes < plain.zone_cover.select("shape_id").distinct().count()
    for step in ("experiment_orders", "clean_orders", "experiment_sessions_stg", "users_per_test", "kpis_per_user"):
        same(getattr(few, step), getattr(plain, step))
    same(*(orders.orders_in_zone(p.src.orders_sessions, p.zone_grid, p.zone_cover, p.src.warehouse_orders) for p in (few, plain)))


def test_order_steps_derive_no_sessions(spark, monkeypatch):
    derived = []
    inner = tables.flat_views
    monkeypatch.setattr(tables, "flat_views", lambda spark, sf, only=None: derived.extend(only) or inner(spark, sf, only))
    src = tables.derive_from_star_schema(spark, SF)
    assert module.ExperimentPipeline(src, FIXTURE_CONFIG).clean_orders.count() > 0
    assert "f_orders" in derived and "f_sessions" not in derived
    assert src.ga_sessions.count() > 0 and src.ga_sessions is src.ga_sessions and derived.count("f_sessions") == 1


def test_joins_of_the_orders_sort_by_the_key_of_many_values_first(spark, sources):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = module.ExperimentPipeline(sources, FIXTURE_CONFIG)
        lines = p.experiment_orders._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    sorts = [line.split("Sort [")[1] for line in lines if " Sort [" in line]
    assert sum(s.startswith(("platform_order_code", "__d_code", "code", "order_id", "__p_code")) for s in sorts) >= 5, sorts
    assert not any(s.startswith(("entity_id", "__null_salt", "__d_entity", "__p_entity")) for s in sorts), sorts
    left = spark.createDataFrame([(1, "a")], "k long, v string")
    joined = relational.left_join_spread_null_keys(left, spark.createDataFrame([(1, 2)], "r long, w long"), [("k", "r")])
    assert joined.count() == 1
