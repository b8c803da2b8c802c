"""The derived orders are computed from their joined lines; what they meet is reduced to the entities that count."""

import pytest
from pyspark.sql import functions as F

from abspark.config import FIXTURE_CONFIG
from abspark.operators import orders, relational
from abspark.sources import fixtures, tables

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert a.dtypes == b.dtypes and a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_orders_of_lines_are_the_view_and_keep_only_what_it_names(spark):
    got = tables.flat_views(spark, SF, ("f_orders",))
    frames = tables.read_star_schema(spark, SF) | {"f_entities": spark.sql(fixtures.F_ENTITIES)}
    same(got["f_orders"], spark.sql(fixtures.F_ORDERS, **{k: v for k, v in frames.items() if "{" + k + "}" in fixtures.F_ORDERS}))
    assert len(got["order_lines"].columns) < len(got["f_orders"].columns) / 2
    assert fixtures.ORDER_LINES in dict(fixtures.FLAT_VIEWS)["f_orders"]


def test_stages_too_long_for_the_compiler_are_not_generated(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    tables.flat_views(spark, SF, ("f_entities",))
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000


def shuffles(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_costs_are_shuffled_once_up_to_the_orders(spark, no_broadcast):
    courier = spark.createDataFrame(
        [("E", "c", 1, 2.0, 1.0), ("E", "c", 1, 3.0, 1.5), ("E", "c", None, 9.0, 9.0), (None, "c", 1, 9.0, 9.0), ("E", "d", 2, 1.0, 1.0), ("E", None, 3, 4.0, 4.0)],
        "entity_id string, country_code string, order_id long, costs double, costs_eur double").withColumn("created_date", F.current_date())
    bridge = spark.createDataFrame([("E", 1, "a"), ("E", 2, "b"), ("E", 2, "c"), ("E", 3, "d"), ("E", None, "e"), (None, 1, "f")], "e string, order_id long, platform_order_code string")
    bridge = bridge.select(F.struct(F.col("e").alias("id")).alias("entity"), "order_id", "platform_order_code", F.current_date().alias("created_date"))
    costs = orders.delivery_costs(courier, bridge, FIXTURE_CONFIG)
    assert sorted((r.order_id, r.platform_order_code, r.delivery_costs_local) for r in costs.collect()) == [
        (1, "a", 5.0), (2, "b", 1.0), (2, "c", 1.0), (3, "d", 4.0)]
    assert shuffles(costs) == 2
    facts = [(1, "E", "c"), (2, "E", "d"), (2, "E", "c"), (None, "E", "c"), (3, "E", None), (-5, "E", "c"), (1, None, "c")] + [(None, None, None)] * 500
    left = spark.createDataFrame(facts, "order_id long, entity_id string, country_code string").withColumn("row", F.monotonically_increasing_id())
    right = costs.select(F.col("order_id").alias("o"), F.col("entity_id").alias("e"), F.col("country_code").alias("c"), "delivery_costs_local")
    joined = relational.left_join_on_leading_keys(left, right, [("order_id", "o"), ("entity_id", "e")], [("country_code", "c")], spread_by=["row"])
    assert shuffles(joined) == 3
    plain = left.join(right, (left.order_id == right.o) & (left.entity_id == right.e) & (left.country_code == right.c), "left")
    same(joined, plain)
    assert joined.where("o is not null").count() == 3
    # No number that stands for a missing key meets a real order of that number.
    real = spark.createDataFrame([(-k, "", "x") for k in range(1, 300)] + [(-k, "E", "c") for k in range(1, 300)], "o long, e string, c string")
    assert relational.left_join_on_leading_keys(left.where("order_id is null or entity_id is null"), real, [("order_id", "o"), ("entity_id", "e")],
                                                [("country_code", "c")], spread_by=["row"]).where("o is not null").isEmpty()


def test_orders_meet_only_rows_of_entities_that_count(spark):
    src = tables.derive_from_star_schema(spark, SF)
    from abspark.plans.pipeline import ExperimentPipeline
    p = ExperimentPipeline(src, FIXTURE_CONFIG)
    known = {r[0] for r in orders.order_entities(src.entities, p.variant_schemes).collect()}
    assert known == {"FP_E0", "FP_E1", "TB_E2", "HS_E3"}
    assert {r[0] for r in p.order_costs.select("entity_id").distinct().collect()} == known
    assert {r[0] for r in p.delivery_costs.select("entity_id").distinct().collect()} > known
