"""Physical-plan checks on the pipeline read from parquet sources."""

import pytest

from abspark.config import FIXTURE_CONFIG
from abspark.plans.pipeline import ExperimentPipeline
from abspark.sources.tables import derive_from_star_schema, from_parquet_dir, write_sources

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipe(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sources"))
    write_sources(derive_from_star_schema(spark, SF), path)
    return ExperimentPipeline(from_parquet_dir(spark, path), FIXTURE_CONFIG, stage=False)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", ["clean_orders", "sessions_with_flag", "kpis_per_user", "significance_combined"])
def test_no_cartesian_or_nested_loop(pipe, step):
    plan = _plan(getattr(pipe, step))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_order_scan(pipe):
    plan = _plan(pipe.clean_orders)
    scans = [line for line in plan.splitlines() if "orders_sessions" in line and "PushedFilters" in line]
    assert scans, plan
    # IsNotNull(delivery_status) is inferred from the pushed delivery_status = 'completed'
    assert any("IsNotNull(delivery_status)" in s and "GreaterThanOrEqual(created_date" in s for s in scans)


def test_statistics_run_no_python(pipe):
    plan = _plan(pipe.significance_exp)
    assert "EvalPython" not in plan and "InPandas" not in plan


def test_no_shuffle_of_a_fact_carries_a_polygon(pipe):
    from abspark.operators import orders

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString().splitlines()

    lines = plan_of(orders.experiment_orders(
        pipe.src, pipe.target_groups, pipe.variant_schemes, pipe.variant_scheme_concat, pipe.zone_grid,
        pipe.zone_cover, pipe.experiment_zones, pipe.delivery_costs, pipe.cfg))
    lines += plan_of(orders.orders_in_zone(pipe.src.orders_sessions, pipe.zone_grid, pipe.zone_cover, pipe.src.warehouse_orders))
    # The cell index decides: an equi-join on (shape, cell).
    assert any("HashJoin" in line and "__cell" in line and "shape_id" in line for line in lines)
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and "platform_order_code" in line or "__null_salt" in line:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            assert "zone_shape" not in line and "zone_shape" not in below.split("Filter")[0], below


def test_statistics_scan_the_kpi_table_once(pipe):
    from abspark.operators import stats

    plan = _plan(stats.kpi_histogram(pipe.gated_kpis_exp))
    assert plan.count("orders_sessions") == _plan(pipe.kpis_per_user).count("orders_sessions") + _plan(
        pipe.treatment_order_share).count("orders_sessions")


def test_a_derived_order_table_is_shuffled_once_for_its_join(spark):
    """Its distinct rows are found in the partitions that the join needs."""
    src = derive_from_star_schema(spark, SF)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, d, p = src.orders_sessions, src.warehouse_orders, src.platform_orders
        met = a.join(d, (a.entity_id == d.global_entity_id) & (a.platform_order_code == d.order_id))
        assert _plan(met).count("Exchange hashpartitioning") == 2
        met = a.join(p, (a.entity_id == p.global_entity_id) & (a.platform_order_code == p.code))
        assert _plan(met).count("Exchange hashpartitioning") == 2
        o = src.logistics_orders.selectExpr("entity.id as e", "order_id as o")
        met = a.join(o, (a.entity_id == o.e) & (a.order_id == o.o))
        assert _plan(met).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
