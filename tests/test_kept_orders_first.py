"""Orders that a step leaves out are left out before they meet other facts."""

import re

import pytest

from abspark.config import FIXTURE_CONFIG, PipelineConfig
from abspark.operators import orders
from abspark.plans.pipeline import ExperimentPipeline
from abspark.plans.registry import ALL_VERTICALS, EXACT_SCHEME, MULTI_VERTICAL
from abspark.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    return tables.derive_from_star_schema(spark, SF)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def depth(line):
    return len(re.match(r"[ :+\-]*", line).group())


def same(a, b):
    assert a.dtypes == b.dtypes and a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_kept_orders_are_found_before_the_warehouse_join(sources):
    lines = optimized(ExperimentPipeline(sources, FIXTURE_CONFIG, stage=False).clean_orders)
    warehouse = next(depth(x) for x in lines if "Join Inner" in x and "__d_code" in x)
    assert [x for x in lines if "Filter" in x and "LIKE concat" in x and depth(x) > warehouse]
    # The tests' parent verticals too: their key set is met below that join.
    assert [x for x in lines if "Join LeftSemi" in x and "__parent" in x and depth(x) > warehouse]


@pytest.mark.parametrize("cfg", [FIXTURE_CONFIG, ALL_VERTICALS, MULTI_VERTICAL, EXACT_SCHEME])
def test_orders_left_out_early_are_those_left_out_late(sources, cfg: PipelineConfig):
    p = ExperimentPipeline(sources, cfg)
    late = orders.with_profit(p.experiment_orders, p.ordered_groups, cfg)
    same(p.order_profit, late)
    same(p.clean_orders.select(*late.columns), orders.clean_orders(late))
    assert p.experiment_orders.count() > late.count()
