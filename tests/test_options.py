"""The three options that change the study's behaviour (off by default)."""

from dataclasses import replace

from pyspark.sql import functions as F

from abspark.config import FIXTURE_CONFIG
from abspark.plans.pipeline import ExperimentPipeline
from abspark.sources.tables import derive_from_star_schema

SF = "/root/testdata/sf0.001"
KEY = ["entity_id", "test_id", "order_id", "vendor_id", "perseus_client_id", "platform_order_code"]


def test_exact_scheme_match_tells_12_from_123(spark):
    # entity 3, test 0 lists scheme 123 where orders carry 12: LIKE keeps them, exact does not
    src = derive_from_star_schema(spark, SF)
    like = ExperimentPipeline(src, FIXTURE_CONFIG).experiment_orders
    exact = ExperimentPipeline(src, replace(FIXTURE_CONFIG, exact_scheme_match=True)).experiment_orders
    a = like.where("keep_drop_flag = 'Keep'").select(*KEY, "scheme_id", "variant")
    b = exact.where("keep_drop_flag = 'Keep'").select(*KEY, "scheme_id", "variant")
    assert b.exceptAll(a).count() == 0
    only = a.exceptAll(b).select("test_id", "scheme_id", "variant").distinct().collect()
    assert [tuple(r) for r in only] == [(30, 12, "Variation2")]


def test_fix_profit_fallback_fills_missing_fee(spark):
    src = derive_from_star_schema(spark, SF)
    base = ExperimentPipeline(src, FIXTURE_CONFIG).order_profit
    fixed = ExperimentPipeline(src, replace(FIXTURE_CONFIG, fix_profit_fallback=True)).order_profit
    no_fee = (F.col("sof_local_cdwh").isNull()) & F.col("delivery_costs_local").isNotNull()
    assert base.where(no_fee).count() > 0
    assert base.where(no_fee & F.col("gross_profit_local").isNotNull()).count() == 0   # the study's NULL
    assert fixed.where(no_fee & F.col("gross_profit_local").isNull()).count() == 0     # filled by the fix
    # rows that have the fee are unchanged (compared as multisets: order rows repeat)
    a = base.where(F.col("sof_local_cdwh").isNotNull()).select(*KEY, "gross_profit_local")
    b = fixed.where(F.col("sof_local_cdwh").isNotNull()).select(*KEY, "gross_profit_local")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
