"""User-grain operators: users per test, KPIs per user, share of treatment orders.

``kpis_per_user`` joins users to orders on six keys and groups by the user
row.  Because every user row is distinct and the join keys are part of it,
the per-user KPIs are exactly the aggregates of the orders that share the six
keys.  So orders are aggregated to that grain first (map-side partial
aggregation, one row per client x test x group x variant) and only then
joined: the big side of the join shrinks from orders to clients.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abspark.config import PipelineConfig
from abspark.functions.columns import NON_TG, UNKNOWN_TG, round_half_away
from abspark.operators.relational import broadcast_if_small, left_join_spread_null_keys
from abspark.sources.schemas import KPIS_PER_USER, apply_contract

USER_COLS = ["entity_id", "country_code", "test_id", "test_name", "test_start_date", "test_end_date",
             "test_length", "first_parent_vertical", "second_parent_vertical", "perseus_client_id", "variant",
             "target_group", "session_in_treatment_flag"]
ORDER_KEYS = ["entity_id", "country_code", "test_id", "perseus_client_id", "target_group", "variant"]
TEST_KEYS = ["entity_id", "country_code", "test_id"]


def users_per_test(sessions_with_flag: DataFrame, tg: DataFrame) -> DataFrame:
    users = sessions_with_flag.select(
        "entity_id", "country_code", "test_id", "perseus_client_id", "variant", "target_group",
        "session_in_treatment_flag").distinct()
    tests = tg.select(
        *TEST_KEYS, "test_name", "test_start_date", "test_end_date",
        F.datediff(F.to_date("test_end_date"), F.to_date("test_start_date")).cast("bigint").alias("test_length"),
        "first_parent_vertical", "second_parent_vertical").distinct()
    # distinct users x distinct tests: the join output is already distinct.
    return users.join(broadcast_if_small(tests), TEST_KEYS, "left").select(*USER_COLS)


USER_KEYS = ["entity_id", "country_code", "test_id", "perseus_client_id"]


def first_variant_rows(users: DataFrame) -> DataFrame:
    """Rows of each user's first variant (sorted, NULL first): ``dense_rank() ... = 1`` without a window.

    The first variant per user is an aggregate (``min`` over (has variant,
    variant), so a NULL variant sorts first), joined back NULL-safely: users
    whose id is NULL form one group, as in the study's window, but here that
    group is a partial aggregate and a skewed join partition AQE can split,
    not one window partition in one task.
    """
    first = users.groupBy(*USER_KEYS).agg(
        F.min(F.struct(F.col("variant").isNotNull().alias("has"), F.col("variant").alias("v"))).alias("__first"))
    first = first.select(*[F.col(k).alias(f"__f_{k}") for k in USER_KEYS], F.col("__first.v").alias("__f_variant"))
    cond = F.col("variant").eqNullSafe(F.col("__f_variant"))
    for k in USER_KEYS:
        cond = cond & users[k].eqNullSafe(first[f"__f_{k}"])
    return users.join(first, cond, "left_semi")


def kpis_per_user(users: DataFrame, clean_orders: DataFrame) -> DataFrame:
    """Orders, revenue and profit per user row, on each user's first variant only."""
    u = users.where(F.col("target_group") != UNKNOWN_TG)
    u = first_variant_rows(u)
    per_key = clean_orders.groupBy(*ORDER_KEYS).agg(
        F.count_distinct("order_id").alias("__orders"),
        F.sum("revenue_local").alias("__revenue"),
        F.sum("gross_profit_local").alias("__profit"),
    )
    per_key = per_key.select(*[F.col(k).alias(f"__o_{k}") for k in ORDER_KEYS], "__orders", "__revenue", "__profit")
    j = left_join_spread_null_keys(u, per_key, [(k, f"__o_{k}") for k in ("perseus_client_id", *(k for k in ORDER_KEYS if k != "perseus_client_id"))],
                                   spread_by=("session_in_treatment_flag",))
    return apply_contract(j.select(
        *USER_COLS,
        F.coalesce(F.col("__orders"), F.lit(0)).cast("bigint").alias("order_count_per_user"),
        F.coalesce(round_half_away("__revenue", 2), F.lit(0.0)).alias("revenue_per_user"),
        F.coalesce(round_half_away("__profit", 2), F.lit(0.0)).alias("profit_per_user"),
    ), KPIS_PER_USER)


def treatment_order_share(clean_orders: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Share of a test's distinct orders that came from target-group vendors (kept if > gate)."""
    treated = F.count_distinct(F.when(F.col("target_group") != NON_TG, F.col("order_id")))
    total = F.count_distinct("order_id")
    share = round_half_away(treated.cast("double") / F.nullif(total, F.lit(0)).cast("double"), 4)
    return clean_orders.groupBy(*TEST_KEYS).agg(share.alias("perc_treatment_orders")).where(
        F.col("perc_treatment_orders") > F.lit(cfg.share_gate))


def gate_by_share(kpis: DataFrame, share: DataFrame) -> DataFrame:
    return kpis.join(broadcast_if_small(share), TEST_KEYS, "inner")
