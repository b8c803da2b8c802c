"""Order-side operators: delivery costs, orders in test zones, revenue/profit, cleaning.

Plan shape for the big fact (``orders_sessions``): every cheap row filter and
every semi-join against a small key table (variants, tests, vertical types,
test zones) runs first, on the columns that are used later, so the fact is
reduced and narrow before it meets the other big tables.  The warehouse join
(big, keyed by entity + order code) brings the delivery point; only then does
the zone's cell index decide (:mod:`abspark.operators.zone_cover`), and the
point is dropped at once.  Platform orders are joined before that, in the same
partitioning; then comes the left join to delivery costs.  The lookups that
decide whether an order is kept precede all of these joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abspark.config import PipelineConfig
from abspark.functions.columns import NON_TG, normalize_vertical
from abspark.operators.relational import broadcast_if_small, key_flag, key_semi_join, left_join_on_leading_keys
from abspark.operators.zone_cover import ZONE_KEY, locate
from abspark.sources.tables import SourceTables

# Entity exclusion rules and the regions whose delivery fee
# comes from the platform-orders table.
EXCLUDED_ENTITY_PATTERNS = ("ODR%", "DN_%")
EXCLUDED_ENTITIES = ("FP_DE", "FP_JP", "TB_SA", "HS_BH")
PLATFORM_FEE_REGIONS = ("Europe", "Asia")


# Columns of the order fact that any later step reads.
ORDER_COLUMNS = (
    "created_date", "order_placed_at", "region", "entity_id", "country_code", "city_name", "city_id", "zone_name",
    "zone_id", "variant", "experiment_id", "perseus_client_id", "ga_session_id", "dps_sessionid", "dps_customer_tag",
    "order_id", "platform_order_code", "scheme_id", "vendor_price_scheme_type", "vendor_id", "chain_id", "chain_name",
    "vertical_type", "vendor_vertical_parent", "delivery_status", "is_own_delivery", "exchange_rate",
    "dps_delivery_fee_local", "delivery_fee_local", "commission_local", "joker_vendor_fee_local", "service_fee",
    "gfv_local", "dps_minimum_order_value_local", "is_delivery_fee_covered_by_discount",
    "is_delivery_fee_covered_by_voucher",
)


def _residual_eq(left, right):
    """``left = right`` kept out of the join keys (NULL never matches, as with a key)."""
    return F.coalesce(left == right, F.lit(False))


def _floor(cfg: PipelineConfig):
    return F.lit(cfg.start_floor).cast("date")


def delivery_costs(courier_timings: DataFrame, logistics_orders: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Delivery cost per order: courier cost rows summed per order, then bridged to the order code.

    The courier rows are dealt by the bridge's key before they are summed, so that one
    shuffle serves both (an order has few courier rows: summing them first saves little).
    Rows without such a key reach no order code.
    """
    p = (courier_timings.where((F.col("created_date") >= _floor(cfg)) & F.col("order_id").isNotNull() & F.col("entity_id").isNotNull())
         .select("entity_id", "country_code", "order_id", "costs", "costs_eur").repartition("order_id", "entity_id")
         .groupBy("entity_id", "country_code", "order_id")
         .agg(F.sum("costs").alias("__costs"), F.sum("costs_eur").alias("__costs_eur")))
    o = logistics_orders.where(F.col("created_date") >= _floor(cfg)).select(
        F.col("entity.id").alias("__o_entity"), F.col("order_id").alias("__o_order"), "platform_order_code")
    j = p.join(o, (p.order_id == o.__o_order) & (p.entity_id == o.__o_entity), "inner")
    # An order bridged by several rows counts its costs once for each, as in the study.
    return j.groupBy("entity_id", "country_code", "order_id", "platform_order_code").agg(
        F.sum("__costs").alias("delivery_costs_local"), F.sum("__costs_eur").alias("delivery_costs_eur"))


def platform_entities(entities: DataFrame) -> DataFrame:
    """Platform entities with their region, minus the excluded entity ids."""
    ent = entities.select("region", "country_iso", "country_name", F.explode_outer("platforms").alias("p")).select(
        "region", F.col("p.entity_id").alias("entity_id"), "country_iso", "country_name")
    cond = ~F.col("entity_id").isin(*EXCLUDED_ENTITIES)
    for pattern in EXCLUDED_ENTITY_PATTERNS:
        cond = cond & ~F.col("entity_id").like(pattern)
    return ent.where(cond)


def order_entities(entities: DataFrame, schemes: DataFrame) -> DataFrame:
    """The entities whose orders can reach the result: platform entities that have a test variant."""
    return key_semi_join(platform_entities(entities).select("entity_id").distinct(), schemes, [("entity_id", "entity_id")])


def orders_in_zone(orders_sessions: DataFrame, grid: DataFrame, cover: DataFrame, warehouse_orders: DataFrame,
                   geodesic: bool = False) -> DataFrame:
    """Spatial join: each order of a test zone with its delivery point, and whether that lies in the zone.

    Orders meet the warehouse on the order code first; the zones come to them
    as grids and cover cells, so no outline is shuffled.
    """
    a = orders_sessions.select("entity_id", "country_code", "zone_id", F.col("experiment_id").alias("test_id"),
                               "order_id", "platform_order_code")
    a = key_semi_join(a, grid, [(c, c) for c in ZONE_KEY])
    d = warehouse_orders.select(
        F.col("global_entity_id").alias("__d_entity"), F.col("order_id").alias("__d_code"),
        F.col("delivery_location.longitude").alias("longitude"), F.col("delivery_location.latitude").alias("latitude"))
    j = a.join(d, (a.platform_order_code == d.__d_code) & (a.entity_id == d.__d_entity), "inner")
    j = j.select(*ZONE_KEY, "order_id", "longitude", "latitude")
    return locate(j, grid, cover, {c: c for c in ZONE_KEY}, "longitude", "latitude", geodesic, keep_outside=True)


def experiment_orders(src: SourceTables, tg: DataFrame, schemes: DataFrame, scheme_concat: DataFrame,
                      grid: DataFrame, cover: DataFrame, zones: DataFrame, costs: DataFrame,
                      cfg: PipelineConfig, of_test_parents: bool = False) -> DataFrame:
    """Completed orders of valid test variants, inside a test zone, with fee components and keep/drop flag.

    ``of_test_parents`` leaves out at once the orders that :func:`with_profit` leaves out.
    Every table that the orders meet is looked up by entity: rows of entities that the
    last join (platform entities) or the first (test variants) drops are left out of all.
    """
    known = order_entities(src.entities, schemes)
    a = src.orders_sessions.where(
        (F.col("created_date") >= _floor(cfg)) & (F.col("delivery_status") == "completed"))
    a = key_semi_join(a, known, [("entity_id", "entity_id")])
    a = key_semi_join(a, schemes, [("entity_id", "entity_id"), ("country_code", "country_code"),
                                   ("experiment_id", "test_id"), ("variant", "variant")])
    test_key = [("entity_id", "entity_id"), ("country_code", "country_code"), ("experiment_id", "test_id")]
    if cfg.sub_vertical_filter:
        # (test, vertical type) in the target groups implies test in the target
        # groups, so this one semi-join also applies the test filter.
        a = key_semi_join(a, tg, test_key + [("vertical_type", "vertical_type")])
    else:
        a = key_semi_join(a, tg, test_key)

    a = key_semi_join(a, grid, test_key + [("zone_id", "zone_id")])
    if of_test_parents:
        a = key_semi_join(a.withColumn("__parent", normalize_vertical("vendor_vertical_parent")), parent_verticals(tg),
                          test_key + [("__parent", "pv")])
    # What decides whether an order is kept comes before the joins with other facts: a step that reads
    # kept orders only has its filter here, and no other order is shuffled.
    t = broadcast_if_small(tg.select(F.col("entity_id").alias("__t_entity"), F.col("vendor_code").alias("__t_vendor"),
                                     F.col("test_id").alias("__t_test"), "tg_name", "parent_vertical_concat"))
    a = a.join(t, (a.entity_id == t.__t_entity) & (a.vendor_id == t.__t_vendor) & (a.experiment_id == t.__t_test),
               "left")
    vs = broadcast_if_small(scheme_concat.select(F.col("entity_id").alias("__v_entity"), F.col("country_code").alias("__v_country"),
                              F.col("test_id").alias("__v_test"), "tg_var_scheme_concat"))
    a = a.join(vs, (a.entity_id == vs.__v_entity) & (a.country_code == vs.__v_country)
               & (a.experiment_id == vs.__v_test), "left")
    target_group = F.coalesce(F.col("tg_name"), F.lit(NON_TG))
    if cfg.exact_scheme_match:
        keys = schemes.select("entity_id", "country_code", "test_id", "target_group", "variant", "price_scheme_id")
        a = a.withColumn("__tg", target_group)
        a = key_flag(a, keys, [("entity_id", "entity_id"), ("country_code", "country_code"),
                               ("experiment_id", "test_id"), ("__tg", "target_group"), ("variant", "variant"),
                               ("scheme_id", "price_scheme_id")], "__scheme_ok")
        scheme_ok = F.col("__scheme_ok")
    else:
        pattern = F.concat(F.lit("%"), target_group, F.lit(" | "), F.col("variant"), F.lit(" | "),
                           F.col("scheme_id"), F.lit("%"))
        scheme_ok = F.like(F.col("tg_var_scheme_concat"), pattern)
    keep = F.when((target_group == NON_TG) | scheme_ok, "Keep").otherwise("Drop")
    a = a.select(*ORDER_COLUMNS, "parent_vertical_concat", target_group.alias("target_group"), keep.alias("keep_drop_flag"))
    decided = a.columns
    dwh = key_semi_join(src.warehouse_orders, known, [("global_entity_id", "entity_id")]).select(
        F.col("global_entity_id").alias("__d_entity"), F.col("order_id").alias("__d_code"),
        F.col("value.mov_customer_fee_local").alias("sof_local_cdwh"),
        F.col("delivery_location.longitude").alias("__lon"), F.col("delivery_location.latitude").alias("__lat"))
    a = a.join(dwh, (a.platform_order_code == dwh.__d_code) & (a.entity_id == dwh.__d_entity), "inner")
    # Platform fees are looked up by (entity, order code, date): join them on
    # (entity, order code), the key the warehouse join already partitioned
    # the fact by, and keep the date equality as a residual condition, so the
    # fact is not shuffled again for this lookup.  It comes before the zones:
    # a cover too large to broadcast deals the fact by cell.
    pd_ = key_semi_join(src.platform_orders, known, [("global_entity_id", "entity_id")]).select(
        F.col("global_entity_id").alias("__p_entity"), F.col("code").alias("__p_code"),
        F.col("created_date_utc").alias("__p_date"), F.col("delivery_fee_local").alias("__pd_fee"))
    a = a.join(pd_, (a.platform_order_code == pd_.__p_code) & (a.entity_id == pd_.__p_entity)
               & _residual_eq(a.created_date, pd_.__p_date), "left")
    a = locate(a, grid, cover, {"entity_id": "entity_id", "country_code": "country_code", "zone_id": "zone_id",
                                "test_id": "experiment_id"}, "__lon", "__lat", cfg.geodesic)
    a = a.select(*decided, "sof_local_cdwh", "__pd_fee")

    cst = costs.select(F.col("entity_id").alias("__c_entity"), F.col("order_id").alias("__c_order"),
                       F.col("country_code").alias("__c_country"), "delivery_costs_local")
    # The costs lie by (order id, entity) already and are not shuffled again; NULL
    # order ids (never matched) are spread instead of landing on one reducer.
    a = left_join_on_leading_keys(a, cst, [("order_id", "__c_order"), ("entity_id", "__c_entity")],
                                  [("country_code", "__c_country")], spread_by=("platform_order_code", "perseus_client_id"))

    dat = broadcast_if_small(zones.select(F.col("entity_id").alias("__s_entity"), F.col("country_code").alias("__s_country"),
                       F.col("test_id").alias("__s_test"), "test_start_date", "test_end_date",
                       F.col("test_name").alias("__s_name")).distinct())
    a = a.join(dat, (a.entity_id == dat.__s_entity) & (a.country_code == dat.__s_country)
               & (a.experiment_id == dat.__s_test), "left")
    ent = broadcast_if_small(platform_entities(src.entities).select(F.col("entity_id").alias("__e_entity"),
                                                               F.col("region").alias("__e_region")))
    a = a.join(ent, a.entity_id == ent.__e_entity, "inner")

    covered = (F.col("is_delivery_fee_covered_by_discount") == F.lit(True)) | (
        F.col("is_delivery_fee_covered_by_voucher") == F.lit(True))
    fee_fallback = F.when(covered, F.lit(0.0)).otherwise(F.col("delivery_fee_local"))
    not_covered = (F.col("is_delivery_fee_covered_by_voucher") == F.lit(False)) & (
        F.col("is_delivery_fee_covered_by_discount") == F.lit(False))
    region = F.col("__e_region")
    actual_df = (
        F.when(region.isin(*PLATFORM_FEE_REGIONS), F.coalesce(F.col("__pd_fee"), fee_fallback))
        .when(~region.isin(*PLATFORM_FEE_REGIONS),
              F.when(not_covered, F.col("delivery_fee_local")).otherwise(F.lit(0.0)))
    )
    sof_local = F.when(F.col("gfv_local") - F.col("dps_minimum_order_value_local") >= 0, F.lit(0.0)).otherwise(
        F.coalesce(F.col("sof_local_cdwh"), F.col("dps_minimum_order_value_local") - F.col("gfv_local")))
    # The result table's column names.
    return a.select(
        "created_date", "order_placed_at", "region", "entity_id", "country_code", "city_name", "city_id",
        "zone_name", "zone_id", "variant", F.col("experiment_id").alias("test_id"), "test_start_date",
        "test_end_date", "perseus_client_id", "ga_session_id", "dps_sessionid", "dps_customer_tag", "order_id",
        "platform_order_code", "scheme_id", "vendor_price_scheme_type", "vendor_id",
        "target_group", "chain_id", "chain_name", "vertical_type",
        normalize_vertical("vendor_vertical_parent").alias("vendor_vertical_parent"), "delivery_status",
        "is_own_delivery", "exchange_rate", "dps_delivery_fee_local", "delivery_fee_local", "commission_local",
        "joker_vendor_fee_local", F.coalesce(F.col("service_fee"), F.lit(0.0)).alias("service_fee_local"),
        "sof_local_cdwh", sof_local.alias("sof_local"), "delivery_costs_local",
        actual_df.alias("actual_df_paid_by_customer"), "is_delivery_fee_covered_by_discount",
        "is_delivery_fee_covered_by_voucher", "parent_vertical_concat", "keep_drop_flag",
    )


def parent_verticals(tg: DataFrame) -> DataFrame:
    """The parent verticals (``pv``) of each test."""
    return (
        tg.select("entity_id", "country_code", "test_id", F.col("first_parent_vertical").alias("pv"))
        .unionByName(tg.select("entity_id", "country_code", "test_id", F.col("second_parent_vertical").alias("pv")))
        .where(F.col("pv").isNotNull())
    )


def with_profit(orders: DataFrame, tg: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Revenue and gross profit per order; keep orders of the test's parent vertical(s)."""
    covered = (F.col("is_delivery_fee_covered_by_discount") == F.lit(True)) | (
        F.col("is_delivery_fee_covered_by_voucher") == F.lit(True))
    fee = F.coalesce(F.col("actual_df_paid_by_customer"),
                     F.when(covered, F.lit(0.0)).otherwise(F.col("delivery_fee_local")))
    base = fee + F.col("commission_local") + F.col("joker_vendor_fee_local") + F.col("service_fee_local")
    revenue = base + F.coalesce(F.col("sof_local_cdwh"), F.col("sof_local"))
    # The study's profit has no fallback for a missing small-order fee (the
    # same column twice in its COALESCE); fix_profit_fallback adds it.
    profit_sof = F.col("sof_local") if cfg.fix_profit_fallback else F.col("sof_local_cdwh")
    profit = base + F.coalesce(F.col("sof_local_cdwh"), profit_sof) - F.col("delivery_costs_local")
    out = orders.select("*", revenue.alias("revenue_local"), profit.alias("gross_profit_local"))
    return key_semi_join(out, parent_verticals(tg), [("entity_id", "entity_id"), ("country_code", "country_code"),
                                        ("test_id", "test_id"), ("vendor_vertical_parent", "pv")])


def clean_orders(orders_with_profit: DataFrame) -> DataFrame:
    return orders_with_profit.where(F.col("keep_drop_flag") == "Keep")


def duplicate_orders(clean: DataFrame) -> DataFrame:
    """Data-quality check: order ids that occur on more than one clean order row of a test.

    Such rows are counted once by the per-user order count but summed twice
    into revenue and profit (the study's behaviour, kept as is).
    """
    return (clean.groupBy("entity_id", "country_code", "test_id", "order_id")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("revenue_local").alias("revenue_local_total"))
            .where(F.col("n_rows") > 1))
