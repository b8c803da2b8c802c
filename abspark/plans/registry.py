"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator/step.

Every query derives the experiment sources from the star-schema tables of
``sf_dir`` and runs the pipeline step on them, so its work grows with the
input tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abspark.config import FIXTURE_CONFIG, PipelineConfig
from abspark.functions.columns import rings_wkt
from abspark.operators import orders, questions, stats, zone_cover
from abspark.plans.pipeline import ExperimentPipeline
from abspark.sources.tables import SourceTables, derive_from_star_schema, flat_views, globe_sources

_CACHE: dict[tuple, ExperimentPipeline] = {}
_SOURCES: dict[tuple, SourceTables] = {}


def pipeline(spark: SparkSession, sf_dir: str, cfg: PipelineConfig = FIXTURE_CONFIG) -> ExperimentPipeline:
    # A stopped session's DataFrames are of no use to the next one.
    app = spark.sparkContext.applicationId
    for cache in (_CACHE, _SOURCES):
        for old in [k for k in cache if k[0] != app]:
            del cache[old]
    if (app, sf_dir) not in _SOURCES:
        _SOURCES[app, sf_dir] = derive_from_star_schema(spark, sf_dir)
    key = (app, sf_dir, cfg)
    if key not in _CACHE:
        _CACHE[key] = ExperimentPipeline(_SOURCES[app, sf_dir], cfg)
    return _CACHE[key]


ALL_VERTICALS = PipelineConfig(start_floor=FIXTURE_CONFIG.start_floor, sub_vertical_filter=False)
MULTI_VERTICAL = PipelineConfig(start_floor=FIXTURE_CONFIG.start_floor, multi_vertical=True)
EXACT_SCHEME = PipelineConfig(start_floor=FIXTURE_CONFIG.start_floor, exact_scheme_match=True)
GEODESIC = PipelineConfig(start_floor=FIXTURE_CONFIG.start_floor, geodesic=True)
PROFIT_FALLBACK = PipelineConfig(start_floor=FIXTURE_CONFIG.start_floor, fix_profit_fallback=True)


def _zone_geography(p: ExperimentPipeline) -> DataFrame:
    g = p.zone_geography
    return g.select(*[c for c in g.columns if c != "zone_shape"], rings_wkt("zone_shape").alias("zone_wkt"))


def _orders_in_zone(p: ExperimentPipeline) -> DataFrame:
    return orders.orders_in_zone(
        p.src.orders_sessions, p.zone_grid, p.zone_cover, p.src.warehouse_orders).drop("ring_tested")


def orders_in_zone_geodesic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on the globe in zones with great-circle edges, across the 180th meridian and around the poles."""
    zones, sessions, warehouse = globe_sources(spark, sf_dir)
    grid, cover = zone_cover.zone_grid(zones, geodesic=True), zone_cover.zone_cover(zones, geodesic=True)
    return orders.orders_in_zone(sessions, grid, cover, warehouse, geodesic=True).drop("ring_tested")


def mann_whitney_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank test on many small samples without ties: the exact distribution decides nearly all of them."""
    users = flat_views(spark, sf_dir, ("f_small_tests",))["f_small_tests"]
    return stats.mann_whitney(users, "profit_per_user", FIXTURE_CONFIG)


STEPS: dict[str, tuple[PipelineConfig, Callable[[ExperimentPipeline], DataFrame]]] = {
    "valid_experiments": (FIXTURE_CONFIG, lambda p: p.valid_experiments),
    "target_groups": (FIXTURE_CONFIG, lambda p: p.target_groups),
    "target_groups_multi_vertical": (MULTI_VERTICAL, lambda p: p.target_groups),
    "experiment_zones": (FIXTURE_CONFIG, lambda p: p.experiment_zones),
    "variant_schemes": (FIXTURE_CONFIG, lambda p: p.variant_schemes),
    "variant_scheme_concat": (FIXTURE_CONFIG, lambda p: p.variant_scheme_concat),
    "zone_geography": (FIXTURE_CONFIG, _zone_geography),
    "delivery_costs": (FIXTURE_CONFIG, lambda p: p.delivery_costs),
    "orders_in_zone": (FIXTURE_CONFIG, _orders_in_zone),
    "experiment_orders_sub_vertical": (FIXTURE_CONFIG, lambda p: p.experiment_orders),
    "experiment_orders_all_verticals": (ALL_VERTICALS, lambda p: p.experiment_orders),
    "order_profit": (FIXTURE_CONFIG, lambda p: p.order_profit),
    "clean_orders": (FIXTURE_CONFIG, lambda p: p.clean_orders),
    "duplicate_orders": (FIXTURE_CONFIG, lambda p: orders.duplicate_orders(p.clean_orders)),
    "experiment_sessions_stg": (FIXTURE_CONFIG, lambda p: p.experiment_sessions_stg),
    "experiment_sessions_stg_all_verticals": (ALL_VERTICALS, lambda p: p.experiment_sessions_stg),
    "experiment_sessions": (FIXTURE_CONFIG, lambda p: p.experiment_sessions),
    "session_treatment_flag": (FIXTURE_CONFIG, lambda p: p.session_treatment_flag),
    "sessions_with_flag": (FIXTURE_CONFIG, lambda p: p.sessions_with_flag),
    "users_per_test": (FIXTURE_CONFIG, lambda p: p.users_per_test),
    "kpis_per_user": (FIXTURE_CONFIG, lambda p: p.kpis_per_user),
    "treatment_order_share": (FIXTURE_CONFIG, lambda p: p.treatment_order_share),
    "significance_exp": (FIXTURE_CONFIG, lambda p: p.significance_exp),
    "significance_ts": (FIXTURE_CONFIG, lambda p: p.significance_ts),
    "significance_combined": (FIXTURE_CONFIG, lambda p: p.significance_combined),
    "variant_means": (FIXTURE_CONFIG, lambda p: p.variant_means.drop(*[c for c in p.variant_means.columns
                                                                        if c.startswith("__")])),
    "variant_deltas": (FIXTURE_CONFIG, lambda p: stats.variant_deltas(p.variant_means)),
    "mann_whitney": (FIXTURE_CONFIG, lambda p: stats.mann_whitney(p.gated_kpis_exp, "profit_per_user", p.cfg)),
    "mann_whitney_order_count": (FIXTURE_CONFIG, lambda p: stats.mann_whitney(
        p.gated_kpis_exp, "order_count_per_user", p.cfg)),
}
# The variant with the vertical-type filter off, and the options, to the end.
for _name in ("experiment_sessions", "clean_orders", "kpis_per_user", "treatment_order_share", "significance_combined"):
    STEPS[f"{_name}_all_verticals"] = (ALL_VERTICALS, lambda p, n=_name: getattr(p, n))
for _name in ("order_profit", "experiment_sessions", "kpis_per_user", "clean_orders", "treatment_order_share",
              "significance_combined"):
    STEPS[f"{_name}_multi_vertical"] = (MULTI_VERTICAL, lambda p, n=_name: getattr(p, n))
STEPS["clean_orders_exact_scheme"] = (EXACT_SCHEME, lambda p: p.clean_orders)
STEPS["clean_orders_geodesic"] = (GEODESIC, lambda p: p.clean_orders)
STEPS["order_profit_fee_fallback"] = (PROFIT_FALLBACK, lambda p: p.order_profit)
for _name in ("overview_stats", "tests_per_entity", "tests_per_entity_vertical", "ts_exp_comparison",
              "direction_agreement", "significance_agreement", "records_in_treatment",
              "records_in_treatment_summary", "records_in_treatment_bins", "treatment_share_summary",
              "treatment_share_bins", "significance_by_length", "significance_by_length_wide", "significance_by_share"):
    STEPS[_name] = (FIXTURE_CONFIG, getattr(questions, _name))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def make(cfg, fn):
        return lambda spark, sf_dir: fn(pipeline(spark, sf_dir, cfg))
    found = {name: make(cfg, fn) for name, (cfg, fn) in STEPS.items()}
    return found | {"orders_in_zone_geodesic": orders_in_zone_geodesic, "mann_whitney_exact": mann_whitney_exact}


FLAGSHIP = "significance_combined"
