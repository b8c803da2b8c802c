"""The ten source tables of the pipeline, in their warehouse shape.

``SourceTables`` holds one DataFrame per source.  ``from_parquet_dir`` reads
them from a folder of parquet files (one per source, written by
``write_sources`` or produced elsewhere with the schemas below);
``derive_from_star_schema`` builds them from the driver's star-schema tables
through the shared fixture SQL, nesting flat rows into arrays of structs where
the warehouse has them (setup vendor lists, country -> city -> zone trees,
session events and zones).

Nesting is a per-key ``collect_list``: one setup's vendor list, one city's
zones, one GA session's events.  Each list is bounded by the size of its
parent record, never by the size of a table.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from abspark.session import ensure_checkpoint_dir, limit_methods
from abspark.sources import fixtures, schemas

SOURCE_NAMES = (
    "experiment_setups",
    "vendors",
    "countries",
    "courier_timings",
    "logistics_orders",
    "entities",
    "orders_sessions",
    "warehouse_orders",
    "platform_orders",
    "ga_sessions",
)

@dataclass
class SourceTables:
    experiment_setups: DataFrame
    vendors: DataFrame
    countries: DataFrame
    courier_timings: DataFrame
    logistics_orders: DataFrame
    entities: DataFrame
    orders_sessions: DataFrame
    warehouse_orders: DataFrame
    platform_orders: DataFrame
    ga_sessions: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


class DerivedTables(SourceTables):
    """Sources whose sessions are derived when they are first read: the order steps never read them."""

    @property
    def ga_sessions(self) -> DataFrame:
        if callable(self._sessions):
            self._sessions = self._sessions()
        return self._sessions

    @ga_sessions.setter
    def ga_sessions(self, sessions: DataFrame | Callable[[], DataFrame]) -> None:
        self._sessions = sessions


def read_star_schema(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")) for name in fixtures.BASE_TABLES}


# Views that several sources are made of: derived once, kept as parquet.  Of
# f_orders the joined lines are kept: every source computes its own columns from
# those few numbers, which costs less than to write and read the wide rows.
SHARED_VIEWS = ("f_session_events", "f_sessions")


def order_lines() -> tuple[str, str]:
    """``F_ORDERS`` in two steps: its joins with the columns that it names, and its expressions over their rows."""
    named = sorted(set(re.findall(r"\b(l|o|en)\.(\w+)", fixtures.F_ORDERS.replace(fixtures.ORDER_LINES, ""))))
    lines = f"SELECT {', '.join(f'{t}.{c} AS {t}__{c}' for t, c in named)} {fixtures.ORDER_LINES}"
    part = lambda table: f"NAMED_STRUCT({', '.join(f"'{c}', {t}__{c}" for t, c in named if t == table)}) AS {table}"
    rows = f"FROM (SELECT {part('l')}, {part('o')}, {part('en')} FROM {{order_lines}})"
    return lines, fixtures.F_ORDERS.replace(fixtures.ORDER_LINES, rows)


def flat_views(spark: SparkSession, sf_dir: str, only: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Run the shared fixture SQL in Spark; returns every flat view by name (``only`` those, with what they need)."""
    limit_methods(spark)
    wanted = set(only or [name for name, _ in fixtures.FLAT_VIEWS])
    for name, sql in reversed(fixtures.FLAT_VIEWS):
        if name in wanted:
            wanted |= {other for other, _ in fixtures.FLAT_VIEWS if "{" + other + "}" in sql}
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fixture-{uuid.uuid4().hex}"
    frames: dict[str, DataFrame] = read_star_schema(spark, sf_dir)

    def needed(sql: str) -> dict[str, DataFrame]:
        return {k: v for k, v in frames.items() if "{" + k + "}" in sql}

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    for name, sql in fixtures.FLAT_VIEWS:
        if name not in wanted:
            continue
        if name == "f_orders":
            lines, sql = order_lines()
            frames["order_lines"] = kept(spark.sql(lines, **needed(lines)), "order_lines")
        frames[name] = spark.sql(sql, **needed(sql))
        if name in SHARED_VIEWS:
            frames[name] = kept(frames[name], name)
    return frames


def _point(x, y):
    return F.struct(x.alias("x"), y.alias("y"))


# The flat views that each part of the sources is made of.
SETUP_AND_ORDER_VIEWS = ("f_entities", "f_vendors", "f_setups", "f_setup_vendors", "f_setup_parents", "f_setup_zones", "f_zones",
                         "f_zone_points", "f_orders")
SESSION_VIEWS = ("f_session_events", "f_sessions", "f_session_zones")


def derive_from_star_schema(spark: SparkSession, sf_dir: str) -> SourceTables:
    v = flat_views(spark, sf_dir, SETUP_AND_ORDER_VIEWS)

    # experiment_setups: one row per setup row with its vendor, parent-vertical and zone lists.
    vendor_lists = v["f_setup_vendors"].groupBy("e", F.col("list_id").alias("vendor_list_id")).agg(
        F.array_sort(F.collect_list("vendor_id")).alias("matching_vendor_ids"))
    parent_lists = v["f_setup_parents"].groupBy("test_id").agg(
        F.array_sort(F.collect_list("parent_vertical")).alias("test_vertical_parents"))
    zone_lists = v["f_setup_zones"].groupBy("e", F.col("list_id").alias("zone_list_id")).agg(
        F.array_sort(F.collect_list("zone_id")).alias("zone_ids"))
    none = F.array().cast("array<string>")
    setups = (
        v["f_setups"]
        .join(vendor_lists, ["e", "vendor_list_id"], "left")
        .join(parent_lists, ["test_id"], "left")
        .join(zone_lists, ["e", "zone_list_id"], "left")
        .select(
            "entity_id", "country_code", "test_id", "test_name", "test_start_date", "test_end_date",
            "is_active", "misconfigured",
            F.struct(F.col("schedule_id").alias("id")).alias("schedule"),
            F.struct(F.col("customer_condition_id").alias("id")).alias("customer_condition"),
            "vendor_group_id", "priority", "variation_group", "price_scheme_id",
            F.coalesce("matching_vendor_ids", none).alias("matching_vendor_ids"),
            F.coalesce("test_vertical_parents", none).alias("test_vertical_parents"),
            "zone_ids",
        )
    )

    vendors = v["f_vendors"].select("global_entity_id", "vendor_id", "vertical_type")

    # countries: country -> platforms, cities -> zones -> rings of points.
    zone_key = ["entity_id", "country_code", "city_id", "zone_id"]
    rings = v["f_zone_points"].groupBy(*zone_key, "ring").agg(
        F.array_sort(F.collect_list(F.struct("pt", "x", "y"))).alias("points"))
    shapes = rings.groupBy(*zone_key).agg(F.array_sort(F.collect_list(F.struct("ring", "points"))).alias("rings"))
    shapes = shapes.select(*zone_key, F.transform(
        "rings", lambda r: F.transform(r["points"], lambda p: _point(p["x"], p["y"]))).alias("shape"))
    zones = v["f_zones"].drop("shape").join(shapes, zone_key).select(
        "country_code", "entity_id", "city_id", "city_name", "city_active",
        F.struct(F.col("zone_id").alias("id"), F.col("zone_name").alias("name"),
                 F.col("zone_active").alias("is_active"), "shape").alias("zone"),
    )
    cities = zones.groupBy("country_code", "entity_id", "city_id", "city_name", "city_active").agg(
        F.array_sort(F.collect_list("zone")).alias("zones"))
    countries = cities.groupBy("country_code", "entity_id").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("city_id").alias("id"), F.col("city_name").alias("name"),
            F.col("city_active").alias("is_active"), F.col("zones")))).alias("cities")
    ).select("country_code", F.array(F.struct(F.col("entity_id"))).alias("platforms"), "cities")

    # Distinct rows are found where the keys that the study joins them on put them: one shuffle serves both.
    # The key of many values comes first: a sort for the join then rarely compares more than its first bytes.
    o = v["f_orders"]
    courier_timings = o.select(
        "entity_id", "country_code", "order_id", "created_date",
        F.col("delivery_costs_local").alias("costs"),
        (F.col("delivery_costs_local") / F.lit(2.0)).alias("costs_eur"))
    logistics_orders = o.select("entity_id", "order_id", "platform_order_code", "created_date").repartition(
        "order_id", "entity_id").distinct().select(
        F.struct(F.col("entity_id").alias("id")).alias("entity"), "order_id", "platform_order_code", "created_date")
    entities = v["f_entities"].select(
        "region", F.col("country_code").alias("country_iso"), "country_name",
        F.array(F.struct(F.col("entity_id"))).alias("platforms"))
    orders_sessions = o.select(
        "created_date", "order_placed_at", "region", "entity_id", "country_code", "city_name", "city_id",
        "zone_name", "zone_id", "variant", F.col("test_id").alias("experiment_id"), "perseus_client_id",
        "ga_session_id", F.concat(F.lit("d"), F.col("order_id").cast("string")).alias("dps_sessionid"),
        "dps_customer_tag", "order_id", "platform_order_code", "scheme_id", "vendor_price_scheme_type",
        "vendor_id", "chain_id", "chain_name", "vertical_type", "vendor_vertical_parent", "delivery_status",
        "is_own_delivery", "exchange_rate", F.col("delivery_fee_local").alias("dps_delivery_fee_local"),
        "delivery_fee_local", "commission_local", "joker_vendor_fee_local", "service_fee", "gfv_local",
        "dps_minimum_order_value_local", "is_delivery_fee_covered_by_discount",
        "is_delivery_fee_covered_by_voucher")
    warehouse_orders = o.select(
        F.col("entity_id").alias("global_entity_id"), F.col("platform_order_code").alias("order_id"),
        F.struct(F.col("mov_customer_fee_local")).alias("value"),
        F.struct(F.col("lon").alias("longitude"), F.col("lat").alias("latitude")).alias("delivery_location"),
    ).repartition("order_id", "global_entity_id").distinct()
    platform_orders = o.where("in_pd_orders").select(
        F.col("entity_id").alias("global_entity_id"), F.col("platform_order_code").alias("code"),
        F.col("created_date").alias("created_date_utc"), F.col("pd_delivery_fee_local").alias("delivery_fee_local"),
    ).repartition("code", "global_entity_id").distinct()

    return DerivedTables(
        experiment_setups=setups, vendors=vendors, countries=countries, courier_timings=courier_timings,
        logistics_orders=logistics_orders, entities=entities, orders_sessions=orders_sessions,
        warehouse_orders=warehouse_orders, platform_orders=platform_orders, ga_sessions=lambda: derive_sessions(spark, sf_dir),
    )


def derive_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ga_sessions: one row per GA session with nested events and zones."""
    v = flat_views(spark, sf_dir, SESSION_VIEWS)
    ev = v["f_session_events"]
    events = ev.groupBy("ga_session_id").agg(F.array_sort(F.collect_list(F.struct(
        "event_time", "event_action", "vendor_code", "vertical_type", "transaction_id", "expedition_type",
    ))).alias("events")).withColumnRenamed("ga_session_id", "events_ga_session_id")
    sz = v["f_session_zones"]
    dps_zone = sz.groupBy("events_ga_session_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("slot"), F.col("zone_id").alias("id"), F.col("zone_name").alias("name"), "city_id", "city_name",
        "timezone")))
        .alias("dps_zone"))
    s = v["f_sessions"]
    return (
        s.join(events, ["events_ga_session_id"], "left")
        .join(dps_zone, ["events_ga_session_id"], "left")
        .select(
            "created_date", "entity_id", "country_code", "platform", "brand", "events_ga_session_id",
            "fullvisitor_id", "visit_id", "has_transaction", "total_transactions", "ga_dps_session_id",
            F.struct(F.col("ga_longitude").alias("longitude"), F.col("ga_latitude").alias("latitude"))
            .alias("ga_location"),
            F.struct(
                "dps_session_timestamp", "endpoint", "perseus_client_id", "variant",
                F.col("test_id").alias("experiment_id"), "vertical_parent", "customer_status", "location",
                F.col("variant").alias("variant_concat"), F.col("location").alias("location_concat"),
                F.col("customer_status").alias("customer_status_concat"),
            ).alias("sessions"),
            "events",
            F.coalesce(
                F.transform("dps_zone", lambda d: d.dropFields("slot")),
                F.array().cast("array<struct<id:bigint,name:string,city_id:bigint,city_name:string,timezone:string>>"),
            ).alias("dps_zone"),
        )
    )


def globe_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(zones, orders, warehouse orders) on the globe, in the shapes of zone geography and of the two sources."""
    v = flat_views(spark, sf_dir, ("f_globe_points", "f_globe_orders"))
    key = ["entity_id", "country_code", "zone_id"]
    rings = v["f_globe_points"].groupBy(*key, "ring").agg(F.array_sort(F.collect_list(F.struct("pt", "x", "y"))).alias("points"))
    zones = rings.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("ring", "points"))).alias("rings")).select(
        *key, F.lit(0).cast("bigint").alias("test_id"),
        F.transform("rings", lambda r: F.transform(r["points"], lambda p: _point(p["x"], p["y"]))).alias("zone_shape"))
    o = v["f_globe_orders"]
    orders = o.select(*key, F.lit(0).cast("bigint").alias("experiment_id"), "order_id", "platform_order_code")
    warehouse = o.select(
        F.col("entity_id").alias("global_entity_id"), F.col("platform_order_code").alias("order_id"),
        F.struct(F.col("lon").alias("longitude"), F.col("lat").alias("latitude")).alias("delivery_location"))
    return zones, orders, warehouse


# Layouts of the facts.  Partitioned folders: the date floor prunes dates, and the
# semi-join with the tests' keys prunes entities at run time.  Bucketed tables:
# orders, warehouse and platform orders share buckets of (entity, order code) and
# meet without a shuffle.
PARTITIONS = {
    "orders_sessions": ("created_date", "entity_id"),
    "courier_timings": ("created_date", "entity_id"),
    "logistics_orders": ("created_date",),
    "platform_orders": ("created_date_utc",),
    "ga_sessions": ("created_date", "entity_id"),
}
BUCKETS = {
    "orders_sessions": ("entity_id", "platform_order_code"),
    "warehouse_orders": ("global_entity_id", "order_id"),
    "platform_orders": ("global_entity_id", "code"),
}


def _read_source(spark: SparkSession, path: str, name: str) -> DataFrame:
    df = spark.read.parquet(path)
    # A folder's partition values are text: the contract says of which type, not their look.
    by = PARTITIONS.get(name, ())
    if by and tuple(df.columns[-len(by):]) == by:
        want = {f.name: f for f in schemas.source_schema(name).fields if f.name in by}
        df = spark.read.schema(StructType([want.get(f.name, f) for f in df.schema.fields])).parquet(path)
    return schemas.conform(df, name)


def from_parquet_dir(spark: SparkSession, path: str) -> SourceTables:
    """Read sources written by :func:`write_sources` (or any producer of the same schemas); any Spark path."""
    return SourceTables(**{n: _read_source(spark, f"{path.rstrip('/')}/{n}", n) for n in SOURCE_NAMES})


def from_catalog(spark: SparkSession, database: str, names: dict[str, str] | None = None) -> SourceTables:
    """Read the sources from catalog tables of ``database``; ``names`` maps a source to another table name."""
    names = names or {}
    return SourceTables(**{n: schemas.conform(spark.table(f"{database}.{names.get(n, n)}"), n) for n in SOURCE_NAMES})


def write_sources(tables: SourceTables, path: str, mode: str = "overwrite", partitioned: bool = False) -> None:
    """One Parquet folder per source; ``partitioned``: the facts by ``PARTITIONS``."""
    for name, df in tables.as_dict().items():
        by = PARTITIONS.get(name, ()) if partitioned else ()
        writer = (df.hint("rebalance", *by) if by else df).write.mode(mode)
        (writer.partitionBy(*by) if by else writer).parquet(f"{path.rstrip('/')}/{name}")


def write_catalog(tables: SourceTables, database: str, buckets: int = 64, mode: str = "overwrite") -> None:
    """One catalog table per source; the order tables by ``BUCKETS``, sorted within.

    Of one bucket number, so that their joins need no shuffle; choose it for
    about a task's worth of the largest table in each bucket.
    """
    for name, df in tables.as_dict().items():
        keys = BUCKETS.get(name)
        writer = (df.repartition(buckets, *keys) if keys else df).write.mode(mode)
        (writer.bucketBy(buckets, *keys).sortBy(*keys) if keys else writer).saveAsTable(f"{database}.{name}")


def without_rejects(tables: SourceTables) -> tuple[SourceTables, dict[str, DataFrame]]:
    """(the sources without rows that break their rules, those rows by source)."""
    split = {name: schemas.split_rejects(df, name) for name, df in tables.as_dict().items()}
    return SourceTables(**{n: good for n, (good, _) in split.items()}), {n: bad for n, (_, bad) in split.items()}
