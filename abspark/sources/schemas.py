"""Type contracts of the source tables and of the table the study reads back.

Every source is checked when it is read: a missing or mistyped column is named
in a ``ContractError`` before any job runs, columns that are only narrower (an
int for a long) are widened, extra columns are left out.  ``split_rejects`` sets
rows apart that break a source's rules, with the rules they break.

The user KPI table is re-typed explicitly before the statistics (the study
does this with ``astype`` because its download does not keep the types);
``apply_contract`` does the same with casts, so NULLs stay NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The columns of the ten sources that the study reads.
_ZONES = "array<struct<id:bigint,name:string,is_active:boolean,shape:array<array<struct<x:double,y:double>>>>>"
SOURCE_COLUMNS = {
    "experiment_setups": (
        "entity_id string, country_code string, test_id bigint, test_name string, test_start_date timestamp, "
        "test_end_date timestamp, is_active boolean, misconfigured boolean, schedule struct<id:bigint>, "
        "customer_condition struct<id:bigint>, vendor_group_id bigint, priority bigint, variation_group string, "
        "price_scheme_id bigint, matching_vendor_ids array<string>, test_vertical_parents array<string>, zone_ids array<bigint>"),
    "vendors": "global_entity_id string, vendor_id string, vertical_type string",
    "countries": (
        "country_code string, platforms array<struct<entity_id:string>>, "
        f"cities array<struct<id:bigint,name:string,is_active:boolean,zones:{_ZONES}>>"),
    "courier_timings": (
        "entity_id string, country_code string, order_id bigint, created_date date, costs double, costs_eur double"),
    "logistics_orders": "entity struct<id:string>, order_id bigint, platform_order_code string, created_date date",
    "entities": "region string, country_iso string, country_name string, platforms array<struct<entity_id:string>>",
    "orders_sessions": (
        "created_date date, order_placed_at timestamp, region string, entity_id string, country_code string, "
        "city_name string, city_id bigint, zone_name string, zone_id bigint, variant string, experiment_id bigint, "
        "perseus_client_id string, ga_session_id string, dps_sessionid string, dps_customer_tag string, order_id bigint, "
        "platform_order_code string, scheme_id bigint, vendor_price_scheme_type string, vendor_id string, chain_id string, "
        "chain_name string, vertical_type string, vendor_vertical_parent string, delivery_status string, "
        "is_own_delivery boolean, exchange_rate double, dps_delivery_fee_local double, delivery_fee_local double, "
        "commission_local double, joker_vendor_fee_local double, service_fee double, gfv_local double, "
        "dps_minimum_order_value_local double, is_delivery_fee_covered_by_discount boolean, "
        "is_delivery_fee_covered_by_voucher boolean"),
    "warehouse_orders": (
        "global_entity_id string, order_id string, value struct<mov_customer_fee_local:double>, "
        "delivery_location struct<longitude:double,latitude:double>"),
    "platform_orders": "global_entity_id string, code string, created_date_utc date, delivery_fee_local double",
    "ga_sessions": (
        "created_date date, entity_id string, country_code string, platform string, brand string, "
        "events_ga_session_id string, fullvisitor_id string, visit_id string, has_transaction boolean, "
        "total_transactions bigint, ga_dps_session_id string, ga_location struct<longitude:double,latitude:double>, "
        "sessions struct<dps_session_timestamp:timestamp,endpoint:string,perseus_client_id:string,variant:string,"
        "experiment_id:bigint,vertical_parent:string,customer_status:string,location:string,variant_concat:string,"
        "location_concat:string,customer_status_concat:string>, "
        "events array<struct<event_time:timestamp,event_action:string,vendor_code:string,vertical_type:string,"
        "transaction_id:string,expedition_type:string>>, "
        "dps_zone array<struct<id:bigint,name:string,city_id:bigint,city_name:string,timezone:string>>"),
}

# Rules of a source's rows, each a condition that must hold.  Rows that break
# one can match nothing in the study (a NULL key) or would poison its sums.
_FACT_KEYS = ("entity_id is not null", "country_code is not null", "created_date is not null")
_finite = lambda *c: tuple(f"coalesce(not isnan({x}) and abs({x}) < double('Infinity'), true)" for x in c)
SOURCE_RULES: dict[str, tuple[str, ...]] = {
    "experiment_setups": ("entity_id is not null", "country_code is not null", "test_id is not null",
                          "test_end_date is null or test_start_date is null or test_end_date >= test_start_date"),
    "vendors": ("global_entity_id is not null", "vendor_id is not null"),
    "countries": ("country_code is not null",),
    "courier_timings": (*_FACT_KEYS, "order_id is not null", *_finite("costs", "costs_eur")),
    "logistics_orders": ("entity.id is not null", "order_id is not null", "created_date is not null"),
    "entities": ("platforms is not null",),
    "orders_sessions": (*_FACT_KEYS, "platform_order_code is not null", *_finite(
        "gfv_local", "delivery_fee_local", "commission_local", "service_fee", "exchange_rate")),
    "warehouse_orders": ("global_entity_id is not null", "order_id is not null",
                         *_finite("delivery_location.longitude", "delivery_location.latitude")),
    "platform_orders": ("global_entity_id is not null", "code is not null", *_finite("delivery_fee_local")),
    "ga_sessions": (*_FACT_KEYS, "events_ga_session_id is not null"),
}

KPIS_PER_USER = StructType([
    StructField("entity_id", StringType()),
    StructField("country_code", StringType()),
    StructField("test_id", LongType()),
    StructField("test_name", StringType()),
    StructField("test_start_date", TimestampType()),
    StructField("test_end_date", TimestampType()),
    StructField("test_length", LongType()),
    StructField("first_parent_vertical", StringType()),
    StructField("second_parent_vertical", StringType()),
    StructField("perseus_client_id", StringType()),
    StructField("variant", StringType()),
    StructField("target_group", StringType()),
    StructField("session_in_treatment_flag", StringType()),
    StructField("order_count_per_user", LongType()),
    StructField("revenue_per_user", DoubleType()),
    StructField("profit_per_user", DoubleType()),
])


def apply_contract(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast the contract's columns (extra columns are kept after them)."""
    names = [f.name for f in schema.fields]
    extra = [c for c in df.columns if c not in names]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)


class ContractError(ValueError):
    """A source lacks columns or has them in other types; ``problems`` lists them by name."""

    def __init__(self, source: str, problems: list[str]):
        self.source, self.problems = source, problems
        super().__init__(f"{source}: " + "; ".join(problems))


_INTEGERS = (ByteType, ShortType, IntegerType, LongType)
_TIMES = (TimestampType, TimestampNTZType)


def _problems(name: str, have: DataType, want: DataType) -> list[str]:
    if have == want or isinstance(have, _TIMES) and isinstance(want, _TIMES):
        return []
    if isinstance(want, StructType) and isinstance(have, StructType):
        return _field_problems(have, want, f"{name}.")
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return _problems(f"{name}[]", have.elementType, want.elementType)
    wider = isinstance(want, LongType) and isinstance(have, _INTEGERS) or isinstance(want, DoubleType) and isinstance(
        have, (*_INTEGERS, FloatType, DecimalType))
    return [] if wider else [f"{name} is {have.simpleString()}, not {want.simpleString()}"]


def _field_problems(have: StructType, want: StructType, prefix: str = "") -> list[str]:
    held = {f.name: f.dataType for f in have.fields}
    found = []
    for f in want.fields:
        found += _problems(prefix + f.name, held[f.name], f.dataType) if f.name in held else [f"{prefix}{f.name} is missing"]
    return found


def _conformed(c: Column, have: DataType, want: DataType) -> Column:
    """``c`` in the contract's type; fields of structs are matched by name."""
    if have == want or isinstance(have, _TIMES):
        return c
    if isinstance(want, StructType):
        held = {f.name: f.dataType for f in have.fields}
        return F.when(c.isNotNull(), F.struct(*[_conformed(c[f.name], held[f.name], f.dataType).alias(f.name) for f in want.fields]))
    if isinstance(want, ArrayType):
        return F.transform(c, lambda x: _conformed(x, have.elementType, want.elementType))
    return c.cast(want)


def source_schema(name: str) -> StructType:
    return StructType.fromDDL(SOURCE_COLUMNS[name])


def conform(df: DataFrame, name: str) -> DataFrame:
    """``df`` with exactly the columns of source ``name``'s contract, or a ``ContractError``."""
    want = source_schema(name)
    problems = _field_problems(df.schema, want)
    if problems:
        raise ContractError(name, problems)
    return df.select(*[_conformed(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType).alias(f.name) for f in want.fields])


def split_rejects(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules of source ``name``, rows that break one with ``broken_rules``)."""
    rules = SOURCE_RULES[name]
    broken = F.filter(F.array(*[F.when(~F.coalesce(F.expr(r), F.lit(False)), F.lit(r)) for r in rules]), lambda x: x.isNotNull())
    marked = df.withColumn("broken_rules", broken)
    return marked.where(F.size("broken_rules") == 0).drop("broken_rules"), marked.where(F.size("broken_rules") > 0)
