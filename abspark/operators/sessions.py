"""Click-stream operators: session events in test zones, and the per-session treatment flag.

A GA session row carries two arrays: its events and the delivery zones it was
seen in.  The study unnests both and takes their product; here the zones
are unnested first and semi-joined to the test zones, so only sessions in
a test zone pay for the event unnest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abspark.config import PipelineConfig
from abspark.functions.columns import NON_TG, UNKNOWN_TG, normalize_vertical, point_wkt
from abspark.operators.relational import broadcast_if_small, key_flag, key_semi_join, left_join_spread_null_keys

SESSION_KEYS = ["created_date", "entity_id", "country_code", "test_id", "variant", "events_ga_session_id"]
TG_PATTERN = r"TG\d+"


def session_events(ga_sessions: DataFrame, geo: DataFrame, tg: DataFrame, schemes: DataFrame,
                   cfg: PipelineConfig) -> DataFrame:
    """One distinct row per session x event x zone of valid test variants in test zones."""
    x = ga_sessions.where(F.col("created_date") >= F.lit(cfg.start_floor).cast("date")).select(
        "created_date", "entity_id", "country_code", "platform", "brand", "events_ga_session_id",
        "fullvisitor_id", "visit_id", "has_transaction", "total_transactions", "ga_dps_session_id",
        F.col("sessions.dps_session_timestamp").alias("dps_session_timestamp"),
        F.col("sessions.endpoint").alias("endpoint"),
        F.col("sessions.perseus_client_id").alias("perseus_client_id"),
        F.col("sessions.variant").alias("variant"),
        F.col("sessions.experiment_id").alias("test_id"),
        normalize_vertical("sessions.vertical_parent").alias("vertical_parent"),
        F.col("sessions.customer_status").alias("customer_status"),
        F.col("sessions.location").alias("location"),
        F.col("sessions.variant_concat").alias("variant_concat"),
        F.col("sessions.location_concat").alias("location_concat"),
        F.col("sessions.customer_status_concat").alias("customer_status_concat"),
        point_wkt("ga_location.longitude", "ga_location.latitude").alias("ga_location"),
        "events", "dps_zone",
    )
    x = key_semi_join(x, schemes, [("entity_id", "entity_id"), ("country_code", "country_code"),
                                   ("test_id", "test_id"), ("variant", "variant")])
    x = key_semi_join(x, tg, [("entity_id", "entity_id"), ("country_code", "country_code"), ("test_id", "test_id")])
    # Session zones: an inner join on the test zones (a NULL zone never matches,
    # so the outer unnest of the study reduces to a plain one).  The zone
    # table's own columns are not kept and the result is DISTINCT, so the
    # join is a semi-join on the zone key.
    x = x.select("*", F.explode("dps_zone").alias("dps")).drop("dps_zone")
    x = key_semi_join(x, geo, [("entity_id", "entity_id"), ("country_code", "country_code"),
                               ("dps.id", "zone_id"), ("test_id", "test_id")])
    x = x.select("*", F.explode_outer("events").alias("e")).drop("events")
    x = x.select("*", F.col("e.vendor_code").alias("vendor_code"), F.col("e.vertical_type").alias("vertical_type"))
    t = broadcast_if_small(tg.select(F.col("entity_id").alias("__t_entity"), F.col("vendor_code").alias("__t_vendor"),
                                     F.col("test_id").alias("__t_test"), "tg_name", "parent_vertical_concat"))
    # Many events have no vendor: where the lookup is too large to broadcast they are spread, not dealt to one task.
    x = left_join_spread_null_keys(x, t, [("vendor_code", "__t_vendor"), ("entity_id", "__t_entity"), ("test_id", "__t_test")],
                                   spread_by=("events_ga_session_id", "e"))
    if cfg.sub_vertical_filter:
        x = key_flag(x, tg, [("entity_id", "entity_id"), ("country_code", "country_code"), ("test_id", "test_id"),
                             ("vertical_type", "vertical_type")], "__vt_ok")
        x = x.where(F.col("vertical_type").isNull() | F.col("__vt_ok"))
    target_group = F.when(F.col("vendor_code").isNull(), F.lit(UNKNOWN_TG)).otherwise(
        F.coalesce(F.col("tg_name"), F.lit(NON_TG)))
    return x.select(
        "created_date", "entity_id", "country_code", "platform", "brand", "events_ga_session_id",
        "fullvisitor_id", "visit_id", "has_transaction", "total_transactions", "ga_dps_session_id",
        "dps_session_timestamp", "endpoint", "perseus_client_id", "variant", "test_id", "vertical_parent",
        "parent_vertical_concat", "customer_status", "location", "variant_concat", "location_concat",
        "customer_status_concat", F.col("e.event_action").alias("event_action"), "vendor_code",
        target_group.alias("target_group"), "vertical_type", F.col("e.event_time").alias("event_time"),
        F.col("e.transaction_id").alias("transaction_id"), F.col("e.expedition_type").alias("expedition_type"),
        F.col("dps.city_id").alias("city_id"), F.col("dps.city_name").alias("city_name"),
        F.col("dps.id").alias("zone_id"), F.col("dps.name").alias("zone_name"),
        F.col("dps.timezone").alias("timezone"), "ga_location",
    ).distinct()


def parent_vertical_filter(stg: DataFrame, tg: DataFrame) -> DataFrame:
    """Keep events whose session parent vertical is the test's (first, or either of two)."""
    key = [("entity_id", "entity_id"), ("country_code", "country_code"), ("test_id", "test_id")]
    first = tg.where(F.col("first_parent_vertical").isNotNull())
    second = tg.where(F.col("second_parent_vertical").isNotNull())
    x = key_flag(stg, first, key + [("vertical_parent", "first_parent_vertical")], "__in_first")
    x = key_flag(x, second, key + [("vertical_parent", "second_parent_vertical")], "__in_second")
    multi = F.col("parent_vertical_concat").like("%,%")
    keep = F.when(multi, F.col("__in_first") | F.col("__in_second")).otherwise(F.col("__in_first"))
    return x.where(keep).drop("__in_first", "__in_second")


def _flag(any_tg, any_non_tg):
    return F.when(any_tg, "Y").when(any_non_tg, "N").otherwise(UNKNOWN_TG)


def session_treatment_flag(events: DataFrame) -> DataFrame:
    """Per GA session: sorted distinct target groups and vendors, and Y / N / Unknown."""
    return events.groupBy(*SESSION_KEYS).agg(
        F.nullif(F.array_join(F.array_sort(F.collect_set("target_group")), ", "), F.lit(""))
        .alias("all_tgs_per_ga_session"),
        F.nullif(F.array_join(F.array_sort(F.collect_set("vendor_code")), ", "), F.lit(""))
        .alias("all_vendor_codes_per_ga_session"),
        _flag(F.bool_or(F.col("target_group").rlike(TG_PATTERN)),
              F.bool_or(F.col("target_group").contains(NON_TG))).alias("session_in_treatment_flag"),
    )


def with_session_flag(events: DataFrame) -> DataFrame:
    """Every event row with its session's flag columns (left join on the six session keys).

    The flags come from the aggregate above, which combines map-side (a
    session's distinct groups and vendors, not its events, cross the
    shuffle).  The join back is an ordinary equi-join, so a session holding a
    large share of all events is a skewed join partition that AQE splits,
    which a window over the session could not do.  A NULL key matches
    nothing, as in the study.
    """
    # Rows with a NULL key match nothing: they need no flags (and would meet in one group).
    known = None
    for k in SESSION_KEYS:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    flags = session_treatment_flag(events.where(known))
    return events.join(flags, SESSION_KEYS, "left").select(
        *events.columns, "all_tgs_per_ga_session", "all_vendor_codes_per_ga_session", "session_in_treatment_flag")
