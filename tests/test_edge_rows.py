"""Hand-made rows for the semantics the study relies on (NULL logic, ties, first rows)."""

import datetime as dt

from pyspark.sql import functions as F

from abspark.config import PipelineConfig
from abspark.operators import kpis, relational, sessions, setups

CFG = PipelineConfig(start_floor="2021-01-01")
SETUP_SCHEMA = (
    "entity_id string, country_code string, test_id long, test_name string, test_start_date timestamp, "
    "test_end_date timestamp, is_active boolean, misconfigured boolean, schedule struct<id:long>, "
    "customer_condition struct<id:long>, vendor_group_id long, priority long, variation_group string, "
    "price_scheme_id long, matching_vendor_ids array<string>, test_vertical_parents array<string>, "
    "zone_ids array<long>")


def _setup(test_id, group, priority, variant, vendors, parents, start=dt.datetime(2022, 1, 1), days=14,
           active=False, misconf=False, schedule=None, cond=None):
    return ("E1", "c1", test_id, f"t{test_id}", start, start + dt.timedelta(days=days), active, misconf,
            {"id": schedule}, {"id": cond}, group, priority, variant, 10 * priority, vendors, parents, [1, 2])


def test_valid_experiments_filters(spark):
    rows = [
        _setup(1, 101, 1, "Control", ["v1"], ["Restaurant"]),
        _setup(2, 101, 1, "Control", ["v1"], ["Restaurant"], active=True),
        _setup(3, 101, 1, "Control", ["v1"], ["Restaurant"], misconf=True),
        _setup(4, 101, 1, "Control", ["v1"], ["Restaurant"], days=6),
        _setup(5, 101, 1, "Control", ["v1"], ["Restaurant"], schedule=7),
        _setup(6, 101, 1, "Control", ["v1"], ["Restaurant"], cond=7),
        _setup(7, 101, 1, "Control", [], ["Restaurant"]),
        _setup(8, 101, 1, "Control", ["v1"], []),
        _setup(9, 101, 1, "Control", [None], ["Restaurant"]),
        _setup(10, 101, 1, "Control", ["v1"], ["Restaurant"], start=dt.datetime(2020, 12, 31)),
        _setup(11, 101, 1, "Control", ["v1"], ["Restaurant"], start=dt.datetime(2022, 1, 1, 23, 0), days=7),
    ]
    df = spark.createDataFrame(rows, SETUP_SCHEMA)
    got = sorted(r.test_id for r in setups.valid_experiments(df, CFG).collect())
    assert got == [1, 11]


def test_target_group_first_row_and_rank(spark):
    rows = [
        # v1 in both groups -> TG1 (lowest vendor_group_id); two parent verticals tie -> smallest kept
        _setup(1, 101, 1, "Control", ["v1", "v2"], ["shop", "Restaurant"]),
        _setup(1, 102, 2, "Control", ["v1", "v3"], ["shop", "Restaurant"]),
    ]
    vendors = spark.createDataFrame([("E1", "v1", "restaurants"), ("E1", "v3", "groceries")],
                                    "global_entity_id string, vendor_id string, vertical_type string")
    df = spark.createDataFrame(rows, SETUP_SCHEMA)
    got = {r.vendor_code: r for r in setups.target_groups(df, vendors, CFG).collect()}
    assert {k: v.tg_name for k, v in got.items()} == {"v1": "TG1", "v2": "TG1", "v3": "TG2"}
    assert got["v1"].parent_vertical_concat == "Restaurant"
    assert (got["v1"].first_parent_vertical, got["v1"].second_parent_vertical) == ("restaurant", None)
    assert got["v1"].vertical_type == "restaurants" and got["v2"].vertical_type is None
    multi = {r.vendor_code: r for r in setups.target_groups(
        df, vendors, PipelineConfig(start_floor="2021-01-01", multi_vertical=True)).collect()}
    assert multi["v1"].parent_vertical_concat == "Restaurant, shop"
    assert (multi["v1"].first_parent_vertical, multi["v1"].second_parent_vertical) == ("restaurant", "shop")


def test_key_semi_join_null_never_matches(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "k string, n int")
    keys = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "k string, n int")
    got = relational.key_semi_join(df, keys, [("k", "k"), ("n", "n")]).collect()
    assert [(r.k, r.n) for r in got] == [("a", 1)]


def test_first_row_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 0, "p")],
                               "k string, o int, rest string")
    got = {r.k: (r.o, r.rest) for r in relational.first_row_per_key(df, ["k"], ["o"]).collect()}
    assert got == {"a": (1, "y"), "b": (None, "q")}  # NULLs sort first, ties broken by the rest


def _events(spark, rows):
    return spark.createDataFrame(rows, (
        "created_date date, entity_id string, country_code string, test_id long, variant string, "
        "events_ga_session_id string, target_group string, vendor_code string"))


def test_session_flag(spark):
    d = dt.date(2022, 1, 3)
    rows = [
        (d, "E1", "c1", 1, "Control", "s1", "TG2", "v1"), (d, "E1", "c1", 1, "Control", "s1", "Non_TG", "v9"),
        (d, "E1", "c1", 1, "Control", "s2", "Non_TG", "v9"), (d, "E1", "c1", 1, "Control", "s2", "Unknown", None),
        (d, "E1", "c1", 1, "Control", "s3", "Unknown", None),
        (d, "E1", "c1", None, "Control", "s4", "TG1", "v1"),
    ]
    ev = _events(spark, rows)
    flags = {r.events_ga_session_id: r for r in sessions.session_treatment_flag(ev).collect()}
    assert flags["s1"].session_in_treatment_flag == "Y" and flags["s1"].all_tgs_per_ga_session == "Non_TG, TG2"
    assert flags["s2"].session_in_treatment_flag == "N" and flags["s2"].all_vendor_codes_per_ga_session == "v9"
    assert flags["s3"].session_in_treatment_flag == "Unknown" and flags["s3"].all_vendor_codes_per_ga_session is None
    joined = {(r.events_ga_session_id, r.target_group): r.session_in_treatment_flag
              for r in sessions.with_session_flag(ev).collect()}
    assert joined[("s1", "Non_TG")] == "Y" and joined[("s2", "Unknown")] == "N"
    assert joined[("s4", "TG1")] is None  # NULL key: no match in the study's join-back


def test_kpis_first_variant_and_zero_fill(spark):
    users = spark.createDataFrame([
        ("E1", "c1", 1, "t1", None, None, 7, "restaurant", None, "u1", "Control", "TG1", "Y"),
        ("E1", "c1", 1, "t1", None, None, 7, "restaurant", None, "u1", "Variation1", "Non_TG", "N"),
        ("E1", "c1", 1, "t1", None, None, 7, "restaurant", None, "u2", "Control", "Unknown", "Unknown"),
        ("E1", "c1", 1, "t1", None, None, 7, "restaurant", None, "u2", "Variation1", "TG1", "Y"),
        ("E1", "c1", 1, "t1", None, None, 7, "restaurant", None, "u3", "Variation2", "Non_TG", "N"),
    ], ", ".join(f"{c} {t}" for c, t in [
        ("entity_id", "string"), ("country_code", "string"), ("test_id", "long"), ("test_name", "string"),
        ("test_start_date", "timestamp"), ("test_end_date", "timestamp"), ("test_length", "long"),
        ("first_parent_vertical", "string"), ("second_parent_vertical", "string"), ("perseus_client_id", "string"),
        ("variant", "string"), ("target_group", "string"), ("session_in_treatment_flag", "string")]))
    orders = spark.createDataFrame([
        ("E1", "c1", 1, "u1", "TG1", "Control", 11, 10.004, 2.0),
        ("E1", "c1", 1, "u1", "TG1", "Control", 11, 10.004, None),
        ("E1", "c1", 1, "u2", "TG1", "Variation1", 12, 5.0, 1.0),
    ], "entity_id string, country_code string, test_id long, perseus_client_id string, target_group string, "
       "variant string, order_id long, revenue_local double, gross_profit_local double")
    got = {(r.perseus_client_id, r.variant): r for r in kpis.kpis_per_user(users, orders).collect()}
    # u1 keeps Control only; u2's Control row was 'Unknown' (dropped first), so Variation1 is its first variant
    assert set(got) == {("u1", "Control"), ("u2", "Variation1"), ("u3", "Variation2")}
    u1 = got[("u1", "Control")]
    assert (u1.order_count_per_user, u1.revenue_per_user, u1.profit_per_user) == (1, 20.01, 2.0)
    u3 = got[("u3", "Variation2")]
    assert (u3.order_count_per_user, u3.revenue_per_user, u3.profit_per_user) == (0, 0.0, 0.0)


def test_share_gate(spark):
    orders = spark.createDataFrame(
        [("E1", "c1", 1, 1, "TG1"), ("E1", "c1", 1, 1, "TG1"), ("E1", "c1", 1, 2, "Non_TG"),
         ("E1", "c1", 1, 3, "Non_TG"), ("E1", "c1", 2, 4, "Non_TG")],
        "entity_id string, country_code string, test_id long, order_id long, target_group string")
    got = {r.test_id: r.perc_treatment_orders for r in kpis.treatment_order_share(orders, CFG).collect()}
    assert got == {1: 0.3333}  # test 2 has no treatment orders: below the gate


def test_left_join_spread_null_keys_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a", 10), (None, "a", 11), (2, None, 12), (2, "b", 13), (3, "c", 14)],
                                 "k1 int, k2 string, v int")
    right = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5), (2, "b", 3.5), (None, "a", 9.0)],
                                  "r1 int, r2 string, x double")
    got = relational.left_join_spread_null_keys(left, right, [("k1", "r1"), ("k2", "r2")])
    want = left.join(right, (left.k1 == right.r1) & (left.k2 == right.r2), "left")
    from collections import Counter
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in want.collect())
    assert got.columns == want.columns


def test_null_key_salt_is_in_the_exchange(spark):
    left = spark.range(1000).selectExpr("if(id % 3 = 0, null, id) as k", "id as v")
    right = spark.range(1000).selectExpr("id as r", "id * 2 as x")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = relational.left_join_spread_null_keys(left, right, [("k", "r")], spread_by=["v"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("__null_salt" in line for line in exchanges), plan
    assert joined.where("x is not null").count() == 666


def _pairs(spark, setup_rows, cfg=CFG):
    vendors = spark.createDataFrame([], "global_entity_id string, vendor_id string, vertical_type string")
    df = spark.createDataFrame(setup_rows, SETUP_SCHEMA)
    return df, {r.vendor_code: (r.vendor_group_id, r.tg_name) for r in setups.target_groups(df, vendors, cfg).collect()}


def test_setup_rows_that_share_a_key_keep_their_own_vendors(spark):
    _, got = _pairs(spark, [_setup(1, 101, 1, "Control", ["v1"], ["shop"]), _setup(1, 102, 1, "Control", ["v2"], ["shop"])])
    assert got == {"v1": (101, "TG1"), "v2": (102, "TG2")}


def test_scheduled_twin_does_not_leak_its_vendor(spark):
    _, got = _pairs(spark, [_setup(1, 101, 1, "Control", ["v1"], ["shop"]),
                            _setup(1, 101, 1, "Control", ["v9"], ["shop"], schedule=3)])
    assert set(got) == {"v1"}


def test_twin_without_vendors_emits_nothing(spark):
    twin = list(_setup(1, 101, 1, "Control", [], ["shop"]))
    twin[13], twin[16] = 99, [7]
    df, _ = _pairs(spark, [_setup(1, 101, 1, "Control", ["v1"], ["shop"]), tuple(twin)])
    assert {r.price_scheme_id for r in setups.variant_schemes(df, CFG).collect()} == {10}
    assert {r.zone_id for r in setups.experiment_zones(df, CFG).collect()} == {1, 2}


def test_null_vendor_group_is_ranked_first(spark):
    for cfg in (CFG, PipelineConfig(start_floor="2021-01-01", multi_vertical=True)):
        _, got = _pairs(spark, [_setup(1, None, 1, "Control", ["v1", "v2"], ["shop"]),
                                _setup(1, 102, 2, "Control", ["v2", "v3"], ["shop"])], cfg)
        assert got == {"v1": (None, "TG1"), "v2": (None, "TG1"), "v3": (102, "TG2")}


def test_broadcast_if_small_measures_bytes(spark):
    df = spark.range(10)
    small = relational.broadcast_if_small(df, max_bytes=1000)
    wide = df.selectExpr("id", "repeat('x', 200) as ring")
    assert relational.measured_bytes(wide) > 2000
    probe = spark.range(100).withColumnRenamed("id", "k")
    hinted = lambda side: "ResolvedHint" in probe.join(side, probe.k == side.id)._jdf.queryExecution().analyzed().toString()
    assert hinted(small) and not hinted(relational.broadcast_if_small(wide, max_bytes=1000))
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_scale_conf_bounds_the_shuffle_partitions():
    from abspark.session import MAX_SHUFFLE_PARTITIONS, scale_conf

    conf = scale_conf(2 * 2 ** 40)
    assert int(conf["spark.sql.shuffle.partitions"]) == 2 * 2 ** 40 // (256 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true" and conf["spark.sql.session.timeZone"] == "UTC"
    assert int(scale_conf(1 << 20)["spark.sql.shuffle.partitions"]) == 200
    assert int(scale_conf(100 * 2 ** 40)["spark.sql.shuffle.partitions"]) == MAX_SHUFFLE_PARTITIONS


def test_records_in_treatment_counts_null_ids_and_keeps_null_flags(spark):
    from types import SimpleNamespace

    from abspark.operators import questions

    rows = [("E", "t1", None, "Y"), ("E", "t1", "u1", "N"), ("E", "t1", "u2", None), ("E", "t2", "u3", None)]
    kpi = spark.createDataFrame(rows, "entity_id string, test_name string, perseus_client_id string, session_in_treatment_flag string")
    got = {r.test_name: (r.n_n, r.n_unknown, r.n_y, r.perc_in_treatment)
           for r in questions.records_in_treatment(SimpleNamespace(gated_kpis_exp=kpi)).collect()}
    assert got == {"t1": (1, None, 1, 0.5), "t2": (None, None, None, 1.0)}
