"""A representative set of registered queries against the DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
KEYS = ["target_groups", "zone_geography", "orders_in_zone", "clean_orders", "experiment_sessions",
        "kpis_per_user", "significance_combined", "significance_by_length", "records_in_treatment_bins",
        "clean_orders_exact_scheme", "order_profit_fee_fallback", "kpis_per_user_all_verticals",
        "order_profit_multi_vertical", "orders_in_zone_geodesic", "clean_orders_geodesic", "mann_whitney_exact",
        "significance_by_length_wide", "significance_agreement", "significance_combined_multi_vertical"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("supplier", "lineitem", "orders", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    res = con.execute(entry.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert rows_of(df.columns, df.collect()) == rows_of(o_cols, res.fetchall())


def test_most_small_samples_take_the_exact_branch(spark):
    rows = entry.queries()["mann_whitney_exact"](spark, SF).groupBy("method").count().collect()
    counts = {r.method: r["count"] for r in rows}
    assert counts["exact"] > 100 and counts["exact"] > counts.get("asymptotic", 0)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and {r.granularity for r in rows} == {"exp", "ts"}
    assert all(0 <= r.profit_per_user_p_val <= 1 for r in rows if r.profit_per_user_p_val is not None)
