"""Question operators on hand-made result rows (the study's edge cases)."""

import math
from types import SimpleNamespace

from abspark.config import PipelineConfig
from abspark.operators import questions

SCHEMA = (
    "entity_id string, country_code string, test_id long, test_name string, test_start_date timestamp, "
    "test_end_date timestamp, test_length long, first_parent_vertical string, second_parent_vertical string, "
    "variant string, avg_order_count_per_user_delta double, order_count_per_user_p_val double, "
    "avg_profit_per_user_delta double, profit_per_user_p_val double, granularity string, "
    "order_count_per_user_sig_flag string, profit_per_user_sig_flag string, perc_treatment_orders double")


def _row(test_id, length, gran, d_oc, p_oc, d_pr, p_pr, share, variant="Variation1"):
    flag = lambda p: "Sig" if p is not None and p <= 0.1 else "Not Sig"
    return ("E", "c", test_id, f"t{test_id}", None, None, length, "restaurant", None, variant,
            d_oc, p_oc, d_pr, p_pr, gran, flag(p_oc), flag(p_pr), share)


def _pipe(spark, rows):
    pipe = SimpleNamespace(analysis=spark.createDataFrame(rows, SCHEMA), cfg=PipelineConfig())
    pipe.ts_exp_comparison = questions.ts_exp_comparison(pipe)
    return pipe


def test_significance_by_length_odds(spark):
    rows = [
        _row(1, 5, "exp", 0.1, 0.05, 0.1, 0.5, 0.3),     # bin 1: Sig only -> odds inf
        _row(2, 6, "exp", 0.1, 0.01, 0.1, 0.5, 0.3),
        _row(3, 10, "exp", 0.1, 0.5, 0.1, 0.5, 0.3),     # bin 2: Not Sig only -> 0
        _row(4, 80, "exp", 0.1, 0.05, 0.1, 0.5, 0.3),    # beyond the last edge: no bin
        _row(5, 12, "ts", 0.1, 0.05, 0.1, 0.5, 0.3),     # bin 2 ts: 1 Sig, 1 Not Sig -> 1.0
        _row(6, 13, "ts", 0.1, 0.5, 0.1, 0.5, 0.3),
    ]
    got = {(r.granularity, r.test_length_bin, r.sig_flag): (r.freq, r.sig_pct)
           for r in questions.significance_by_length(_pipe(spark, rows)).where("kpi = 'order_count'").collect()}
    assert got[("exp", 1, "Sig")] == (2, math.inf) and got[("exp", 1, "Not Sig")] == (0, math.inf)
    assert got[("exp", 2, "Not Sig")] == (1, 0.0) and got[("exp", 2, "Sig")] == (0, 0.0)
    assert got[("ts", 2, "Sig")] == (1, 1.0)
    assert got[("exp", 5, "Sig")] == (0, 0.0)           # empty bins are listed with 0
    assert len(got) == 2 * 11 * 2                       # granularities x bins x flags
    assert sum(f for f, _ in got.values()) == 5         # the length-80 row is in no bin


def test_significance_by_share_props(spark):
    rows = [_row(1, 7, "exp", 0.1, 0.05, 0.1, 0.5, 0.1), _row(2, 7, "exp", 0.1, 0.5, 0.1, 0.5, 0.15),
            _row(3, 7, "exp", 0.1, 0.5, 0.1, 0.5, 0.5), _row(4, 7, "exp", 0.1, 0.5, 0.1, 0.5, 0.0)]
    got = {(r.share_bin, r.sig_flag): (r.freq, r.prop)
           for r in questions.significance_by_share(_pipe(spark, rows)).where("kpi = 'order_count'").collect()}
    assert got[("(0, 0.2]", "Sig")] == (1, 0.5) and got[("(0, 0.2]", "Not Sig")] == (1, 0.5)
    assert got[("(0.2, 0.5]", "Not Sig")] == (1, 1.0)   # 0.5 is in the middle bin (right-closed)
    assert got[("(0.5, 1]", "Sig")] == (0, None)        # empty bin: 0 / 0 -> NULL
    assert sum(f for f, _ in got.values()) == 3         # share 0 is in no bin


def test_direction_with_null_delta(spark):
    rows = []
    for t, (d_ts, d_exp) in enumerate([(0.1, -0.2), (0.1, 0.3), (None, -0.1), (0.0, -0.5)]):
        rows.append(_row(t, 7, "ts", d_ts, 0.5, 0.1, 0.5, 0.3))
        rows.append(_row(t, 7, "exp", d_exp, 0.5, 0.1, 0.5, 0.3))
    out = {r.delta_direction: r for r in questions.direction_agreement(_pipe(spark, rows)).where(
        "kpi = 'order_count'").collect()}
    # only test 0 points opposite ways; a NULL or zero delta counts as the same direction
    assert out["Delta - Opposite Direction"].freq == 1 and out["Delta - Same Direction"].freq == 3
    assert out["Delta - Opposite Direction"].share == 0.25 and out["Delta - Opposite Direction"].many_opposite is False


def test_agreement_in_one_pass_with_cuts_that_no_test_is_in(spark):
    rows = [_row(1, 5, "exp", 0.1, 0.05, 0.1, 0.5, 0.3), _row(1, 5, "ts", -0.1, 0.05, 0.2, 0.01, 0.3),
            _row(2, 5, "exp", 0.1, None, 0.1, 0.5, 0.3)]  # no ts row: its flags are NULL there
    got = questions.significance_agreement(_pipe(spark, rows))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Join") == 1
    cells = {(r.kpi, r.data_cut): tuple(r)[2:] for r in got.collect()}
    assert cells == {("order_count", "All Experiments"): (0, 0, 0, 1), ("order_count", "Opposite Deltas"): (0, 0, 0, 1),
                     ("profit", "All Experiments"): (0, 0, 1, 0), ("profit", "Opposite Deltas"): (0, 0, 0, 0)}
    none = questions.significance_agreement(_pipe(spark, [])).collect()
    assert len(none) == 4 and all(tuple(r)[2:] == (0, 0, 0, 0) for r in none)


def test_wide_length_table(spark):
    rows = [_row(1, 5, "exp", 0.1, 0.05, 0.1, 0.5, 0.3), _row(2, 5, "exp", 0.1, 0.5, 0.1, 0.5, 0.3),
            _row(3, 30, "exp", 0.1, 0.01, 0.1, 0.5, 0.3)]
    got = questions.significance_by_length_wide(_pipe(spark, rows))
    assert got.columns[4:] == [f"{g}_{f}_{v}" for g in ("exp", "ts") for f in ("not_sig", "sig") for v in ("freq", "sig_pct")]
    by_bin = {r.test_length_bin: r for r in got.where("kpi = 'order_count'").collect()}
    assert len(by_bin) == 11
    assert (by_bin[1].exp_sig_freq, by_bin[1].exp_not_sig_freq, by_bin[1].exp_sig_sig_pct) == (1, 1, 1.0)
    assert (by_bin[5].exp_sig_freq, by_bin[5].exp_sig_sig_pct) == (1, math.inf) and by_bin[2].exp_sig_freq == 0
    assert all(r.ts_sig_freq is None for r in by_bin.values())  # no ts row at all
