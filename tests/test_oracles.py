"""Queries against their SQL twins on the smallest tables, one per family."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare

FAST = ["market_rollup", "market_features", "segment_rollup", "weekly_sat", "spine_ffill",
        "lineitem_profile", "date_grain", "numeric_promotion", "abbreviated_subtypes",
        "model_routes", "candidate_window", "quarter_parse", "channel_groups", "model_matrix",
        "bocpd_probs", "cp_candidates", "integration_report", "validation_checks",
        "psi_segment", "acf_hints", "gate_decision", "adstock_decays", "date_forms", "pacf_hints",
        "order_hints", "chain_diagnostics", "online_probs", "merged_profile", "spec_sheet",
        "change_payload"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, duck, folder, name):
    verdict = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], folder)
    assert verdict.startswith("ok"), verdict


def test_entry_returns_change_points(spark):
    df = entry.entry(spark)
    assert df.columns == ["product", "week", "t", "cp_prob", "exp_run_length"]
    assert df.count() > 0
