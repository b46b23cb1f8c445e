"""Registered queries against their DuckDB oracle on the smallest tables.

A selection runs by default; FULL_TESTS=all runs every registered query.
"""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, oracle
from tillbook.catalog import load_all

SF = "/root/testdata/sf0.001"
SMOKE = """daily_summary next_month_join store_risk_score service_score sales_scorecard cascading_match nearest_asof
event_window_join time_slot_inherit refund_inherit store_daily_actuals platform_pivot cs_issue_mart menu_total_agg
review_topic_counts parse_mixed_date parse_localized_datetime order_type_classify platform_revenue_rule main_item_segments
remainder_allocation adjustment_rows store_scoped_blacklist collection_compare monthly_operation order_structure
unify_receipts unify_union_pos unify_platform_b target_achievement month_forecast_fill token_overlap_match spearman_test
independence_test scan_csv_union append_unique upsert_keep_last incremental_file_ingest stream_dedup_ingest
line_grain_ingest rule_diagnosis item_evidence sales_band_alerts count_amount_check log_error_extract linear_regression_two""".split()
NAMES = list(load_all().QUERIES) if os.environ.get("FULL_TESTS") == "all" else SMOKE


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, note


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    base = load_all()
    assert set(base.QUERIES) <= set(entry.queries())
    assert set(base.QUERIES) - set(base.ORACLE) == {"linear_regression"}


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
