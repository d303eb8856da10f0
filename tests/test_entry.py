"""The driver contract and a sample of registered queries against DuckDB on the smallest data."""
import re

import pytest

import __spark_entry__ as entry
from oracle import compare, duck
from retail_analytics.plans import load_all

SF = "/root/testdata/sf0.001"
SAMPLE = ["a1_parameterised_scan", "a13_output_per_branch", "b8_virtual_zones", "c0b_run_rate", "c8_all_brands_coverage", "c15_concept_table",
          "c23_size_brand_matrix", "d14_client_history", "d16_grouped_history", "d21_daily_matrix", "e12_capital_abc", "e18_dead_stock", "e15_closest_article", "g2_rfm_segments", "g9_growth_bridge",
          "g7_retention", "h9_control_limits", "i9_category_rules", "j2_margin_table", "j6_discount_outliers", "j7_price_cells", "a12_incremental_summary", "a8_price_quarantine",
          "l3_reconciliation_on_write", "c1_coverage_heavy_client", "c0b_delivery_gaps", "f15_weighted_percentiles", "k3_rejection_metrics", "m2_split_residue_largest", "n9_frame_diff"]


def test_contract(spark):
    q, o = entry.queries(), entry.oracle_sql()
    assert len(q) > 300 and set(o) <= set(q)
    q, o = ({k: v for k, v in x.items() if k in load_all()} for x in (q, o))       # the numbered operators have their own tests
    assert all(re.match(r"^(c0[a-i]|[a-n]\d+)_[a-z0-9_]+$", k) for k in q)
    assert set(q) == set(o) == set(load_all())
    df = entry.entry(spark)
    assert df.count() > 0 and "cantidad" in df.columns


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_matches_duckdb(spark, name):
    got = compare(spark, duck(SF), load_all()[name], SF)
    assert got in (None, "empty result"), got


def test_unused_client_join_disappears(spark):
    """A report without client columns does not join the client dimension, one with them does."""
    def client_columns(name):
        return load_all()[name].run(spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("c_mktsegment")
    assert client_columns("d1_daily_sales") == 0 and client_columns("n16_channel_discount") > 0
