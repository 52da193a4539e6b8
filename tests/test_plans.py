"""Physical plan properties the design relies on (checked with explain)."""

import re

import pytest

from envstats.plans import catalog

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    names = ["county_risk", "region_summary", "rolling_trend", "top20_regions",
             "null_profile", "duplicate_report"]
    return {n: _plan(catalog.QUERIES[n](spark, SF_SMALL)) for n in names}


def test_scan_reads_only_needed_columns(plans):
    rs = re.findall(r"ReadSchema: struct<([^>]*)>", plans["county_risk"])
    lineitem = [r for r in rs if "l_suppkey" in r]
    assert lineitem and set(lineitem[0].replace(":bigint", "").replace(":int", "")
                            .replace(":double", "").split(",")) == {"l_suppkey", "l_linenumber",
                                                                    "l_discount"}


def test_unused_dimensions_not_joined(plans):
    assert "Join" not in plans["county_risk"]


def test_dimension_joins_broadcast_and_partial_aggregation(plans):
    p = plans["region_summary"]
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "partial_avg" in p and "partial_count" in p


def test_window_not_preceded_by_global_sort(plans):
    assert "rangepartitioning" not in plans["rolling_trend"]
    assert "Window" in plans["rolling_trend"]


def test_top_k_is_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["top20_regions"]


def test_profiles_are_one_pass(plans):
    for name in ("null_profile", "duplicate_report", "county_risk"):
        assert plans[name].count("lineitem.parquet") == 1, name
