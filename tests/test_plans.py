"""The physical plans keep the properties the design relies on."""

import contextlib
import io

import pytest

import __spark_entry__ as entry

from conftest import SF_SMOKE


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", ["monthly_mean_per_center", "top_regions_by_forecast", "coverage_percent"])
def test_headline_plans(spark, key):
    plan = _plan(entry.queries()[key](spark, SF_SMOKE))
    # the strict date filter reaches the Parquet scan as a timestamp range
    assert "GreaterThanOrEqual(l_shipdate," in plan
    # only the used lineitem columns are read
    read_schemas = [line for line in plan.splitlines() if "ReadSchema: struct<l_" in line]
    assert read_schemas and all("l_orderkey" not in line and "l_extendedprice" not in line for line in read_schemas)
    # dimensions are broadcast; no Python evaluation anywhere
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan
    assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan


def test_rare_keys_compute_their_input_once(spark):
    """The daily sums are written once; both uses read that, and no window holds a key's rows."""
    plan = _plan(entry.queries()["rare_key_anti_join"](spark, SF_SMOKE))
    assert "ReadSchema: struct<l_" not in plan and "LeftAnti" in plan and "Window" not in plan


@pytest.mark.parametrize("key", ["sorted_report", "report_positions", "single_file_report"])
def test_positions_need_no_global_window(spark, key):
    plan = _plan(entry.queries()[key](spark, SF_SMOKE))
    assert "Window" not in plan and "SinglePartition" not in plan


def test_reports_are_sorted(spark):
    for key in ("monthly_mean_per_center", "top_regions_by_forecast", "top_regions_by_forecast_rounded", "coverage_percent", "region_ranking", "category_trend"):
        assert "rangepartitioning" in _plan(entry.queries()[key](spark, SF_SMOKE))


def test_top_n_is_limited_before_its_shuffle(spark):
    plan = _plan(entry.queries()["top_regions_by_forecast"](spark, SF_SMOKE))
    assert plan.count("WindowGroupLimit") >= 2  # partial before the exchange, final after


def test_fits_are_partial_aggregates(spark):
    plan = _plan(entry.queries()["coverage_percent"](spark, SF_SMOKE))
    assert "partial_try_sum" in plan or "partial_sum" in plan
    assert "collect_list" not in plan
