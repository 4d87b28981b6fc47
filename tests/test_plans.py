"""Physical plans: what is pushed down, and what must not appear."""

from __future__ import annotations

import re

import __spark_entry__ as entry_module
import pytest

SF_DIR = "/root/testdata/sf0.01"


def plan(spark, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


# Training-data operators run for longer and have plan tests of their own.
NAMES = [n for n in sorted(entry_module.queries()) if not re.match(r"op\d+_|pipeline$", n)]


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_row_at_a_time_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_top1_keeps_one_row_per_task(spark):
    text = plan(spark, "top1_by_measure")
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_classifier_stays_in_the_jvm(spark):
    assert "Python" not in plan(spark, "classify_rules")
    assert "Python" not in plan(spark, "classify_rules_udf")
    assert "ArrowEvalPython" in plan(spark, "classify_rules_arrow")


@pytest.mark.parametrize("name", ["filter_eq_top1", "cohort_avg", "avg_since_top1", "pct_change"])
def test_year_filters_reach_the_scan(spark, name):
    pushed = plan(spark, name).split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual" in pushed


def test_scans_read_only_needed_columns(spark):
    schema = plan(spark, "group_avg").split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["l_quantity", "l_returnflag"]


@pytest.mark.parametrize("name", ["first_place_counts", "rank_of_argmax"])
def test_few_large_partitions_meet_no_window(spark, name):
    assert "Window" not in plan(spark, name)


@pytest.mark.parametrize("name", ["rank_in_partition_text", "rank_in_partition_cells"])
def test_rank_deals_rows_once_and_joins_offsets_by_broadcast(spark, name):
    text = plan(spark, name)
    assert text.count("passthrough") == 1 and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    # Nothing but the dealt rows is below the ranking window.
    window = text[text.index("Window [rank") :].split("\n")
    assert "Sort" in window[1] and "passthrough" in window[2]


@pytest.mark.parametrize(
    "name", ["panel_rank_of_richest", "panel_gdp_change", "panel_longest_lived_in_year"]
)
def test_panel_years_reach_the_scan(spark, name):
    dates = _date_filters(spark, name)
    assert dates and all("GreaterThanOrEqual" in d and "LessThan(" in d for d in dates)


def test_panel_range_reaches_the_scan(spark):
    assert all("GreaterThanOrEqual" in d for d in _date_filters(spark, "panel_longest_lived"))


def _date_filters(spark, name):
    """Filters on the date that the scans of all jobs of a query push down."""
    seen, panel = [], entry_module._panel
    years = {
        "panel_rank_of_richest": entry_module._in_year("l_shipdate", 2000),
        "panel_gdp_change": entry_module._in_year("l_shipdate", 2000),
        "panel_longest_lived_in_year": entry_module._in_year("l_shipdate", 1999),
        "panel_longest_lived": entry_module._from_year("l_shipdate", 1997),
    }
    text = panel(spark, SF_DIR, years[name]).history._jdf.queryExecution().executedPlan().toString()
    for part in text.split("PushedFilters: [")[1:]:
        filters = part.split("]")[0]
        if "l_shipdate" in filters:
            seen.append(filters)
    return seen
