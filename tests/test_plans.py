"""Properties of physical plans."""

from __future__ import annotations

import re

import pytest

from meterlens.plans.catalog import QUERIES

# Plans with a Python stage: the sketch whose state depends on every earlier bit.
WITH_PYTHON = {"dgim_count", "gbt_score", "gbt_facts", "classification_form", "head_types"}

ONE_CUT = {"sample_readings"}


def plan(spark, folder, name):
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITH_PYTHON))
def test_no_python_and_no_row_products(spark, folder, name):
    text = plan(spark, folder, name)
    assert not re.search(r"Python|InPandas|InArrow", text)
    assert "CartesianProduct" not in text
    # Nested loops only against the one row of a global aggregate; a sample has one cut.
    kinds = {("BuildRight", "Cross")} | ({("BuildRight", "Inner")} if name in ONE_CUT else set())
    assert set(re.findall(r"BroadcastNestedLoopJoin (\w+), (\w+)", text)) <= kinds


@pytest.mark.parametrize("name", ["latest_reading", "building_summary", "exact_dedup",
                                  "building_statistics", "bloom_dedup"])
def test_no_sort_before_aggregation(spark, folder, name):
    text = plan(spark, folder, name)
    partial = [line for line in text.splitlines() if "SortAggregate" in line and "partial" in line]
    # What is sorted is one row per building and attribute set, never readings.
    assert all("_first" in line or "_order" in line for line in partial)
    assert "partial_min(((" not in "".join(partial)


@pytest.mark.parametrize("name", ["recent_24", "moving_average_asof"])
def test_top_rows_are_cut_before_the_shuffle(spark, folder, name):
    text = plan(spark, folder, name)
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_only_short_lists_of_texts_are_gathered(spark, folder):
    text = plan(spark, folder, "categorical_profile")
    # Two tables: values are gathered behind a semi join with their columns of few values.
    assert len(re.findall(r"Filter \(distinct_values#\d+L < 20\)", text)) == 2
    assert text.count("LeftSemi") == 2 and text.count("partial_collect_list") == 2


@pytest.mark.parametrize("name", ["recent_readings", "recent_anomalies", "building_types"])
def test_top_k_is_not_a_global_sort(spark, folder, name):
    assert "TakeOrderedAndProject" in plan(spark, folder, name)


def test_statistics_are_made_in_few_scans(spark, folder, monkeypatch):
    """Every plan that is written counts: the readings are read three times for an ensemble."""
    from meterlens.operators import aggregates, detectors, quantiles, rollup
    from meterlens.plans import reports
    from meterlens.sources.events import readings
    from meterlens.storage import durable

    rows = durable(readings(spark, folder))
    path = rows.inputFiles()[0].rsplit("/", 1)[0].rsplit("/", 1)[1]
    read = []

    def scans(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return len(re.findall(rf"FileScan parquet .*{path}", plan))

    def counted(df, *partitions):
        read.append(scans(df))
        return durable(df, *partitions)

    for module in (detectors, quantiles, rollup, reports):
        monkeypatch.setattr(module, "durable", counted)

    def total(make):
        read.clear()
        last = scans(make())
        return sum(read) + last

    # Without adaptive execution the plan shows which exchanges are reused before it runs.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert total(lambda: aggregates.building_statistics(rows)) == 2
        assert total(lambda: detectors.ensemble(rows)) == 3
        assert total(lambda: detectors.iqr(rows)) == 3
        assert total(lambda: detectors.detect_batch(rows)) == 3
        assert total(lambda: reports.insights(rows)) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_counts_for_quantiles_are_shuffled_once(spark, folder):
    df = QUERIES["building_statistics"](spark, folder)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_projections_and_filters_reach_the_scan(spark, folder):
    text = plan(spark, folder, "distinct_buildings")
    assert re.search(r"ReadSchema: struct<user_id:bigint>", text)
    text = plan(spark, folder, "time_range")
    assert "GreaterThanOrEqual(ts," in text and "LessThanOrEqual(ts," in text
