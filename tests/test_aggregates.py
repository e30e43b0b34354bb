from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlens.operators import aggregates as A
from meterlens.operators import filters as P
from meterlens.operators import profile as R
from meterlens.operators import thresholds as X
from meterlens.plans import reports
from meterlens.schema import FEATURES
from tests.conftest import START


def test_weather_needs_100_rows(make_readings):
    def rows(n):
        return make_readings([
            {"meter_reading": float(i), "air_temperature": float(i * i % 17), "wind_speed": 3.0}
            for i in range(n)
        ])

    assert A.weather_correlation(rows(99)).count() == 0
    assert A.temperature_ranges(rows(99)).count() == 0
    assert A.weather_correlation(rows(99), min_rows=0).first().sample_size == 99
    bins = A.temperature_ranges(rows(99), min_rows=0).orderBy("bin").collect()
    assert [r.bin for r in bins] == [1, 2, 3, 4, 5] and sum(r["count"] for r in bins) == 99
    empty = [(r["mean"], r.std) for r in bins if r["count"] == 0]
    assert empty == [(None, None)]
    assert A.temperature_ranges(rows(99), wind=False, min_rows=0).count() == 4
    assert A.temperature_ranges(rows(0), min_rows=0).count() == 0
    row = A.weather_correlation(rows(100)).first()
    x = np.arange(100.0)
    assert row.temperature == pytest.approx(np.corrcoef(x, x * x % 17)[0, 1])
    assert row.wind_speed is None
    assert A.weather_correlation(rows(100), wind=False).first().wind_speed == 0.0
    trend = {r.measure: r for r in A.weather_trend(rows(100)).collect()}
    assert trend["wind_speed"].slope is None


def test_peak_hours_need_more_than_ten(make_readings):
    low = [{"hour": 1, "meter_reading": 1.0}] * 50
    for n, peak in ((10, False), (11, True)):
        df = make_readings(low + [{"hour": 5, "meter_reading": 90.0}] * n)
        found = {r.hour: r.is_peak for r in A.hourly_patterns(df).collect()}
        assert found == {1: False, 5: peak}


def test_type_rates_come_from_rounded_values(make_readings):
    df = make_readings([
        {"meter_reading": 1.005, "square_feet": 3.0, "anomaly": 1},
        {"meter_reading": 2.0, "square_feet": 3.0},
        {"meter_reading": None, "primary_use": "Office", "square_feet": 4.0},
        {"primary_use": None},
    ])
    row = A.type_performance(df).collect()
    assert len(row) == 1
    assert (row[0].meter_reading_count, row[0].anomaly_rate) == (2, 50.0)
    assert row[0].square_feet_mean == 3.33
    assert row[0].consumption_per_sqft == pytest.approx(
        round(row[0].meter_reading_mean / 3.33 * 1000, 3)
    )


def test_comparison_without_anomalies(make_readings):
    row = A.anomaly_comparison(make_readings([{}, {}])).first()
    assert (row.anomaly_rate, row.anomaly_avg, row.normal_avg) == (0.0, None, None)
    assert A.worst_building(make_readings([{}])).count() == 0
    assert A.overall_stats(make_readings([])).first().anomaly_rate == 0.0


def test_first_attributes_and_null_readings(make_readings):
    df = make_readings([
        {"primary_use": "Retail", "timestamp": START + dt.timedelta(days=1)},
        {"primary_use": "Office", "timestamp": START, "meter_reading": None, "anomaly": 1},
    ])
    row = A.building_summary(df).first()
    assert (row.primary_use, row.total_readings, row.avg_consumption) == ("Office", 2, 10.0)
    assert row.anomaly_rate == 50.0 and row.is_marked
    assert A.building_detail(df).first().total_readings == 1


def test_explorer_filter(make_readings):
    days = [{"timestamp": START + dt.timedelta(hours=12 * i), "building_id": i} for i in range(8)]
    df = make_readings(days)
    assert P.explorer_filter(df).count() == 8
    assert P.explorer_filter(df, temp_min="", primary_use=None).count() == 8
    ids = P.explorer_filter(df, date_from="2024-01-02", date_to="2024-01-03")
    assert sorted(r.building_id for r in ids.collect()) == [2, 3, 4, 5]
    assert P.explorer_filter(df, building_id_min=2, building_id_max=3).count() == 2
    assert P.explorer_filter(df, temp_max=0).count() == 0
    with pytest.raises(ValueError):
        P.explorer_filter(df, colour="red")


def test_pages(make_readings):
    df = make_readings([{} for _ in range(120)])
    third = P.explorer_page(df, 3).collect()
    assert len(third) == 20 and third[0].total == 120 and third[0].pages == 3
    first = P.page_after(df.select("row_id"), "row_id", None, 50).collect()
    second = P.page_after(df.select("row_id"), "row_id", first[-1].row_id, 50).collect()
    assert [r.row_id for r in second] == list(range(50, 100))


def test_merge_keys(spark):
    a = spark.createDataFrame([(1, "x")], "row_id int, v string")
    b = spark.createDataFrame([(1, "y", 2)], "row_id int, v string, w int")
    assert P.merge_key(a, b) == "row_id"
    assert P.join_on_merge_key(a, b).collect() == [(1, "x", 2)]
    with pytest.raises(ValueError):
        P.join_on_merge_key(a.drop("row_id"), b)
    sides = {r.column_name: r.side for r in P.schema_compare(a, b).collect()}
    assert sides == {"row_id": "common", "v": "common", "w": "right only"}


def test_rows_as_multisets(spark):
    schema = "a int, b string, {} int"
    left = spark.createDataFrame([(1, "x", 0)] * 3 + [(2, None, 0), (3, "z", 0)], schema.format("l"))
    right = spark.createDataFrame([(1, "x", 5), (2, None, 6), (2, None, 7), (4, "w", 8)], schema.format("r"))
    found = {r.a: (r.b, r.in_both, r.left_only, r.right_only) for r in P.row_compare(left, right).collect()}
    assert found == {1: ("x", 1, 2, 0), 2: (None, 1, 0, 1), 3: ("z", 0, 1, 0), 4: ("w", 0, 0, 1)}
    with pytest.raises(ValueError):
        P.row_compare(left.select("l"), right)
    sides = {r.column_name: (r.left_type, r.right_type, r.side) for r in P.schema_sides(
        left, right.withColumn("a", F.col("a").cast("long"))).collect()}
    assert sides == {"a": ("int", "bigint", "common"), "b": ("string", "string", "common"),
                     "l": ("int", None, "left only"), "r": (None, "int", "right only")}


def test_nan_is_missing_in_all_statistics(spark, make_readings):
    nan = float("nan")
    df = make_readings([{"meter_reading": x, "air_temperature": x} for x in (1.0, nan, 3.0, None)])
    stats = A.building_statistics(df).first()
    assert (stats["count"], stats["mean"], stats["std"], stats["min"], stats["max"], stats["median"]) == (
        2, 2.0, 1.0, 1.0, 3.0, 2.0)
    moments = A.building_moments(df).first()
    assert {c: moments[c] for c in moments.asDict()} == {
        c: stats[c] for c in ("building_id", "mean", "std", "min", "max", "count")}
    described = {r.column_name: r for r in R.numeric_describe(df).collect()}
    row = described["meter_reading"]
    assert (row["count"], row["mean"], row["p50"], row["max"]) == (2, 2.0, 2.0, 3.0)
    assert row["std"] == pytest.approx(2 ** 0.5)
    empty = R.numeric_describe(df.where("false")).collect()
    assert {r["count"] for r in empty} == {0} and {r["mean"] for r in empty} == {None}
    limits = {r.parameter: r for r in X.feature_thresholds(df).collect()}
    assert (limits["air_temperature"]["mean"], limits["air_temperature"]["q1"]) == (2.0, 1.5)
    latest = A.building_statistics(df, latest=True).first()
    assert (latest.meter_reading, latest.timestamp) == (3.0, START + dt.timedelta(hours=2))


def test_merged_moments_keep_their_digits(make_readings):
    """Squared deviations merge over bins: large values that hardly differ keep their spread."""
    values = [1e9 + i % 7 for i in range(400)] + [-1e9 - i % 3 for i in range(100)]
    for part in (values[:400], values):
        row = A.building_statistics(make_readings([{"meter_reading": v} for v in part])).first()
        assert row["mean"] == pytest.approx(np.mean(part), rel=1e-12)
        assert row["std"] == pytest.approx(np.std(part), rel=1e-7)


def test_profile(spark):
    rows = [(1, "a", None), (2, "b", 1), (3, "a", 0)]
    df = spark.createDataFrame(rows, "n int, t string, my_label int")
    assert P.columns_of_kind(df, "numeric") == ["n", "my_label"]
    nulls = {r.column_name: (r.data_type, r.non_null) for r in R.null_profile(df).collect()}
    assert nulls == {"n": ("int", 3), "t": ("string", 3), "my_label": ("int", 2)}
    assert R.categorical_profile(df).collect() == [("t", 2, ["a", "b"])]
    found = {r.value: r.percentage for r in R.label_distribution(df).collect()}
    assert found == {"0": pytest.approx(100 / 3), "1": pytest.approx(100 / 3)}
    assert R.label_distribution(df.select("n")).count() == 0
    many = df.select(*[F.lit("x").alias(f"c{i}") for i in range(10)])
    assert sorted(R.categorical_profile(many).collect()) == sorted(
        (f"c{i}", 1, ["x"]) for i in range(10))
    fifteen = spark.range(15).select(F.format_string("v%02d", "id").alias("t"))
    assert len(R.categorical_profile(fifteen).first().listed) == 15
    assert R.categorical_profile(fifteen, listed_below=15).first().listed is None


def test_explanations(spark, make_readings):
    rows = make_readings([{"meter_reading": 700.0, "air_temperature": None}, {}])
    defaults = X.default_thresholds(spark)
    found = X.anomalous_parameters(rows, defaults).collect()
    assert [(r.parameter, r.severity, r.expected_range) for r in found] == [
        ("meter_reading", "HIGH", "0.00 - 500.00")
    ]
    explained = X.explain_rows(rows, defaults).orderBy("row_id").collect()
    assert [r.anomaly_count for r in explained] == [1, 0]
    entry = explained[0].anomalous_parameters[0]
    assert (entry.parameter, entry.deviation, entry.severity) == ("meter_reading", 5.5, "HIGH")


def test_zero_std_has_zero_deviation(spark, make_readings):
    schema = ("parameter string, mean double, std double, min double, max double, "
              "q1 double, q3 double")
    limits = spark.createDataFrame([("month", 5.0, 0.0, 5.0, 5.0, 5.0, 5.0)], schema)
    row = X.anomalous_parameters(make_readings([{"month": 6}]), limits).first()
    assert (row.deviation, row.severity) == (0.0, "LOW")


def test_defaults_fill_missing_parameters(make_readings):
    df = make_readings([{}, {"meter_reading": 30.0}]).drop("wind_speed")
    merged = {r.parameter: r for r in X.with_defaults(X.feature_thresholds(df)).collect()}
    assert set(merged) == set(FEATURES)
    assert merged["wind_speed"]["max"] == 15.0
    assert merged["meter_reading"]["mean"] == 20.0


def test_reports(make_readings):
    rows = [
        {"building_id": i % 3, "meter_reading": 100.0 - i % 24, "hour": i % 24,
         "air_temperature": float(i % 24), "primary_use": "Office" if i % 2 else "Retail",
         "anomaly": int(i % 3 == 2)}
        for i in range(120)
    ]
    found = {r.kind: r for r in reports.insights(make_readings(rows)).collect()}
    assert found["worst_building"].subject == "2"
    assert found["temperature_effect"].subject == "decreases"
    assert found["peak_hour"].subject == "0"
    assert found["most_efficient_type"].subject == "Office"
    assert found["least_efficient_type"].subject == "Retail"
    assert reports.complete_analysis(make_readings(rows[:99])) == {}
    df = make_readings(rows)
    overview = reports.overview(df)
    assert overview["stats"].first().labeled_anomalies == 40
    assert overview["building_types"].count() == 2
    assert reports.building_page(df, page=2, size=2)["buildings"].first().building_id == 2
    details = reports.building_details(df, 2)
    assert details["info"].first().year_built == 2000
    assert details["recent"].count() == 24
    assert details["statistics"].first().anomaly_count == 40
    detected = df.limit(3).withColumn("detected_at", F.current_timestamp())
    feed = reports.anomaly_feed(df, detected)
    assert {r.source: r.row_count for r in feed["counts"].collect()} == {
        "labeled": 20, "detected": 3,
    }
    full = reports.complete_analysis(make_readings(rows))
    assert {k: set(v) for k, v in full.items()} == {
        "weather": {"correlations", "temperature_ranges", "trend"},
        "buildings": {"types", "sizes"},
        "temporal": {"hours", "weekdays", "months", "peak_hours"},
        "anomalies": {"comparison", "types"},
        "insights": {"insights"},
    }
    assert full["weather"]["correlations"].first().sample_size == 120
    assert reports.complete_analysis(make_readings(rows), 110)["anomalies"]["comparison"].first(
    ).total_readings == 110
