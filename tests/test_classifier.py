from __future__ import annotations

import random

import pytest

from meterlens.operators import classifier as C
from meterlens.operators.sampling import sample_fraction, sample_readings, stratified_split
from meterlens.operators.thresholds import feature_thresholds
from meterlens.schema import FEATURES


@pytest.fixture(scope="module")
def rows():
    """Anomalies are high readings at night."""
    rng = random.Random(3)
    out = []
    for i in range(600):
        odd = rng.random() < 0.2
        out.append({
            "row_id": i, "anomaly": int(odd), "air_temperature": rng.uniform(-5, 30),
            "meter_reading": rng.uniform(300, 500) if odd else rng.uniform(50, 200),
            "hour": rng.randrange(0, 5) if odd else rng.randrange(24),
        })
    return out


def test_nulls_are_dropped(make_readings):
    df = make_readings([{}, {"wind_speed": None}, {"anomaly": None}])
    assert C.training_set(df).columns == ["row_id", *FEATURES, "anomaly"]
    assert C.training_set(df).count() == 1
    assert C.training_set(df.drop("wind_speed")).count() == 2
    assert C.class_counts(C.training_set(df)).collect() == [(0, 1)]


def test_training_end_to_end(spark, make_readings, rows, tmp_path):
    readings = make_readings(rows)
    path, metrics = str(tmp_path / "model"), str(tmp_path / "metrics")
    report = C.run_training(readings, path, rounds=5, metrics_path=metrics)
    by_class = {r["class"]: r for r in report.collect()}
    anomalies = sum(r["anomaly"] for r in rows)
    assert by_class[1].support == round(anomalies * 0.2)
    assert by_class[1].recall > 0.9 and by_class[1].accuracy > 0.95
    stored = {r.metric: r.value for r in spark.read.parquet(metrics).collect()}
    assert stored["accuracy"] == by_class[0].accuracy
    assert stored["recall_1"] == by_class[1].recall

    model = C.load_model(path)
    assert C.model_features(model) == FEATURES
    assert C.area_under_pr(model, C.training_set(readings)) > 0.95
    scored = C.score(model, readings, feature_thresholds(readings)).collect()
    assert C.model_features(model) == FEATURES
    for r in scored:
        assert r.probability_normal + r.probability_anomaly == pytest.approx(1)
        assert r.prediction_label == ("Anomaly" if r.prediction else "Normal")
        assert r.confidence == max(r.probability_normal, r.probability_anomaly)
        assert r.anomaly_count == len(r.anomalous_parameters)
        assert r.missing_features == []

    partial = C.predict(model, readings.drop("wind_speed", "month")).first()
    assert partial.missing_features == ["wind_speed", "month"]
    zeros = readings.drop("wind_speed", "month").selectExpr("*", "0D wind_speed", "0 month")
    assert C.predict(model, zeros).first().probability_normal == partial.probability_normal

    schema = ("meter_reading double, building_id int, air_temperature double, wind_speed double, "
              "square_feet int, floor_count int, primary_use string, year_built int, hour int, "
              "day_of_week int, timestamp string")
    forms = spark.createDataFrame(
        [(450.0, 1, 20.0, 3.0, 5000, 3, "Office", 2010, 2, 5, "2024-06-01T02:00:00Z"),
         (100.0, 1, 20.0, 3.0, 5000, 3, "Barn", 2010, 14, 2, "2024-06-01T02:00:00Z")], schema)
    high, low = C.classify(model, forms).collect()
    assert (high.predicted_anomaly, high.is_weekend, high.known_type) == (1, True, True)
    assert (low.predicted_anomaly, low.is_business_hours, low.known_type) == (0, True, False)
    assert high.building_age == 15 and high.use_per_area == pytest.approx(0.09)


def test_report_without_positive_predictions(spark):
    matrix = spark.createDataFrame([(0, 0, 9), (1, 0, 1)], "label int, prediction int, row_count bigint")
    rows = {r["class"]: r for r in C.classification_report(matrix).collect()}
    assert (rows[1].precision, rows[1].recall, rows[1].f1) == (0.0, 0.0, 0.0)
    assert (rows[0].recall, rows[0].accuracy) == (1.0, 0.9)


def test_samples_are_exact(make_readings, rows):
    df = make_readings(rows + [{"row_id": 900, "meter_reading": None}])
    for n in (1, 77, 600, 10_000):
        first = {r.row_id for r in sample_readings(df, n).collect()}
        again = {r.row_id for r in sample_readings(df.repartition(7), n).collect()}
        assert len(first) == min(n, 600) and first == again
    other = {r.row_id for r in sample_readings(df, 77, seed=1).collect()}
    assert other != {r.row_id for r in sample_readings(df, 77).collect()}
    assert sample_readings(df, 0).count() == 0
    assert 0 < sample_fraction(df, 0.3).count() < 600


def test_split_is_exact_per_label(make_readings, rows):
    split = stratified_split(make_readings(rows)).collect()
    for label in (0, 1):
        mine = [r for r in split if r.anomaly == label]
        assert sum(r.is_test for r in mine) == round(len(mine) * 0.2)
    few = stratified_split(make_readings([{}, {}])).collect()
    assert [r.is_test for r in few] == [False, False]
