from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pytest

from meterlens.operators import detectors as D
from meterlens.operators.aggregates import building_statistics, latest_reading, recent_per_building
from tests.conftest import START


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_statistics(make_readings):
    values = [4.0, 9.0, 1.0, None, 7.0]
    row = only(building_statistics(make_readings([{"meter_reading": v} for v in values])))
    known = [v for v in values if v is not None]
    assert row["count"] == 4
    assert row["std"] == pytest.approx(np.std(known))
    assert (row["min"], row["max"], row["mean"]) == (1.0, 9.0, 5.25)
    for name, q in (("q25", 25), ("median", 50), ("q75", 75)):
        assert row[name] == pytest.approx(np.percentile(known, q))


def test_constant_and_single_reading(make_readings):
    for rows in ([{"meter_reading": 5.0}] * 10, [{"meter_reading": 5.0}]):
        df = make_readings(rows)
        sigma, iqr = D.three_sigma(df).collect()[0], D.iqr(df).collect()[0]
        assert (sigma.is_anomaly, sigma.confidence, sigma.details) == (
            False, 0.0, "No variance in data",
        )
        assert (iqr.is_anomaly, iqr.confidence, iqr.details) == (False, 0.0, "No IQR variance")


def test_only_null_readings_give_no_statistics(make_readings):
    df = make_readings([{"meter_reading": None}] * 3)
    assert building_statistics(df).count() == 0
    assert latest_reading(df).count() == 0


def test_unknown_building_is_kept(make_readings):
    df = make_readings([{"building_id": 9}])
    stats = building_statistics(make_readings([{}, {"meter_reading": 11.0}]))
    row = only(D.three_sigma(df, stats))
    assert (row.is_anomaly, row.confidence, row.details) == (False, 0.0, "No historical data")
    assert only(D.iqr(df, stats)).details == "No historical data"


def statistics(spark, **values):
    base = {"building_id": 1, "mean": 10.0, "std": 2.0, "q25": 8.0, "q75": 12.0}
    base.update(values)
    schema = "building_id bigint, mean double, std double, q25 double, q75 double"
    return spark.createDataFrame([tuple(base.values())], schema)


def test_limits_are_strict(spark, make_readings):
    stats = statistics(spark)
    at, above = make_readings([{"meter_reading": 16.0}]), make_readings([{"meter_reading": 17.0}])
    assert not only(D.three_sigma(at, stats)).is_anomaly
    row = only(D.three_sigma(above, stats))
    assert row.is_anomaly and row.confidence == 1.0 and row.details == "Z-score: 3.50"
    # Bounds are 2 and 18.
    assert not only(D.iqr(make_readings([{"meter_reading": 18.0}]), stats)).is_anomaly
    row = only(D.iqr(make_readings([{"meter_reading": 1.0}]), stats))
    assert row.is_anomaly and row.confidence == pytest.approx(0.25)
    assert row.details == "IQR bounds: [2.00, 18.00]"


def hourly(n, last=None, building=1):
    rows = [
        {"building_id": building, "meter_reading": 10.0 + i % 2,
         "timestamp": START + dt.timedelta(hours=i)}
        for i in range(n)
    ]
    if last is not None:
        rows[-1]["meter_reading"] = last
    return rows


@pytest.mark.parametrize("n, readings, history", [(23, 23, None), (24, 24, 23), (25, 25, 24)])
def test_moving_average_sizes(make_readings, n, readings, history):
    row = only(D.moving_average_asof(make_readings(hourly(n, last=50.0))))
    assert row.n_readings == readings
    if history is None:
        assert row.details == "Insufficient data: 23 readings" and not row.is_anomaly
    else:
        past = [10.0 + i % 2 for i in range(history)]
        assert row.moving_avg == pytest.approx(np.mean(past))
        assert row.moving_std == pytest.approx(np.std(past))
        assert row.is_anomaly and row.confidence == 1.0


def test_moving_average_takes_the_25th_of_more(make_readings):
    # 30 half-hourly readings lie within 25 hours; the 25th counts as current.
    rows = hourly(30)
    for i, row in enumerate(rows):
        row["timestamp"] = START + dt.timedelta(minutes=30 * i)
    rows[24]["meter_reading"] = 77.0
    assert only(D.moving_average_asof(make_readings(rows))).current_reading == 77.0


def test_moving_average_as_of_now_finds_nothing(make_readings):
    df = make_readings(hourly(30))
    assert D.moving_average_asof(df, as_of="2030-01-01 00:00:00").count() == 0
    row = only(D.moving_average_asof(df, as_of="2024-01-02 05:00:00"))
    assert row.n_readings == 25
    batch = only(D.detect_batch(df, method="moving_avg", as_of="2030-01-01 00:00:00"))
    assert batch.details == "Insufficient data: 0 readings"


def test_moving_average_without_variance(make_readings):
    rows = [{"meter_reading": 5.0} for _ in range(25)]
    row = only(D.moving_average_asof(make_readings(rows)))
    assert (row.is_anomaly, row.details) == (False, "No variance in recent data")


def test_rolling_form_needs_full_history(make_readings):
    rows = D.moving_average(make_readings(hourly(26, last=50.0))).orderBy("row_id").collect()
    assert [r.n_readings for r in rows[:3]] == [0, 1, 2]
    assert rows[23].details == "Insufficient data: 23 readings"
    assert rows[24].n_readings == 24 and not rows[24].is_anomaly
    assert rows[25].is_anomaly


def test_votes(make_readings):
    row = only(D.detect_batch(make_readings(hourly(25, last=500.0))))
    assert row.is_anomaly and json.loads(row.details)["votes"] == "3/3"
    # With more, the closed range of 25 hours holds 26 readings and the 25th is current.
    row = only(D.detect_batch(make_readings(hourly(40, last=500.0))))
    assert row.is_anomaly and json.loads(row.details)["votes"] == "2/3"
    assert json.loads(row.details)["methods"]["3-Sigma"]["details"].startswith("Z-score")
    # The 25th reading of the range is odd, the latest is not.
    rows = hourly(40)
    rows[-2]["meter_reading"] = 14.0
    row = only(D.detect_batch(make_readings(rows)))
    assert not row.is_anomaly and json.loads(row.details)["votes"] == "1/3"


def test_batch_choices(spark, make_readings):
    df = make_readings(hourly(30) + hourly(30, last=90.0, building=2))
    assert [r.building_id for r in D.detect_batch(df, [2], "3sigma").collect()] == [2]
    ids = spark.createDataFrame([(1,)], "building_id bigint")
    assert [r.building_id for r in D.detect_batch(df, ids, "iqr").collect()] == [1]
    row = only(D.detect_latest(df, 2))
    assert row.is_anomaly and row.building_info.primary_use == "Office"
    assert row.statistics.total_readings == 30


def test_latest_breaks_ties_by_row(make_readings):
    df = make_readings([
        {"meter_reading": 1.0, "timestamp": START},
        {"meter_reading": 2.0, "timestamp": START},
        {"meter_reading": None, "timestamp": START + dt.timedelta(hours=1)},
    ])
    assert only(latest_reading(df)).meter_reading == 2.0
    recent = recent_per_building(df, 1)
    assert only(recent).row_id == 1
