from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from meterlens.schema import READINGS  # noqa: E402
from meterlens.session import session_builder  # noqa: E402

SF = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = (
        session_builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF


@pytest.fixture
def make_readings(spark):
    """Readings from dicts; what is not given has a plain default."""
    def make(rows):
        full = []
        for i, row in enumerate(rows):
            ts = row.get("timestamp", START + dt.timedelta(hours=i))
            base = {
                "row_id": i, "building_id": 1, "timestamp": ts, "meter_reading": 10.0,
                "anomaly": 0, "primary_use": "Office", "site_id": 1, "square_feet": 5000.0,
                "floor_count": 2.0, "year_built": 2000, "air_temperature": 20.0,
                "wind_speed": 3.0, "cloud_coverage": 4.0, "dew_temperature": 10.0,
                "sea_level_pressure": 1010.0, "hour": ts.hour, "weekday": ts.weekday(),
                "month": ts.month,
            }
            full.append({**base, **row})
        return spark.createDataFrame([tuple(r[n] for n in READINGS.names) for r in full], READINGS)

    return make
