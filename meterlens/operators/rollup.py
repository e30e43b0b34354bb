"""What the reports need of the readings, measured in few scans.

One aggregation over grouping sets measures the readings by type, size, hour, weekday,
month and building, and overall; its result has a row per value of each and is stored. One row of
moments measures the weather of complete rows. Reports are made from these two tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions.numeric import guarded_corr, size_class
from meterlens.operators.aggregates import complete_weather, labelled
from meterlens.storage import durable

DIMENSIONS = ["primary_use", "size_category", "hour", "weekday", "month", "building_id"]
WEATHER = ["air_temperature", "wind_speed"]


def rollup(readings: DataFrame) -> DataFrame:
    """Measures per value of each dimension and overall; ``part`` selects them."""
    reading = F.col("meter_reading")
    rows = readings.select(
        "primary_use", size_class(F.col("square_feet")).alias("size_category"), "hour", "weekday",
        "month", "building_id", "meter_reading", "anomaly", "square_feet", "air_temperature",
    )
    grouped = rows.groupingSets([*[[d] for d in DIMENSIONS], []], *DIMENSIONS).agg(
        F.grouping_id().alias("_set"),
        F.count("*").alias("rows"),
        F.count(reading).alias("readings"),
        F.avg(reading).alias("mean"),
        F.stddev_samp(reading).alias("std"),
        F.sum("anomaly").alias("anomalies"),
        F.count_if(labelled()).alias("anomalous"),
        F.count_if(F.col("anomaly") == 0).alias("normal"),
        F.avg(F.when(labelled(), reading)).alias("anomalous_mean"),
        F.avg(F.when(F.col("anomaly") == 0, reading)).alias("normal_mean"),
        F.avg("square_feet").alias("area_mean"),
        guarded_corr(reading, F.col("air_temperature")).alias("temperature_r"),
    )
    return durable(grouped)


def part(base: DataFrame, dimension: str | None = None) -> DataFrame:
    """The rows of one dimension whose value is known, or the one row of all readings."""
    every = (1 << len(DIMENSIONS)) - 1
    if dimension is None:
        return base.where(F.col("_set") == every).drop("_set", *DIMENSIONS)
    own = every - (1 << len(DIMENSIONS) - 1 - DIMENSIONS.index(dimension))
    others = [d for d in DIMENSIONS if d != dimension]
    return base.where((F.col("_set") == own) & F.col(dimension).isNotNull()).drop("_set", *others)


def weather_moments(readings: DataFrame, wind: bool = True) -> DataFrame:
    """One row: correlations, lines and bounds of the weather of complete rows."""
    reading = F.col("meter_reading")
    rows = complete_weather(readings, wind)
    clouds = [c for c in ["cloud_coverage"] if c in readings.columns]
    columns = [F.count("*").alias("sample_size")]
    for name in [*WEATHER, *clouds]:
        x = F.col(name)
        paired = F.when(reading.isNotNull(), x)
        columns += [
            guarded_corr(reading, x).alias(f"{name}_r"),
            F.count(x).alias(f"{name}_points"),
            F.regr_slope(reading, x).alias(f"{name}_slope"),
            F.regr_intercept(reading, x).alias(f"{name}_intercept"),
            F.min(paired).alias(f"{name}_min"),
            F.max(paired).alias(f"{name}_max"),
        ]
    return durable(rows.agg(*columns))
