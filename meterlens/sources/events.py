"""Readings derived from the ``events`` and ``customer`` test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that need the customer table.
BUILDING_COLUMNS = ["primary_use", "site_id", "square_feet", "floor_count", "year_built"]


def readings(spark: SparkSession, folder: str, attributes: bool = True) -> DataFrame:
    """The readings table; ``attributes=False`` leaves out the building columns.

    Each event has exactly one customer, so the left join keeps the events' rows. No
    side is hinted: Spark broadcasts customers when their files are small and splits hot
    buildings of a sort-merge join otherwise.
    """
    k, event_id = F.col("k"), F.col("event_id")
    temperature = F.when(k != 99, k * 0.5 - 10)
    # A filter on the reading is pushed down and reads k once more; a pattern costs a third
    # of parsing the JSON text.
    number = F.regexp_extract("props", r'"k":\s*(\d+)', 1).try_cast("int")
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("k", number)
    base = events.select(
        event_id.alias("row_id"),
        F.col("user_id").alias("building_id"),
        F.col("ts").alias("timestamp"),
        F.when(k != 0, F.col("value")).alias("meter_reading"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("anomaly"),
        temperature.alias("air_temperature"),
        ((event_id % 31) * 0.5).cast("double").alias("wind_speed"),
        (event_id % 10).cast("double").alias("cloud_coverage"),
        (temperature - 2 - event_id % 7).cast("double").alias("dew_temperature"),
        (1000 + (event_id * 7) % 40).cast("double").alias("sea_level_pressure"),
        F.hour("ts").alias("hour"),
        F.weekday("ts").alias("weekday"),
        F.month("ts").alias("month"),
    ).withColumn("air_temperature", F.col("air_temperature").cast("double"))
    if not attributes:
        return base
    key = F.col("c_custkey")
    buildings = spark.read.parquet(f"{folder}/customer.parquet").select(
        key.alias("building_id"),
        F.col("c_mktsegment").alias("primary_use"),
        F.col("c_nationkey").cast("int").alias("site_id"),
        F.floor(F.abs("c_acctbal") * 12).cast("double").alias("square_feet"),
        (1 + key % 10).cast("double").alias("floor_count"),
        (1950 + key % 70).cast("int").alias("year_built"),
    )
    return base.join(buildings, "building_id", "left")
