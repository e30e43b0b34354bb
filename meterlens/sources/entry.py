"""Manually entered readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.sources.tables import write_batch, write_readings

# The last id of the buildings known from the start, and default types.
LAST_KNOWN_BUILDING = 199
KNOWN_TYPE = "Office"
NEW_TYPE = "New Building"


def validate_entries(entries: DataFrame) -> DataFrame:
    """Add the default type, the parsed time and the list of broken rules.

    A missing temperature or wind speed is allowed and a zero stays a zero.
    """
    parsed = entries.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))
    rules = [
        ("building_id", F.col("building_id") >= 0),
        ("meter_reading", (F.col("meter_reading") >= 0) & ~F.isnan("meter_reading")),
        ("timestamp", F.col("timestamp").isNotNull()),
        ("wind_speed", F.col("wind_speed").isNull() | (F.col("wind_speed") >= 0)),
        ("anomaly", F.col("anomaly").isin(0, 1)),
    ]
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]
    return (
        parsed.withColumn(
            "primary_use",
            F.when(F.col("building_id") > LAST_KNOWN_BUILDING, NEW_TYPE).otherwise(KNOWN_TYPE),
        )
        .withColumn("errors", F.concat_ws(",", *broken))
        .withColumn("is_valid", F.col("errors") == "")
    )


def split_entries(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) entries."""
    accepted = validated.where("is_valid").drop("errors", "is_valid")
    rejected = validated.where(~F.col("is_valid")).drop("is_valid")
    return accepted, rejected


def store_entries(
    entries: DataFrame, readings_path: str, rejected_path: str, batch: str | None = None
) -> None:
    """Add accepted rows to the readings and keep the rejected ones with their errors.

    Entries of the same named ``batch`` are replaced in both tables.
    """
    accepted, rejected = split_entries(validate_entries(entries))
    stamped = (
        accepted.withColumn("hour", F.hour("timestamp"))
        .withColumn("weekday", F.weekday("timestamp"))
        .withColumn("month", F.month("timestamp"))
    )
    write_readings(stamped, readings_path, "append", batch)
    write_batch(rejected, rejected_path, batch)
