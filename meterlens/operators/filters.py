"""Projections, filters, top-k and pages."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SIZE = 50

# Columns handed to the analyses.
ANALYSIS_COLUMNS = [
    "building_id", "meter_reading", "anomaly", "air_temperature", "wind_speed",
    "cloud_coverage", "primary_use", "square_feet", "floor_count", "hour", "weekday",
    "month", "timestamp",
]


def available(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns the table has, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric`` or ``string`` columns."""
    base = {"numeric": T.NumericType, "string": T.StringType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, base)]


def non_null_readings(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("meter_reading").isNotNull())


def project_readings(readings: DataFrame) -> DataFrame:
    return non_null_readings(readings).select(*available(readings, ANALYSIS_COLUMNS))


def labeled_anomalies(readings: DataFrame) -> DataFrame:
    return non_null_readings(readings).where(F.col("anomaly") == 1)


def time_range(df: DataFrame, start, end, column: str = "timestamp") -> DataFrame:
    """Rows in the closed range [start, end]."""
    kind = df.schema[column].dataType
    return df.where(F.col(column).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def explorer_filter(readings: DataFrame, **parameters) -> DataFrame:
    """Conjunction of optional filters; blank parameters are ignored.

    Bounds (``building_id``, ``meter_reading``, ``temp``, ``wind_speed`` with ``_min`` or
    ``_max``) are inclusive, ``date_to`` covers its whole day, ``primary_use`` and
    ``anomaly_filter`` are equalities.
    """
    ranges = {
        "building_id": "building_id", "meter_reading": "meter_reading",
        "temp": "air_temperature", "wind_speed": "wind_speed",
    }
    known = {f"{p}_{b}" for p in ranges for b in ("min", "max")}
    known |= {"date_from", "date_to", "primary_use", "anomaly_filter"}
    unknown = set(parameters) - known
    if unknown:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    given = {k: v for k, v in parameters.items() if v is not None and v != ""}

    conditions: list[Column] = []
    for prefix, name in ranges.items():
        kind = float if prefix != "building_id" else int
        if f"{prefix}_min" in given:
            conditions.append(F.col(name) >= kind(given[f"{prefix}_min"]))
        if f"{prefix}_max" in given:
            conditions.append(F.col(name) <= kind(given[f"{prefix}_max"]))
    stamp = readings.schema["timestamp"].dataType
    if "date_from" in given:
        start = date.fromisoformat(str(given["date_from"]))
        conditions.append(F.col("timestamp") >= F.lit(start.isoformat()).cast(stamp))
    if "date_to" in given:
        after = date.fromisoformat(str(given["date_to"])) + timedelta(days=1)
        conditions.append(F.col("timestamp") < F.lit(after.isoformat()).cast(stamp))
    if "primary_use" in given:
        conditions.append(F.col("primary_use") == given["primary_use"])
    if "anomaly_filter" in given:
        conditions.append(F.col("anomaly") == int(given["anomaly_filter"]))
    for condition in conditions:
        readings = readings.where(condition)
    return readings


def recent_readings(readings: DataFrame, n: int = 50) -> DataFrame:
    """The n most recent non-null readings of all buildings."""
    columns = ["row_id", "building_id", "timestamp", "meter_reading", "anomaly", "primary_use",
               "air_temperature"]
    rows = non_null_readings(readings).select(*columns)
    return rows.orderBy(F.desc("timestamp"), F.desc("row_id")).limit(n)


def recent_anomalies(readings: DataFrame, n: int = 20) -> DataFrame:
    """The n most recent labelled anomalies."""
    columns = ["row_id", "building_id", "timestamp", "meter_reading", "primary_use",
               "air_temperature", "site_id"]
    rows = labeled_anomalies(readings).select(*columns)
    return rows.orderBy(F.desc("timestamp"), F.desc("row_id")).limit(n)


def recent_detections(anomalies: DataFrame, n: int = 20) -> DataFrame:
    """The n most recently detected anomalies."""
    return anomalies.orderBy(F.desc("detected_at"), "building_id", F.desc("timestamp")).limit(n)


def all_anomalies(readings: DataFrame, detected: DataFrame) -> DataFrame:
    """Labelled and detected anomalies in one table, tagged with their source."""
    columns = ["building_id", "timestamp", "meter_reading", "primary_use", "air_temperature",
               "site_id"]
    labelled = labeled_anomalies(readings).select(*columns)
    return labelled.withColumn("source", F.lit("labeled")).unionByName(
        detected.withColumn("source", F.lit("detected")), allowMissingColumns=True
    )


def page(df: DataFrame, order: list, number: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """One page of an ordered result (Spark keeps only the first ``number * size`` rows)."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, key: str, last, size: int = PAGE_SIZE) -> DataFrame:
    """The page following key value ``last``: deep pages cost no more than the first."""
    rest = df if last is None else df.where(F.col(key) > last)
    return rest.orderBy(key).limit(size)


def explorer_page(
    readings: DataFrame, number: int = 1, size: int = PAGE_SIZE, **parameters
) -> DataFrame:
    """A page of filtered readings with the total and the number of pages on every row."""
    rows = explorer_filter(readings, **parameters)
    total = rows.agg(F.count("*").alias("total")).withColumn(
        "pages", F.ceil(F.col("total") / size).cast("long")
    )
    shown = page(rows, [F.desc("timestamp"), F.desc("row_id")], number, size)
    return shown.withColumn("page", F.lit(number)).crossJoin(F.broadcast(total))


def merge_key(left: DataFrame, right: DataFrame) -> str | None:
    """``row_id``, else ``id``, else None: rows cannot be matched."""
    for key in ("row_id", "id"):
        if key in left.columns and key in right.columns:
            return key
    return None


def join_on_merge_key(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on the merge key; columns both sides have are taken from the left."""
    key = merge_key(left, right)
    if key is None:
        raise ValueError("no common row_id or id column")
    extra = [c for c in right.columns if c == key or c not in left.columns]
    return left.join(right.select(*extra), key)


def schema_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Where each column occurs and its type on either side; reads no data."""
    ours, theirs = dict(left.dtypes), dict(right.dtypes)
    names = [*ours, *[c for c in theirs if c not in ours]]
    rows = [(c, ours.get(c), theirs.get(c)) for c in names]
    kinds = "column_name string, left_type string, right_type string"
    side = F.when(F.col("right_type").isNull(), "left only").when(
        F.col("left_type").isNull(), "right only"
    ).otherwise("common")
    return left.sparkSession.createDataFrame(rows, kinds).withColumn("side", side)


def row_compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each distinct row of the shared columns, and how often it is in both, only left, only right.

    A multiset intersection and both differences in one aggregation: copies are counted where
    they lie, so a row repeated a million times is shuffled once a task. Nulls are equal.
    """
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no common columns")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = left.select(*shared, one.alias("_l"), none.alias("_r")).unionByName(
        right.select(*shared, none.alias("_l"), one.alias("_r"))
    )
    counted = both.groupBy(*shared).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    return counted.select(
        *shared,
        F.least("_l", "_r").alias("in_both"),
        F.greatest(F.col("_l") - F.col("_r"), none).alias("left_only"),
        F.greatest(F.col("_r") - F.col("_l"), none).alias("right_only"),
    )


def schema_compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """Where each column occurs, and how many values it holds on either side."""
    def filled(df: DataFrame, name: str) -> DataFrame:
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        return counts.unpivot([], df.columns, "column_name", name)

    both = filled(left, "left_values").join(filled(right, "right_values"), "column_name", "full")
    side = F.when(F.col("right_values").isNull(), "left only").when(
        F.col("left_values").isNull(), "right only"
    ).otherwise("common")
    return both.withColumn("side", side)
