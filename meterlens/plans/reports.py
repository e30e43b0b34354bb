"""Reports: several result tables, or findings, from one table of readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.operators import aggregates as A
from meterlens.operators import filters as P
from meterlens.operators.filters import project_readings
from meterlens.operators.rollup import WEATHER, part, rollup, weather_moments
from meterlens.operators.sampling import sample_readings
from meterlens.storage import durable

# Least rows for a full run, the correlation that counts as a finding
# (exclusive), and the number of distinct hours a peak hour needs (exclusive).
MIN_ROWS = 100
NOTABLE_CORRELATION = 0.3
MIN_HOURS = 12


def overview(readings: DataFrame, detected: DataFrame | None = None) -> dict[str, DataFrame]:
    """Overall numbers and the most frequent building types."""
    return {
        "stats": A.overall_stats(readings, detected),
        "building_types": A.building_types(readings),
    }


def building_page(readings: DataFrame, page: int = 1, size: int = 20) -> dict[str, DataFrame]:
    """A page of buildings in the order of their ids, and how many there are."""
    return {
        "buildings": P.page(A.building_summary(readings), ["building_id"], page, size),
        "total": A.distinct_buildings(readings),
    }


def building_details(readings: DataFrame, building_id: int) -> dict[str, DataFrame]:
    """Attributes, last 24 readings and statistics of one building; empty if unknown."""
    rows = readings.where(F.col("building_id") == building_id)
    return {
        "info": A.building_info(rows),
        "recent": A.recent_per_building(rows),
        "statistics": A.building_detail(rows),
    }


def anomaly_feed(
    readings: DataFrame, anomalies: DataFrame, n: int = 20
) -> dict[str, DataFrame]:
    """The n most recent labelled and detected anomalies, and the number of each."""
    labelled = P.recent_anomalies(readings, n)
    detected = P.recent_detections(anomalies, n)

    def count(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("source"), "row_count")

    counts = count(labelled, "labeled").unionByName(count(detected, "detected"))
    return {"labeled": labelled, "detected": detected, "counts": counts}


def weather_report(readings: DataFrame, wind: bool = True) -> dict[str, DataFrame]:
    """Correlations, temperature bins and lines, in two scans."""
    moments = weather_moments(readings, wind)
    bounds = moments.select(
        F.col("air_temperature_min").alias("_lo"),
        F.col("air_temperature_max").alias("_hi"),
        F.col("sample_size").alias("_n"),
    )
    line = ["points", "slope", "intercept", "min", "max"]
    lines = moments.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), *[F.col(f"{m}_{c}").alias(c) for c in line])
        for m in WEATHER
    ]))).where(F.col("points") > 0)
    ends = {
        f"y_{end}": F.col("intercept") + F.col("slope") * F.col(f"x_{end}") for end in ("min", "max")
    }
    return {
        "correlations": A.correlations(moments, wind),
        "temperature_ranges": A.temperature_ranges(readings, wind, bounds=bounds),
        "trend": lines.withColumnsRenamed({"min": "x_min", "max": "x_max"}).withColumns(ends),
    }


def weather_dashboard(readings: DataFrame) -> dict[str, DataFrame]:
    """The dashboard form: wind may be missing, undefined correlations are 0."""
    return weather_report(readings, wind=False)


def building_report(base: DataFrame) -> dict[str, DataFrame]:
    """By type and size, from the rolled-up measures."""
    return {
        "types": A.rated_types(part(base, "primary_use")),
        "sizes": A.rated_sizes(_patterns(base, "size_category")),
    }


def _patterns(base: DataFrame, dimension: str) -> DataFrame:
    return part(base, dimension).select(
        dimension, "mean", F.col("readings").alias("count"), "anomalies")


def temporal_report(base: DataFrame) -> dict[str, DataFrame]:
    """By hour, weekday and month, from the rolled-up measures."""
    overall = part(base).select(F.col("mean").alias("_overall"))
    hours = A.marked_hours(_patterns(base, "hour"), overall)
    return {
        "hours": hours,
        "weekdays": A.named_days(_patterns(base, "weekday")),
        "months": _patterns(base, "month"),
        "peak_hours": hours.where("is_peak").select("hour"),
    }


def anomaly_report(base: DataFrame) -> dict[str, DataFrame]:
    """Anomalies against normal readings and by type, from the rolled-up measures."""
    types = part(base, "primary_use").select(
        "primary_use", F.col("anomalous").alias("anomalies"), F.col("rows").alias("total"))
    return {"comparison": A.compared(part(base)), "types": A.most_anomalous_types(types)}


def insights(
    readings: DataFrame, base: DataFrame | None = None, min_hours: int = MIN_HOURS
) -> DataFrame:
    """One row (kind, subject, value) per finding that applies, in one scan of the readings.

    ``base`` is their ``rollup``, if there is one. A peak hour needs more than ``min_hours``
    different hours.
    """
    base = rollup(readings) if base is None else base

    def finding(rows: DataFrame, kind: str, subject, value) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("kind"),
            subject.cast("string").alias("subject"),
            value.cast("double").alias("value"),
        )

    types = part(base, "primary_use").where(F.col("mean").isNotNull())
    # Equal means: the first name in the alphabet, at either end.
    ends = types.agg(
        F.count("*").alias("n"),
        F.min(F.struct("mean", "primary_use")).alias("low"),
        F.min(F.struct((-F.col("mean")).alias("minus"), "primary_use")).alias("high"),
    ).where(F.col("n") > 1)
    worst = A.most_anomalous_building(
        part(base, "building_id").select("building_id", F.col("anomalies").alias("anomaly_count")))
    correlation = part(base).select(F.col("temperature_r").alias("r")).where(
        F.abs("r") > NOTABLE_CORRELATION)
    direction = F.when(F.col("r") > 0, "increases").otherwise("decreases")
    hours = part(base, "hour").agg(
        F.count("*").alias("n"),
        F.min(
            F.when(F.col("mean").isNotNull(), F.struct((-F.col("mean")).alias("minus"), "hour"))
        ).alias("top"),
    ).where(F.col("n") > min_hours)
    findings = [
        finding(ends, "most_efficient_type", F.col("low.primary_use"), F.col("low.mean")),
        finding(ends, "least_efficient_type", F.col("high.primary_use"), -F.col("high.minus")),
        finding(worst, "worst_building", F.col("building_id"), F.col("anomaly_count")),
        finding(correlation, "temperature_effect", direction, F.col("r")),
        finding(hours, "peak_hour", F.col("top.hour"), -F.col("top.minus")),
    ]
    return reduce(DataFrame.unionByName, findings)


def complete_analysis(
    readings: DataFrame, sample_size: int | None = None, min_rows: int = MIN_ROWS
) -> dict[str, dict[str, DataFrame]]:
    """All reports over the non-null readings, or a sample; nothing below ``min_rows`` rows.

    A sample is stored once. The full table is scanned three times: for the rolled-up
    measures, the weather, and the temperature bins.
    """
    rows = project_readings(readings)
    if sample_size is not None:
        rows = durable(project_readings(sample_readings(readings, sample_size)))
    if rows.limit(min_rows).count() < min_rows:
        return {}
    base = rollup(rows)
    return {
        "weather": weather_report(rows),
        "buildings": building_report(base),
        "temporal": temporal_report(base),
        "anomalies": anomaly_report(base),
        "insights": {"insights": insights(rows, base)},
    }


# The column that names a row of each table of the full run; others have one row.
SUBJECTS = {
    ("weather", "temperature_ranges"): "temp_range",
    ("weather", "trend"): "measure",
    ("buildings", "types"): "primary_use",
    ("buildings", "sizes"): "size_category",
    ("temporal", "hours"): "hour",
    ("temporal", "weekdays"): "day_name",
    ("temporal", "months"): "month",
    ("temporal", "peak_hours"): "hour",
    ("anomalies", "types"): "primary_use",
    ("insights", "insights"): "kind",
}


def flat_analysis(results: dict[str, dict[str, DataFrame]]) -> DataFrame | None:
    """All numbers of a full run as rows (report, table_name, subject, measure, value)."""
    parts = []
    for report, tables in results.items():
        for name, rows in tables.items():
            subject = SUBJECTS.get((report, name))
            named = F.col(subject).cast("string") if subject else F.lit(None).cast("string")
            kinds = dict(rows.dtypes)
            numbers = [c for c in rows.columns if c != subject and kinds[c] not in ("string", "boolean")]
            if not numbers:  # a list of subjects
                rows, numbers = rows.withColumn("listed", F.lit(1)), ["listed"]
            long = rows.select(
                F.lit(report).alias("report"), F.lit(name).alias("table_name"),
                named.alias("subject"), *[F.col(c).cast("double").alias(c) for c in numbers],
            ).unpivot(["report", "table_name", "subject"], numbers, "measure", "value")
            parts.append(long.where(F.col("value").isNotNull()))
    return reduce(DataFrame.unionByName, parts) if parts else None
