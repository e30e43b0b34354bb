"""Anomaly detectors: 3-sigma, interquartile range, moving average, majority vote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlens.functions.numeric import fixed_text
from meterlens.operators.aggregates import (
    building_moments,
    building_statistics,
    latest_reading,
    latest_with_moments,
)
from meterlens.operators.filters import non_null_readings
from meterlens.operators.ordering import MAX_ROWS, find_hot_keys, hot_keys_of, look_back
from meterlens.storage import durable

# Limits of the three methods and the votes the ensemble needs.
SIGMAS = 3.0
IQR_FACTOR = 1.5
MA_FACTOR = 2.0
MA_ROWS = 24
VOTES = 2

NO_HISTORY = "No historical data"


def _verdict(prefix: str, cases: list[tuple[Column, str]], score, anomaly, text) -> dict:
    """Columns of a method: the cases decide "no" with confidence 0 and their text."""
    flag, confidence, details = F, F, F
    for condition, reason in cases:
        flag = flag.when(condition, F.lit(False))
        confidence = confidence.when(condition, F.lit(0.0))
        details = details.when(condition, F.lit(reason))
    return {
        f"{prefix}_anomaly": flag.otherwise(anomaly),
        f"{prefix}_confidence": confidence.otherwise(score),
        f"{prefix}_details": details.otherwise(text),
    }


def z_score() -> Column:
    """|reading - mean| / std; null without variance or history."""
    std = F.col("std")
    return F.when(std > 0, F.abs(F.col("meter_reading") - F.col("mean")) / std)


def sigma_columns() -> dict[str, Column]:
    z = z_score()
    cases = [
        (F.col("mean").isNull(), NO_HISTORY),
        (F.col("std") == 0, "No variance in data"),
    ]
    text = F.concat(F.lit("Z-score: "), fixed_text(z, 2))
    return _verdict("sigma", cases, F.least(z / SIGMAS, F.lit(1.0)), z > SIGMAS, text)


def iqr_bounds() -> dict[str, Column]:
    margin = IQR_FACTOR * (F.col("q75") - F.col("q25"))
    return {"lower_bound": F.col("q25") - margin, "upper_bound": F.col("q75") + margin}


def iqr_columns() -> dict[str, Column]:
    x = F.col("meter_reading")
    iqr = F.col("q75") - F.col("q25")
    low, high = iqr_bounds().values()
    distance = F.when(x < low, low - x).when(x > high, x - high).otherwise(F.lit(0.0))
    score = F.least(F.when(iqr > 0, distance / iqr), F.lit(1.0))
    cases = [(F.col("mean").isNull(), NO_HISTORY), (iqr == 0, "No IQR variance")]
    text = F.concat(
        F.lit("IQR bounds: ["), fixed_text(low, 2), F.lit(", "), fixed_text(high, 2), F.lit("]")
    )
    return _verdict("iqr", cases, score, (x < low) | (x > high), text)


def moving_average_columns(factor: float = MA_FACTOR) -> dict[str, Column]:
    deviation = F.abs(F.col("current_reading") - F.col("moving_avg"))
    threshold = F.lit(factor) * F.col("moving_std")
    score = F.least(F.when(threshold > 0, deviation / threshold).otherwise(0.0), F.lit(1.0))
    cases = [(F.col("moving_std") == 0, "No variance in recent data")]
    text = F.concat(
        F.lit("MA: "), fixed_text(F.col("moving_avg"), 2),
        F.lit(", Deviation: "), fixed_text(deviation, 2),
    )
    verdict = _verdict("ma", cases, score, deviation > threshold, text)
    n = F.coalesce(F.col("n_readings"), F.lit(0))
    short = ~F.coalesce(F.col("enough"), F.lit(False))
    return {
        "ma_anomaly": F.when(short, False).otherwise(verdict["ma_anomaly"]),
        "ma_confidence": F.when(short, 0.0).otherwise(verdict["ma_confidence"]),
        "ma_details": F.when(
            short, F.format_string("Insufficient data: %d readings", n)
        ).otherwise(verdict["ma_details"]),
    }


def with_statistics(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows with their building's statistics; unknown buildings keep nulls."""
    return rows.join(stats, "building_id", "left")


def _every_reading(
    readings: DataFrame, stats: DataFrame | None, statistics: Callable = building_statistics
) -> DataFrame:
    rows = non_null_readings(readings).select(
        "row_id", "building_id", "timestamp", "meter_reading", "anomaly"
    )
    if stats is None:
        # Stored first, so that its size is known when the join strategy is chosen.
        stats = durable(statistics(readings))
    return with_statistics(rows, stats)


def _named(rows: DataFrame, prefix: str, method: str, extra: list[str]) -> DataFrame:
    return rows.select(
        *extra,
        F.col(f"{prefix}_anomaly").alias("is_anomaly"),
        F.col(f"{prefix}_confidence").alias("confidence"),
        F.lit(method).alias("method"),
        F.col(f"{prefix}_details").alias("details"),
    )


READING = ["row_id", "building_id", "timestamp", "meter_reading", "anomaly"]


def three_sigma(readings: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """3-sigma verdict for every non-null reading against its building's statistics."""
    rows = _every_reading(readings, stats, building_moments).withColumns(
        {"z_score": F.coalesce(z_score(), F.lit(0.0)), **sigma_columns()}
    )
    return _named(rows, "sigma", "3sigma", [*READING, "z_score"])


def iqr(readings: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Interquartile verdict, with its bounds, for every non-null reading."""
    rows = _every_reading(readings, stats).withColumns({**iqr_bounds(), **iqr_columns()})
    return _named(rows, "iqr", "iqr", [*READING, "lower_bound", "upper_bound"])


def _moving(
    readings: DataFrame, rows: int, max_rows: int, stats: DataFrame | None = None
) -> DataFrame:
    """Each non-null reading with mean and population std of the previous ``rows``.

    Hot buildings are found in the counts of ``stats`` instead of by a scan of their own.
    """
    def outputs(window):
        before = window.rowsBetween(-rows, -1)
        return {
            "n_readings": F.count("meter_reading").over(before),
            "moving_avg": F.avg("meter_reading").over(before),
            "moving_std": F.stddev_pop("meter_reading").over(before),
        }

    usable = non_null_readings(readings).select(*READING)
    if stats is None:
        hot = find_hot_keys(usable, ["building_id"], max_rows)
    else:
        hot = hot_keys_of(stats, ["building_id"], "count", max_rows)
    moved = look_back(usable, ["building_id"], ["timestamp", "row_id"], rows, outputs, hot)
    return moved.withColumns(
        {"current_reading": F.col("meter_reading"), "enough": F.col("n_readings") >= rows}
    )


def moving_average(
    readings: DataFrame,
    window_rows: int = MA_ROWS,
    factor: float = MA_FACTOR,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Verdict for every reading against exactly the ``window_rows`` readings before it."""
    rows = _moving(readings, window_rows, max_rows).withColumns(moving_average_columns(factor))
    return _named(rows, "ma", "moving_avg", [*READING, "n_readings", "moving_avg", "moving_std"])


def moving_average_asof(
    readings: DataFrame,
    window_rows: int = MA_ROWS,
    range_hours: int | None = None,
    as_of=None,
    factor: float = MA_FACTOR,
    ends: DataFrame | None = None,
) -> DataFrame:
    """One verdict per building over the range of hours ending at ``as_of``.

    The first ``window_rows + 1`` readings of the closed range count; the last of them is
    the current one, the others are its history. Without ``as_of`` each building's range
    ends at its own latest reading, which ``ends`` (building_id, timestamp) may give;
    buildings with no reading in the range give no row.
    """
    hours = window_rows + 1 if range_hours is None else range_hours
    length = F.expr(f"INTERVAL '{int(hours)}' HOUR")
    usable = non_null_readings(readings).select(
        "row_id", "building_id", "timestamp", "meter_reading"
    )
    if as_of is not None:
        end = F.lit(as_of).cast(readings.schema["timestamp"].dataType)
        in_range = usable.where(F.col("timestamp").between(end - length, end))
    else:
        if ends is None:
            ends = durable(usable.groupBy("building_id").agg(F.max("timestamp").alias("timestamp")))
        ends = ends.select("building_id", F.col("timestamp").alias("_end"))
        in_range = usable.join(ends, "building_id").where(
            F.col("timestamp") >= F.col("_end") - length
        )
    # Each task keeps window_rows + 1 rows per building before the shuffle.
    oldest = Window.partitionBy("building_id").orderBy("timestamp", "row_id")
    taken = in_range.withColumn("_rn", F.row_number().over(oldest)).where(
        F.col("_rn") <= window_rows + 1
    )
    sized = taken.withColumn("_n", F.count("*").over(Window.partitionBy("building_id")))
    history = F.when(F.col("_rn") < F.col("_n"), F.col("meter_reading"))
    summary = sized.groupBy("building_id").agg(
        F.max("_n").alias("n_readings"),
        F.avg(history).alias("moving_avg"),
        F.stddev_pop(history).alias("moving_std"),
        F.max(F.when(F.col("_rn") == F.col("_n"), F.col("meter_reading"))).alias(
            "current_reading"
        ),
    )
    rows = summary.withColumn("enough", F.col("n_readings") >= window_rows)
    rows = rows.withColumns(moving_average_columns(factor))
    extra = ["building_id", "n_readings", "current_reading", "moving_avg", "moving_std"]
    return _named(rows, "ma", "moving_avg", extra)


def ensemble_columns() -> dict[str, Column]:
    """Majority and mean confidence of the three methods' columns."""
    flags = [F.col(f"{p}_anomaly").cast("int") for p in ("sigma", "iqr", "ma")]
    scores = [F.col(f"{p}_confidence") for p in ("sigma", "iqr", "ma")]
    votes = flags[0] + flags[1] + flags[2]

    def method(prefix: str) -> Column:
        return F.struct(
            F.col(f"{prefix}_anomaly").alias("anomaly"),
            F.col(f"{prefix}_confidence").alias("confidence"),
            F.col(f"{prefix}_details").alias("details"),
        )

    confidence = (scores[0] + scores[1] + scores[2]) / 3
    return {
        "votes": votes,
        "ensemble_anomaly": votes >= VOTES,
        "ensemble_confidence": confidence,
        "ensemble_details": F.struct(
            F.struct(
                method("sigma").alias("3-Sigma"),
                method("iqr").alias("IQR"),
                method("ma").alias("Moving Avg"),
            ).alias("methods"),
            F.concat(votes.cast("string"), F.lit("/3")).alias("votes"),
            confidence.alias("avg_confidence"),
        ),
    }


def ensemble(
    readings: DataFrame,
    stats: DataFrame | None = None,
    window_rows: int = MA_ROWS,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Majority vote of the three methods for every non-null reading.

    ``details`` is a struct with each method's verdict, the votes and the mean confidence.
    The readings are scanned three times: twice for the statistics, once for the verdicts.
    """
    counted = None
    if stats is None:
        stats = counted = durable(building_statistics(readings))
    rows = with_statistics(_moving(readings, window_rows, max_rows, counted), stats)
    rows = rows.withColumns({**sigma_columns(), **iqr_columns(), **moving_average_columns()})
    rows = rows.withColumns(ensemble_columns())
    extra = [*READING, "votes", "sigma_anomaly", "iqr_anomaly", "ma_anomaly"]
    return _named(rows, "ensemble", "ensemble", extra)


METHODS = {"3sigma": "sigma", "iqr": "iqr", "moving_avg": "ma"}


def detect_batch(
    readings: DataFrame,
    building_ids: list[int] | DataFrame | None = None,
    method: str = "ensemble",
    window_rows: int = MA_ROWS,
    range_hours: int | None = None,
    as_of=None,
) -> DataFrame:
    """Verdict on the latest non-null reading of each, or each listed, building.

    ``details`` is text, JSON for the ensemble. An unknown method means the ensemble.
    """
    if isinstance(building_ids, DataFrame):
        readings = readings.join(building_ids.select("building_id"), "building_id", "left_semi")
    elif building_ids is not None:
        readings = readings.where(F.col("building_id").isin(list(building_ids)))
    prefix = METHODS.get(method, "ensemble")
    quartiles = prefix in ("iqr", "ensemble")
    # Last reading, moments and quartiles together; the moving average takes its ends from it.
    rows = durable(
        building_statistics(readings, latest=True) if quartiles else latest_with_moments(readings)
    )
    ends = rows.select("building_id", "timestamp")
    if prefix in ("sigma", "ensemble"):
        rows = rows.withColumns(sigma_columns())
    if quartiles:
        rows = rows.withColumns(iqr_columns())
    if prefix in ("ma", "ensemble"):
        recent = moving_average_asof(
            readings, window_rows, range_hours, as_of, ends=ends
        ).select(
            "building_id",
            F.col("is_anomaly").alias("ma_anomaly"),
            F.col("confidence").alias("ma_confidence"),
            F.col("details").alias("ma_details"),
        )
        rows = rows.join(recent, "building_id", "left").withColumns(
            {
                "ma_anomaly": F.coalesce("ma_anomaly", F.lit(False)),
                "ma_confidence": F.coalesce("ma_confidence", F.lit(0.0)),
                "ma_details": F.coalesce("ma_details", F.lit("Insufficient data: 0 readings")),
            }
        )
    extra = ["building_id", "meter_reading", "timestamp"]
    if prefix == "ensemble":
        rows = rows.withColumns(ensemble_columns())
        rows = rows.withColumn("ensemble_details", F.to_json("ensemble_details"))
    return _named(rows, prefix, method, extra)


def detect_latest(readings: DataFrame, building_id: int | None = None) -> DataFrame:
    """3-sigma verdict on latest readings with building and statistics structs."""
    if building_id is not None:
        readings = readings.where(F.col("building_id") == building_id)
    stats = non_null_readings(readings).groupBy("building_id").agg(
        F.avg("meter_reading").alias("mean"),
        F.stddev_pop("meter_reading").alias("std"),
        F.count("*").alias("total_readings"),
    )
    rows = latest_reading(readings, ("primary_use", "site_id")).join(stats, "building_id")
    z = F.coalesce(z_score(), F.lit(0.0))
    return rows.select(
        "building_id",
        "meter_reading",
        "timestamp",
        (z > SIGMAS).alias("is_anomaly"),
        F.least(z / SIGMAS, F.lit(1.0)).alias("confidence"),
        z.alias("z_score"),
        F.lit("3-sigma").alias("method"),
        F.struct("primary_use", "site_id").alias("building_info"),
        F.struct("mean", "std", "total_readings").alias("statistics"),
    )
