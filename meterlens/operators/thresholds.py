"""Per-parameter thresholds and the explanation of readings outside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions.numeric import fixed_text, severity
from meterlens.operators.filters import available, non_null_readings
from meterlens.operators.profile import column_distributions
from meterlens.schema import DEFAULT_THRESHOLDS, FEATURES, THRESHOLDS


def feature_thresholds(readings: DataFrame, features: list[str] | None = None) -> DataFrame:
    """mean, sample std, mean ± 3 std and quartiles of each available feature.

    Rows without a reading are left out, other nulls and NaN only from their own column.
    """
    columns = available(readings, features or FEATURES)
    found = column_distributions(
        non_null_readings(readings), columns, "parameter", {"q1": 0.25, "q3": 0.75}
    )
    std = F.col("std_samp")
    return found.select(
        "parameter",
        "mean",
        std.alias("std"),
        (F.col("mean") - 3 * std).alias("min"),
        (F.col("mean") + 3 * std).alias("max"),
        "q1",
        "q3",
    )


def default_thresholds(spark: SparkSession) -> DataFrame:
    """The fallback thresholds as a literal table, known to the optimizer in size."""
    rows = ", ".join(
        f"('{name}', {', '.join(f'{v}D' for v in values)})" for name, *values in DEFAULT_THRESHOLDS
    )
    names = ", ".join(f"`{c}`" for c in THRESHOLDS.names)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})")


def with_defaults(thresholds: DataFrame) -> DataFrame:
    """The computed thresholds, and the defaults for parameters without any."""
    defaults = default_thresholds(thresholds.sparkSession)
    missing = defaults.join(F.broadcast(thresholds), "parameter", "left_anti")
    return thresholds.unionByName(missing)


def _deviation(value, mean, std):
    return F.when(std > 0, F.abs(value - mean) / std).otherwise(F.lit(0.0))


def _range_text(low, high):
    return F.concat(fixed_text(low, 2), F.lit(" - "), fixed_text(high, 2))


def anomalous_parameters(
    rows: DataFrame, thresholds: DataFrame, ids: list[str] | None = None
) -> DataFrame:
    """One row per parameter outside its thresholds.

    There is one threshold row per feature, so broadcasting them is bounded; parameters
    without a threshold, and missing values, are skipped.
    """
    ids = ids or ["row_id", "building_id"]
    columns = available(rows, FEATURES)
    long = rows.select(
        *ids, *[F.col(c).cast("double").alias(c) for c in columns if c not in ids]
    ).unpivot(ids, columns, "parameter", "value")
    known = thresholds.where(F.col("parameter").isin(columns))
    value, mean, std = F.col("value"), F.col("mean"), F.col("std")
    outside = (value < F.col("min")) | (value > F.col("max"))
    found = long.join(F.broadcast(known), "parameter").where(outside)
    return found.select(
        *ids,
        "parameter",
        "value",
        _range_text(F.col("min"), F.col("max")).alias("expected_range"),
        "mean",
        _deviation(value, mean, std).alias("deviation"),
    ).withColumn("severity", severity(F.col("deviation")))


def explain_rows(rows: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Add ``anomalous_parameters`` (a list) and ``anomaly_count`` to every row.

    The thresholds travel as one row of a map, so nothing is shuffled. Only columns the
    rows have are checked.
    """
    columns = available(rows, FEATURES)
    limits = thresholds.where(F.col("parameter").isin(columns)).agg(
        F.map_from_entries(
            F.collect_list(
                F.struct("parameter", F.struct("mean", "std", "min", "max"))
            )
        ).alias("_limits")
    )

    def entry(name: str):
        value, limit = F.col(name).cast("double"), F.col("_limits")[name]
        deviation = _deviation(value, limit["mean"], limit["std"])
        outside = (value < limit["min"]) | (value > limit["max"])
        return F.when(
            outside,
            F.struct(
                F.lit(name).alias("parameter"),
                value.alias("value"),
                _range_text(limit["min"], limit["max"]).alias("expected_range"),
                limit["mean"].alias("mean"),
                deviation.alias("deviation"),
                severity(deviation).alias("severity"),
            ),
        )

    found = F.array_compact(F.array(*[entry(c) for c in columns]))
    return (
        rows.crossJoin(F.broadcast(limits))
        .withColumn("anomalous_parameters", found)
        .withColumn("anomaly_count", F.size("anomalous_parameters"))
        .drop("_limits")
    )
