"""Summary statistics. Every heavy step is a partial hash aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlens.functions.arrival import arrival
from meterlens.functions.numeric import (
    equal_width_bin,
    guarded_corr,
    nan_to_null,
    percent,
    size_class,
    temperature_label,
    weekday_name,
)
from meterlens.operators.filters import non_null_readings
from meterlens.operators.quantiles import distribution

# Least rows for weather results, least rows of a reported hour or day
# (exclusive), and the rate in percent above which a building is marked (exclusive).
MIN_WEATHER_ROWS = 100
MIN_PERIOD_ROWS = 10
MARKED_RATE = 5


def labelled() -> Column:
    return F.col("anomaly") == 1


def overall_stats(readings: DataFrame, detected: DataFrame | None = None) -> DataFrame:
    """One row: readings, buildings, labelled and detected anomalies, rate."""
    counts = readings.agg(
        F.count("*").alias("total_readings"),
        F.count_distinct("building_id").alias("total_buildings"),
        F.count_if(labelled()).alias("labeled_anomalies"),
    ).select(
        "*",
        (F.col("total_readings") - F.col("labeled_anomalies")).alias("normal_readings"),
        F.bround(percent(F.col("labeled_anomalies"), F.col("total_readings")), 2).alias(
            "anomaly_rate"
        ),
    )
    if detected is None:
        return counts.withColumn("detected_anomalies", F.lit(0).cast("long"))
    return counts.crossJoin(
        F.broadcast(detected.agg(F.count("*").alias("detected_anomalies")))
    )


def distinct_buildings(readings: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return readings.agg(count("building_id").alias("total_buildings"))


def building_types(readings: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent building types; rows without a type count as one of them."""
    counts = readings.groupBy("primary_use").agg(F.count("*").alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "primary_use").limit(n)


def building_summary(readings: DataFrame) -> DataFrame:
    """Per building: attributes of its first reading, counts, last time, mean, rate.

    Null readings are counted. Attributes are grouping keys of a first aggregation, so
    texts never enter its buffers and it stays a hash aggregation.
    """
    attributes = ["primary_use", "site_id", "square_feet", "floor_count"]
    parts = readings.groupBy("building_id", *attributes).agg(
        F.min(arrival()).alias("_first"),
        F.count("*").alias("_rows"),
        F.count_if(labelled()).alias("_anomalies"),
        F.max("timestamp").alias("_last"),
        F.sum("meter_reading").alias("_sum"),
        F.count("meter_reading").alias("_readings"),
    )
    totals = parts.groupBy("building_id").agg(
        F.min_by(F.struct(*attributes), "_first").alias("_attributes"),
        F.sum("_rows").alias("total_readings"),
        F.sum("_anomalies").alias("anomaly_count"),
        F.max("_last").alias("last_reading"),
        F.when(F.sum("_readings") > 0, F.sum("_sum") / F.sum("_readings")).alias(
            "avg_consumption"
        ),
    )
    rate = percent(F.col("anomaly_count"), F.col("total_readings"))
    return totals.select(
        "building_id",
        "_attributes.*",
        "total_readings",
        "anomaly_count",
        "last_reading",
        "avg_consumption",
        rate.alias("anomaly_rate"),
        (rate > MARKED_RATE).alias("is_marked"),
    )


def building_detail(readings: DataFrame) -> DataFrame:
    """Per building, over non-null readings only: mean, min, max, counts."""
    return non_null_readings(readings).groupBy("building_id").agg(
        F.avg("meter_reading").alias("avg_consumption"),
        F.min("meter_reading").alias("min_consumption"),
        F.max("meter_reading").alias("max_consumption"),
        F.count("*").alias("total_readings"),
        F.count_if(labelled()).alias("anomaly_count"),
    )


def known_readings(readings: DataFrame) -> DataFrame:
    """Rows whose reading is a number: NaN is a missing reading, as null is."""
    return readings.where(nan_to_null(F.col("meter_reading")).isNotNull())


def _moments() -> list[Column]:
    return [
        F.avg("meter_reading").alias("mean"),
        F.stddev_pop("meter_reading").alias("std"),
        F.min("meter_reading").alias("min"),
        F.max("meter_reading").alias("max"),
        F.count("*").alias("count"),
    ]


def building_moments(readings: DataFrame) -> DataFrame:
    """Per building: mean, population std, min, max and count of its readings."""
    return known_readings(readings).groupBy("building_id").agg(*_moments())


QUARTILES = {"median": 0.5, "q75": 0.75, "q25": 0.25}


def building_statistics(readings: DataFrame, latest: bool = False) -> DataFrame:
    """Per building: the moments, median and quartiles; with ``latest`` its last reading too.

    The table is scanned twice: for a histogram, and for the values at the wanted ranks.
    """
    last = (arrival(), {"timestamp": "timestamp", "meter_reading": "meter_reading"})
    stats = distribution(
        readings, ["building_id"], "meter_reading", QUARTILES, latest=last if latest else None
    )
    return stats.withColumnRenamed("std_pop", "std").drop("std_samp")


def latest_with_moments(readings: DataFrame) -> DataFrame:
    """The last reading of each building and its moments, in one aggregation."""
    order = arrival()
    return known_readings(readings).groupBy("building_id").agg(
        F.max_by("timestamp", order).alias("timestamp"),
        F.max_by("meter_reading", order).alias("meter_reading"),
        *_moments(),
    )


def anomaly_distribution(readings: DataFrame) -> DataFrame:
    return readings.groupBy("anomaly").agg(F.count("*").alias("row_count"))


def complete_weather(readings: DataFrame, wind: bool = True) -> DataFrame:
    """Rows with a reading and a temperature and, for the full analysis, wind."""
    subset = ["meter_reading", "air_temperature"] + (["wind_speed"] if wind else [])
    return readings.na.drop(subset=subset)


def weather_correlation(
    readings: DataFrame, wind: bool = True, min_rows: int = MIN_WEATHER_ROWS
) -> DataFrame:
    """One row of correlations with the reading, none below ``min_rows`` usable rows.

    ``wind=False`` is the dashboard form: wind may be missing, and a correlation that does
    not exist is 0.
    """
    reading = F.col("meter_reading")
    columns = ["air_temperature", "wind_speed"]
    columns += ["cloud_coverage"] if wind and "cloud_coverage" in readings.columns else []
    found = complete_weather(readings, wind).agg(
        F.count("*").alias("sample_size"),
        *[guarded_corr(reading, F.col(c)).alias(f"{c}_r") for c in columns],
    )
    return correlations(found, wind, min_rows)


def correlations(
    moments: DataFrame, wind: bool = True, min_rows: int = MIN_WEATHER_ROWS
) -> DataFrame:
    """The same from a row with the sample size and each correlation, ``<column>_r``."""
    names = {"air_temperature_r": "temperature", "wind_speed_r": "wind_speed"}
    if wind and "cloud_coverage_r" in moments.columns:
        names["cloud_coverage_r"] = "cloud_coverage"
    values = [
        (F.col(c) if wind else F.coalesce(c, F.lit(0.0))).alias(name) for c, name in names.items()
    ]
    return moments.where(F.col("sample_size") >= min_rows).select("sample_size", *values)


def temperature_ranges(
    readings: DataFrame, wind: bool = True, min_rows: int = MIN_WEATHER_ROWS,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Mean, sample std and count of readings in five equal-width temperature bins.

    No rows below ``min_rows`` complete readings; 0 is no guard. The full analysis names all
    bins, an empty one with count 0; ``wind=False``, the dashboard form, leaves those out.
    ``bounds`` may give the row of least and greatest temperature and count (_lo, _hi, _n).
    """
    usable = complete_weather(readings, wind).select("meter_reading", "air_temperature")
    if bounds is None:
        bounds = usable.agg(
            F.min("air_temperature").alias("_lo"),
            F.max("air_temperature").alias("_hi"),
            F.count("*").alias("_n"),
        )
    bounds = bounds.where((F.col("_n") >= min_rows) & (F.col("_n") > 0))
    number = equal_width_bin(F.col("air_temperature"), F.col("_lo"), F.col("_hi"))
    found = (
        usable.crossJoin(F.broadcast(bounds))
        .groupBy(number.alias("bin"))
        .agg(
            F.avg("meter_reading").alias("mean"),
            F.stddev_samp("meter_reading").alias("std"),
            F.count("*").alias("count"),
        )
    )
    if wind:
        # The single row of bounds, or none below the guard, gives the five bins or none.
        every = bounds.select(F.explode(F.sequence(F.lit(1), F.lit(5))).alias("bin"))
        found = every.join(found, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
    return found.withColumn("temp_range", temperature_label(F.col("bin")))


def weather_trend(readings: DataFrame, wind: bool = True) -> DataFrame:
    """Least-squares line of the reading over temperature and wind, with its end points.

    A constant measure has no line. The points of the scatter plot are the rows of
    ``complete_weather``.
    """
    measures = ["air_temperature", "wind_speed"]
    long = complete_weather(readings, wind).unpivot("meter_reading", measures, "measure", "x")
    y, x = F.col("meter_reading"), F.col("x")
    line = long.where(x.isNotNull()).groupBy("measure").agg(
        F.count("*").alias("points"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
    )
    for end in ("min", "max"):
        y_end = F.col("intercept") + F.col("slope") * F.col(f"x_{end}")
        line = line.withColumn(f"y_{end}", y_end)
    return line


def type_performance(readings: DataFrame) -> DataFrame:
    """Per type: statistics rounded to 2 places first, rates from the rounded values."""
    return rated_types(
        readings.where(F.col("primary_use").isNotNull()).groupBy("primary_use").agg(
            F.avg("meter_reading").alias("mean"),
            F.stddev_samp("meter_reading").alias("std"),
            F.count("meter_reading").alias("readings"),
            F.sum("anomaly").alias("anomalies"),
            F.avg("square_feet").alias("area_mean"),
        )
    )


def rated_types(measured: DataFrame) -> DataFrame:
    """The same from the measures of each type."""
    half_even = F.bround
    rounded = measured.select(
        "primary_use",
        half_even("mean", 2).alias("meter_reading_mean"),
        half_even("std", 2).alias("meter_reading_std"),
        F.col("readings").alias("meter_reading_count"),
        F.col("anomalies").alias("anomaly_sum"),
        half_even("area_mean", 2).alias("square_feet_mean"),
    )
    rate = F.when(
        F.col("meter_reading_count") > 0,
        F.col("anomaly_sum") / F.col("meter_reading_count") * 100,
    )
    per_area = F.when(
        F.col("square_feet_mean") != 0,
        F.col("meter_reading_mean") / F.col("square_feet_mean") * 1000,
    )
    return rounded.withColumns(
        {"anomaly_rate": half_even(rate, 2), "consumption_per_sqft": half_even(per_area, 3)}
    )


def _pattern(readings: DataFrame, key) -> DataFrame:
    return readings.groupBy(key).agg(
        F.avg("meter_reading").alias("mean"),
        F.count("meter_reading").alias("count"),
        F.sum("anomaly").alias("anomalies"),
    )


def size_performance(readings: DataFrame) -> DataFrame:
    """Per size class; areas without a class are left out."""
    classed = readings.withColumn("size_category", size_class(F.col("square_feet")))
    return rated_sizes(
        _pattern(classed.where(F.col("size_category").isNotNull()), "size_category")
    )


def rated_sizes(by_class: DataFrame) -> DataFrame:
    return by_class.withColumn("anomaly_rate", percent(F.col("anomalies"), F.col("count")))


def hourly_patterns(readings: DataFrame) -> DataFrame:
    """Per hour, with a flag for peak hours: over 10 readings, mean above the overall mean."""
    overall = readings.agg(F.avg("meter_reading").alias("_overall"))
    return marked_hours(_pattern(readings.where(F.col("hour").isNotNull()), "hour"), overall)


def marked_hours(by_hour: DataFrame, overall: DataFrame) -> DataFrame:
    """The same from the measures of each hour and a row with the mean of all, ``_overall``."""
    peak = (F.col("count") > MIN_PERIOD_ROWS) & (F.col("mean") > F.col("_overall"))
    return (
        by_hour.crossJoin(F.broadcast(overall))
        .withColumn("is_peak", F.coalesce(peak, F.lit(False)))
        .drop("_overall")
    )


def weekday_patterns(readings: DataFrame) -> DataFrame:
    """Per weekday, with its name and whether it has enough readings to be shown."""
    return named_days(_pattern(readings.where(F.col("weekday").isNotNull()), "weekday"))


def named_days(by_day: DataFrame) -> DataFrame:
    return by_day.withColumns(
        {
            "day_name": weekday_name(F.col("weekday")),
            "is_shown": F.col("count") > MIN_PERIOD_ROWS,
        }
    )


def monthly_patterns(readings: DataFrame) -> DataFrame:
    return _pattern(readings.where(F.col("month").isNotNull()), "month")


def anomaly_comparison(readings: DataFrame) -> DataFrame:
    """One row comparing anomalies and normal readings; means need both classes."""
    return compared(readings.agg(
        F.count("*").alias("rows"),
        F.sum("anomaly").alias("anomalies"),
        F.count_if(labelled()).alias("anomalous"),
        F.count_if(F.col("anomaly") == 0).alias("normal"),
        F.avg(F.when(labelled(), F.col("meter_reading"))).alias("anomalous_mean"),
        F.avg(F.when(F.col("anomaly") == 0, F.col("meter_reading"))).alias("normal_mean"),
    ))


def compared(measured: DataFrame) -> DataFrame:
    """The same from the measures of all readings."""
    both = (F.col("anomalous") > 0) & (F.col("normal") > 0)
    anomaly_avg, normal_avg = F.col("anomaly_avg"), F.col("normal_avg")
    total = F.coalesce("anomalies", F.lit(0))
    return measured.select(
        F.col("rows").alias("total_readings"),
        total.alias("total_anomalies"),
        percent(total, F.col("rows")).alias("anomaly_rate"),
        F.when(both, F.col("anomalous_mean")).alias("anomaly_avg"),
        F.when(both, F.col("normal_mean")).alias("normal_avg"),
    ).withColumns(
        {
            "difference": anomaly_avg - normal_avg,
            "percent_difference": F.when(normal_avg != 0, (anomaly_avg / normal_avg - 1) * 100),
        }
    )


def anomaly_by_type(readings: DataFrame, n: int = 5) -> DataFrame:
    """The n types with most anomalies and the rate within each type."""
    return most_anomalous_types(
        readings.where(F.col("primary_use").isNotNull()).groupBy("primary_use").agg(
            F.count_if(labelled()).alias("anomalies"), F.count("*").alias("total")
        ), n
    )


def most_anomalous_types(by_type: DataFrame, n: int = 5) -> DataFrame:
    return (
        by_type.where(F.col("anomalies") > 0)
        .withColumn("rate", percent(F.col("anomalies"), F.col("total")))
        .orderBy(F.desc("anomalies"), "primary_use")
        .limit(n)
    )


def worst_building(readings: DataFrame) -> DataFrame:
    """The building with most anomalies, none when there are no anomalies."""
    return most_anomalous_building(
        readings.groupBy("building_id").agg(F.sum("anomaly").alias("anomaly_count"))
    )


def most_anomalous_building(counts: DataFrame) -> DataFrame:
    top = counts.orderBy(F.desc("anomaly_count"), "building_id").limit(1)
    return top.where(F.col("anomaly_count") > 0)


def explorer_summary(filtered: DataFrame) -> DataFrame:
    """Rows, buildings, anomalies and mean reading (1 place) of a filtered table."""
    return filtered.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("building_id").alias("unique_buildings"),
        F.count_if(labelled()).alias("total_anomalies"),
        F.coalesce(F.round(F.avg("meter_reading"), 1), F.lit(0.0)).alias("avg_consumption"),
    )


def latest_reading(readings: DataFrame, attributes: tuple[str, ...] = ()) -> DataFrame:
    """The last non-null reading of each building, ties in time broken by row id.

    ``attributes`` are building columns taken along from that row; being grouping keys of
    the first aggregation they should change rarely within a building.
    """
    order = arrival()
    parts = non_null_readings(readings).groupBy("building_id", *attributes).agg(
        F.max(order).alias("_order"),
        F.max_by("row_id", order).alias("row_id"),
        F.max_by("timestamp", order).alias("timestamp"),
        F.max_by("meter_reading", order).alias("meter_reading"),
    )
    if not attributes:
        return parts.drop("_order")
    columns = ["row_id", "timestamp", "meter_reading", *attributes]
    latest = F.max_by(F.struct(*columns), "_order").alias("_latest")
    return parts.groupBy("building_id").agg(latest).select("building_id", "_latest.*")


def building_info(readings: DataFrame) -> DataFrame:
    """First known attributes of each building, year of construction included."""
    attributes = ["primary_use", "site_id", "square_feet", "floor_count", "year_built"]
    parts = readings.groupBy("building_id", *attributes).agg(F.min(arrival()).alias("_first"))
    first = F.min_by(F.struct(*attributes), "_first").alias("_attributes")
    return parts.groupBy("building_id").agg(first).select("building_id", "_attributes.*")


def recent_per_building(readings: DataFrame, n: int = 24) -> DataFrame:
    """The n most recent non-null readings of each building.

    Spark keeps n rows per building in every task before the shuffle, so a hot building
    moves no more rows than any other.
    """
    newest = Window.partitionBy("building_id").orderBy(F.desc("timestamp"), F.desc("row_id"))
    columns = ["row_id", "building_id", "timestamp", "meter_reading", "anomaly",
               "air_temperature", "hour"]
    return (
        non_null_readings(readings)
        .select(*columns)
        .withColumn("position", F.row_number().over(newest))
        .where(F.col("position") <= n)
    )
