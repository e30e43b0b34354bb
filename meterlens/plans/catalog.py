"""The checked queries: every operator applied to readings derived from the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions import numeric
from meterlens.operators import aggregates as A
from meterlens.operators import bloom as B
from meterlens.operators import classifier as C
from meterlens.operators import detectors as D
from meterlens.operators import dgim as G
from meterlens.operators import filters as P
from meterlens.operators import profile as R
from meterlens.operators import sampling as S
from meterlens.operators import sessions as W
from meterlens.operators import thresholds as X
from meterlens.operators.alerts import process_alerts
from meterlens.operators.counting import trailing_count
from meterlens.plans import reports
from meterlens.schema import FEATURES, READINGS
from meterlens.sources import tables
from meterlens.sources.entry import validate_entries
from meterlens.sources.events import readings as load
from meterlens.sources.files import (
    head_csv,
    judged_readings,
    read_csv_checked,
    split_judged,
)
from meterlens.storage import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Hours of the moving-average range: readings of the test tables come about twice a day.
RANGE_HOURS = 601
# Parameters of the filters, sketches and samples below.
EXPLORER = dict(
    building_id_min=3, building_id_max=120, meter_reading_min=2.5, temp_max="30",
    wind_speed_min=1, date_from="2024-01-05", date_to="2024-01-20", primary_use="",
    anomaly_filter=None,
)
CAPACITY, ERROR_RATE = 10000, 0.1
DEMO_CAPACITY, DEMO_ERROR_RATE = 1000, 0.01
HOUR, DAY = 3600, 86400
SAMPLE = 1000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def events_only(spark: SparkSession, folder: str) -> DataFrame:
    """Readings without building columns: no join."""
    return load(spark, folder, attributes=False)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def readings_csv(spark, folder):
    """Readings as CSV files, NaN for missing numbers, among them lines that can't be loaded.

    Every 97th reading is written again without its last field, with a building that is no
    number, and without a time; every 89th has a wind speed that is no number in a copy.
    """
    rows = load(spark, folder).select(*READINGS.names)
    numbers = [c for c in rows.columns if c not in ("timestamp", "primary_use")]
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in numbers}
    raw = rows.withColumns({**text, "timestamp": F.col("timestamp").cast("string")})
    row = F.col("row_id").cast("long")
    path = f"{shared_folder(spark)}/meterlens/{uuid.uuid4().hex}"

    def put(lines):
        lines.write.mode("append").option("header", True).csv(path)

    put(raw)
    few = raw.where(row % 97 == 0)
    put(few.drop("month"))
    put(few.withColumn("building_id", F.concat(F.lit("b"), "building_id")))
    put(few.withColumn("timestamp", F.lit("")))
    put(raw.where(row % 89 == 0).withColumn("wind_speed", F.lit("calm")))
    return read_csv_checked(spark, path, READINGS.names)


@query
def ingest_readings(spark, folder):
    """CSV text parsed, typed and split; copies with one bad value are loaded without it."""
    return split_judged(judged_readings(readings_csv(spark, folder)))[0]


@query
def ingest_rejects(spark, folder):
    """The quarantine of the same files: reasons, how often, and how many were loaded."""
    quarantine = split_judged(judged_readings(readings_csv(spark, folder)))[1]
    reason = F.concat_ws(";", "reasons")
    fields = F.size(F.split("line", ",", -1))
    return quarantine.groupBy(reason.alias("reasons"), "loaded", fields.alias("fields")).agg(
        F.count("*").alias("row_count"))


@query
def head_types(spark, folder):
    """Types and values of the first 50 lines of the CSV files, inferred from these alone."""
    rows = load(spark, folder).select("row_id", "meter_reading", "primary_use")
    path = f"{shared_folder(spark)}/meterlens/{uuid.uuid4().hex}"
    rows.orderBy("row_id").coalesce(1).write.option("header", True).csv(path)
    head = head_csv(spark, path, 50)
    kinds = F.create_map(*[F.lit(x) for pair in head.dtypes for x in pair])
    return R.null_profile(head).select(
        "column_name", kinds[F.col("column_name")].alias("data_type"), "non_null")


@query
def table_counts(spark, folder):
    rows = events_only(spark, folder)
    detected = D.three_sigma(rows).where("is_anomaly")
    return tables.table_counts({"meter_readings": rows, "anomalies": detected})



@query
def entry_validate(spark, folder):
    """Readings as entry forms: negative readings and blank times are made broken."""
    form = events_only(spark, folder).select(
        "row_id",
        (F.col("building_id") * 2 - 5).alias("building_id"),
        (F.col("meter_reading") - 0.5).alias("meter_reading"),
        F.when(F.col("row_id") % 17 != 0, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm"))
        .otherwise(F.lit("")).alias("timestamp"),
        "air_temperature",
        (F.col("wind_speed") - 0.5).alias("wind_speed"),
        "anomaly",
    )
    return validate_entries(form)


@query
def project_readings(spark, folder):
    return P.project_readings(load(spark, folder))


@query
def non_null_readings(spark, folder):
    return P.non_null_readings(load(spark, folder))


@query
def labeled_anomalies(spark, folder):
    return P.labeled_anomalies(load(spark, folder))


@query
def time_range(spark, folder):
    rows = events_only(spark, folder).select("row_id", "timestamp", "meter_reading")
    return P.time_range(rows, "2024-01-10 00:00:00", "2024-01-20 12:00:00")


@query
def drop_null_weather(spark, folder):
    return A.complete_weather(events_only(spark, folder))


@query
def explore_filter(spark, folder):
    return P.explorer_filter(load(spark, folder), **EXPLORER)


@query
def join_on_row_id(spark, folder):
    """Labels file and features file matched on their common key."""
    rows = events_only(spark, folder)
    labels = rows.select("row_id", "building_id", "timestamp", "meter_reading", "anomaly")
    features = load(spark, folder).drop("anomaly")
    return P.join_on_merge_key(labels, features)


@query
def schema_compare(spark, folder):
    rows = load(spark, folder)
    labels = rows.select("row_id", "building_id", "timestamp", "meter_reading", "anomaly")
    return P.schema_compare(labels, rows.drop("anomaly"))


@query
def overall_stats(spark, folder):
    rows = events_only(spark, folder)
    return A.overall_stats(rows, D.three_sigma(rows).where("is_anomaly"))


@query
def distinct_buildings(spark, folder):
    return A.distinct_buildings(events_only(spark, folder))


@query
def building_types(spark, folder):
    return A.building_types(load(spark, folder))


@query
def building_summary(spark, folder):
    return rounded(A.building_summary(load(spark, folder)), 9, "avg_consumption")


@query
def building_detail(spark, folder):
    return rounded(A.building_detail(events_only(spark, folder)), 9, "avg_consumption")


@query
def building_info(spark, folder):
    return A.building_info(load(spark, folder))


@query
def building_statistics(spark, folder):
    stats = A.building_statistics(events_only(spark, folder))
    return rounded(stats, 9, "mean", "std", "median", "q75", "q25")


@query
def anomaly_distribution(spark, folder):
    return A.anomaly_distribution(events_only(spark, folder))


@query
def weather_correlation(spark, folder):
    result = A.weather_correlation(events_only(spark, folder))
    return rounded(result, 9, "temperature", "wind_speed", "cloud_coverage")


@query
def weather_dashboard(spark, folder):
    result = A.weather_correlation(events_only(spark, folder), wind=False)
    return rounded(result, 9, "temperature", "wind_speed")


@query
def temperature_ranges(spark, folder):
    return rounded(A.temperature_ranges(events_only(spark, folder)), 9, "mean", "std")


@query
def weather_trend(spark, folder):
    result = A.weather_trend(events_only(spark, folder))
    return rounded(result, 9, "slope", "intercept", "y_min", "y_max")


@query
def type_performance(spark, folder):
    return A.type_performance(load(spark, folder))


@query
def size_performance(spark, folder):
    return rounded(A.size_performance(load(spark, folder)), 9, "mean", "anomaly_rate")


@query
def hourly_patterns(spark, folder):
    return rounded(A.hourly_patterns(events_only(spark, folder)), 9, "mean")


@query
def weekday_patterns(spark, folder):
    return rounded(A.weekday_patterns(events_only(spark, folder)), 9, "mean")


@query
def monthly_patterns(spark, folder):
    return rounded(A.monthly_patterns(events_only(spark, folder)), 9, "mean")


@query
def anomaly_comparison(spark, folder):
    result = A.anomaly_comparison(events_only(spark, folder))
    return rounded(result, 9, "anomaly_avg", "normal_avg", "difference", "percent_difference")


@query
def anomaly_by_type(spark, folder):
    return A.anomaly_by_type(load(spark, folder))


@query
def worst_building(spark, folder):
    return A.worst_building(events_only(spark, folder))


@query
def insights(spark, folder):
    return rounded(reports.insights(load(spark, folder)), 9, "value")


@query
def full_analysis(spark, folder):
    """All numbers of the full run over the non-null readings."""
    return rounded(reports.flat_analysis(reports.complete_analysis(load(spark, folder))), 6, "value")


@query
def feature_thresholds(spark, folder):
    result = X.feature_thresholds(load(spark, folder))
    return rounded(result, 6, "mean", "std", "min", "max", "q1", "q3")


@query
def explore_summary(spark, folder):
    return A.explorer_summary(P.explorer_filter(load(spark, folder), **EXPLORER))


@query
def null_profile(spark, folder):
    return rounded(R.null_profile(load(spark, folder)), 9, "null_percent").drop("data_type")


@query
def numeric_describe(spark, folder):
    result = R.numeric_describe(load(spark, folder))
    return rounded(result, 6, "mean", "std", "min", "p25", "p50", "p75", "max")


@query
def categorical_profile(spark, folder):
    """The text columns of the readings and two of the events behind them."""
    rows = load(spark, folder).select("primary_use")
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_type", "props")
    profile = R.categorical_profile(rows).unionByName(R.categorical_profile(events))
    return profile.withColumn("listed", F.concat_ws("|", "listed"))


@query
def label_distribution(spark, folder):
    return R.label_distribution(events_only(spark, folder))


@query
def latest_reading(spark, folder):
    return A.latest_reading(load(spark, folder), ("primary_use", "site_id"))


@query
def recent_24(spark, folder):
    return A.recent_per_building(events_only(spark, folder))


@query
def recent_readings(spark, folder):
    return P.recent_readings(load(spark, folder))


@query
def recent_anomalies(spark, folder):
    return P.recent_anomalies(load(spark, folder))


@query
def building_page(spark, folder):
    summary = A.building_summary(load(spark, folder)).drop("avg_consumption")
    return P.page(summary, ["building_id"], number=2, size=20)


@query
def explore_page(spark, folder):
    rows = P.explorer_page(load(spark, folder), number=3, **EXPLORER)
    return rows.select("row_id", "building_id", "timestamp", "meter_reading", "page", "total",
                       "pages")


@query
def all_anomalies(spark, folder):
    rows = load(spark, folder)
    detected = D.three_sigma(rows).where("is_anomaly")
    return P.all_anomalies(rows, detected.select("building_id", "timestamp", "meter_reading"))


@query
def reading_context(spark, folder):
    rows = load(spark, folder)
    return rounded(rows.select("row_id", *numeric.reading_context()), 9, "use_per_area")



@query
def three_sigma(spark, folder):
    return rounded(D.three_sigma(events_only(spark, folder)), 9, "confidence", "z_score")


@query
def iqr(spark, folder):
    result = D.iqr(events_only(spark, folder)).drop("details")
    return rounded(result, 9, "confidence", "lower_bound", "upper_bound")


@query
def moving_average(spark, folder):
    result = D.moving_average(events_only(spark, folder))
    return rounded(result.drop("details"), 9, "confidence", "moving_avg", "moving_std")


@query
def moving_average_asof(spark, folder):
    result = D.moving_average_asof(events_only(spark, folder), range_hours=RANGE_HOURS)
    return rounded(result.drop("details"), 9, "confidence", "moving_avg", "moving_std")


@query
def ensemble(spark, folder):
    result = D.ensemble(events_only(spark, folder))
    return rounded(result.drop("details"), 9, "confidence")


@query
def detect_batch(spark, folder):
    result = D.detect_batch(events_only(spark, folder), range_hours=RANGE_HOURS)
    votes = F.get_json_object("details", "$.votes").alias("votes")
    return rounded(result.select("*", votes).drop("details"), 9, "confidence")


@query
def detect_latest(spark, folder):
    result = D.detect_latest(load(spark, folder))
    flat = result.select(
        *[c for c in result.columns if c not in ("building_info", "statistics")],
        "building_info.*", "statistics.*",
    )
    return rounded(flat, 9, "confidence", "z_score", "mean", "std")


@query
def anomalous_parameters(spark, folder):
    rows = load(spark, folder)
    result = X.anomalous_parameters(rows, X.feature_thresholds(rows))
    return rounded(result, 6, "value", "mean", "deviation")


@query
def default_thresholds(spark, folder):
    """Parameters outside the fallback thresholds, counted over all readings."""
    found = X.anomalous_parameters(load(spark, folder), X.default_thresholds(spark))
    return found.groupBy("parameter", "severity", "expected_range").agg(
        F.count("*").alias("row_count")
    )


@query
def sample_readings(spark, folder):
    return S.sample_readings(events_only(spark, folder), SAMPLE)


@query
def training_set(spark, folder):
    return C.training_set(load(spark, folder))


@query
def stratified_split(spark, folder):
    rows = C.training_set(load(spark, folder)).select("row_id", "anomaly")
    return S.stratified_split(rows)


@query
def confusion_matrix(spark, folder):
    """3-sigma verdicts taken as predictions of the label."""
    verdicts = D.three_sigma(events_only(spark, folder))
    return C.confusion_matrix(verdicts.withColumn("prediction", F.col("is_anomaly").cast("int")))


@query
def classification_report(spark, folder):
    verdicts = D.three_sigma(events_only(spark, folder))
    predicted = verdicts.withColumn("prediction", F.col("is_anomaly").cast("int"))
    result = C.classification_report(C.confusion_matrix(predicted))
    return rounded(result, 9, "precision", "recall", "f1", "accuracy")


@query
def gbt_score(spark, folder):
    """Train on four fifths of the readings, score the last fifth."""
    scored = C.scored_test_rows(load(spark, folder))
    return scored.select("row_id", "anomaly", "prediction", "prediction_label", "confidence",
                         "probability_normal", "probability_anomaly", "anomaly_count")


def consistent(scored):
    """What holds for a scored row, whatever the trees have learned."""
    normal, anomalous = F.col("probability_normal"), F.col("probability_anomaly")
    prediction = F.col("prediction")
    return scored.select(
        "*",
        (F.abs(normal + anomalous - 1) < 1e-9).alias("sums_to_one"),
        (prediction == F.when(anomalous > normal, 1).otherwise(0)).alias("is_likelier"),
        (F.col("confidence") == F.greatest(normal, anomalous)).alias("confidence_is_greater"),
        (F.col("prediction_label") == F.when(prediction == 1, "Anomaly").otherwise("Normal")).alias(
            "label_fits"),
    )


@query
def gbt_facts(spark, folder):
    """Which rows are scored, their explanations, and the consistency of their predictions."""
    scored = C.scored_test_rows(load(spark, folder))
    return consistent(scored).select(
        "row_id", "anomaly", "anomaly_count", F.size("missing_features").alias("n_missing"),
        "sums_to_one", "is_likelier", "confidence_is_greater", "label_fits")


@query
def classification_form(spark, folder):
    """Every 50th reading as a classification form without cloud cover and pressure."""
    rows = load(spark, folder)
    model = C.train(C.training_set(rows))
    forms = rows.where(F.col("row_id") % 50 == 0).select(
        "row_id", "meter_reading", "primary_use", "square_feet", "floor_count", "year_built",
        "air_temperature", "wind_speed", "dew_temperature", "hour",
        F.col("weekday").alias("day_of_week"), "timestamp")
    found = C.classify(model, forms)
    in_range = F.col("anomaly_probability").between(0, 1)
    fits = F.col("predicted_anomaly") == F.when(F.col("anomaly_probability") > 0.5, 1).otherwise(0)
    return rounded(found.select(
        "row_id", "known_type", in_range.alias("is_probability"), fits.alias("prediction_fits"),
        "use_per_area", "building_age", "is_weekend", "is_business_hours"), 9, "use_per_area")


@query
def missing_features(spark, folder):
    """Readings without two of the features: their names, and the zeros that stand for them."""
    rows = events_only(spark, folder).drop("wind_speed")
    typed = C.with_missing_features(rows, FEATURES)
    return typed.select(
        "row_id", F.concat_ws(",", "missing_features").alias("missing_features"),
        "wind_speed", "square_feet", "floor_count", "meter_reading")


@query
def recent_detections(spark, folder):
    """The latest rows of an anomalies table, each detected an hour after its reading."""
    stored = tables.anomaly_rows(D.iqr(events_only(spark, folder)))
    detected = stored.withColumn("detected_at", F.col("timestamp") + F.expr("INTERVAL 1 HOUR"))
    return rounded(P.recent_detections(detected).drop("details"), 9, "anomaly_score")


@query
def iso_times(spark, folder):
    return events_only(spark, folder).select(
        "row_id", numeric.iso_text(F.col("timestamp")).alias("iso"))


@query
def row_compare(spark, folder):
    """Rounded readings of odd and of all rows as multisets: copies count as often as they occur."""
    rows = events_only(spark, folder).select(
        "row_id", "hour", "wind_speed", F.floor("meter_reading").alias("reading"))
    odd = rows.where("row_id % 2 = 1").drop("row_id")
    few = rows.where("row_id % 3 = 0").withColumn("extra", F.lit(1))
    return P.row_compare(odd, few)


def labelled_items(spark, folder):
    rows = P.labeled_anomalies(events_only(spark, folder))
    return rows.select("row_id", "building_id", "timestamp", "meter_reading")


@query
def bloom_build(spark, folder):
    rows = labelled_items(spark, folder)
    return B.bloom_build(rows, B.reading_item(), CAPACITY, ERROR_RATE)


@query
def bloom_dedup(spark, folder):
    rows = labelled_items(spark, folder)
    return B.bloom_dedup(rows, B.reading_item(), CAPACITY, ERROR_RATE)


@query
def bloom_stats(spark, folder):
    rows = B.bloom_dedup(labelled_items(spark, folder), B.reading_item(), CAPACITY, ERROR_RATE)
    return rounded(B.bloom_stats(rows, CAPACITY, ERROR_RATE), 9, "estimated_fpr")


@query
def bloom_probe(spark, folder):
    """All readings looked up in the filter of the labelled ones."""
    bits = B.bloom_build(labelled_items(spark, folder), B.reading_item(), CAPACITY, ERROR_RATE)
    rows = P.non_null_readings(events_only(spark, folder)).select(
        "row_id", "building_id", "meter_reading"
    )
    return B.bloom_probe(rows, B.reading_item(), bits, CAPACITY, ERROR_RATE)


@query
def anomaly_dedup_stats(spark, folder):
    """The labelled-alert run: filter statistics and the count of a window without expiry."""
    rows = labelled_items(spark, folder)
    marked = B.bloom_dedup(rows, B.reading_item(), DEMO_CAPACITY, DEMO_ERROR_RATE)
    stats = B.bloom_stats(marked, DEMO_CAPACITY, DEMO_ERROR_RATE)
    counted = stats.withColumns(G.closed_form(F.col("total_processed")))
    return rounded(counted, 9, "estimated_fpr")


@query
def exact_dedup(spark, folder):
    return B.exact_dedup(labelled_items(spark, folder), B.reading_item())


def scored_alerts(spark, folder):
    scored = D.three_sigma(events_only(spark, folder)).where(F.col("anomaly") == 1)
    return scored.select("row_id", "building_id", "timestamp",
                         F.col("confidence").alias("anomaly_score"))


@query
def alert_dedup(spark, folder):
    """Labelled readings as alerts scored by 3-sigma: de-duplicated, counted per hour."""
    processed, _ = process_alerts(scored_alerts(spark, folder), CAPACITY, 0.01, HOUR)
    return processed.drop("anomaly_score")


def anomaly_bits(spark, folder):
    return events_only(spark, folder).select(
        "row_id", "building_id", "timestamp", F.col("anomaly").alias("bit")
    )


@query
def exact_window_count(spark, folder):
    return trailing_count(anomaly_bits(spark, folder), ["building_id"], 3 * DAY)


@query
def dgim_count(spark, folder):
    return G.dgim_count(anomaly_bits(spark, folder), ["building_id"], 14 * DAY)


@query
def dgim_closed_form(spark, folder):
    return G.dgim_closed_form(anomaly_bits(spark, folder), ["building_id"])


@query
def tumbling_counts(spark, folder):
    return W.tumbling_counts(load(spark, folder), "6 hours", ["primary_use"])


@query
def sliding_counts(spark, folder):
    return W.sliding_counts(load(spark, folder), "12 hours", "6 hours", ["primary_use"])


@query
def session_counts(spark, folder):
    return W.session_counts(events_only(spark, folder), 6 * HOUR, ["building_id"])
