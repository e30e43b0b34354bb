"""Streams of readings: sources, windows, detection and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from meterlens.operators.detectors import iqr_columns, sigma_columns, with_statistics
from meterlens.operators.filters import non_null_readings
from meterlens.operators.sessions import (
    sliding_counts,
    stream_session_counts,
    tumbling_counts,
)
from meterlens.sources.entry import store_entries
from meterlens.sources.tables import append_anomalies, batch_name, write_batch


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of Parquet files; the limit bounds the rows of a micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def with_event_time(stream: DataFrame, delay: str, ts: str = "timestamp") -> DataFrame:
    """Cast to TIMESTAMP, which watermarks need, and drop rows later than ``delay``."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def windowed_counts(
    stream: DataFrame,
    delay: str,
    width: str,
    slide: str | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Tumbling or sliding counts of a stream; windows appear once the watermark closes them."""
    timed = with_event_time(stream, delay)
    if slide:
        return sliding_counts(timed, width, slide, keys)
    return tumbling_counts(timed, width, keys)


def session_counts(stream: DataFrame, delay: str, gap: str, keys: list[str]) -> DataFrame:
    return stream_session_counts(with_event_time(stream, delay), gap, keys)


def detect(stream: DataFrame, stats: DataFrame, method: str = "3sigma") -> DataFrame:
    """3-sigma or IQR verdict for each reading of a stream against stored statistics."""
    prefix, columns = {"3sigma": ("sigma", sigma_columns), "iqr": ("iqr", iqr_columns)}[method]
    rows = with_statistics(non_null_readings(stream), stats).withColumns(columns())
    return rows.select(
        *stream.columns,
        F.col(f"{prefix}_anomaly").alias("is_anomaly"),
        F.col(f"{prefix}_confidence").alias("confidence"),
        F.lit(method).alias("method"),
        F.col(f"{prefix}_details").alias("details"),
    )


def exact_dedup(stream: DataFrame, item: str, delay: str) -> DataFrame:
    """First occurrence of each item; an item is forgotten ``delay`` after its time."""
    return with_event_time(stream, delay).dropDuplicatesWithinWatermark([item])


def append_entries_stream(
    entries: DataFrame, readings_path: str, rejected_path: str, checkpoint: str
) -> DataStreamWriter:
    """Validate entered readings per micro-batch; accepted and rejected go to two tables.

    The tables are those of ``store_entries`` and ``write_readings``: loads, forms and
    streams add batches to the same folders, and a batch run again replaces its own.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        store_entries(batch, readings_path, rejected_path, batch_name(checkpoint, batch_id))

    return entries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def append_anomalies_stream(
    results: DataFrame, path: str, checkpoint: str
) -> DataStreamWriter:
    """Add the flagged readings of a stream to the anomalies table, each batch once.

    A file sink would keep a list of its own files, and a reader who finds it sees no others.
    Here every batch is a folder like that of a batch run, replaced if it runs again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        append_anomalies(batch, path, batch_name(checkpoint, batch_id))

    return results.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def batch_stats(batch: DataFrame, batch_id: int, path: str, name: str) -> None:
    """Store rows and duplicates of a de-duplicated micro-batch as stream statistics."""
    names = ["processed", "duplicates"]
    counts = batch.agg(
        F.count("*").cast("double").alias("processed"),
        F.count_if("is_duplicate").cast("double").alias("duplicates"),
    ).unpivot([], names, "metric", "value")
    stamped = counts.withColumns(
        {"timestamp": F.current_timestamp(), "batch_id": F.lit(batch_id).cast("long")}
    )
    write_batch(stamped, path, name)
