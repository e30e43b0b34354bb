"""The stored tables: layout, reset, appends, counts."""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.schema import ANOMALIES, READINGS, TABLES

MAX_RECORDS_PER_FILE = 5_000_000


def batch_name(checkpoint: str, batch_id: int) -> str:
    """The name of a micro-batch in the tables it writes to.

    It is made of the checkpoint, since every stream numbers its batches from 0: two streams
    never replace each other's rows, and a batch run again replaces its own.
    """
    return f"stream-{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{batch_id}"


def write_batch(
    rows: DataFrame, path: str, batch: str | None = None, partitions: tuple[str, ...] = ()
) -> None:
    """Put ``rows`` into a stored table as the batch ``batch``, in place of an earlier one.

    Every writer of a table, batch or stream, uses these folders: a plain read of ``path`` sees
    all rows and their ``batch``. Only this batch's folder is replaced, also by no rows, so a
    writer that fails and runs again leaves its rows once. Without a name the batch is a new one.
    """
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path}/batch={batch or f'run-{uuid.uuid4().hex}'}")


def in_schema(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types; those ``rows`` lack are null, others are dropped."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def write_readings(
    readings: DataFrame, path: str, mode: str = "overwrite", batch: str | None = None
) -> None:
    """Batch and month folders, each file sorted by building and time.

    ``overwrite`` replaces the whole table, ``append`` adds a batch or, if it is there already,
    replaces that one. All batches have all columns of the readings, so a plain read needs no
    schema merging. A batch without row ids gets some from its name.

    Range partitioning on the full sort key spreads a hot building or month over many
    tasks; the sort makes Parquet's min/max statistics skip row groups for building and
    time lookups.
    """
    batch = batch or f"run-{uuid.uuid4().hex}"
    if "row_id" not in readings.columns:
        # Below 10**18, as the total order of readings needs.
        number = F.xxhash64(F.lit(batch), F.monotonically_increasing_id())
        readings = readings.withColumn("row_id", F.pmod(number, F.lit(10**18)))
    order = ["reading_month", "building_id", "timestamp", "row_id"]
    laid_out = (
        in_schema(readings, READINGS)
        .withColumn("reading_month", F.date_format("timestamp", "yyyy-MM"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    if mode == "append":
        write_batch(laid_out, path, batch, ("reading_month",))
        return
    (
        laid_out.withColumn("batch", F.lit(batch))
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("batch", "reading_month")
        .parquet(path)
    )


def reset_tables(spark: SparkSession, folder: str) -> None:
    """Replace the four stored tables by empty typed ones."""
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of all batches of a stored table, in its columns."""
    schema = TABLES[name]
    return spark.read.schema(schema).parquet(f"{folder}/{name}").select(*schema.names)


def anomaly_rows(results: DataFrame) -> DataFrame:
    """Detector results that are anomalies, in the shape of the anomalies table."""
    return results.where("is_anomaly").select(
        "building_id",
        "timestamp",
        "meter_reading",
        F.col("confidence").alias("anomaly_score"),
        F.col("method").alias("detection_method"),
        F.col("details").cast("string").alias("details"),
        F.current_timestamp().alias("detected_at"),
    )


def append_anomalies(results: DataFrame, path: str, batch: str | None = None) -> None:
    """Add the flagged rows of a detector run; a run without any adds no rows.

    A run that names its ``batch`` can be repeated: its rows are replaced.
    """
    write_batch(in_schema(anomaly_rows(results), ANOMALIES), path, batch)


def append_metrics(metrics: DataFrame, path: str, batch: str | None = None) -> None:
    """Add (metric, value, …) rows, stamped with the time of writing."""
    write_batch(metrics.withColumn("timestamp", F.current_timestamp()), path, batch)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table. Counts over Parquet read row-group footers, no columns."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
