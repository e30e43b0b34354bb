"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RECORDS: list[list[str]] = []
#: Bytes in one Arrow batch between Spark and Python while a table is written, about. A batch is
#: held on both sides, by every task.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a cluster
    no machine's own disk would outlive its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="meterlens-"))
    return spark.sparkContext.getCheckpointDir()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Plans that run in the block hand Python ``BATCH_BYTES`` of rows at a time, one row at least."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def limit_batches(spark: SparkSession) -> None:
    """As ``small_batches``, for good: for rows that are read after whoever made them is done.

    A limit that the session was given stays.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def durable(df: DataFrame, *partitions: str) -> DataFrame:
    """Write ``df`` once and read it back, in a folder per value of ``partitions`` if named.

    The lineage ends at the written table, so losing an executor repeats nothing, and
    Catalyst then plans with the measured file size: it broadcasts the table only when
    it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/meterlens/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partitions) if partitions else df.write
    for record in _RECORDS:
        record.append(path)
    with small_batches(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def durable_buckets(df: DataFrame, key: str, count: int) -> DataFrame:
    """Write ``df`` once as a table of ``count`` buckets by ``key`` and read it back.

    Joins on ``key`` with rows that are repartitioned in ``count`` by it leave the table's rows
    where they are.
    """
    spark, name = df.sparkSession, f"meterlens_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/meterlens/{name}"
    for record in _RECORDS:
        record.append(path)
    with small_batches(spark):
        df.write.format("parquet").bucketBy(count, key).option("path", path).saveAsTable(name)
    return spark.table(name)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables ``durable`` writes in the block, in order."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not paths]


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that ``durable`` wrote and nothing will read any more.

    Spark deletes the shuffle files behind them once the driver's collector has met the plans
    that made them, so it is run as well; by itself that may take half an hour. What the first
    run lets go, a second one meets.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    for _ in range(2):
        jvm.System.gc()
        time.sleep(0.2)
