"""Session settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: small sides become broadcasts, skewed joins are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wall-clock times are written and read without a zone.
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python line of every column expression makes planning several times
    # slower than it need be.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Bytes of a shuffle that one task should read.
TASK_BYTES = 256 << 20


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions for shuffles of as many bytes as the input; fewer are merged at run time."""
    return max(200, -(-input_bytes // TASK_BYTES))


def session_builder(name: str = "meterlens", input_bytes: int | None = None) -> SparkSession.Builder:
    """A builder with these settings; ``input_bytes``, if known, sizes the shuffles.

    Spark's 200 partitions would each get half a terabyte of a 100 TB sort. Adaptive execution
    merges small partitions but doesn't make more of them.
    """
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes))
    return builder
