"""Alert processing: repeated alerts are marked and fresh ones counted in a trailing window.

An alert is a duplicate if a Bloom filter may have seen its building, time and score. Only
fresh alerts count. What a run has to know of earlier alerts is a state of two small tables, so
a stream processed a batch at a time gives the rows of one run over all alerts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.operators.bloom import alert_item, bloom_build, bloom_dedup, bloom_stats
from meterlens.operators.counting import trailing_count
from meterlens.operators.dgim import dgim_count
from meterlens.storage import durable


class AlertState(NamedTuple):
    """Earlier alerts: the filter's set bits, and fresh alerts per time within a window."""

    bits: DataFrame
    recent: DataFrame


def process_alerts(
    alerts: DataFrame,
    capacity: int,
    error_rate: float,
    window_seconds: int,
    state: AlertState | None = None,
) -> tuple[DataFrame, AlertState]:
    """(alerts with item, is_duplicate and ones_in_window, what the next run adds to the state).

    Alerts have row_id, building_id, timestamp and anomaly_score. ``ones_in_window`` counts the
    fresh alerts of the window ending at the alert's time, earlier runs included. The new
    bits are those not in ``state``; the recent alerts replace the state's.
    """
    known = state.bits if state is not None else None
    marked = durable(bloom_dedup(alerts, alert_item(), capacity, error_rate, known=known))
    fresh = marked.where(~F.col("is_duplicate")).groupBy("timestamp").agg(F.count("*").alias("n"))
    if state is not None:
        fresh = fresh.unionByName(state.recent.select("timestamp", "n")).groupBy("timestamp").agg(
            F.sum("n").alias("n"))
    # A time without fresh alerts still asks for the count of its window.
    times = marked.select("timestamp", F.lit(0).cast("long").alias("n")).unionByName(fresh)
    ones = times.groupBy("timestamp").agg(F.sum("n").alias("n"))
    counts = trailing_count(
        ones.withColumn("stream", F.lit(0)), ["stream"], window_seconds, weight="n"
    ).drop("stream")
    processed = marked.join(counts, "timestamp").select(*marked.columns, "ones_in_window")

    bits = bloom_build(marked.where(~F.col("is_duplicate")), F.col("item"), capacity, error_rate)
    if known is not None:
        bits = bits.join(known.select("bit"), "bit", "left_anti")
    length = F.expr(f"INTERVAL '{int(window_seconds)}' SECOND")
    last = fresh.agg(F.max("timestamp").alias("_last"))
    recent = fresh.crossJoin(F.broadcast(last)).where(F.col("timestamp") >= F.col("_last") - length)
    return processed, AlertState(bits, recent.drop("_last"))


def alert_statistics(
    processed: DataFrame, capacity: int, error_rate: float, window_seconds: int
) -> DataFrame:
    """One row: the filter's statistics and the estimated fresh alerts of the last window."""
    stats = bloom_stats(processed, capacity, error_rate)
    fresh = processed.where(~F.col("is_duplicate")).select(
        F.lit(0).alias("stream"), "row_id", "timestamp", F.lit(1).alias("bit")
    )
    counted = dgim_count(fresh, ["stream"], window_seconds).select(
        F.col("estimate_per_size").alias("estimated_in_window"), "bucket_count", "memory_bytes"
    )
    names = ["estimated_in_window", "bucket_count", "memory_bytes"]
    none = stats.sparkSession.range(1).select(F.lit(True).alias("_all"))
    # One row, also without a fresh alert.
    filled = none.join(counted, F.col("_all"), "left").select(
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names]
    )
    return stats.crossJoin(F.broadcast(filled))
