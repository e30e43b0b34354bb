"""Counts per time window and per burst of activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.operators.ordering import MAX_ROWS, find_hot_keys, look_back, running_total


def _measures() -> list[Column]:
    return [
        F.count("*").alias("readings"),
        F.count_if(F.col("anomaly") == 1).alias("anomalies"),
    ]


def tumbling_counts(
    readings: DataFrame, width: str, keys: list[str] | None = None, ts: str = "timestamp"
) -> DataFrame:
    """Readings and anomalies per fixed window and key; batch or stream."""
    window = F.window(ts, width)
    counts = readings.groupBy(window.alias("_w"), *(keys or [])).agg(*_measures())
    return _flat(counts, keys)


def sliding_counts(
    readings: DataFrame,
    width: str,
    slide: str,
    keys: list[str] | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """The same over overlapping windows starting every ``slide``."""
    window = F.window(ts, width, slide)
    counts = readings.groupBy(window.alias("_w"), *(keys or [])).agg(*_measures())
    return _flat(counts, keys)


def stream_session_counts(
    readings: DataFrame, gap: str, keys: list[str], ts: str = "timestamp"
) -> DataFrame:
    """Readings and anomalies per burst, as Spark's own session windows."""
    counts = readings.groupBy(F.session_window(ts, gap).alias("_w"), *keys).agg(*_measures())
    return _flat(counts, keys)


def _flat(counts: DataFrame, keys: list[str] | None) -> DataFrame:
    return counts.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *(keys or []),
        "readings",
        "anomalies",
    )


def session_counts(
    readings: DataFrame,
    gap_seconds: int,
    keys: list[str],
    ts: str = "timestamp",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Batch form of the same: a burst ends when nothing follows within the gap.

    Spark's session windows sort all rows of a key in one task; this cuts hot keys into
    chunks after merging rows of equal time.
    """
    gap = F.expr(f"INTERVAL '{int(gap_seconds)}' SECOND")
    per_time = readings.groupBy(*keys, ts).agg(*_measures())
    hot = find_hot_keys(readings, keys, max_rows)
    spaced = look_back(per_time, keys, [ts], 1, lambda w: {"_before": F.lag(ts).over(w)}, hot)
    starts = F.coalesce(F.col(ts) > F.col("_before") + gap, F.lit(True))
    marked = spaced.withColumn("_starts", starts.cast("long")).drop("_before")
    numbered = running_total(marked, keys, [ts], "_starts", "_session", hot)
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            F.min(ts).alias("window_start"),
            (F.max(ts) + gap).alias("window_end"),
            F.sum("readings").alias("readings"),
            F.sum("anomalies").alias("anomalies"),
        )
        .drop("_session")
    )
