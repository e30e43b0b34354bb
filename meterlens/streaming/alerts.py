"""Streams of alerts: de-duplication and window counts with state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meterlens.functions.arrival import micros
from meterlens.operators.alerts import AlertState, process_alerts
from meterlens.operators.bloom import bloom_build, bloom_dedup
from meterlens.operators.dgim import BUCKETS, advance, estimates, expire, to_buckets
from meterlens.sources.tables import batch_name, write_batch
from meterlens.streaming.readings import batch_stats

#: The set bits of a filter, by the batch that set them.
BITS = T.StructType([T.StructField("bit", T.LongType()), T.StructField("version", T.LongType())])


def known_bits(batch: DataFrame, batch_id: int, state_path: str) -> DataFrame | None:
    """The bits set by earlier batches: each is stored once, by the batch that set it.

    Of a batch that runs again its own bits are not read.
    """
    if batch_id == 0:
        return None
    stored = batch.sparkSession.read.schema(BITS).parquet(state_path)
    return stored.where(F.col("version") < batch_id).select("bit")


def bloom_dedup_stream(
    alerts: DataFrame,
    item: Column,
    capacity: int,
    error_rate: float,
    state_path: str,
    output_path: str,
    checkpoint: str,
    stats_path: str | None = None,
) -> DataStreamWriter:
    """Pass a stream through one Bloom filter, a micro-batch at a time.

    The filter's set bits are a table of at most as many rows as the filter has bits, to which
    a batch adds those it sets first. Each batch uses the bits of those before it and writes
    its own output and bits by batch number, so a batch run again after a failure replaces both.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(checkpoint, batch_id)
        known = known_bits(batch, batch_id, state_path)
        marked = bloom_dedup(batch, item, capacity, error_rate, known=known)
        write_batch(marked, output_path, name)
        bits = bloom_build(batch, item, capacity, error_rate)
        if known is not None:
            bits = bits.join(known, "bit", "left_anti")
        bits.write.mode("overwrite").parquet(f"{state_path}/version={batch_id}")
        if stats_path is not None:
            done = batch.sparkSession.read.schema(marked.schema).parquet(f"{output_path}/batch={name}")
            batch_stats(done, batch_id, stats_path, name)

    return alerts.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)


def process_alerts_stream(
    alerts: DataFrame,
    capacity: int,
    error_rate: float,
    window_seconds: int,
    state_path: str,
    output_path: str,
    checkpoint: str,
    stats_path: str | None = None,
) -> DataStreamWriter:
    """``process_alerts`` a micro-batch at a time.

    If batches follow each other in time, the output is that of one run over all alerts. The
    state is stored by batch number: the bits a batch set first, and the fresh alerts of the
    window before its end.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        spark, state = batch.sparkSession, None
        known = known_bits(batch, batch_id, f"{state_path}/bits")
        if known is not None:
            state = AlertState(known, spark.read.parquet(f"{state_path}/recent/version={batch_id - 1}"))
        processed, after = process_alerts(batch, capacity, error_rate, window_seconds, state)
        name = batch_name(checkpoint, batch_id)
        write_batch(processed, output_path, name)
        after.bits.write.mode("overwrite").parquet(f"{state_path}/bits/version={batch_id}")
        after.recent.write.mode("overwrite").parquet(f"{state_path}/recent/version={batch_id}")
        if stats_path is not None:
            done = spark.read.schema(processed.schema).parquet(f"{output_path}/batch={name}")
            batch_stats(done, batch_id, stats_path, name)

    return alerts.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)


#: Folded: bucket times and their levels, time of the last bit, bits. Waiting: per time the
#: bits, the ones, the least row id and its bit.
STATE = T.StructType([
    T.StructField("times", T.ArrayType(T.LongType())),
    T.StructField("levels", T.ArrayType(T.IntegerType())),
    T.StructField("last", T.LongType()),
    T.StructField("total", T.LongType()),
    *[T.StructField(f"waiting_{name}", T.ArrayType(T.LongType()))
      for name in ("at", "bits", "ones", "row", "first")],
])


def merge_waiting(waiting: dict[int, list[int]], rows: pd.DataFrame) -> None:
    """Add rows (_at, row_id, _bit) to the bits waiting per time: [bits, ones, row, first bit]."""
    for at, row, bit in zip(rows["_at"].tolist(), rows["row_id"].tolist(), rows["_bit"].tolist()):
        entry = waiting.setdefault(at, [0, 0, row, bit])
        entry[0] += 1
        entry[1] += bit == 1
        if row < entry[2]:
            entry[2:] = [row, bit]


def dgim_stream(
    bits: DataFrame, key: str, window_seconds: int, delay: str,
    ts: str = "timestamp", bit: str = "bit",
) -> DataFrame:
    """Estimated ones in the window of each key, each time the watermark passes bits of it.

    Bits later than ``delay`` are dropped. The others wait until the watermark has passed
    their time and are then folded in the order of time and row id, so the result is that of
    one pass over the bits that were not late, however they arrived. What waits is kept per time, not
    per bit, and rows of a micro-batch are merged into it an Arrow batch at a time. A key
    without a bit for longer than a window is forgotten once the watermark has passed it; so
    ``total_bits`` counts from a key's last pause of that length on.
    """
    window = int(window_seconds) * 1_000_000

    def update(
        group: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        levels: list[list[int]] = []
        waiting: dict[int, list[int]] = {}
        last, total = None, 0
        if state.exists:
            times, level_numbers, last, total, *columns = state.get
            for at, level in zip(times, level_numbers):
                while len(levels) <= level:
                    levels.append([])
                levels[level].append(at)
            waiting = {at: list(rest) for at, *rest in zip(*columns)}
        passed = state.getCurrentWatermarkMs() * 1000
        if not state.hasTimedOut:
            for rows in batches:
                merge_waiting(waiting, rows[rows["_at"] >= passed])
        ready = sorted(at for at in waiting if at < passed)
        for at in ready:
            count, ones, _, first = waiting.pop(at)
            # After a pause a key starts anew, whether or not it was forgotten in time.
            total = count if last is None or at - last > window else total + count
            if ones:
                # The clock before the first one: a zero of the same time has moved it.
                advance(levels, at, ones, at if first == 0 or last is None else last, window)
            last = at
            expire(levels, last - window)
        if ready:
            yield pd.DataFrame({
                key: [group[0]], "total_bits": [total], "last_at": [last],
                "buckets": [to_buckets(levels)],
            })
        if not waiting and (last is None or last + window < passed):
            if state.exists:
                state.remove()
            return
        flat = [(at, level) for level, times in enumerate(levels) for at in times]
        columns = [list(c) for c in zip(*[(at, *rest) for at, rest in sorted(waiting.items())])]
        state.update((
            [a for a, _ in flat], [v for _, v in flat], last, total, *(columns or [[]] * 5)
        ))
        due = min(waiting) if waiting else last + window
        state.setTimeoutTimestamp(max(due, passed) // 1000 + 1)

    output = T.StructType([
        bits.schema[key],
        T.StructField("total_bits", T.LongType()),
        T.StructField("last_at", T.LongType()),
        T.StructField("buckets", BUCKETS),
    ])
    timed = bits.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    folded = (
        timed.select(key, "row_id", "_ts", micros(ts).alias("_at"), F.col(bit).cast("long").alias("_bit"))
        .groupBy(key)
        .applyInPandasWithState(update, output, STATE, "update", GroupStateTimeout.EventTimeTimeout)
    )
    return folded.withColumns(estimates(F.col("buckets"))).drop("buckets")
