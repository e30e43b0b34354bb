"""Approximate counts of ones in a sliding window, in logarithmic memory per key.

Ones are kept in buckets of 1, 2, 4, … with the time of their newest one. A third bucket
of a size makes the two oldest of it one of double size; a bucket older than the window is
dropped after every bit, zeros included.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from meterlens.functions.arrival import micros
from meterlens.operators.ordering import (
    CHUNK,
    MAX_ROWS,
    HotKeys,
    find_hot_keys,
    look_back,
    split_hot_keys,
)
from meterlens.storage import durable

# Fixed value: bytes counted per bucket.
BUCKET_BYTES = 16

BUCKETS = T.ArrayType(
    T.StructType([T.StructField("at", T.LongType()), T.StructField("size", T.LongType())])
)


def push(levels: list[list[int]], at: int, ones: int = 1) -> None:
    """Add ones of one time. ``levels[j]`` holds the times of the 2**j buckets, oldest first.

    All ones are added level by level: of n buckets of a size the oldest pairs move up,
    leaving one bucket when n is odd and two when it is even.
    """
    older: list[int] = []
    level = 0
    while older or ones:
        if level == len(levels):
            levels.append([])
        waiting = levels[level] + older
        total = len(waiting) + ones
        keep = total if total <= 2 else 2 - total % 2
        moved = total - keep
        stay = waiting[moved:]
        levels[level] = stay + [at] * (keep - len(stay))
        older = waiting[1:moved:2]
        ones = moved // 2 - len(older)
        level += 1


def expire(levels: list[list[int]], cutoff: int) -> None:
    """Drop buckets older than the cutoff; larger ones are always older."""
    while levels:
        oldest = levels[-1]
        while oldest and oldest[0] < cutoff:
            oldest.pop(0)
        if oldest:
            return
        levels.pop()


def advance(levels: list[list[int]], at: int, ones: int, clock: int, window: int) -> None:
    """Pass the bits of one time; ``clock`` is the time of the bit before the first one."""
    expire(levels, clock - window)
    push(levels, at)
    expire(levels, at - window)
    push(levels, at, ones - 1)


def to_buckets(levels: list[list[int]]) -> list[dict]:
    """Buckets, newest first."""
    return [
        {"at": int(at), "size": 1 << j}
        for j, times in enumerate(levels)
        for at in reversed(times)
    ]


def from_buckets(buckets: list) -> list[list[int]]:
    """The times per level of buckets listed newest first."""
    levels: list[list[int]] = []
    for bucket in reversed(buckets):
        level = int(bucket["size"]).bit_length() - 1
        while len(levels) <= level:
            levels.append([])
        levels[level].append(int(bucket["at"]))
    return levels


def estimates(buckets: Column) -> dict[str, Column]:
    """Statistics of a bucket list.

    ``estimate_per_size`` halves the oldest bucket of every size, ``estimate_classic`` only
    the oldest of all, which is the smaller error.
    """
    sizes = F.transform(buckets, lambda b: b["size"])
    zero = F.lit(0).cast("long")

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda a, s: a + s)

    def lost(size: Column) -> Column:
        return size - F.shiftright(size, 1)

    largest = F.coalesce(F.array_max(sizes), zero)
    count = F.size(buckets)
    return {
        "estimate_per_size": total(sizes) - total(F.transform(F.array_distinct(sizes), lost)),
        "estimate_classic": total(sizes) - lost(largest),
        "bucket_count": count,
        "memory_bytes": count * BUCKET_BYTES,
    }


def fold_buckets(
    ones: DataFrame, keys: list[str], window: int, state: DataFrame | None = None
) -> DataFrame:
    """(keys, _buckets) after the ``ones`` (keys, _at, _ones, _clock) of each key, in order.

    ``state`` gives the buckets a key starts with; keys with a state but no ones keep it.
    """
    columns = [*keys, "_at", "_ones", "_clock", "_buckets"]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, levels = None, []
        for batch in batches:
            done = []
            for *row_key, at, count, clock, start in zip(*[batch[c].tolist() for c in columns]):
                if row_key != key:
                    if key is not None:
                        done.append([*key, to_buckets(levels)])
                    key, levels = row_key, []
                if start is not None:
                    levels = from_buckets(start)
                else:
                    advance(levels, int(at), int(count), int(clock), window)
            if done:
                yield pd.DataFrame(done, columns=[*keys, "_buckets"])
        if key is not None:
            yield pd.DataFrame([[*key, to_buckets(levels)]], columns=[*keys, "_buckets"])

    schema = T.StructType([
        *[ones.schema[k] for k in keys], T.StructField("_buckets", BUCKETS)
    ])
    rows = ones.withColumn("_buckets", F.lit(None).cast(BUCKETS))
    if state is not None:  # the least time: a state comes first
        zero = F.lit(0).cast("long")
        rows = rows.unionByName(state.select(
            *keys, F.lit(-(1 << 62)).alias("_at"), zero.alias("_ones"), zero.alias("_clock"), "_buckets"
        ))
    return (
        rows.repartition(*keys).sortWithinPartitions(*keys, "_at").mapInPandas(fold, schema)
    )


def fold_chunks(chunks: DataFrame, keys: list[str], window: int, hot: HotKeys) -> DataFrame:
    """The same for hot keys, whose rows are numbered in consecutive chunks.

    A round folds the next chunk of every key and stores the buckets for the round after it; a task
    sees one chunk of a key, and rounds are as many as the chunks of the hottest key.
    """
    turn = Window.partitionBy(*keys).orderBy(CHUNK)
    # One row per chunk and key in it: fewer than chunks and hot keys together.
    turns = durable(chunks.select(*keys, CHUNK).distinct().withColumn(
        "_round", F.row_number().over(turn)))
    rounds = turns.agg(F.max("_round")).first()[0] or 0
    state = None
    for number in range(1, rounds + 1):
        due = turns.where(F.col("_round") == number).select(*keys, CHUNK)
        ones = chunks.join(F.broadcast(due), [*keys, CHUNK], "left_semi").drop(CHUNK)
        state = durable(fold_buckets(ones, keys, window, state))
    if state is None:
        return fold_buckets(chunks.drop(CHUNK), keys, window)
    return state


def dgim_state(
    bits: DataFrame,
    keys: list[str],
    window_seconds: int,
    ts: str = "timestamp",
    bit: str = "bit",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Per key: bits seen, time of the last one, and the live buckets at that time.

    Bits of equal key and time (ordered by ``row_id``) are merged before anything is
    shuffled by key. A pause longer than the window empties all buckets, so only what
    follows a key's last such pause is folded. Each task reads its keys in order, a batch of
    rows at a time, and holds the buckets of one key only. A key with more than ``max_rows`` bits is
    folded a chunk of its time after the other, the buckets being handed on.
    """
    window = int(window_seconds) * 1_000_000
    per_time = bits.groupBy(*keys, ts).agg(
        F.count("*").alias("_bits"),
        F.count_if(F.col(bit) == 1).alias("_ones"),
        F.min_by(bit, "row_id").alias("_first"),
    )
    hot = find_hot_keys(bits, keys, max_rows)
    timed = look_back(
        per_time, keys, [ts], 1, lambda w: {"_before": F.lag(ts).over(w)}, hot
    ).withColumns({"_at": micros(ts), "_before": micros("_before")})
    clock = F.when(F.col("_first") == 0, F.col("_at")).otherwise(
        F.coalesce("_before", "_at")
    )
    ones = timed.where(F.col("_ones") > 0).select(
        *keys, "_at", "_ones", clock.alias("_clock")
    )
    spaced = look_back(
        ones, keys, ["_at"], 1, lambda w: {"_previous": F.lag("_at").over(w)}, hot
    )
    restart = F.coalesce(F.col("_at") - F.col("_previous") > window, F.lit(True))
    spaced = spaced.withColumn("_restart", restart)
    starts = spaced.where("_restart").groupBy(*keys).agg(F.max("_at").alias("_start"))
    recent = spaced.join(starts, keys).where(F.col("_at") >= F.col("_start"))

    recent = recent.select(*keys, "_at", "_ones", "_clock")
    if hot is None:
        folded = fold_buckets(recent, keys, window)
    else:
        cold, chunks = split_hot_keys(recent, keys, ["_at"], hot)
        folded = fold_buckets(cold, keys, window).unionByName(
            fold_chunks(chunks, keys, window, hot)
        )
    totals = per_time.groupBy(*keys).agg(
        F.sum("_bits").alias("total_bits"), F.max(ts).alias("last_time")
    )
    cutoff = micros("last_time") - window
    live = F.filter(
        F.coalesce("_buckets", F.array().cast(BUCKETS)), lambda b: b["at"] >= cutoff
    )
    return totals.join(folded, keys, "left").select(
        *keys, "total_bits", "last_time", live.alias("buckets")
    )


def dgim_count(
    bits: DataFrame,
    keys: list[str],
    window_seconds: int,
    ts: str = "timestamp",
    bit: str = "bit",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Estimated ones in the window ending at each key's last bit."""
    state = dgim_state(bits, keys, window_seconds, ts, bit, max_rows)
    return state.withColumns(estimates(F.col("buckets"))).drop("buckets")


def closed_form(ones: Column) -> dict[str, Column]:
    """The same statistics after ``ones`` ones of which none has expired.

    Bucket counts per size are then the digits 1 and 2 of the number in bijective base 2:
    with L = floor(log2(n + 1)) sizes, the digits exceed one by the bits of n + 1 - 2**L.
    """
    sizes = F.length(F.bin(ones + 1)) - 1
    above = F.call_function("shiftleft", F.lit(1).cast("long"), sizes)
    rest = ones + 1 - above
    largest = F.shiftright(above, 1)
    halves = F.shiftright(largest, 1)
    count = sizes + F.bit_count(rest)
    return {
        "estimate_per_size": F.when(ones > 0, rest + largest - 1).otherwise(F.lit(0)).cast("long"),
        "estimate_classic": ones - (largest - halves),
        "bucket_count": count.cast("long"),
        "memory_bytes": (count * BUCKET_BYTES).cast("long"),
    }


def dgim_closed_form(bits: DataFrame, keys: list[str], bit: str = "bit") -> DataFrame:
    """Per key, the count of ones and the statistics of a window that never expires."""
    counted = bits.groupBy(*keys).agg(F.count_if(F.col(bit) == 1).alias("ones"))
    return counted.withColumns(closed_form(F.col("ones")))
