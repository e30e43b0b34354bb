"""Ordered computations over keys of which some are far too large for one task.

A window partitioned by building puts all readings of a building into one task. Here a
key above ``max_rows`` is cut into chunks, consecutive in its order: Spark range-partitions
the hot rows on (key, order), which also separates rows of equal time, and the partition
number, once written to the shared folder, is a plain column. Frames reaching back over a
chunk's start get the rows they need from the chunks before; running totals get the sum of
the chunks before. Both are exact. With no hot key the plan is an ordinary window.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from meterlens.storage import durable

MAX_ROWS = 2_000_000
CHUNK = "_chunk"


class HotKeys(NamedTuple):
    """Keys above the limit (at most ``rows / max_rows`` of them) and their chunks."""

    keys: DataFrame
    chunks: int


def find_hot_keys(df: DataFrame, keys: list[str], max_rows: int = MAX_ROWS) -> HotKeys | None:
    """The keys with more than ``max_rows`` rows, None if there are none.

    Keys must not be null. The result also serves tables with fewer rows per key.
    """
    return hot_keys_of(df.groupBy(*keys).agg(F.count("*").alias("_n")), keys, "_n", max_rows)


def hot_keys_of(
    counted: DataFrame, keys: list[str], count: str, max_rows: int = MAX_ROWS
) -> HotKeys | None:
    """The same from a table of rows per key, where one is at hand."""
    counts = counted.select(*keys, F.col(count).alias("_n")).where(F.col("_n") > max_rows)
    rows = counts.agg(F.sum("_n")).first()[0]
    if rows is None:
        return None
    return HotKeys(durable(counts.select(*keys)), max(2, math.ceil(rows / max_rows)))


def split_hot_keys(
    df: DataFrame, keys: list[str], order: list[str], hot: HotKeys
) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, chunked rows of hot keys); ``order`` is unique within a key."""
    cold = df.join(hot.keys, keys, "left_anti")
    chunks = (
        df.join(hot.keys, keys, "left_semi")
        .repartitionByRange(hot.chunks, *keys, *order)
        .withColumn(CHUNK, F.spark_partition_id())
    )
    return cold, durable(chunks, CHUNK)


def look_back(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rows: int,
    outputs: Callable[[WindowSpec], dict[str, Column]],
    hot_keys: HotKeys | None,
) -> DataFrame:
    """Add columns whose frames reach back at most ``rows`` rows within a key.

    ``outputs`` gets the ordered window and returns the columns to add.
    """
    plain = outputs(Window.partitionBy(*keys).orderBy(*order))
    if hot_keys is None:
        return df.withColumns(plain)
    cold, hot = split_hot_keys(df, keys, order, hot_keys)

    in_chunk = Window.partitionBy(*keys, CHUNK)
    last = in_chunk.orderBy(*[F.desc(c) for c in order])
    rest = [c for c in df.columns if c not in keys]
    ordered = order + [c for c in rest if c not in order]
    tails = (
        hot.withColumn("_rn", F.row_number().over(last))
        .where(F.col("_rn") <= rows)
        .groupBy(*keys, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct(*ordered))).alias("_tail"))
    )
    # Every chunk before holds at least one row, so `rows` chunks suffice.
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(-rows, -1)
    joined = F.flatten(F.collect_list("_tail").over(before))
    size = F.size(joined)
    carried = F.when(size > rows, F.slice(joined, size - rows + 1, rows)).otherwise(joined)
    halo = (
        tails.select(*keys, CHUNK, carried.alias("_carried"))
        .select(*keys, CHUNK, F.explode("_carried").alias("_row"))
        .select(*keys, CHUNK, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .withColumn("_halo", F.lit(True))
    )
    with_halo = hot.withColumn("_halo", F.lit(False)).unionByName(halo)
    chunked = (
        with_halo.withColumns(outputs(in_chunk.orderBy(*order)))
        .where(~F.col("_halo"))
        .drop("_halo", CHUNK)
    )
    return cold.withColumns(plain).unionByName(chunked)


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    hot_keys: HotKeys | None,
) -> DataFrame:
    """Add the sum of ``value`` over the rows up to and including each row of a key."""
    def so_far(*partition: str) -> Column:
        frame = Window.partitionBy(*partition).orderBy(*order)
        return F.sum(value).over(frame.rowsBetween(Window.unboundedPreceding, 0))

    if hot_keys is None:
        return df.withColumn(name, so_far(*keys))
    cold, hot = split_hot_keys(df, keys, order, hot_keys)
    before = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        hot.groupBy(*keys, CHUNK)
        .agg(F.sum(value).alias("_sum"))
        .select(*keys, CHUNK, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    chunked = (
        hot.withColumn(name, so_far(*keys, CHUNK))
        .join(offsets, [*keys, CHUNK])
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop("_offset", CHUNK)
    )
    return cold.withColumn(name, so_far(*keys)).unionByName(chunked)
