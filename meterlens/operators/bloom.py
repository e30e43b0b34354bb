"""Bloom filters as tables of set bits, and de-duplication through them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.functions.arrival import arrival
from meterlens.functions.hashing import bloom_position, bloom_size
from meterlens.functions.numeric import fixed_text, percent

# A table of set bits has at most as many rows as the filter has bits; up to this many
# (about 40 MB) it is broadcast and looked up in place. Beyond, every distinct item meets its
# bits in one join, however many hashes there are.
BROADCAST_BITS = 1_000_000


def item_id(*parts: Column) -> Column:
    """Parts of an item joined by underscores."""
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def reading_item() -> Column:
    """Building and reading to 2 places, without the time: equal readings collide."""
    return item_id(F.col("building_id"), fixed_text(F.col("meter_reading"), 2))


def alert_item(score: str = "anomaly_score") -> Column:
    """Building, time and score to 3 places."""
    time = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return item_id(F.col("building_id"), time, fixed_text(F.col(score), 3))


def _placed(items: DataFrame, capacity: int, error_rate: float) -> DataFrame:
    """One row per item (``_item``) and hash, with the ``bit``.

    Rows are multiplied before hashing: one hash per generated loop compiles and runs
    faster than all of them side by side.
    """
    bits, hashes = bloom_size(capacity, error_rate)
    numbers = F.array(*[F.lit(i) for i in range(hashes)])
    spread = items.withColumn("_number", F.explode(numbers))
    position = bloom_position("_item", "_number", bits)
    return spread.withColumn("bit", position).drop("_item", "_number")


def bloom_build(items: DataFrame, item: Column, capacity: int, error_rate: float) -> DataFrame:
    """The set bits of a filter holding all items."""
    return _placed(items.select(item.alias("_item")), capacity, error_rate).select("bit").distinct()


def bloom_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """The filter holding the items of both."""
    return left.union(right).distinct()


def bloom_packed(bits: DataFrame) -> DataFrame:
    """The set bits as Spark bitmaps, one row per bucket of 32,768 bits."""
    position = F.col("bit") + 1
    return bits.groupBy(F.bitmap_bucket_number(position).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bitmap")
    )


def _last_set(
    rows: DataFrame, table: DataFrame, value: str, capacity: int, error_rate: float
) -> DataFrame:
    """Add ``_last``, the greatest ``value`` of the bits of ``_item``; null if one isn't set.

    ``table`` has (bit, ``value``). A small one is broadcast. A large one is joined with the
    bits of each distinct item once; the items found then go back to their rows.
    """
    bits, hashes = bloom_size(capacity, error_rate)
    if bits <= BROADCAST_BITS:
        for i in range(hashes):
            side = table.select(F.col("bit").alias("_bit"), F.col(value).alias(f"_v{i}"))
            rows = rows.withColumn("_bit", bloom_position("_item", i, bits)).join(
                F.broadcast(side), "_bit", "left"
            ).drop("_bit")
        values = [F.col(f"_v{i}") for i in range(hashes)]
        every = F.lit(True)
        for v in values:
            every = every & v.isNotNull()
        return rows.withColumn("_last", F.when(every, F.greatest(*values) if hashes > 1 else values[0]))
    items = rows.select("_item").distinct()
    placed = _placed(items.withColumn("_key", F.col("_item")), capacity, error_rate)
    # An item sets a bit once, whatever number of its hashes fall on it.
    sought = placed.groupBy("_key", "bit").agg(F.lit(1).alias("_one"))
    found = (
        sought.join(table.select("bit", F.col(value).alias("_value")), "bit", "left")
        .groupBy("_key")
        .agg(F.count("*").alias("_n"), F.count("_value").alias("_set"), F.max("_value").alias("_last"))
        .where("_n = _set")
        .select("_key", "_last")
    )
    return rows.join(found, rows["_item"].eqNullSafe(found["_key"]), "left").drop("_key")


def bloom_probe(
    rows: DataFrame, item: Column, set_bits: DataFrame, capacity: int, error_rate: float
) -> DataFrame:
    """Add ``maybe_present``: all bits of the row's item are set."""
    marked = set_bits.select("bit", F.lit(1).alias("_set"))
    found = _last_set(rows.withColumn("_item", item), marked, "_set", capacity, error_rate)
    return found.select(*rows.columns, F.col("_last").isNotNull().alias("maybe_present"))


def first_set_bits(
    rows: DataFrame, item: Column, order: Column, capacity: int, error_rate: float
) -> DataFrame:
    """The set bits of the filter and the order number of the row that set each first."""
    ordered = rows.select(order.alias("first_set"), item.alias("_item"))
    placed = _placed(ordered, capacity, error_rate)
    return placed.groupBy("bit").agg(F.min("first_set").alias("first_set"))


def bloom_dedup(
    rows: DataFrame,
    item: Column,
    capacity: int,
    error_rate: float,
    order: Column | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Add ``item`` and ``is_duplicate``, as if rows passed the filter one by one.

    One by one, a row is a duplicate if earlier rows have set all its bits, and sets none
    then. So the rows that set bits first are known without running through them: a bit's
    first row is the least of all rows with that bit, and a row is a duplicate when every
    one of its bits was set before it. ``known`` holds bits set before the first row.
    """
    order = arrival() if order is None else order
    table = first_set_bits(rows, item, order, capacity, error_rate)
    if known is not None:
        earlier = known.select("bit", F.lit(-1).cast("decimal(38,0)").alias("first_set"))
        table = table.unionByName(earlier).groupBy("bit").agg(
            F.min("first_set").alias("first_set")
        )
    named = rows.withColumns({"_item": item, "_order": order})
    found = _last_set(named, table, "first_set", capacity, error_rate)
    duplicate = F.coalesce(F.col("_last") < F.col("_order"), F.lit(False))
    return found.select(*rows.columns, F.col("_item").alias("item"), duplicate.alias("is_duplicate"))


def bloom_stats(deduplicated: DataFrame, capacity: int, error_rate: float) -> DataFrame:
    """One row of filter statistics after a de-duplication run."""
    bits, hashes = bloom_size(capacity, error_rate)
    fresh = deduplicated.agg(
        F.count("*").alias("total_processed"),
        F.count_if("is_duplicate").alias("duplicates_detected"),
        F.count_if(~F.col("is_duplicate")).alias("items_added"),
    )
    set_bits = bloom_build(deduplicated, F.col("item"), capacity, error_rate).agg(
        F.count("*").alias("bits_set")
    )
    still_zero = F.pow(F.lit(1 - 1 / bits), hashes * F.col("items_added"))
    rate = F.when(F.col("items_added") > 0, F.pow(1 - still_zero, F.lit(hashes)))
    return fresh.crossJoin(F.broadcast(set_bits)).select(
        "total_processed",
        "duplicates_detected",
        percent(F.col("duplicates_detected"), F.col("total_processed")).alias("duplicate_rate"),
        F.lit(capacity).cast("long").alias("capacity"),
        "items_added",
        F.lit(bits).cast("long").alias("bit_array_size"),
        "bits_set",
        (F.col("bits_set") / bits).alias("utilization"),
        F.coalesce(rate, F.lit(0.0)).alias("estimated_fpr"),
        F.lit(hashes).alias("hash_functions"),
    )


def exact_dedup(rows: DataFrame, item: Column, order: Column | None = None) -> DataFrame:
    """The first row of every distinct item, and how many copies there are."""
    order = arrival() if order is None else order
    return rows.groupBy(item.alias("item")).agg(
        F.min_by("row_id", order).alias("row_id"),
        F.min_by("timestamp", order).alias("timestamp"),
        F.count("*").alias("copies"),
    )
