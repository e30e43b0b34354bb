"""Exact counts in trailing windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.operators.ordering import MAX_ROWS, find_hot_keys, running_total


def trailing_count(
    bits: DataFrame,
    keys: list[str],
    window_seconds: int,
    ts: str = "timestamp",
    bit: str = "bit",
    max_rows: int = MAX_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """Ones in [t - window, t] for every key and time t of ``bits``, both ends included.

    With ``weight`` a row stands for that column's number of ones.

    The count is a difference of two running totals: up to t, and before t - window. So
    each time becomes two points on one line per key, instead of a frame that would reread
    the whole window for every row. Rows of equal key and time are merged first.
    """
    ones = F.count_if(F.col(bit) == 1) if weight is None else F.sum(weight)
    per_time = bits.groupBy(*keys, ts).agg(ones.alias("_ones"))
    length = F.expr(f"INTERVAL '{int(window_seconds)}' SECOND")
    # At equal times the start of a window (0) precedes the ones of that time (1).
    opening = F.struct(
        (F.col(ts) - length).alias("_at"), F.lit(0).alias("_kind"),
        F.lit(0).cast("long").alias("_delta"),
    )
    closing = F.struct(
        F.col(ts).alias("_at"), F.lit(1).alias("_kind"), F.col("_ones").alias("_delta")
    )
    points = per_time.select(*keys, ts, F.explode(F.array(opening, closing)).alias("_p"))
    points = points.select(*keys, ts, "_p._at", "_p._kind", "_p._delta")
    hot = find_hot_keys(bits, keys, max_rows)
    counted = running_total(points, keys, ["_at", "_kind", ts], "_delta", "_total", hot)
    before = F.max(F.when(F.col("_kind") == 0, F.col("_total")))
    until = F.max(F.when(F.col("_kind") == 1, F.col("_total")))
    return counted.groupBy(*keys, ts).agg((until - before).alias("ones_in_window"))
