"""Random rows of an exact number, reproducible and without a global sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlens.functions.hashing import shuffle_key
from meterlens.operators.filters import non_null_readings

# Rows are first counted by this many hex digits of their key (16**5 buckets).
BUCKET_DIGITS = 5


def _cuts(keyed: DataFrame, quota: Callable[[Column], Column]) -> DataFrame:
    """Per stratum the key of the last row within its quota.

    A histogram over key prefixes tells in which bucket the quota ends; only that bucket,
    a millionth of the rows, is ordered.
    """
    stratum = Window.partitionBy("_stratum")
    bucket = F.substring("_key", 1, BUCKET_DIGITS)
    histogram = keyed.groupBy("_stratum", bucket.alias("_bucket")).agg(
        F.count("*").alias("_c")
    )
    ranked = histogram.select(
        "_stratum",
        "_bucket",
        "_c",
        (F.sum("_c").over(stratum.orderBy("_bucket")) - F.col("_c")).alias("_start"),
        quota(F.sum("_c").over(stratum)).alias("_quota"),
    )
    last = ranked.where(
        (F.col("_quota") > F.col("_start")) & (F.col("_quota") <= F.col("_start") + F.col("_c"))
    ).select("_stratum", "_bucket", (F.col("_quota") - F.col("_start")).alias("_take"))
    within = Window.partitionBy("_stratum").orderBy("_key")
    return (
        keyed.withColumn("_bucket", bucket)
        .join(F.broadcast(last), ["_stratum", "_bucket"])
        .withColumn("_rn", F.row_number().over(within))
        .where(F.col("_rn") <= F.col("_take"))
        .groupBy("_stratum")
        .agg(F.max("_key").alias("_cut"))
    )


def _keyed(rows: DataFrame, stratum: Column, seed: int) -> DataFrame:
    return rows.withColumns({"_stratum": stratum, "_key": shuffle_key("row_id", seed)})


def sample_readings(readings: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly n random non-null readings, or all if there are fewer."""
    keyed = _keyed(non_null_readings(readings), F.lit(0), seed)
    cuts = _cuts(
        keyed.select("_stratum", "_key"), lambda total: F.least(total, F.lit(n).cast("long"))
    )
    return (
        keyed.join(F.broadcast(cuts), "_stratum")
        .where(F.col("_key") <= F.col("_cut"))
        .drop("_stratum", "_key", "_cut")
    )


def sample_fraction(readings: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the non-null readings, in one narrow pass."""
    return non_null_readings(readings).sample(fraction=fraction, seed=seed)


def stratified_sample(
    rows: DataFrame, n: int, label: str = "anomaly", seed: int = 42
) -> DataFrame:
    """At most ``n`` rows, of every label its share of them, rounded down; all if there are fewer.

    A null label is a label of its own.
    """
    keyed = _keyed(rows, F.coalesce(F.col(label).cast("string"), F.lit("")), seed)
    total = rows.agg(F.count("*").alias("_total")).first()[0]
    if total <= n:
        return rows
    cuts = _cuts(
        keyed.select("_stratum", "_key"),
        lambda size: F.floor(size * F.lit(n / total)).cast("long"),
    )
    # One row per label.
    return (
        keyed.join(F.broadcast(cuts), "_stratum")
        .where(F.col("_key") <= F.col("_cut"))
        .drop("_stratum", "_key", "_cut")
    )


def stratified_split(
    rows: DataFrame, label: str = "anomaly", test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: of every label exactly the rounded share, chosen at random.

    There is one cut per label, so broadcasting them is bounded.
    """
    keyed = _keyed(rows, F.col(label), seed)
    cuts = _cuts(
        keyed.select("_stratum", "_key"),
        lambda total: F.bround(total * F.lit(test_share)).cast("long"),
    )
    chosen = F.coalesce(F.col("_key") <= F.col("_cut"), F.lit(False))
    return (
        keyed.join(F.broadcast(cuts), "_stratum", "left")
        .withColumn("is_test", chosen)
        .drop("_stratum", "_key", "_cut")
    )
