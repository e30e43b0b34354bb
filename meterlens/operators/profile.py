"""Table profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.operators.filters import columns_of_kind
from meterlens.operators.quantiles import distribution

# Fixed value: a column's values are listed below this many distinct ones.
LISTED_BELOW = 20


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null values, percentage of nulls. One pass over the table."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot("_rows", df.columns, "column_name", "non_null")
    types = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    nulls = F.when(F.col("_rows") > 0, (1 - F.col("non_null") / F.col("_rows")) * 100)
    return long.select(
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        "non_null",
        nulls.alias("null_percent"),
    )


def column_distributions(
    df: DataFrame, columns: list[str], key: str, quantiles: dict[str, float]
) -> DataFrame:
    """The distribution of each column's numbers, one row per column that has any.

    A row becomes one (column, value) pair per column inside a task and goes straight into
    the histogram; only counted bins are shuffled.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, key, "value"
    )
    return distribution(long, [key], "value", quantiles, few_keys=True)


def numeric_describe(df: DataFrame) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max of every numeric column.

    NaN counts as missing in all of them. A column without values has count 0.
    """
    columns = columns_of_kind(df, "numeric")
    if not columns:
        empty = ("column_name string, count bigint, mean double, std double, min double, "
                 "p25 double, p50 double, p75 double, max double")
        return df.sparkSession.createDataFrame([], empty)
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = column_distributions(df, columns, "column_name", quartiles)
    # One row per column, known to the optimizer.
    names = F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name")
    every = df.sparkSession.range(1).select(names)
    return every.join(F.broadcast(found), "column_name", "left").select(
        "column_name",
        F.coalesce("count", F.lit(0).cast("long")).alias("count"),
        "mean",
        F.col("std_samp").alias("std"),
        "min",
        *quartiles,
        "max",
    )


def categorical_profile(df: DataFrame, listed_below: int = LISTED_BELOW) -> DataFrame:
    """Distinct values of every text column; all of them are listed when fewer than ``listed_below``.

    Values are de-duplicated in a shuffle, and only those of short lists are gathered.
    """
    columns = columns_of_kind(df, "string")
    if not columns:
        empty = "column_name string, distinct_values bigint, listed array<string>"
        return df.sparkSession.createDataFrame([], empty)
    distinct = (
        df.select(*columns)
        .unpivot([], columns, "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("_c"))
    )
    sizes = distinct.groupBy("column_name").agg(F.count("*").alias("distinct_values"))
    # One row per text column.
    short = F.broadcast(sizes.where(F.col("distinct_values") < listed_below))
    listed = (
        distinct.join(short, "column_name", "left_semi")
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list("value")).alias("listed"))
    )
    return sizes.join(F.broadcast(listed), "column_name", "left").select(
        "column_name", "distinct_values", "listed")


def label_distribution(df: DataFrame) -> DataFrame:
    """Counts and percentages of the values of every column named like a label."""
    columns = [c for c in df.columns if "anomaly" in c.lower() or "label" in c.lower()]
    if not columns:
        empty = "column_name string, value string, row_count bigint, percentage double"
        return df.sparkSession.createDataFrame([], empty)
    total = df.agg(F.count("*").alias("_total"))
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("row_count"))
    )
    share = F.col("row_count") / F.col("_total") * 100
    return counts.crossJoin(F.broadcast(total)).select(
        "column_name", "value", "row_count", share.alias("percentage")
    )
