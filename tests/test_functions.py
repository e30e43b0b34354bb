from __future__ import annotations

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from meterlens.functions.arrival import arrival, micros
from meterlens.functions.hashing import bloom_position, bloom_size, shuffle_key
from meterlens.functions.numeric import (
    equal_width_bin,
    fixed_text,
    guarded_corr,
    iso_text,
    label_text,
    nan_to_null,
    percent,
    reading_context,
    severity,
    size_class,
    temperature_label,
    weekday_name,
)


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_equal_width_bins(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"))
    bins = column(df, equal_width_bin(F.col("x"), F.lit(0.0), F.lit(100.0)))
    assert [bins.count(b) for b in range(1, 6)] == [21, 20, 20, 20, 20]
    same = column(df.limit(2), equal_width_bin(F.lit(7.0), F.lit(7.0), F.lit(7.0)))
    assert same == [3, 3]
    assert column(df.limit(1), temperature_label(F.lit(3))) == ["Moderate"]


def test_size_classes(spark):
    areas = [0.0, 10000.0, 10001.0, 50000.0, 100000.0, 100001.0, None]
    df = spark.createDataFrame([(a,) for a in areas], "a double")
    expected = [None, "Small", "Medium", "Medium", "Large", "Very Large", None]
    assert column(df, size_class(F.col("a"))) == expected


def test_classes_and_texts(spark):
    df = spark.range(1)
    assert column(df, severity(F.lit(4.5))) == ["HIGH"]
    assert column(df, severity(F.lit(3.5))) == ["MEDIUM"]
    assert column(df, severity(F.lit(3.0))) == ["LOW"]
    assert column(df, weekday_name(F.lit(0))) == ["Mon"]
    assert column(df, weekday_name(F.lit(7))) == [None]
    assert column(df, label_text(F.lit(1))) == ["Anomaly"]
    assert column(df, nan_to_null(F.lit(float("nan")))) == [None]
    assert column(df, percent(F.lit(1), F.lit(0))) == [0.0]
    assert column(df, percent(F.lit(1), F.lit(8))) == [12.5]
    assert column(df, fixed_text(F.lit(2.5), 2)) == ["2.50"]
    stamp = F.lit("2024-01-02 03:04:05.6").cast("timestamp_ntz")
    assert column(df, iso_text(stamp)) == ["2024-01-02T03:04:05"]


def test_half_even_rounding(spark):
    rounded = column(spark.range(1), F.array(F.bround(F.lit(2.5)), F.bround(F.lit(0.125), 2)))
    assert rounded == [[2.0, 0.12]]


def test_correlation_of_constant_is_null(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("c"))
    assert column(df, guarded_corr(F.col("x"), F.col("c"))) == [None]
    assert column(df, guarded_corr(F.col("x"), -F.col("x")))[0] == pytest.approx(-1)


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 4.5), (3.0, 5.0), (100.0, None), (None, -50.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    expected = df.na.drop().stat.corr("x", "y")
    assert column(df, guarded_corr(F.col("x"), F.col("y")))[0] == pytest.approx(expected)


def test_bloom_sizes():
    assert bloom_size(10000, 0.1) == (47925, 3)
    assert bloom_size(10000, 0.01) == (95850, 6)
    assert bloom_size(1000, 0.01) == (9585, 6)


def test_bloom_positions_are_the_full_digest(spark):
    items = [f"{i}_{i * 7.25:.2f}" for i in range(300)]
    df = spark.createDataFrame([(t,) for t in items], "t string")
    for bits in (9585, 2**31 - 1, 2**31, 2**40 + 7):
        got = df.select("t", bloom_position("t", 4, bits).alias("p")).collect()
        for row in got:
            digest = hashlib.md5(f"{row.t}_4".encode()).hexdigest()
            assert row.p == int(digest, 16) % bits


def test_arrival_orders_by_time_then_row(spark):
    base = dt.datetime(2024, 3, 10, 2, 30)  # skipped in zones with a clock change
    rows = [(base + dt.timedelta(microseconds=random.randrange(10**10)), i) for i in range(50)]
    rows += [(base, 900), (base, 5), (dt.datetime(1969, 12, 31, 23), 1)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, row_id bigint")
    got = [(r.timestamp, r.row_id) for r in df.orderBy(arrival()).collect()]
    assert got == sorted(rows)
    epoch = dt.datetime(1970, 1, 1)
    for row in df.select("timestamp", micros().alias("m")).collect():
        assert row.m == (row.timestamp - epoch) // dt.timedelta(microseconds=1)


def test_shuffle_key_matches_digest(spark):
    assert column(spark.range(7, 8), shuffle_key("id", 42)) == [
        hashlib.md5(b"42_7").hexdigest()
    ]


def test_reading_context(spark, make_readings):
    df = make_readings([
        {"meter_reading": 50.0, "square_feet": 1000.0, "year_built": 2010, "weekday": 5, "hour": 8},
        {"weekday": 4, "hour": 19, "square_feet": 0.0},
    ])
    first, second = df.select(*reading_context()).collect()
    assert tuple(first) == (0.05, 15, True, True)
    assert (second.use_per_area, second.is_weekend, second.is_business_hours) == (
        None, False, False,
    )
