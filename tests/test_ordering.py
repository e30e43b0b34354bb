"""Hot keys cut into chunks give what plain windows give."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from meterlens.operators import sessions
from meterlens.operators.counting import trailing_count
from meterlens.operators.detectors import ensemble, moving_average
from meterlens.operators.ordering import find_hot_keys, look_back, running_total
from tests.conftest import START


def rows_with_hot_key(seed=1, n=600):
    """A third of the rows of one key, many of them at equal times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 9)
        at = START + dt.timedelta(minutes=rng.randrange(60) if key == 0 else rng.randrange(9000))
        rows.append((i, key, at, round(rng.random() * 100, 2), int(rng.random() < 0.3)))
    return rows


SCHEMA = "row_id bigint, k bigint, at timestamp_ntz, x double, bit int"


def as_sets(df):
    return sorted(map(repr, df.collect()))


def test_no_hot_keys(spark):
    df = spark.createDataFrame(rows_with_hot_key(), SCHEMA)
    assert find_hot_keys(df, ["k"], 1000) is None
    assert find_hot_keys(df, ["k"], 100).keys.collect() == [(0,)]


def test_look_back_over_chunks(spark):
    df = spark.createDataFrame(rows_with_hot_key(), SCHEMA).repartition(4)

    def outputs(window):
        frame = window.rowsBetween(-24, -1)
        return {
            "n": F.count("x").over(frame),
            "ids": F.concat_ws(",", F.collect_list(F.col("row_id").cast("string")).over(frame)),
            "before": F.lag("x").over(window),
        }

    plain = look_back(df, ["k"], ["at", "row_id"], 24, outputs, None)
    for limit in (100, 30, 7):
        hot = find_hot_keys(df, ["k"], limit)
        assert hot is not None
        cut = look_back(df, ["k"], ["at", "row_id"], 24, outputs, hot)
        assert as_sets(cut.select(*plain.columns)) == as_sets(plain)


def test_running_total_over_chunks(spark):
    df = spark.createDataFrame(rows_with_hot_key(2), SCHEMA)
    df = df.withColumn("bit", F.col("bit").cast("long"))
    plain = running_total(df, ["k"], ["at", "row_id"], "bit", "total", None)
    hot = find_hot_keys(df, ["k"], 20)
    cut = running_total(df, ["k"], ["at", "row_id"], "bit", "total", hot)
    assert as_sets(cut.select(*plain.columns)) == as_sets(plain)


def test_trailing_count_is_exact(spark):
    rows = rows_with_hot_key(3, 400)
    df = spark.createDataFrame(rows, SCHEMA)
    seconds = 600
    length = dt.timedelta(seconds=seconds)
    expected = {
        (k, at): sum(b for _, k2, at2, _, b in rows if k2 == k and at - length <= at2 <= at)
        for _, k, at, _, _ in rows
    }
    for limit in (10**6, 25):
        got = trailing_count(df, ["k"], seconds, ts="at", max_rows=limit)
        assert {(r.k, r["at"]): r.ones_in_window for r in got.collect()} == expected


def test_sessions_equal_session_windows(spark):
    rows = rows_with_hot_key(4, 400)
    # Exactly one gap after another: still the same burst.
    at = START + dt.timedelta(days=30)
    rows += [(1000 + i, 50, at + i * dt.timedelta(minutes=10), 1.0, 0) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("anomaly", F.col("bit"))
    theirs = sessions.stream_session_counts(df, "10 minutes", ["k"], "at")
    for limit in (10**6, 30):
        ours = sessions.session_counts(df, 600, ["k"], "at", max_rows=limit)
        assert as_sets(ours.select(*theirs.columns)) == as_sets(theirs)


def test_detectors_with_hot_building(spark, make_readings):
    rng = random.Random(5)
    rows = [
        {"building_id": 1 if i % 3 else 2 + i % 5, "meter_reading": rng.choice([None, 5.0, 9.0, 80.0]),
         "timestamp": START + dt.timedelta(minutes=i // 4)}
        for i in range(300)
    ]
    df = make_readings(rows)
    for operator in (moving_average, ensemble):
        plain = operator(df).drop("details")
        cut = operator(df, max_rows=40).drop("details")

        def near(frame):
            numbers = [c for c, kind in frame.dtypes if kind == "double"]
            return as_sets(frame.withColumns({c: F.round(c, 9) for c in numbers}))

        assert near(cut.select(*plain.columns)) == near(plain)
