from __future__ import annotations

import datetime as dt
import random
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from meterlens.operators.aggregates import building_statistics
from meterlens.operators.alerts import alert_statistics, process_alerts
from meterlens.operators.bloom import bloom_dedup
from meterlens.operators.detectors import detect_batch, iqr, three_sigma
from meterlens.operators.sessions import sliding_counts, tumbling_counts
from meterlens.plans.catalog import scored_alerts
from meterlens.schema import ANOMALIES, READINGS, STREAM_STATS
from meterlens.sources.entry import store_entries
from meterlens.sources.events import readings as derived
from meterlens.sources.tables import append_anomalies, write_readings
from meterlens.streaming import alerts as SA
from meterlens.streaming import readings as SR
from tests.conftest import START
from tests.test_sketches import BIT_SCHEMA, CAPACITY, ERROR, ITEM_SCHEMA, Model, bit_rows, stream


def drain(df, mode, tmp_path):
    """Run a stream over all its files, return what it wrote."""
    name = "t" + uuid.uuid4().hex
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    assert query.exception() is None
    return df.sparkSession.table(name)


def finish(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    """Readings in four files in the order of time."""
    path = str(tmp_path_factory.mktemp("stream") / "readings")
    rows = derived(spark, folder).select(*READINGS.names)
    for day in (0, 8, 15, 23):
        first = START + dt.timedelta(days=day)
        last = START + dt.timedelta(days={0: 8, 8: 15, 15: 23, 23: 99}[day])
        part = rows.where((F.col("timestamp") >= F.lit(first)) & (F.col("timestamp") < F.lit(last)))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def closed(batch, delay):
    """Windows a stream has finished when its watermark trails the last reading."""
    end = batch.agg(F.max("last")).first()[0] - delay
    return sorted(map(repr, batch.where(F.col("window_end") <= F.lit(end)).drop("last").collect()))


@pytest.mark.parametrize("slide", [None, "6 hours"])
def test_windows_equal_batch(spark, stored, tmp_path, slide):
    source = SR.read_stream(spark, stored, READINGS, files_per_trigger=1)
    counts = SR.windowed_counts(source, "1 hour", "1 day", slide, ["primary_use"])
    streamed = drain(counts, "append", tmp_path)
    rows = spark.read.parquet(stored).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    twin = sliding_counts(rows, "1 day", slide, ["primary_use"]) if slide else tumbling_counts(
        rows, "1 day", ["primary_use"]
    )
    last = rows.agg(F.max("timestamp").alias("last"))
    expected = closed(twin.crossJoin(last), dt.timedelta(hours=1))
    assert len(expected) > 100
    assert sorted(map(repr, streamed.collect())) == expected


def test_sessions_of_a_stream(spark, stored, tmp_path):
    source = SR.read_stream(spark, stored, READINGS, files_per_trigger=2)
    streamed = drain(SR.session_counts(source, "1 hour", "6 hours", ["building_id"]), "append",
                     tmp_path)
    assert streamed.count() > 100
    assert streamed.where("window_end <= window_start").count() == 0


def test_detection_equals_batch(spark, stored, tmp_path):
    rows = spark.read.parquet(stored)
    stats = building_statistics(rows)
    source = SR.read_stream(spark, stored, READINGS)
    for method, operator in (("3sigma", three_sigma), ("iqr", iqr)):
        streamed = drain(SR.detect(source, stats, method), "append", tmp_path)
        flagged = {r.row_id for r in streamed.where("is_anomaly").collect()}
        assert flagged == {r.row_id for r in operator(rows).where("is_anomaly").collect()}
    path, checkpoint = str(tmp_path / "anomalies"), str(tmp_path / "checkpoint")
    finish(SR.append_anomalies_stream(SR.detect(source, stats, "iqr"), path, checkpoint))
    table = spark.read.schema(ANOMALIES).parquet(path)
    assert table.count() == len(flagged) > 0 and table.first().detection_method == "iqr"


def one_anomaly(make_readings):
    rows = [{"meter_reading": 10.0 + i % 2} for i in range(24)] + [{"meter_reading": 500.0}]
    return make_readings(rows)


def test_batch_and_stream_share_the_anomalies(spark, make_readings, tmp_path):
    path, arrived = str(tmp_path / "anomalies"), str(tmp_path / "in")
    rows = one_anomaly(make_readings)
    stats = building_statistics(rows)

    def stored():
        return spark.read.parquet(path)

    append_anomalies(detect_batch(rows), path)
    assert stored().count() == 1
    rows.where("meter_reading = 500").coalesce(1).write.parquet(arrived)
    source = SR.detect(SR.read_stream(spark, arrived, READINGS), stats, "3sigma")
    finish(SR.append_anomalies_stream(source, path, str(tmp_path / "checkpoint")))
    assert stored().count() == 2
    append_anomalies(detect_batch(rows), path)
    assert stored().count() == 3
    # The same batches once more: a lost checkpoint, and a batch run of the same name.
    finish(SR.append_anomalies_stream(source, path, str(tmp_path / "checkpoint")))
    assert stored().count() == 3
    shutil.rmtree(tmp_path / "checkpoint")
    finish(SR.append_anomalies_stream(source, path, str(tmp_path / "checkpoint")))
    assert stored().count() == 3
    for _ in range(2):
        append_anomalies(detect_batch(rows), path, "2024-01-02")
        assert stored().count() == 4
    methods = [r.detection_method for r in stored().collect()]
    assert sorted(methods) == ["3sigma", "ensemble", "ensemble", "ensemble"]
    # Another stream has batches of its own, though they bear the same numbers.
    finish(SR.append_anomalies_stream(source, path, str(tmp_path / "other")))
    assert stored().count() == 5


def test_loads_forms_and_streams_share_the_readings(spark, make_readings, tmp_path):
    readings, bad, arrived = (str(tmp_path / n) for n in ("readings", "bad", "in"))
    schema = ("building_id bigint, meter_reading double, timestamp string, "
              "air_temperature double, wind_speed double, anomaly int")
    form = (7, 5.0, "2024-05-01T10:30", None, 1.0, 0)
    write_readings(make_readings([{}, {}]), readings)
    store_entries(spark.createDataFrame([form], schema), readings, bad)
    put(spark, [form, (8, -1.0, *form[2:])], schema, arrived)
    source = SR.read_stream(spark, arrived, spark.read.parquet(arrived).schema, 1)
    finish(SR.append_entries_stream(source, readings, bad, str(tmp_path / "checkpoint")))
    stored = spark.read.parquet(readings)
    assert stored.count() == 4 and spark.read.parquet(bad).count() == 1
    assert {r.reading_month for r in stored.collect()} == {"2024-01", "2024-05"}
    assert stored.where("row_id is null or hour is null").count() == 0
    again = stored.where("building_id = 7 and reading_month = '2024-05'")
    assert "PartitionFilters: [isnotnull(reading_month" in again._jdf.queryExecution().executedPlan().toString()
    assert again.count() == 2
    # A load replaces the table; later batches add to it again.
    write_readings(make_readings([{}]), readings)
    assert spark.read.parquet(readings).count() == 1
    put(spark, [form], schema, arrived)
    finish(SR.append_entries_stream(source, readings, bad, str(tmp_path / "checkpoint")))
    assert spark.read.parquet(readings).count() == 2


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_late_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = "timestamp timestamp_ntz, anomaly int"
    hour = dt.timedelta(hours=1)
    for hours in (0, 10, 20, 0.5, 40):
        put(spark, [(START + hours * hour, 1)], schema, path)
    source = SR.read_stream(spark, path, spark.read.parquet(path).schema, 1)
    # Files are read oldest first. Lateness is judged by the watermark of the batch before
    # the last one: the fourth file is behind that of the second.
    got = drain(SR.windowed_counts(source, "1 hour", "1 hour"), "append", tmp_path).collect()
    assert {(r.window_start.replace(tzinfo=None) - START, r.readings) for r in got} == {
        (0 * hour, 1), (10 * hour, 1), (20 * hour, 1),
    }


def test_exact_dedup_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    put(spark, stream(200), ITEM_SCHEMA, path)
    put(spark, stream(200), ITEM_SCHEMA, path)
    source = SR.read_stream(spark, path, spark.read.parquet(path).schema, 1)
    got = drain(SR.exact_dedup(source, "name", "1 day"), "append", tmp_path)
    assert got.count() == len({r[2] for r in stream(200)})


def test_bloom_stream_equals_one_pass(spark, tmp_path):
    rows = stream(900)
    path = str(tmp_path / "in")
    for start in range(0, 900, 300):
        put(spark, rows[start:start + 300], ITEM_SCHEMA, path)
    source = SR.read_stream(spark, path, spark.read.parquet(path).schema, 1)
    out, stats = str(tmp_path / "out"), str(tmp_path / "stats")
    finish(SA.bloom_dedup_stream(
        source, F.col("name"), CAPACITY, ERROR, str(tmp_path / "bits"), out,
        str(tmp_path / "checkpoint"), stats,
    ))
    got = {r.row_id: r.is_duplicate for r in spark.read.parquet(out).collect()}
    df = spark.createDataFrame(rows, ITEM_SCHEMA)
    whole = bloom_dedup(df, F.col("name"), CAPACITY, ERROR).collect()
    assert got == {r.row_id: r.is_duplicate for r in whole}
    metrics = spark.read.schema(STREAM_STATS).parquet(stats)
    sums = {r.metric: r["sum(value)"] for r in metrics.groupBy("metric").sum("value").collect()}
    assert sums == {"processed": 900, "duplicates": sum(got.values())}
    assert {r.batch_id for r in metrics.collect()} == {0, 1, 2}


def test_dgim_stream_equals_one_by_one(spark, tmp_path):
    rows = bit_rows(60, 400)
    models = {}
    for _, key, at, bit in rows:
        models.setdefault(key, Model(60)).add((at - START).total_seconds(), bit)
    # Every file holds rows out of order, up to 100 of the next file's among them; a last row of
    # another key, far later, lets the watermark pass all bits.
    shuffled = sorted(rows, key=lambda r: r[0] + random.Random(r[0]).randrange(100))
    far = (400, 99, rows[-1][2] + dt.timedelta(days=30), 1)
    path = str(tmp_path / "in")
    for start in range(0, 400, 100):
        put(spark, shuffled[start:start + 100], BIT_SCHEMA, path)
    put(spark, [far], BIT_SCHEMA, path)
    source = SR.read_stream(spark, path, spark.read.parquet(path).schema, 1)
    got = drain(SA.dgim_stream(source, "k", 60, "1 day"), "update", tmp_path)
    latest = got.groupBy("k").agg(F.max_by(F.struct("*"), "last_at").alias("r")).select("r.*")
    found = {r.k: r for r in latest.collect()}
    assert set(found) == set(models)
    for key, model in models.items():
        assert found[key].estimate_per_size == model.per_size()
        assert found[key].bucket_count == len(model.buckets)
        times = [row[2] for row in rows if row[1] == key]
        pauses = [i for i in range(1, len(times)) if times[i] - times[i - 1] > dt.timedelta(seconds=60)]
        assert found[key].total_bits == len(times) - max(pauses, default=0)


def test_late_bits_and_silent_keys(spark, tmp_path):
    """Late bits are dropped, others wait for the watermark, silent keys are forgotten."""
    path = str(tmp_path / "in")

    def at(seconds):
        return START + dt.timedelta(seconds=seconds)

    files = [
        [(0, 1, at(0), 1), (1, 1, at(10), 1), (2, 2, at(10), 1)],
        [(3, 1, at(100), 1)],                      # the watermark passes the first file
        [(4, 1, at(95), 1), (5, 1, at(5), 1)],     # in time, and late
        [(6, 1, at(130), 0)],
        [(7, 1, at(1000), 1), (8, 2, at(1000), 1)],  # both keys were silent for a window
        [(9, 3, at(5000), 1)],
    ]
    for rows in files:
        put(spark, rows, BIT_SCHEMA, path)
    source = SR.read_stream(spark, path, spark.read.parquet(path).schema, 1)
    got = drain(SA.dgim_stream(source, "k", 60, "20 seconds"), "update", tmp_path)
    origin = int((START - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    seen = sorted((r.k, (r.last_at - origin) // 10**6, r.total_bits, r.estimate_classic)
                  for r in got.collect())
    per_key = {k: [s[1:] for s in seen if s[0] == k] for k in (1, 2, 3)}
    # The late one at 5 s counts nowhere; the one at 95 s comes before that at 100 s. After a
    # pause longer than the window the bits are counted anew. A lone one counts half, rounded down.
    assert per_key[1] == [(10, 2, 1), (100, 2, 1), (130, 3, 1), (1000, 1, 0)]
    assert per_key[2] == [(10, 1, 0), (1000, 1, 0)]
    assert per_key[3] == []


def test_alert_stream_equals_batch(spark, folder, tmp_path):
    alerts = scored_alerts(spark, folder).select(
        "row_id", "building_id", "timestamp", "anomaly_score").cache()
    schema = alerts.schema
    rows = sorted(alerts.collect(), key=lambda r: (r.timestamp, r.row_id))
    # Repeat some alerts a little later under new ids.
    rows += [(10**6 + i, r.building_id, r.timestamp, r.anomaly_score) for i, r in enumerate(rows[::5])]
    rows = sorted(map(tuple, rows), key=lambda r: (r[2], r[0]))
    cuts = [0, *[c for c in (len(rows) // 4, len(rows) // 2, 3 * len(rows) // 4)], len(rows)]
    for i, c in enumerate(cuts[1:-1], 1):  # equal times stay in one file
        while rows[c][2] == rows[c - 1][2]:
            c += 1
        cuts[i] = c
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for a, b in zip(cuts, cuts[1:]):
        put(spark, rows[a:b], schema, path)
    source = SR.read_stream(spark, path, schema, 1)
    stats = str(tmp_path / "stats")

    def run():
        finish(SA.process_alerts_stream(
            source, 200, 0.05, 86400, str(tmp_path / "state"), out, str(tmp_path / "cp"), stats))
        names = ["row_id", "item", "is_duplicate", "ones_in_window"]
        return sorted(map(tuple, spark.read.parquet(out).select(*names).collect()))

    whole, state = process_alerts(spark.createDataFrame(rows, schema), 200, 0.05, 86400)
    expected = sorted(map(tuple, whole.select("row_id", "item", "is_duplicate", "ones_in_window").collect()))
    assert run() == expected
    bits = spark.read.parquet(str(tmp_path / "state" / "bits")).select("bit")
    assert bits.count() == bits.distinct().count() == state.bits.count()
    # All batches once more, as after a lost checkpoint: the same rows.
    shutil.rmtree(tmp_path / "cp")
    assert run() == expected
    assert spark.read.parquet(stats).where("metric = 'processed'").agg(F.sum("value")).first()[0] == len(rows)
    row = alert_statistics(whole, 200, 0.05, 86400).first()
    assert row.total_processed == len(rows) and row.duplicates_detected >= len(rows) // 6
    assert row.estimated_in_window > 0
    none = alert_statistics(whole.where("false"), 200, 0.05, 86400).first()
    assert (none.total_processed, none.estimated_in_window) == (0, 0)


def test_entries_of_a_stream(spark, tmp_path):
    schema = ("building_id bigint, meter_reading double, timestamp string, "
              "air_temperature double, wind_speed double, anomaly int")
    path = str(tmp_path / "in")
    put(spark, [(201, 5.0, "2024-05-01T10:30", None, 1.0, 0)], schema, path)
    put(spark, [(1, -5.0, "2024-05-01T10:30", None, 1.0, 0)], schema, path)
    source = SR.read_stream(spark, path, spark.read.parquet(path).schema, 1)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    finish(SR.append_entries_stream(source, good, bad, str(tmp_path / "checkpoint")))
    stored = spark.read.parquet(good)
    assert [r.primary_use for r in stored.collect()] == ["New Building"]
    assert [r.errors for r in spark.read.parquet(bad).collect()] == ["meter_reading"]
