from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from meterlens.operators.detectors import detect_batch
from meterlens.schema import ANOMALIES, READINGS, TABLES
from meterlens.sources import entry, files, tables
from meterlens.storage import durable, recorded, remove_tables, shared_folder
from tests.conftest import START


def write(path, text):
    path.write_text(text)
    return str(path)


HEADER = "building_id,timestamp,meter_reading,anomaly,square_feet,year_built"


def test_csv_to_readings(spark, tmp_path):
    labels = write(tmp_path / "train.csv", "building_id,timestamp,meter_reading,anomaly\n")
    features = write(
        tmp_path / "features.csv",
        f"{HEADER}\n1,2016-01-01 00:00:00,NaN,0,7432,2008.0\n"
        "1,2016-02-01 13:00:00,12.5,1,,\n2,2016-01-04 01:00:00,,0,100,1999\n",
    )
    target = str(tmp_path / "readings")
    rows = files.ingest_features_csv(spark, labels, features, target)
    got = {(r.building_id, r.timestamp): r for r in rows.collect()}
    first = got[1, dt.datetime(2016, 1, 1)]
    assert (first.meter_reading, first.square_feet, first.year_built) == (None, 7432.0, 2008)
    second = got[1, dt.datetime(2016, 2, 1, 13)]
    assert (second.meter_reading, second.square_feet, second.hour, second.weekday,
            second.month) == (12.5, None, 13, 0, 2)
    assert got[2, dt.datetime(2016, 1, 4, 1)].meter_reading is None
    known = {f.name: f.dataType for f in READINGS.fields}
    for field in rows.schema.fields:
        assert field.name in ("batch", "reading_month") or known[field.name] == field.dataType
    folders = {p.name for p in (tmp_path / "readings").glob("batch=*/reading_month=*")}
    assert folders == {"reading_month=2016-01", "reading_month=2016-02"}


def test_labels_need_a_features_column(spark, tmp_path):
    labels = write(tmp_path / "a.csv", "building_id,extra\n")
    features = write(tmp_path / "b.csv", HEADER + "\n")
    with pytest.raises(ValueError, match="extra"):
        files.ingest_features_csv(spark, labels, features, str(tmp_path / "out"))


def test_rejected_lines(spark, tmp_path):
    features = write(
        tmp_path / "features.csv",
        f"{HEADER}\n1,2016-01-01 00:00:00,5.0,0,7432,2008\n"
        "2,2016-01-01 00:00:00,5.0\n"                          # fields missing
        "3,2016-01-01 00:00:00,5.0,0,7432,2008,7,8\n"          # fields too many
        "x,2016-01-01 00:00:00,5.0,0,7432,2008\n"
        "4,someday,5.0,0,7432,2008\n"
        ",2016-01-01 00:00:00,5.0,0,7432,2008\n"
        "5,2016-01-01 00:00:00,high,0,\"big\",NaN\n"
        "6,2016-01-01 00:00:00, nan ,0,null,\n",
    )
    labels = write(tmp_path / "train.csv", "building_id,timestamp,meter_reading,anomaly\n")
    target, bad = str(tmp_path / "readings"), str(tmp_path / "bad")
    rows = files.ingest_features_csv(spark, labels, features, target, bad)
    assert sorted((r.building_id, r.meter_reading, r.square_feet) for r in rows.collect()) == [
        (1, 5.0, 7432.0), (5, None, None), (6, None, None)]
    got = {r.line: (r.reasons, r.loaded) for r in spark.read.parquet(bad).collect()}
    assert len(got) == 6
    assert got["2,2016-01-01 00:00:00,5.0"] == (["line does not fit the header"], False)
    assert got["3,2016-01-01 00:00:00,5.0,0,7432,2008,7,8"][1] is False
    assert got["x,2016-01-01 00:00:00,5.0,0,7432,2008"] == (["building_id: x"], False)
    assert got["4,someday,5.0,0,7432,2008"] == (["timestamp: someday"], False)
    by_reason = {tuple(reasons): loaded for reasons, loaded in got.values()}
    assert by_reason["building_id: missing",] is False
    assert by_reason["meter_reading: high", "square_feet: big"] is True


def test_head_types_come_from_the_head(spark, tmp_path):
    path = write(tmp_path / "x.csv", "a,b\n" + "\n".join(f"{i},{i}" for i in range(10)) + "\nx,y\n")
    assert dict(files.head_csv(spark, path, 10).dtypes) == {"a": "int", "b": "int"}
    assert files.head_csv(spark, path, 10).count() == 10
    assert dict(files.head_csv(spark, path, 11).dtypes) == {"a": "string", "b": "string"}


def test_head_of_csv(spark, tmp_path):
    path = write(tmp_path / "x.csv", "a,b\n" + "\n".join(f"{i},t{i}" for i in range(1500)))
    head = files.head_csv(spark, path)
    assert head.count() == 1000 and dict(head.dtypes) == {"a": "int", "b": "string"}


def test_layout_is_sorted_and_pruned(spark, make_readings, tmp_path):
    rows = [
        {"building_id": i % 7, "timestamp": START + dt.timedelta(hours=37 * i)} for i in range(200)
    ]
    path = str(tmp_path / "r")
    tables.write_readings(make_readings(rows), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 200
    one = stored.where("reading_month = '2024-02' AND building_id = 3")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_month" in plan
    assert "EqualTo(building_id,3)" in plan
    for _, part in stored.toPandas().groupby(stored.toPandas().index // 10**6):
        assert len(part) == 200


def test_tables(spark, make_readings, tmp_path):
    folder = str(tmp_path)
    tables.reset_tables(spark, folder)
    for name, schema in TABLES.items():
        stored = tables.read_table(spark, folder, name)
        assert stored.count() == 0 and stored.schema.names == schema.names
    rows = [{"meter_reading": 10.0 + i % 2} for i in range(24)] + [{"meter_reading": 500.0}]
    path = f"{folder}/anomalies"
    tables.append_anomalies(detect_batch(make_readings(rows)), path)
    tables.append_anomalies(detect_batch(make_readings(rows[:-1])), path)
    stored = tables.read_table(spark, folder, "anomalies").collect()
    assert len(stored) == 1
    assert stored[0].detection_method == "ensemble" and stored[0].detected_at is not None
    assert json.loads(stored[0].details)["votes"] == "3/3"
    anomalies = tables.read_table(spark, folder, "anomalies")
    assert [f.dataType for f in anomalies.schema.fields] == [f.dataType for f in ANOMALIES.fields]
    counts = tables.table_counts({n: tables.read_table(spark, folder, n) for n in TABLES})
    assert {r.table_name: r.row_count for r in counts.collect()} == {
        "meter_readings": 0, "anomalies": 1, "model_performance": 0, "stream_stats": 0,
    }


def forms(spark, rows):
    schema = ("building_id bigint, meter_reading double, timestamp string, "
              "air_temperature double, wind_speed double, anomaly int")
    return spark.createDataFrame(rows, schema)


GOOD = (199, 12.5, "2024-05-01T10:30", 0.0, None, 0)


def test_entries(spark, tmp_path):
    rows = [GOOD, (200, *GOOD[1:]), (-1, *GOOD[1:]), (1, -0.5, *GOOD[2:]),
            (1, 1.0, "yesterday", None, -2.0, 3)]
    accepted, rejected = entry.split_entries(entry.validate_entries(forms(spark, rows)))
    kinds = {r.building_id: (r.primary_use, r.air_temperature) for r in accepted.collect()}
    assert kinds == {199: ("Office", 0.0), 200: ("New Building", 0.0)}
    assert sorted(r.errors for r in rejected.collect()) == [
        "building_id", "meter_reading", "timestamp,wind_speed,anomaly",
    ]
    readings, bad = str(tmp_path / "readings"), str(tmp_path / "rejected")
    entry.store_entries(forms(spark, rows), readings, bad)
    entry.store_entries(forms(spark, [GOOD]), readings, bad)
    assert spark.read.parquet(readings).count() == 3
    assert spark.read.parquet(bad).count() == 3
    assert spark.read.parquet(readings).first().hour == 10
    # A named batch is replaced; loads and forms share one table with all columns.
    for _ in range(2):
        entry.store_entries(forms(spark, [GOOD, (-1, *GOOD[1:])]), readings, bad, "monday")
    assert spark.read.parquet(readings).count() == 4
    assert spark.read.parquet(bad).count() == 4
    entry.store_entries(forms(spark, [(-1, *GOOD[1:])]), readings, bad, "monday")
    stored = spark.read.parquet(readings)
    assert stored.count() == 3
    assert stored.columns == [*READINGS.names, "batch", "reading_month"]
    ids = [r.row_id for r in stored.collect()]
    assert len(set(ids)) == 3 and all(0 <= i < 10**18 for i in ids)


def test_exports_keep_zeros(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.0, None)], "a int, b double, c string")
    df = df.coalesce(1)
    files.export_csv(df, str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("part-*.csv")).read_text()
    assert text.splitlines() == ["a,b,c", "1,0.0,"]
    files.export_json(df, str(tmp_path / "json"))
    text = next((tmp_path / "json").glob("part-*.json")).read_text()
    assert json.loads(text) == {"a": 1, "b": 0.0, "c": None}


def test_durable_tables_can_be_removed(spark):
    with recorded() as outer:
        first = durable(spark.range(3))
        with recorded() as inner:
            second = durable(spark.range(4))
    durable(spark.range(5))
    assert (len(outer), len(inner)) == (2, 1) and outer[1] == inner[0]
    remove_tables(spark, inner)
    assert first.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        second.count()


def test_durable_tables_live_in_the_shared_folder(spark):
    kept = durable(spark.range(10).withColumn("x", F.rand()))
    assert kept.collect() == kept.collect()
    assert shared_folder(spark).replace("file:", "") in kept.inputFiles()[0]
