"""Tables in the shared folder, and what goes with them."""

from __future__ import annotations

import time

import pyarrow as pa
from pyspark.sql import functions as F

from meterlens.storage import BATCH_BYTES, durable, durable_buckets, remove_tables


def shuffles(spark) -> int:
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_shuffles_behind_removed_tables_go(spark):
    remove_tables(spark, [])
    time.sleep(2)
    before = shuffles(spark)
    durable(spark.range(1000).withColumn("k", F.col("id") % 7).repartition(5, "k").mapInArrow(
        lambda batches: batches, "id long, k long"))
    assert shuffles(spark) > before
    remove_tables(spark, [])
    for _ in range(20):
        if shuffles(spark) <= before:
            break
        time.sleep(0.25)
    assert shuffles(spark) <= before


def test_batches_of_long_rows_stay_small(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "b": [batch.nbytes]})

    rows = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t"))
    kept = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    found = durable(rows.mapInArrow(sizes, "n long, b long")).agg(F.sum("n"), F.max("b")).first()
    assert found[0] == 400 and found[1] <= 2 * BATCH_BYTES
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == kept


def test_buckets_keep_rows_where_they_are(spark):
    table = durable_buckets(spark.range(100).withColumn("v", F.col("id") * 2).repartition(6, "id"), "id", 6)
    joined = table.join(spark.range(50).repartition(6, "id").hint("merge"), "id")
    assert joined.agg(F.sum("v")).first()[0] == 2 * sum(range(50))
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
