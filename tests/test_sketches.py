"""Bloom filters and window counters against one-by-one models."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from meterlens.functions.hashing import bloom_size
from meterlens.operators import bloom as B
from meterlens.operators import dgim as G
from meterlens.operators.counting import trailing_count
from tests.conftest import START

CAPACITY, ERROR = 300, 0.05
ITEM_SCHEMA = "row_id bigint, timestamp timestamp_ntz, name string"


def bits_of(item, bits, hashes):
    return {int(hashlib.md5(f"{item}_{i}".encode()).hexdigest(), 16) % bits for i in range(hashes)}


def stream(n=1500, seed=11):
    rng = random.Random(seed)
    return [
        (i, START + dt.timedelta(seconds=i // 3), f"item{rng.randrange(1400)}") for i in range(n)
    ]


def one_by_one(rows, known=()):
    bits, hashes = bloom_size(CAPACITY, ERROR)
    filled, flags = set(known), {}
    for row_id, _, name in rows:
        mine = bits_of(name, bits, hashes)
        flags[row_id] = mine <= filled
        filled |= mine
    return flags, filled


def test_dedup_equals_one_by_one(spark):
    assert bloom_size(CAPACITY, ERROR) == (1870, 4)
    rows = stream()
    expected, filled = one_by_one(rows)
    df = spark.createDataFrame(rows, ITEM_SCHEMA).repartition(5)
    marked = B.bloom_dedup(df, F.col("name"), CAPACITY, ERROR)
    assert {r.row_id: r.is_duplicate for r in marked.collect()} == expected
    exact = len(rows) - len({name for _, _, name in rows})
    assert sum(expected.values()) > exact  # false positives are part of the answer
    bits = B.bloom_build(df, F.col("name"), CAPACITY, ERROR)
    assert {r.bit for r in bits.collect()} == filled
    stats = B.bloom_stats(marked, CAPACITY, ERROR).first()
    assert stats.duplicates_detected == sum(expected.values())
    assert stats.bits_set == len(filled)
    n, m, k = stats.items_added, 1870, 4
    assert stats.estimated_fpr == pytest.approx((1 - (1 - 1 / m) ** (k * n)) ** k)


def test_dedup_joins_large_filters(spark, monkeypatch):
    monkeypatch.setattr(B, "BROADCAST_BITS", 10)
    rows = stream(300)
    expected, _ = one_by_one(rows)
    df = spark.createDataFrame(rows, ITEM_SCHEMA)
    marked = B.bloom_dedup(df, F.col("name"), CAPACITY, ERROR)
    assert {r.row_id: r.is_duplicate for r in marked.collect()} == expected
    # Four hashes, one join on bits; the other brings items back to their rows.
    plan = marked._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"Join \[bit#", plan)) == 1
    assert len(re.findall(r"(?:SortMerge|ShuffledHash|BroadcastHash)Join ", plan)) == 2
    with_null = df.unionByName(spark.createDataFrame([(900, START, None)], ITEM_SCHEMA))
    flags = {r.row_id: r.is_duplicate for r in B.bloom_dedup(
        with_null, F.col("name"), CAPACITY, ERROR).collect()}
    assert len(flags) == 301 and flags[900] is not None
    bits = B.bloom_build(df.where("row_id < 100"), F.col("name"), CAPACITY, ERROR)
    filled = {r.bit for r in bits.collect()}
    for r in B.bloom_probe(df, F.col("name"), bits, CAPACITY, ERROR).collect():
        assert r.maybe_present == (bits_of(r.name, 1870, 4) <= filled)


def test_known_bits_and_probe(spark):
    rows = stream(900)
    expected, _ = one_by_one(rows)
    df = spark.createDataFrame(rows, ITEM_SCHEMA)
    first, second = df.where("row_id < 400"), df.where("row_id >= 400")
    known = B.bloom_build(first, F.col("name"), CAPACITY, ERROR)
    marked = B.bloom_dedup(second, F.col("name"), CAPACITY, ERROR, known=known)
    assert {r.row_id: r.is_duplicate for r in marked.collect()} == {
        i: flag for i, flag in expected.items() if i >= 400
    }
    probed = B.bloom_probe(df, F.col("name"), known, CAPACITY, ERROR)
    filled = {r.bit for r in known.collect()}
    for r in probed.collect():
        assert r.maybe_present == (bits_of(r.name, 1870, 4) <= filled)
    both = B.bloom_union(known, B.bloom_build(second, F.col("name"), CAPACITY, ERROR))
    assert both.count() == B.bloom_build(df, F.col("name"), CAPACITY, ERROR).count()
    packed = B.bloom_packed(known).agg(F.sum(F.bitmap_count("bitmap"))).first()[0]
    assert packed == len(filled)


def test_empty_filter(spark):
    df = spark.createDataFrame([], ITEM_SCHEMA)
    stats = B.bloom_stats(B.bloom_dedup(df, F.col("name"), CAPACITY, ERROR), CAPACITY, ERROR)
    row = stats.first()
    assert (row.estimated_fpr, row.duplicate_rate, row.bits_set) == (0.0, 0.0, 0)


def test_repeated_alerts(spark):
    rows = [(0, 1, START, 0.75), (1, 1, START, 0.75), (2, 1, START, 0.5), (3, 2, START, 0.75)]
    schema = "row_id bigint, building_id bigint, timestamp timestamp_ntz, anomaly_score double"
    df = spark.createDataFrame(rows, schema)
    marked = B.bloom_dedup(df, B.alert_item(), 10000, 0.01).orderBy("row_id").collect()
    assert [r.is_duplicate for r in marked] == [False, True, False, False]
    assert marked[0].item == "1_2024-01-01 00:00:00.000000_0.750"
    first = {r.item: (r.row_id, r.copies) for r in B.exact_dedup(df, B.alert_item()).collect()}
    assert first[marked[0].item] == (0, 2) and len(first) == 3


class Model:
    """Buckets as one list of (time, size), newest first; every bit handled alone."""

    def __init__(self, window):
        self.window, self.buckets = window, []

    def add(self, at, bit):
        if bit:
            self.buckets.insert(0, (at, 1))
            size = 1
            while True:
                same = [i for i, (_, s) in enumerate(self.buckets) if s == size]
                if len(same) < 3:
                    break
                newer, older = same[-2], same[-1]
                self.buckets[newer] = (self.buckets[newer][0], size * 2)
                del self.buckets[older]
                size *= 2
        self.buckets = [b for b in self.buckets if b[0] >= at - self.window]

    def per_size(self):
        sizes = [s for _, s in self.buckets]
        return sum(s * (sizes.count(s) - 1) + s // 2 for s in set(sizes))


def bit_rows(seed, n, keys=4):
    rng = random.Random(seed)
    rows, at = [], 0
    for i in range(n):
        at += rng.choice([0, 0, 1, 5, 20]) if rng.random() < 0.99 else 500
        key = 0 if rng.random() < 0.5 else rng.randrange(1, keys)
        rows.append((i, key, START + dt.timedelta(seconds=at), int(rng.random() < 0.6)))
    return rows


BIT_SCHEMA = "row_id bigint, k bigint, timestamp timestamp_ntz, bit int"


@pytest.mark.parametrize("window, max_rows", [(60, 10**6), (60, 40), (5, 10**6), (10**6, 40)])
def test_dgim_equals_one_by_one(spark, window, max_rows):
    rows = bit_rows(window, 700)
    models = {}
    for _, key, at, bit in rows:
        models.setdefault(key, Model(window)).add((at - START).total_seconds(), bit)
    df = spark.createDataFrame(rows, BIT_SCHEMA).repartition(3)
    state = G.dgim_state(df, ["k"], window, max_rows=max_rows).collect()
    assert len(state) == len(models)
    origin = (START - dt.datetime(1970, 1, 1)).total_seconds()
    for r in state:
        got = [(b["at"] / 1e6 - origin, b["size"]) for b in r.buckets]
        assert got == models[r.k].buckets
        assert r.total_bits == sum(1 for row in rows if row[1] == r.k)
    counted = {r.k: r for r in G.dgim_count(df, ["k"], window, max_rows=max_rows).collect()}
    for key, model in models.items():
        assert counted[key].estimate_per_size == model.per_size()
        assert counted[key].bucket_count == len(model.buckets)
        assert counted[key].memory_bytes == 16 * len(model.buckets)


def test_a_hot_key_is_folded_in_chunks(spark, monkeypatch):
    """One key with nearly all bits: no fold sees more than a chunk, the state is handed on."""
    rng = random.Random(2)
    rows, at = [], 0
    for i in range(6000):
        at += rng.choice([1, 2, 3])
        rows.append((i, int(i % 50 == 0), START + dt.timedelta(seconds=at), int(rng.random() < 0.7)))
    model = Model(4000)
    for _, key, when, bit in rows:
        if key == 0:
            model.add((when - START).total_seconds(), bit)
    seen = []
    fold = G.fold_buckets
    monkeypatch.setattr(G, "fold_buckets", lambda ones, *rest: (
        seen.append(ones.count()), fold(ones, *rest))[1])
    df = spark.createDataFrame(rows, BIT_SCHEMA)
    state = {r.k: r for r in G.dgim_state(df, ["k"], 4000, max_rows=500).collect()}
    origin = (START - dt.datetime(1970, 1, 1)).total_seconds()
    assert [(b["at"] / 1e6 - origin, b["size"]) for b in state[0].buckets] == model.buckets
    assert len(seen) > 8 and max(seen) < 1500 < sum(seen)


def test_many_ones_at_once():
    for ones in (1, 2, 3, 7, 64, 1000):
        at_once, singly = [[1], [0]], [[1], [0]]
        G.push(at_once, 9, ones)
        for _ in range(ones):
            G.push(singly, 9)
        assert at_once == singly


def test_a_key_without_ones(spark):
    df = spark.createDataFrame([(0, 1, START, 0)], BIT_SCHEMA)
    row = G.dgim_count(df, ["k"], 60).first()
    assert (row.estimate_per_size, row.estimate_classic, row.bucket_count) == (0, 0, 0)


def test_closed_form(spark):
    rows = spark.range(300).select("id", *[
        c.alias(n) for n, c in G.closed_form(F.col("id")).items()
    ]).collect()
    for r in rows:
        model = Model(10**9)
        for i in range(r.id):
            model.add(i, 1)
        sizes = [s for _, s in model.buckets]
        assert r.bucket_count == len(sizes)
        assert r.estimate_per_size == model.per_size()
        largest = max(sizes, default=0)
        assert r.estimate_classic == sum(sizes) - largest + largest // 2
    assert (rows[100].bucket_count, rows[100].estimate_per_size) == (9, 68)


def test_estimates_are_near_exact_counts(spark):
    rows = bit_rows(3, 900)
    df = spark.createDataFrame(rows, BIT_SCHEMA)
    counted = G.dgim_count(df, ["k"], 300)
    exact = trailing_count(df, ["k"], 300).withColumnRenamed("timestamp", "last_time")
    for r in counted.join(exact, ["k", "last_time"]).collect():
        assert abs(r.estimate_classic - r.ones_in_window) <= 0.5 * r.ones_in_window + 1
