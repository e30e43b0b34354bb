"""Similarity digests of improbable features.

Every 32-byte window of a text has a collision entropy, found from the number of equal byte
pairs in it. How rare each value is, over all windows of the corpus, ranks the windows: the
rarer, the more improbable. Windows ranked first among their neighbours, 32 to either side,
are a text's features; repeats of few bytes never are. Features set five bits each in a Bloom
filter of 2048 bits, and a new filter is chained on after 160 features. Two digests are compared
by the share of common bits, less what chance would give.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlens.llm.shingles import BYTE_VALUES, U, mix64, powers

WINDOW = 32
PAIRS = WINDOW * (WINDOW - 1) // 2
#: Windows with more equal pairs hold less than about one bit of collision entropy.
MAX_PAIRS = PAIRS // 2
REACH = 32
FILTER_BITS = 2048
FILTER_FEATURES = 160
FEATURE_BITS = 5
#: Share of the way from chance to full overlap that counts as none.
CUTOFF = 0.3


def equal_pairs(data: np.ndarray) -> np.ndarray:
    """Number of equal byte pairs in each window of ``WINDOW`` bytes.

    Sliding by one adds the equal bytes before the new one and takes away those after the old.
    """
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.int32)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    first = np.bincount(data[:WINDOW], minlength=256)
    change = before[WINDOW:].astype(np.int32) - after[: n - WINDOW]
    out = np.empty(n - WINDOW + 1, np.int32)
    out[0] = (first * (first - 1)).sum() // 2
    np.cumsum(change, out=out[1:])
    out[1:] += out[0]
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` (a power of two) values."""
    done = 1
    while done < width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return values


def features(data: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Hashes of a text's features in order; of the whole text if it has none."""
    pairs = equal_pairs(data)
    n = len(pairs)
    whole = np.array([int.from_bytes(hashlib.blake2b(data.tobytes(), digest_size=8).digest(), "little")], U)
    if not n:
        return whole if len(data) else whole[:0]
    sums = np.concatenate([np.zeros(1, U), np.cumsum(BYTE_VALUES[data] * powers(len(data)), dtype=U)])
    hashed = mix64((sums[WINDOW:] - sums[:-WINDOW]) * powers(n, True))
    # Ties of rank go by hash, so a choice depends on nothing but the neighbouring bytes.
    key = (rank[pairs].astype(U) << U(32)) | (hashed >> U(32))
    edge = np.full(REACH, np.iinfo(np.uint64).max, U)
    around = sliding_min(np.concatenate([edge, key, edge]), 2 * REACH)[:n]
    chosen = np.flatnonzero((key == around) & (pairs <= MAX_PAIRS))
    return hashed[chosen] if len(chosen) else whole


def bloom_chain(hashes: np.ndarray) -> np.ndarray:
    """Filters (rows of bytes) of ``FILTER_FEATURES`` features each."""
    count = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((count, FILTER_BITS), np.uint8)
    row = np.arange(len(hashes)) // FILTER_FEATURES
    for i in range(FEATURE_BITS):
        bits[row, ((hashes >> U(11 * i)) & U(FILTER_BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1)


def fingerprint(data: bytes, rank: np.ndarray) -> tuple[str, np.ndarray]:
    """(``features:filters in base 64``, filters); an empty text has ``0:``."""
    hashes = features(np.frombuffer(data, np.uint8), rank)
    chain = bloom_chain(hashes)
    return f"{len(hashes)}:{base64.b64encode(chain.tobytes()).decode()}", chain


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; 1 for equal digests, 0 against an empty one.

    Each filter of the shorter chain counts with its best partner in the longer one.
    """
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    ones_a, ones_b = np.bitwise_count(a).sum(axis=1), np.bitwise_count(b).sum(axis=1)
    best = np.zeros(len(a))
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(axis=1)
        most = np.minimum(ones_a[i], ones_b)
        chance = ones_a[i] * ones_b.astype(float) / FILTER_BITS
        floor = chance + CUTOFF * (most - chance)
        best[i] = np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1).max()
    # A filter counts by its bits: the last of a chain may be almost empty.
    return float((best * ones_a).sum() / ones_a.sum())


def rarity_ranks(docs: DataFrame, data: str) -> np.ndarray:
    """Rank of each number of equal pairs, the rarest over all windows of all texts first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAIRS + 1, np.int64)
        for batch in batches:
            for d in batch.column(0).to_pylist():
                total += np.bincount(equal_pairs(np.frombuffer(d or b"", np.uint8)), minlength=PAIRS + 1)
        yield pa.RecordBatch.from_pydict(
            {"pairs": pa.array(range(PAIRS + 1), pa.int32()), "n": pa.array(total, pa.int64())})

    rows = docs.select(data).mapInArrow(count, "pairs int, n long").groupBy("pairs").agg(
        F.sum("n").alias("n")).collect()  # PAIRS + 1 rows
    counts = np.zeros(PAIRS + 1, np.int64)
    for row in rows:
        counts[row["pairs"]] = row["n"]
    rank = np.empty(PAIRS + 1, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(PAIRS + 1)
    return rank


def with_neighbours(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, _data, _bucket, _guest, _order, _hash): descending runs of keys that overlap by one.

    Keys are cut into ranges at their quantiles. The first row of each range is also sent, as a guest,
    to the end of the range before it (the first range's to the last), so every row meets its next
    one within a range and no text moves twice. The number of ranges is that of shuffle
    partitions.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.approxQuantile(key, [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    cuts = sorted({int(c) for c in cuts}, reverse=True)
    edges = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    bucket = F.when(F.col(key).isNull(), len(cuts) + 1).otherwise(
        F.size(F.filter(edges, lambda c: c > F.col(key))))
    keyed = docs.select(
        F.col(key), F.coalesce(F.encode(text, "UTF-8"), F.lit(b"")).alias("_data"),
        bucket.alias("_bucket"),
        F.bitwise_not(F.col(key).cast("long")).alias("_order"),  # descending, nulls apart
        F.xxhash64(text).alias("_hash"))
    heads = keyed.groupBy("_bucket").agg(F.min(F.struct("_order", "_hash")).alias("h")).orderBy("_bucket").collect()
    back = {heads[i]["_bucket"]: heads[i - 1]["_bucket"] for i in range(len(heads))}
    rows = [(r["_bucket"], r["h"]["_order"], r["h"]["_hash"], back[r["_bucket"]]) for r in heads]
    table = spark.createDataFrame(rows, "_bucket int, o long, h long, back int")
    # One row per range.
    joined = keyed.join(
        F.broadcast(table), (keyed._bucket == table._bucket) & keyed._order.eqNullSafe(table.o)
        & (keyed._hash == table.h), "left").drop(table._bucket)
    places = F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("g")))
    guest = F.array(F.struct(F.col("back").alias("b"), F.lit(True).alias("g")))
    placed = joined.withColumn("_p", F.explode(
        F.when(F.col("back").isNotNull(), F.concat(places, guest)).otherwise(places)))
    return placed.select(key, "_data", F.col("_p.b").alias("_bucket"), F.col("_p.g").alias("_guest"),
                         "_order", "_hash").repartition(ranges, "_bucket").sortWithinPartitions(
                             "_bucket", "_guest", "_order", "_hash")


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Digest of every text, of its edited text, and their likeness, per row.

    The edited text's last third (rounded down) is the next document's beginning, by
    descending key, after the last the first. Null keys come last, rows that repeat a key
    in the order of a hash of their texts. Null texts are empty. Returns (key, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next); no rows give none.
    """
    rank = rarity_ranks(docs.select(F.encode(text, "UTF-8").alias("d")), "d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (key, text, digest, filters, range) of the row that waits for its next
        for batch in batches:
            out = []
            for k, data, bucket, guest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if last is not None and last[4] != bucket:
                    last = None
                if guest and last is None:
                    continue
                own = data.decode("utf-8", "surrogatepass")
                mark, chain = fingerprint(data, rank)
                if last is not None:
                    before, n = last[1], len(last[1])
                    edited = (before[: n - n // 3] + own[: n // 3]).encode("utf-8", "surrogatepass")
                    edited_mark, edited_chain = fingerprint(edited, rank)
                    out.append((last[0], n, hashlib.sha256(edited).hexdigest(), last[2], edited_mark,
                                likeness(last[3], edited_chain), likeness(last[3], chain)))
                last = None if guest else (k, own, mark, chain, bucket)
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = [batch.schema.types[0], pa.int64(), pa.string(), pa.string(), pa.string(),
                     pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    added = StructType.fromDDL(
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
    schema = StructType(docs.select(key).schema.fields + added.fields)
    names = schema.names
    return with_neighbours(docs, key, text).mapInArrow(run, schema)
