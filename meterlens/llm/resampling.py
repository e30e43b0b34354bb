"""Documents drawn by importance weights towards a target's distribution of hashed n-grams.

Both corpora are counted over the same buckets of n-gram hashes; a bucket's gain is the log of
how much likelier it is in the target. A document weighs the sum of the gains of its n-grams,
and the draw without replacement takes the highest sums of weight and Gumbel noise, which
depends on the id only.

Tokens and n-grams are Arrow columns: ``ascii_lower``, ``split_pattern_regex``,
``list_flatten`` and ``dictionary_encode`` make the terms; neighbouring dictionary indices,
shifted against each other, make the n-grams; each distinct one is hashed once, and gains are
taken by index and summed by text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlens.llm.arrow_words import Terms, slices, terms_of
from meterlens.storage import durable

NGRAMS = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Rows ordered by one task.
ROWS_PER_TASK = 2_000_000
COUNTED = "bucket int, n long"


def ngram_buckets(terms: Terms, ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every run of 1 to ``ngrams`` consecutive terms, texts ascending.

    The hash of a longer run continues that of its first part, so a distinct pair of (shorter
    run, next term) is hashed once.
    """
    lengths = np.diff(terms.offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    words = [b" " + w.encode() for w in terms.dictionary.to_pylist()]
    hashes = np.array([zlib.crc32(w[1:]) for w in words], np.int64)
    codes = terms.codes.astype(np.int64)
    texts, found = [text], [hashes.take(codes) % buckets]
    runs = codes
    for n in range(2, ngrams + 1):
        if len(codes) < n:
            break
        inside = text[:len(text) - n + 1] == text[n - 1:]
        # ``runs`` holds -1 where no run of n - 1 terms starts; those aren't inside either.
        first, following = runs[:len(inside)][inside], codes[n - 1:][inside]
        pairs, at = np.unique(first * len(words) + following, return_inverse=True)
        start, word = np.divmod(pairs, max(1, len(words)))
        hashes = np.array([zlib.crc32(words[w], int(h)) for w, h in zip(word, hashes[start])], np.int64)
        runs = np.full(len(inside), -1, np.int64)
        runs[inside] = at
        texts.append(text[:len(inside)][inside])
        found.append(hashes.take(at) % buckets)
    texts, found = np.concatenate(texts), np.concatenate(found)
    if ngrams > 1:
        order = np.argsort(texts, kind="stable")
        texts, found = texts[order], found[order]
    return texts, found


def bucket_counts(texts: DataFrame, text: str, ngrams: int, buckets: int) -> np.ndarray:
    """Occurrences of each bucket in all texts: every task sends one row a bucket at most."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                _, found = ngram_buckets(terms_of(part.column(0)), ngrams, buckets)
                total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])

    rows = texts.select(text).mapInArrow(count, COUNTED).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():  # ``buckets`` rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of smoothed target and source shares of each bucket, floored."""
    k = len(source)
    s_all, t_all = int(source.sum()) + k, int(target.sum()) + k
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * s_all) / float((s + 1) * t_all)))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighted(
    docs: DataFrame, gain: np.ndarray, keep: tuple[str, ...], text: str, ngrams: int
) -> DataFrame:
    """``keep``, n_features, n_words and weight (the sum of gains) per row."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                terms = terms_of(part.column(part.num_columns - 1))
                texts, found = ngram_buckets(terms, ngrams, len(gain))
                ends = np.searchsorted(texts, np.arange(part.num_rows + 1))
                sums = np.concatenate([[0], np.cumsum(gain.take(found))])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(np.diff(ends), pa.int64()),
                     pa.array(np.diff(terms.offsets), pa.int64()), pa.array(np.diff(sums[ends]), pa.int64())],
                    names=[*part.schema.names[:-1], "n_features", "n_words", "weight"])

    schema = StructType(docs.select(*keep).schema.fields + StructType.fromDDL(
        "n_features long, n_words long, weight long").fields)
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(weigh, schema)


def gumbel(key: str, seed: int = SEED) -> Column:
    """1000 times Gumbel noise of the id and the seed, floored; a null id counts as empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digits = F.substring(F.sha2(named.cast("binary"), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def numbered(rows: DataFrame, order: list[Column], count: int, name: str) -> DataFrame:
    """``rows`` with their place (from 1) in ``order``, without a task that sees all of them.

    Range partitions are written once with each row's place in its partition; the rows of the
    partitions before are then one number a partition.
    """
    parts = max(1, -(-count // ROWS_PER_TASK))
    schema = StructType(rows.schema.fields + StructType.fromDDL("_part int, _place long").fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)),
                 pa.array(np.arange(done + 1, done + n + 1))], names=schema.names)
            done += n

    placed = durable(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(place, schema))
    sizes = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(
        F.max("_place").alias("n")).collect()}  # one row a range partition
    before, pairs = 0, []
    for part in sorted(sizes):
        pairs.append((part, before))
        before += sizes[part]
    offsets = rows.sparkSession.createDataFrame(pairs, "_part int, _before long")
    return placed.join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_place") + F.col("_before")).drop("_part", "_place", "_before")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
    keep: tuple[str, ...] = (), ngrams: int = NGRAMS, buckets: int = BUCKETS,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``key``, ``keep``, n_features, weight, score and rank per row of ``docs``.

    Of the N rows with ``min_words`` words or more, floor(percent * N / 100) have a rank, from 1
    by descending score and ascending id; the rank of others is null. A null, empty or very long
    text is a text like any other, with as many features as it has. Repeated rows are each
    drawn or not, as rows of their own; a null id hashes as an empty one and comes last in ties.
    No rows give none; an empty target has the smoothed, uniform distribution. Names in ``keep``
    must differ from the added ones; columns not named in it are never read.
    """
    gain = gains(bucket_counts(docs, text, ngrams, buckets), bucket_counts(target, text, ngrams, buckets))
    scored = durable(weighted(docs, gain, (key, *keep), text, ngrams).withColumn(
        "score", F.col("weight") + gumbel(key, seed)))
    eligible = F.col("n_words") >= min_words
    count = scored.where(eligible).count()
    drawn = percent * count // 100
    columns = [key, *keep, "n_features", "weight", "score"]
    ranked = numbered(scored.where(eligible).select(*columns),
                      [F.desc("score"), F.asc_nulls_last(key)], count, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").unionByName(rest)
