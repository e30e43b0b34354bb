"""Importance resampling against a one-by-one model."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from meterlens.llm.resampling import resample

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = ("doc_id long, text string, weight string, score int, rank int, n_words int, bucket int, "
          "n int, _part int, _place int")


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, 5, 6, 7) for i, t in rows], SCHEMA)


def features(text, ngrams):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return words, [" ".join(words[i:i + n]) for n in range(1, ngrams + 1)
                   for i in range(len(words) - n + 1)]


def model(docs, target, ngrams, buckets, min_words, percent):
    def counts(texts):
        out = [0] * buckets
        for text in texts:
            for f in features(text, ngrams)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(t for _, t in docs), counts(target)
    s_all, t_all = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (s_all + buckets) / ((a + 1) * (t_all + buckets))))
            for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        words, found = features(text, ngrams)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, len(words)])
    eligible = sorted((r for r in rows if r[4] >= min_words),
                      key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    place = {id(r): k for k, r in enumerate(eligible[:percent * len(eligible) // 100], 1)}
    return [(*r[:4], place.get(id(r))) for r in rows]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(6)

    def prose(n):
        return rng.choice([" ", ", ", "-"]).join(
            rng.choice(["Straße", "w1", "W2", "été", "the", "a", "x9", "ÀB"]) + str(rng.randrange(9))
            for _ in range(n))

    texts = [None, "", " .,; ", "\x00\x7f", "word", "..leading and trailing..", prose(60_000)]
    texts += [prose(rng.randrange(1, 60)) for _ in range(150)]
    rows = list(enumerate(texts))
    # Repeated rows, ids that repeat, and an id that is missing.
    return rows + [rows[9], (9, "other text of an old id " * 9), (None, prose(30))]


@pytest.mark.parametrize("ngrams, buckets", [(1, 10_000), (2, 500), (3, 7)])
def test_equal_to_the_model(spark, docs, ngrams, buckets):
    target = [prose for _, prose in docs[20:30]] + [None, "unseen words only"]
    got = resample(table(spark, docs), table(spark, list(enumerate(target))), ngrams=ngrams,
                   buckets=buckets, percent=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    wanted = model(docs, target, ngrams, buckets, 20, 40)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))


def test_order_does_not_depend_on_partitions(spark, docs, monkeypatch):
    from meterlens.llm import resampling

    monkeypatch.setattr(resampling, "ROWS_PER_TASK", 10)
    target = table(spark, [(0, "the été")])
    runs = [sorted(map(repr, map(tuple, resample(
        table(spark, docs).repartition(n), target, min_words=1, percent=100).collect())))
        for n in (1, 5)]
    assert runs[0] == runs[1] == sorted(map(repr, model(docs, ["the été"], 1, 10_000, 1, 100)))


def test_other_columns_are_kept(spark, docs):
    got = resample(table(spark, docs).withColumnRenamed("weight", "w"), table(spark, docs), keep=("w",))
    assert got.columns == ["doc_id", "w", "n_features", "weight", "score", "rank"]
    assert got.where("w = 'x'").count() == len(docs)


def test_empty_tables(spark, docs):
    none = table(spark, docs).where("false")
    assert resample(none, table(spark, docs)).count() == 0
    got = resample(table(spark, docs), none)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, model(docs, [], 1, 10_000, 20, 10)))
