"""Ranked search against a score computed document by document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from meterlens.llm import ranking
from meterlens.llm.ranking import Shard, rank_documents, shards

TERM = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def model(docs, items, top):
    found = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in found if c)
    total = sum(c.total() for _, c in found)
    held = Counter(w for _, c in found for w in c)
    rows = []
    for item, text in items:
        scores = []
        for doc, counts in found:
            m = 50 + 50 * counts.total() * n_docs // max(1, total)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[w] + 1)))
                * (10**9 * counts[w] // (1000 * counts[w] + 20 * m))
                for w in set(terms(text)) if w in counts)
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        rows += [(item, rank, None if none else doc, -score)
                 for rank, (score, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(map(repr, rows))


def prose(rng, n):
    # A few words are in nearly every text, most in few.
    return " ".join(f"W{min(int(rng.expovariate(0.02)), 900)}" if rng.random() < 0.6
                    else rng.choice(["the", "of", "une", "Été"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(9)
    texts = [None, "", "...", "the", "THE the", prose(rng, 50_000), "a-b_c[d]e\x00f"]
    texts += [prose(rng, rng.randrange(1, 80)) for _ in range(400)]
    rows = list(enumerate(texts))
    # Equal texts give ties; a repeated row and a missing id.
    return rows + [(1000 + i, rows[20][1]) for i in range(70)] + [rows[30], (None, rows[31][1])]


@pytest.fixture(scope="module")
def items(docs):
    rng = random.Random(4)
    return [(1, docs[20][1]), (2, "the of"), (3, None), (4, ""), (5, "absent"), (6, "d e the THE"),
            (None, docs[40][1]), (7, docs[5][1]), *[(10 + i, prose(rng, 25)) for i in range(20)],
            (8, docs[50][1]), (8, docs[51][1])]


SCHEMA = "{} long, text string, id int, score string, rank string, n int, number int, terms int, salt int"


def tables(spark, docs, items):
    def table(name, rows):
        return spark.createDataFrame([(i, t, 1, "s", "r", 2, 3, 4, 5) for i, t in rows], SCHEMA.format(name))

    return table("doc_id", docs), table("item_id", items)


@pytest.mark.parametrize("top", [50, 3])
def test_equal_to_the_model(spark, docs, items, top):
    d, i = tables(spark, docs, items)
    got = rank_documents(d.repartition(3), i, top=top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(repr, map(tuple, got.collect()))) == model(docs, items, top)


def test_items_in_blocks(spark, docs, items, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_TERMS", 100)
    got = rank_documents(*tables(spark, docs, items[:12]))
    assert sorted(map(repr, map(tuple, got.collect()))) == model(docs, items[:12], 50)


def test_empty_tables(spark, docs, items):
    d, i = tables(spark, docs, items)
    assert rank_documents(d.where("false"), i).count() == 0
    assert rank_documents(d, i.where("false")).count() == 0


@pytest.mark.parametrize("run, share", [(4, 1 / 16), (16, 0.0), (64, 0.9)])
def test_skipping_loses_nothing(monkeypatch, run, share):
    """Short and long lists in any mixture, thresholds that rise, ties at the threshold."""
    monkeypatch.setattr(ranking, "RUN", run)
    monkeypatch.setattr(ranking, "LONG", share)
    rng = np.random.default_rng(8)
    for trial in range(60):
        n, v = int(rng.integers(1, 200)), 12
        dense = rng.random(v) * rng.random()
        grid = rng.integers(1, 4, (n, v)) * (rng.random((n, v)) < dense)
        doc, term = np.nonzero(grid)
        weights = rng.integers(0, 5, v) * 1000
        norm = rng.integers(1, 3, n) * 50
        shard = Shard(doc, term, grid[doc, term], norm, weights)
        wanted = rng.choice(v, rng.integers(1, v), replace=False)
        count = grid[:, wanted]
        scores = (weights[wanted] * (ranking.SCALE * count // (
            1000 * count + 20 * norm[:, None]))).sum(axis=1)
        top = int(rng.integers(1, 30))
        threshold = int(rng.choice([1, np.median(scores) + 1]))
        docs, found = shard.best(wanted, threshold, top)
        assert (scores[docs] == found).all() and len(set(docs.tolist())) == len(docs)
        best = sorted(scores[scores >= threshold].tolist(), reverse=True)
        cut = best[top - 1] if len(best) > top else threshold
        assert set(np.flatnonzero(scores >= max(cut, threshold))) <= set(docs.tolist())


def test_shards_are_bounded(monkeypatch):
    monkeypatch.setattr(ranking, "SHARD_DOCS", 5)
    monkeypatch.setattr(ranking, "SHARD_POSTINGS", 12)
    rows = [[i, 3, list(range(i % 6)), [1] * (i % 6)] for i in range(60)] + [[60, 30, list(range(20)), [1] * 20]]
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                        ("counts", pa.list_(pa.int64()))])
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
    got = list(shards(iter(table.to_batches(max_chunksize=7)), 61, 300, np.ones(20, np.int64)))
    assert [i for ids, _ in got for i in ids.to_pylist()] == list(range(61))
    for ids, shard in got:
        assert len(ids) <= 5 and (len(shard.docs) <= 12 or len(ids) == 1)
    assert sum(len(shard.docs) for _, shard in got) == sum(len(r[2]) for r in rows)
