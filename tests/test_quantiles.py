from __future__ import annotations

import random

import numpy as np
import pytest

from meterlens.operators.quantiles import exact_quantiles

PROBS = {"p0": 0.0, "p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p100": 1.0}


@pytest.mark.parametrize("few_keys", [False, True])
def test_equal_to_numpy(spark, few_keys):
    rng = random.Random(7)
    groups = {
        "spread": [rng.gauss(0, 1) * 10 ** rng.randrange(-6, 7) for _ in range(500)],
        "copies": [rng.choice([0.0, 1.5, 1.5, 2.25]) for _ in range(300)],
        "tiny": [rng.random() * 1e-9 for _ in range(101)],
        "negative": [-rng.random() * 100 for _ in range(64)],
        "single": [3.25],
        "pair": [1.0, 2.0],
        "huge": [1e307, -1e307, 1e305, 4.0],
    }
    rows = [(k, x) for k, values in groups.items() for x in values]
    rows += [("spread", None), ("empty", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double").repartition(3)
    got = {r.k: r for r in exact_quantiles(df, ["k"], "x", PROBS, few_keys).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, q in PROBS.items():
            expected = np.percentile(values, q * 100)
            assert got[k][name] == pytest.approx(expected, rel=1e-12, abs=1e-300), (k, name)


def test_two_keys_and_integers(spark):
    rows = [(i % 2, i % 3, i) for i in range(90)]
    df = spark.createDataFrame(rows, "a int, b int, v int")
    for r in exact_quantiles(df, ["a", "b"], "v", {"q": 0.3}).collect():
        values = [v for a, b, v in rows if (a, b) == (r.a, r.b)]
        assert r.q == pytest.approx(np.percentile(values, 30))


def test_nan_is_left_out(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 3.0)], "k int, v double")
    assert exact_quantiles(df, ["k"], "v", {"p50": 0.5}).first()["p50"] == 2.0
