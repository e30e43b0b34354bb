"""SimHash groups against one-by-one models."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from meterlens.llm import simhash as S

SCHEMA = ("doc_id long, text string, source string, print long, id int, n int, bytes string, "
          "component string, component_id string, least int, own int")


def table(spark, rows):
    return spark.createDataFrame([(i, t, "a", 1, 2, 3, "b", "c", "d", 4, 5) for i, t in rows], SCHEMA)


def model(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def prose(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
    return " ".join(words)


def test_fingerprints_and_groups(spark):
    rng = random.Random(1)
    base = prose(rng, 600)
    texts = [None, "", " \t\x0b ", "one", "ONE", "one two", "a b c", "A\nb\x0cc ", "é É 😀 w",
             "a\x1cb c\x85d e", base, base.upper(), prose(rng, 100_000)]
    texts += [edited(rng, base, k) for k in range(1, 40)]
    texts += [prose(rng, rng.randrange(1, 60)) for _ in range(60)]
    rows = list(enumerate(texts, 5))
    got = {r["doc_id"]: r for r in S.simhash_groups(table(spark, rows)).collect()}
    prints = {i: model(t) for i, t in rows}
    links = [(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3]
    wanted = components(links, prints)
    assert len(set(wanted.values())) < len(set(prints.values())), "no near copies in the test"
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        i: (f"{p:016x}", wanted[i]) for i, p in prints.items()}
    assert got[5]["fingerprint"] == "0" * 16 and got[7]["component_id"] == 5


def near(rng, value, most):
    for bit in rng.sample(range(64), rng.randrange(most + 1)):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("long, block", [(2048, 1024), (40, 16), (4, 3)])
def test_lists_lose_no_link(spark, long, block):
    """Random neighbourhoods and one crowded list, split and in blocks, against all pairs."""
    rng = random.Random(3)
    prints = {near(rng, x, 4) for x in (rng.getrandbits(64) for _ in range(20)) for _ in range(25)}
    crowd = rng.getrandbits(24) << 40
    prints |= {crowd | rng.getrandbits(12) for _ in range(300)}
    prints = np.array(sorted(prints), np.uint64)
    signed = prints.view(np.int64).tolist()
    expected = [
        (signed[i], signed[j]) for i in range(len(prints))
        for j in range(i + 1, len(prints)) if (int(prints[i]) ^ int(prints[j])).bit_count() <= 3
    ]
    df = spark.createDataFrame([(x,) for x in signed], "print long")
    found = [tuple(r) for r in S.links(S.posting_lists(df, long), block=block).collect()]
    assert set(map(frozenset, found)) <= set(map(frozenset, expected))
    assert components(found, signed) == components(expected, signed)


def test_any_three_bytes_may_differ():
    """Each way to differ in three bytes leaves one of the indexed threes equal."""
    from itertools import combinations

    for differing in combinations(range(8), 3):
        assert any(not set(t) & set(differing) for t in S.TRIPLES)


def test_null_ids_repeated_rows_and_hot_fingerprints(spark):
    rows = [(7, "same text here"), (7, "another one entirely"), (9, "another one entirely"),
            (None, "same text here"), (None, "nobody else has this"), (8, "same text here")]
    rows += [(100 + i, "hot hot hot") for i in range(1200)]
    got = sorted(((r["doc_id"], r["component_id"]) for r in S.simhash_groups(
        table(spark, rows)).collect() if (r["doc_id"] or 0) < 100), key=repr)
    # Id 7 has two texts, so both of their groups are its own.
    assert got == sorted([(7, 7), (7, 7), (9, 7), (None, 7), (None, None), (8, 7)], key=repr)
    hot = S.simhash_groups(table(spark, rows)).where("doc_id >= 100")
    assert hot.count() == 1200 and hot.where("component_id <> 100").count() == 0


def test_no_rows(spark):
    assert S.simhash_groups(table(spark, [(1, "x")]).where("doc_id < 0")).count() == 0
