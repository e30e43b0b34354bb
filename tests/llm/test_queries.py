"""The registered text queries: against their SQL twins, and that each of them runs."""

from __future__ import annotations

import hashlib
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

from meterlens.llm.oracle import ORACLES
from meterlens.llm.queries import QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, folder, database, name):
    result = QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    found = database.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    expected = [tuple(repr(r[names.index(c)]) for c in columns) for r in found.fetchall()]
    actual = [tuple(repr(r[c]) for c in columns) for r in result.collect()]
    assert sorted(actual) == sorted(expected)


def rows_of(spark, folder, name):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


def texts_of(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    return {r["doc_id"]: r.asDict() for r in rows}


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_language_model_query(spark, folder):
    docs, rows = texts_of(spark, folder), rows_of(spark, folder, "op1_pitman_yor")
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_secret_query(spark, folder):
    docs, rows = texts_of(spark, folder), rows_of(spark, folder, "op2_secret_scan")
    assert {r["doc_id"] for r in rows} == set(docs)
    for r in rows:
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        counts = {k: sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")}
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == list(counts.values())
        base = ",".join(":".join(s) for s in spans if s[0] != "random")
        assert hashlib.sha256(base.encode()).hexdigest() == r["base_sha256"]


def test_fingerprint_query(spark, folder):
    docs, rows = texts_of(spark, folder), rows_of(spark, folder, "op3_improbable_features")
    by_text = {}
    for r in rows:
        text = docs[r["doc_id"]]["text"] or ""
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert len(rows) == len(docs) and sum(r["near_edited"] for r in rows) > 2 * sum(r["near_next"] for r in rows)


def test_neighbour_query(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in table])
    x = np.array([r["embedding"] for r in table], float)
    found = {}
    for r in rows_of(spark, folder, "op4_collision_counting"):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = 0
    for q, near in found.items():
        scores = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        hits += len({v for _, v, _ in near} & set(ids[order].tolist()))
        assert [rank for rank, _, _ in sorted(near)] == list(range(1, 21))
    assert hits >= 0.9 * 20 * len(found)


def test_mix_query(spark, folder):
    docs, rows = texts_of(spark, folder), rows_of(spark, folder, "op6_source_mix")
    taken, target, largest = {}, {}, max(r["size"] for r in rows)
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        taken[source] = taken.get(source, 0) + r["taken"]
        target[source] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert len(rows) == len(docs) and all(abs(taken[s] - target[s]) <= largest for s in taken)
    again = rows_of(spark, folder, "op6_source_mix")
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_bpe_query(spark, folder):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    docs, rows = texts_of(spark, folder), rows_of(spark, folder, "op7_bpe_chunks")
    assert len(rows) == len(docs)
    for r in rows:
        ids = tokenizer.encode(docs[r["doc_id"]]["text"] or "", add_special_tokens=False).ids
        shown = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(shown.encode()).hexdigest())


def test_language_query(spark, folder):
    docs, rows = texts_of(spark, folder), rows_of(spark, folder, "op10_language_id")
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"] and r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.95 * len(held) > 0
