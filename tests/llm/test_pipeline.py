"""The pipeline: extra columns, whole stages, and what it leaves behind."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterlens.llm.queries import TOKENIZER

#: Names that operators use for columns of their own.
CLASHING = ["base", "spans", "candidates", "_text", "size", "target", "taken", "score", "lang_pred",
            "row", "kept", "component_id", "n_shingles"]


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    rng = random.Random(12)
    words = {"en": "the of and with house river which night walking".split(),
             "de": "der und mit haus fluss welche nacht gehen straße".split()}
    rows = []
    for i in range(160):
        lang = "en" if i % 2 else "de"
        rows.append((i, sentence(rng, words[lang] + [f"w{rng.randrange(40)}" for _ in range(9)], 40),
                     lang if i % 3 else None, f"src{i % 4}"))
    rows += [(200, rows[7][1], "en", "src0"), (201, None, "en", "src1"), (202, "", None, "src1"),
             (203, "1234 5678", "en", "src1"), (204, rows[8][1] + " password = abcdefgh123", "de", "src2"),
             (None, sentence(rng, words["en"], 30), "en", None), (9, rows[9][1], "en", "src1")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame = frame.withColumn("n_chars", F.length("text").cast("long"))
    for i, name in enumerate(CLASHING):
        frame = frame.withColumn(name, F.lit(i))
    path = str(tmp_path_factory.mktemp("docs"))
    frame.coalesce(1).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_keep_the_columns(spark, documents):
    """Every stage by itself, on a table with clashing names, against what it must do."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{documents}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, documents).cache()
        assert out.columns == columns and out.schema == docs.schema, name
        kept[name] = [r.asDict() for r in out.collect()]
        assert all(r[c] == i for r in kept[name] for i, c in enumerate(CLASHING)), name
        docs = out
    texts = {r["doc_id"]: r["text"] for r in kept["language_id"]}
    assert not {201, 202, 203} & set(texts) and len(texts) >= 160
    assert all(r["lang"] in ("en", "de") for r in kept["language_id"])
    ids = [r["doc_id"] for r in kept["near_dedup"]]
    assert ids.count(9) == 1 and 200 not in ids and 7 in ids and None in ids
    secret = [r["text"] for r in kept["secret_scan"] if r["doc_id"] in (8, 204)]
    assert not any("abcdefgh123" in t for t in secret)
    assert len(kept["secret_scan"]) == len(ids)
    found = corpus_pipeline.STAGES[-1][1](spark, docs, documents).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    wanted = sorted((str(r["doc_id"]), hashlib.sha256(" ".join(map(str, tokenizer.encode(
        r["text"], add_special_tokens=False).ids)).encode()).hexdigest()) for r in kept["source_mix"])
    assert sorted((str(r["doc_id"]), r["ids_sha256"]) for r in found) == wanted


def test_runs_leave_only_the_last_tables(spark, documents):
    from meterlens.storage import recorded

    with recorded() as made:
        first = corpus_pipeline.run(spark, documents)
    rows = sorted(map(repr, first.collect()))
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    left = [p for p in made if fs.Path(p).getFileSystem(conf).exists(fs.Path(p))]
    assert len(left) < len(made) / 3
    # Another run, on its own tables, leaves the first one's result readable.
    assert sorted(map(repr, corpus_pipeline.run(spark, documents).collect())) == rows
    assert sorted(map(repr, first.collect())) == rows
    assert rows


def test_no_documents(spark, documents, tmp_path):
    spark.read.parquet(f"{documents}/documents.parquet").where("false").write.parquet(
        str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
