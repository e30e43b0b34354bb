"""From raw documents to a tokenized training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of documents, whatever they are called. A stage's rows are written as Parquet before
the next stage reads them. A stage learns from its own input. Unless the
session has a limit for Arrow batches of its own, it gets a small one: a stage's rows are read
after the stage has returned.

Null, empty and very long texts: language ID rejects texts without a letter, every other stage
takes a text as it is. Copies, repeated rows among them, leave one document. Ties go to the
smaller id. Empty documents give no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.llm.bpe import encode_documents
from meterlens.llm.common import read_table, remainder
from meterlens.llm.langid import UNDETERMINED, predict_languages, train_language_model
from meterlens.llm.minhash import near_duplicates
from meterlens.llm.mixing import apply_mix, mix_to_targets
from meterlens.llm.queries import TOKENIZER
from meterlens.llm.secrets import find_secrets, redact
from meterlens.storage import durable, limit_batches, recorded, remove_tables

#: A text is rejected whose likeliest language has less than this calibrated probability.
MIN_LANGUAGE_SCORE = 0.35


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns called by number, none like an operator's own, and their names."""
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def named(rows: DataFrame, names: dict[str, str], **changed: Column) -> DataFrame:
    """The columns by their names again, those in ``changed`` with new values."""
    return rows.select(*[changed.get(c, F.col(n)).alias(c) for c, n in names.items()])


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter or a likely language; fill in a missing ``lang``."""
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = train_language_model(docs.where(~held), key=F.col("doc_id"))
    rows, at = numbered(docs)
    predicted = predict_languages(rows, model, at["text"], keep=tuple(rows.columns))
    likely = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return named(predicted.where(likely), at, lang=F.coalesce(at["lang"], "lang_pred"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group, and all without an id."""
    with recorded() as made:
        kept = durable(near_duplicates(docs).where("kept").groupBy("doc_id").agg(
            F.count("*").alias("n")))
    remove_tables(spark, made[:-1])  # all but the ids kept
    once = docs.join(kept.where("n = 1").select("doc_id"), "doc_id", "left_semi")
    # Rows that repeat an id are one document: the least of them stays.
    rest = [c for c in docs.columns if c != "doc_id"]
    repeated = (
        docs.join(kept.where("n > 1").select("doc_id"), "doc_id", "left_semi")
        .groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", "row.*")
    )
    unnamed = docs.where("doc_id is null")
    return once.select(*docs.columns).unionByName(repeated).unionByName(unnamed)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; no document goes."""
    rows, at = numbered(docs)
    found = find_secrets(rows, at["text"], keep=tuple(rows.columns))
    clean = redact(found.drop("base"), "spans", at["text"])
    length = F.when(F.size("spans") > 0, F.length(at["text"]).cast("long"))
    return named(clean, at, n_chars=F.coalesce(length, at["n_chars"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's words near its target: documents repeat, or go."""
    rows, at = numbered(docs)
    rest = tuple(c for c in rows.columns if c != at["doc_id"])
    mixed = mix_to_targets(rows, at["source"], at["text"], key=at["doc_id"], keep=rest)
    return named(apply_mix(mixed, at["text"], at["n_chars"]), at)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """``stage`` with whole texts handed to Python in small batches, also when its rows are read."""
    @functools.wraps(stage)
    def limited(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        limit_batches(spark)
        return stage(spark, docs, sf_dir)

    return limited


STAGES: list[tuple[str, Stage]] = [
    ("language_id", in_small_batches(identify_languages)),
    ("near_dedup", in_small_batches(drop_near_duplicates)),
    ("secret_scan", in_small_batches(redact_secrets)),
    ("source_mix", in_small_batches(mix_sources)),
    ("bpe", in_small_batches(encode)),
]

#: No SQL: the trained model, the test battery and the tokenizer have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before: list[str] = []
    for _, stage in STAGES[:-1]:
        with recorded() as made:
            docs = durable(stage(spark, docs, sf_dir))
        # What this stage read and made on its way is done with; its rows are the last table.
        remove_tables(spark, before + made[:-1])
        before = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
