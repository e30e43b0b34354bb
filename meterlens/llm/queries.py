"""The operators of this subpackage over their whole tables, with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.llm.bpe import encode_documents
from meterlens.llm.common import read_table, remainder
from meterlens.llm.digests import edited_fingerprints
from meterlens.llm.langid import predict_languages, train_language_model
from meterlens.llm.minhash import near_duplicates
from meterlens.llm.mixing import mix_to_targets
from meterlens.llm.neighbours import nearest
from meterlens.llm.pitman_yor import score_texts
from meterlens.llm.ranking import rank_documents
from meterlens.llm.resampling import resample
from meterlens.llm.secrets import find_secrets
from meterlens.llm.simhash import simhash_groups
from meterlens.llm.suffixes import remove_repeats
from meterlens.llm.warc import derive_records, responses_of_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[function.__name__] = function
    return function


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"))


@query
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_targets(read_table(spark, sf_dir, "documents"))


@query
def op7_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = derive_records(responses_of_pages(read_table(spark, sf_dir, "pages")), ("page_id",))
    return records.select(
        "page_id", "record_type", "record_id", "refers_to", "concurrent_to", "target_uri",
        "date", "content_type", "payload_digest", "block_digest", "content_length",
        F.sha2("block", 256).alias("block_sha256"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    model = train_language_model(docs.where(~held), key=F.col("doc_id"))
    return predict_languages(docs.withColumn("held_out", held), model, keep=("doc_id", "held_out"))


@query
def op3_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


@query
def op4_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


@query
def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(remainder("doc_id", 5) == 1, F.lit(False))
    return score_texts(read_table(spark, sf_dir, "documents"), held)


@query
def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents"))


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# The parts of the results above that SQL can express, through the same operators.


@query
def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_secret_scan(spark, sf_dir).drop("spans")


@query
def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_improbable_features(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


@query
def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op6_source_mix(spark, sf_dir)
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


@query
def base_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = op1_pitman_yor(spark, sf_dir)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                         F.round("base_score", 5).alias("base_score"))
