"""What several of the text operators share: table readers and word expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Number of runs without ASCII white space, 0 for null; a native expression.

    Dropping every word but its first character leaves one character a word, which is
    cheaper than building an array of words.
    """
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus
