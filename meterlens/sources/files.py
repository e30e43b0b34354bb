"""CSV in, typed tables, CSV and JSON out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.functions.numeric import nan_to_null
from meterlens.schema import READINGS
from meterlens.sources.tables import write_batch, write_readings

# The raw text of a line that does not fit the header.
CORRUPT = "_corrupt_record"
# Columns a reading must have, and fixed values: how missing ones are written.
REQUIRED = ["building_id", "timestamp"]
MISSING = ["", "nan", "null", "none"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a CSV with a header. Without a schema every column stays text."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def head_csv(spark: SparkSession, path: str, rows: int = 1000) -> DataFrame:
    """The first rows of a CSV with types inferred from these alone, for profiling.

    Only the lines asked for are read and held by the driver; the rest of the file is not looked at.
    """
    lines = [r.value for r in spark.read.text(path).limit(rows + 1).collect()]
    reader = spark.read.option("header", True).option("inferSchema", True)
    return reader.csv(spark.sparkContext.parallelize(lines, 1))


def read_csv_checked(
    spark: SparkSession, path: str, columns: list[str] | None = None
) -> DataFrame:
    """Every column of a CSV as text, and the whole line in ``CORRUPT`` where it does not fit.

    ``columns`` names them if the first line of the files is not to be trusted.
    """
    columns = columns or read_csv(spark, path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
    # Pruned columns would not be parsed, and a broken line would pass.
    options = {"header": True, "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
    return spark.read.schema(schema).options(**options).csv(path)


def _typed(field: T.StructField) -> Column:
    source = F.col(field.name)
    if isinstance(field.dataType, T.DoubleType):
        return nan_to_null(source.try_cast("double"))
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        # Integers arrive as "3" or, where pandas met a missing value, as "3.0".
        as_double = nan_to_null(source.try_cast("double"))
        exact = source.try_cast(field.dataType)
        return F.coalesce(exact, as_double.try_cast(field.dataType))
    return source.try_cast(field.dataType)


def _with_time_parts(typed: DataFrame) -> DataFrame:
    derived = {"hour": F.hour, "weekday": F.weekday, "month": F.month}
    for name, part in derived.items():
        if name not in typed.columns:
            typed = typed.withColumn(name, part("timestamp"))
    return typed


def typed_readings(raw: DataFrame) -> DataFrame:
    """Cast text columns to the readings schema; NaN, blanks and bad values become null.

    Missing ``hour``, ``weekday`` and ``month`` are taken from the timestamp. Columns the
    schema does not know are dropped.
    """
    present = [f for f in READINGS.fields if f.name in raw.columns]
    return _with_time_parts(raw.select(*[_typed(f).alias(f.name) for f in present]))


def judged_readings(raw: DataFrame) -> DataFrame:
    """``typed_readings`` with ``line``, ``reasons`` and ``loaded``.

    A reason names the line if it does not fit the header, a required column without a value, or
    a column whose text is not of its type. A row is loaded unless its line does not fit or a
    required value is missing; other bad values are null in it.
    """
    present = [f for f in READINGS.fields if f.name in raw.columns]
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    reasons = [F.when(corrupt, F.lit("line does not fit the header"))]
    fits = ~corrupt
    for field in present:
        written = ~F.lower(F.trim(F.col(field.name))).isin(MISSING)
        bad = ~corrupt & written & _typed(field).isNull()
        told = F.concat(F.lit(f"{field.name}: "), F.col(field.name))
        reason = F.when(F.coalesce(bad, F.lit(False)), told)
        if field.name in REQUIRED:
            absent = ~corrupt & ~F.coalesce(written, F.lit(False))
            reason = reason.when(absent, F.lit(f"{field.name}: missing"))
            fits = fits & _typed(field).isNotNull()
        reasons.append(reason)
    columns = [c for c in raw.columns if c != CORRUPT]
    text = F.to_csv(F.struct(*columns))
    return _with_time_parts(raw.select(
        *[_typed(f).alias(f.name) for f in present],
        (F.coalesce(F.col(CORRUPT), text) if CORRUPT in raw.columns else text).alias("line"),
        F.array_compact(F.array(*reasons)).alias("reasons"),
        fits.alias("loaded"),
    ))


def split_judged(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings to load, quarantine): lines with reasons, also those that were loaded."""
    readings = judged.where("loaded").drop("line", "reasons", "loaded")
    return readings, judged.where(F.size("reasons") > 0).select("line", "reasons", "loaded")


def ingest_features_csv(
    spark: SparkSession, path: str, features_path: str, target: str,
    rejected_path: str | None = None,
) -> DataFrame:
    """Load the features file, which carries every column, into the readings layout.

    ``path`` is the labels-only file. It holds nothing the features file lacks, so its
    rows are not read; only its header is compared. Lines that are not loaded, or not whole,
    go to ``rejected_path`` with their reasons.
    """
    labels = read_csv(spark, path)
    features = read_csv_checked(spark, features_path)
    missing = set(labels.columns) - set(features.columns)
    if missing:
        raise ValueError(f"columns missing from the features file: {sorted(missing)}")
    readings, quarantine = split_judged(judged_readings(features))
    write_readings(readings, target)
    if rejected_path is not None:
        write_batch(quarantine, rejected_path)
    return spark.read.parquet(target)


def export_csv(df: DataFrame, path: str) -> None:
    """Zeros stay zeros; only nulls are written as empty fields."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
