"""Guarded arithmetic, bins and classes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlens.schema import SIZE_CLASSES, TEMPERATURE_LABELS, WEEKDAY_NAMES


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, 0 when the whole is not positive."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; null where either side is constant.

    ``corr`` divides by zero there, which ANSI mode turns into an error.
    """
    both = x.isNotNull() & y.isNotNull()
    sx = F.stddev_pop(F.when(both, x))
    sy = F.stddev_pop(F.when(both, y))
    return F.when((sx > 0) & (sy > 0), F.covar_pop(x, y) / (sx * sy))


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int = 5) -> Column:
    """1-based right-closed bin of ``x`` in [lo, hi]; the minimum belongs to bin 1.

    When all values are equal they fall into the middle bin.
    """
    inside = F.ceil((x - lo) * bins / (hi - lo))
    return F.when(x.isNull(), None).when(
        hi > lo, F.greatest(F.lit(1), F.least(F.lit(bins), inside))
    ).otherwise(F.lit((bins + 1) // 2)).cast("int")


def temperature_label(bin_number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in TEMPERATURE_LABELS]), bin_number)


def size_class(area: Column) -> Column:
    """Right-closed size class; null for a missing or non-positive area."""
    out = F.when(area.isNull() | (area <= 0), None)
    for name, upper in SIZE_CLASSES:
        out = out.when(area <= upper, F.lit(name))
    return out


def weekday_name(weekday: Column) -> Column:
    names = F.array(*[F.lit(d) for d in WEEKDAY_NAMES])
    return F.when(weekday.between(0, 6), F.element_at(names, weekday + 1))


def severity(deviation: Column) -> Column:
    return F.when(deviation > 4, "HIGH").when(deviation > 3, "MEDIUM").otherwise("LOW")


def label_text(label: Column) -> Column:
    return F.when(label == 1, "Anomaly").otherwise("Normal")


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def reading_context(reference_year: int = 2025) -> list[Column]:
    """Use per area, building age, weekend and business-hours flags of a reading."""
    area = F.col("square_feet")
    return [
        F.when(area > 0, F.col("meter_reading") / area).alias("use_per_area"),
        (F.lit(reference_year) - F.col("year_built")).alias("building_age"),
        (F.col("weekday") >= 5).alias("is_weekend"),
        F.col("hour").between(8, 18).alias("is_business_hours"),
    ]


def fixed_text(x: Column, digits: int) -> Column:
    """``x`` with a fixed number of decimals; exact decimal ties round away from zero."""
    return F.format_string(f"%.{digits}f", x)
