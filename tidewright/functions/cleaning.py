"""Text-to-number conversion and null, NaN and sign rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMERIC = "decimal(38,9)"


def safe_number(text: Column, to: str = "double") -> Column:
    """Bad text becomes null instead of an error."""
    return text.try_cast(to)


def comma_number(text: Column, to: str = "double") -> Column:
    """Number written with a decimal comma."""
    return F.regexp_replace(text, ",", ".").try_cast(to)


def blank_to_null(text: Column, *blanks: str) -> Column:
    marks = ("", "nan") if not blanks else blanks
    return F.when(F.trim(text).isin(*marks), None).otherwise(text)


def zero_filled(column: Column, to: str = "double") -> Column:
    """Unparseable or missing becomes 0, then narrowed to ``to``."""
    return F.coalesce(column.try_cast("double"), F.lit(0.0)).cast(to)


def finite_or_zero(column: Column) -> Column:
    """Null, NaN and both infinities become 0; a non-finite ``x`` has ``x - x`` NaN."""
    value = column.cast("double")
    return F.when(value.isNull() | F.isnan(value - value), F.lit(0.0)).otherwise(value)


def null_text_to_blank(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def is_numeric_text(column: Column) -> Column:
    return column.try_cast("double").isNotNull()


def percent_accuracy(real: Column, predicted: Column) -> Column:
    """``max(0, 1 - |real - pred| / |real|) * 100``; null unless both are known.

    The guard matters: Spark's ``greatest`` skips nulls, so an unmeasured hour
    would otherwise be scored 0 %.
    """
    score = (1 - F.abs(real - predicted) / F.nullif(F.abs(real), F.lit(0.0))) * 100
    return F.when(score.isNotNull(), F.greatest(F.lit(0.0), score))


def root_mean_square(a: Column, b: Column) -> Column:
    """Null as soon as either end is null."""
    return F.sqrt((a * a + b * b) / 2)
