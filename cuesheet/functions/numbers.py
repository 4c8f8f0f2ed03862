"""Numbers: rounding, clamping, unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(x: Column, digits: int) -> Column:
    """x rounded half up on its first twelve decimals, as a double: the same in every engine that has decimals."""
    return F.round(x.cast("decimal(30,12)"), digits).cast("double")


def clamp01(x: Column) -> Column:
    """x within 0 to 1; null if it is null, which greatest and least would pass over."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def conf_to_unit(conf: Column) -> Column:
    """A confidence of 0 to 100 as 0 to 1; null counts as one half."""
    return F.coalesce(clamp01(conf / 100.0), F.lit(0.5))


def ms_to_seconds(x: Column) -> Column:
    """Milliseconds, as a number or text, in seconds; null and what is no number are 0."""
    return F.coalesce(F.try_divide(x.try_cast("double"), F.lit(1000.0)), F.lit(0.0))


def trim_seconds(max_seconds: Column, max_minutes: Column) -> Column:
    """The smaller of two limits, of which either may be null; null if both are."""
    return F.least(max_seconds, max_minutes * 60.0)


def one_decimal(x: Column) -> Column:
    """A number as text with one decimal, rounded by its exact binary value, of ties to the even digit: 0.85, which is a little less, is 0.8."""
    return F.call_function("format_number", x, F.lit("0.0"))
