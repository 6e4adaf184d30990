"""Lenient conversions from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_int(text: Column) -> Column:
    """Text to int, null where it is no number; digits after a point are cut off.

    The session's ANSI setting plays no part.
    """
    well_formed = text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]*)$")
    whole = F.regexp_extract(text, r"^([+-]?[0-9]*)", 1)
    return F.when(
        well_formed, F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int"))
    )


def int_or_zero(text: Column) -> Column:
    """Text to int, 0 where it is not exactly an integer."""
    exact = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))
    return F.coalesce(exact, F.lit(0))


def word_and_number(text: Column) -> Column:
    """``word,number[,more]`` to a struct; ``value`` is null where the number is bad."""
    parts = F.split(text, ",")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).alias("word"),
        F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double").alias("value"),
    )
