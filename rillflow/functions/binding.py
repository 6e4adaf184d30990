"""Columns that are computed in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep: list[str] | str = "*", **columns: Column) -> DataFrame:
    """Add columns through a one-row generator.

    Conditions on a projected column are pushed below the projection with the
    whole expression inside. For costly expressions that several conditions or
    columns use, the generator keeps one evaluation per row; it needs no shuffle.
    """
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [keep] if isinstance(keep, str) else keep
    return df.select(*kept, F.inline(F.array(values)))
