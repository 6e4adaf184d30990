"""Expressions on arrays that hold sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def n_common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def n_combined(a: Column, b: Column) -> Column:
    return F.size(F.array_union(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """Common over combined members; 0 for two empty sets."""
    total = n_combined(a, b)
    return F.when(total > 0, n_common(a, b).cast("double") / total.cast("double")).otherwise(
        F.lit(0.0)
    )


def quite_similar(a: Column, b: Column, threshold: float) -> Column:
    """Strictly more common members than ``threshold`` of the combined ones, in doubles."""
    return n_common(a, b).cast("double") > n_combined(a, b).cast("double") * F.lit(float(threshold))


def different(a: Column, b: Column, fields: list[str]) -> Column:
    """Whether two structs differ in at least one of the given fields."""
    unequal = F.lit(False)
    for field in fields:
        unequal = unequal | ~a[field].eqNullSafe(b[field])
    return unequal


def more_members_than(members: Column, n: int) -> Column:
    return F.size(members) > n
