"""Running sums inside groups of any size, without a task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same(left: Column, right: Column) -> Column:
    """Equality under which null equals null."""
    return left.eqNullSafe(right)


def fraction(hashed: Column) -> Column:
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(1 << 53))


def least_hashed(rows: DataFrame, count: int, hashed: str, ties: list[str], n: int) -> DataFrame:
    """The ``n`` of ``count`` different rows with the smallest 64-bit ``hashed`` values, as unsigned numbers.

    A bound on the hash leaves about 4 n rows of the whole table, so that the task
    that picks gets those and not n rows from each task before it. That fewer than
    n are left has no practical chance (four times as many are expected).
    """
    at = fraction(F.col(hashed))
    few = rows.filter(at < F.lit(min(1.0, 4.0 * max(n, 100) / max(count, 1))))
    return few.orderBy(at, *ties).limit(n)


def running_sum(rows: DataFrame, group: str, hashed: str, ties: list[str], value: str, name: str) -> DataFrame:
    """``rows`` plus ``name``: the sum of ``value`` over the rows before it in its group.

    The order in a group is that of the 64-bit ``hashed`` column (as an unsigned
    fraction), then of ``ties``. A group of n rows is cut at fixed fractions into
    about sqrt(n) chunks; the sums of the chunks are added up per group and the
    rows per chunk, so neither step holds more than about sqrt(n) rows of a group
    together. ``rows`` is read twice and should be a stored, narrow table. A null
    group is a group like any other.
    """
    sizes = rows.groupBy(F.col(group).alias("_group")).agg(
        F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("_chunks")
    )
    cut = (
        rows.join(sizes, same(F.col(group), F.col("_group")), "left")
        .withColumn("_at", fraction(F.col(hashed)))
        .withColumn("_chunk", F.floor(F.col("_at") * F.col("_chunks")))
        .drop("_chunks", "_group")
    )
    earlier = Window.partitionBy("_of").orderBy("_nr").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        cut.groupBy(F.col(group).alias("_of"), F.col("_chunk").alias("_nr"))
        .agg(F.sum(value).alias("_sum"))
        .select("_of", "_nr", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(group, "_chunk").orderBy("_at", *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(sums, same(F.col(group), F.col("_of")) & (F.col("_chunk") == F.col("_nr")), "left")
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop("_at", "_chunk", "_inside", "_of", "_nr", "_offset")
    )
