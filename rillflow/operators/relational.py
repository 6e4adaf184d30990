"""Queries on tables whose numbers arrive as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions.casts import lenient_int


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def with_int(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Add the lenient integer value of a text column."""
    return df.withColumn(name or f"{column}_int", lenient_int(F.col(column)))


def ballot_order(ballots: DataFrame) -> DataFrame:
    """The candidates in the order of the ballot, which is text and sorts as text."""
    pairs = distinct_values(ballots, "candidate_name", "candidate_ballot_order")
    return pairs.orderBy("candidate_ballot_order", "candidate_name")


def friendly_order(ballots: DataFrame, names: DataFrame) -> DataFrame:
    """The ballot order in words. The distinct pairs are few, so they meet the lookup late."""
    return (
        distinct_values(ballots, "candidate_name", "candidate_ballot_order")
        .join(names, "candidate_ballot_order")
        .select("candidate_name", "friendly_name")
    )


def total_of(df: DataFrame, column: str) -> DataFrame:
    """The sums over all rows of a text column's integer values and of every numeric column."""
    return with_int(df, column, f"{column}_int").groupBy().sum()


def total_by(df: DataFrame, key: str, column: str, name: str = "sum_column") -> DataFrame:
    """Sums per key, the highest first."""
    sums = df.groupBy(key).agg(F.sum(lenient_int(F.col(column))).alias(name))
    return sums.orderBy(F.desc(name), key)


def top_valid_group(df: DataFrame, code: str, key: str, column: str) -> DataFrame:
    """The key with the highest sum among the rows whose code is a number."""
    physical = df.filter(lenient_int(F.col(code)).isNotNull())
    return total_by(physical, key, column).limit(1)
