"""Expressions on ``array<double>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def add_scaled(a: Column, b: Column, factor: float) -> Column:
    """``a + factor * b`` element by element."""
    return F.zip_with(a, b, lambda x, y: x + y * F.lit(float(factor)))


def similarity_percent(distance: Column, farthest: Column) -> Column:
    """Closeness against the farthest vector in whole percent; null if all coincide."""
    return F.when(farthest > 0, F.floor(F.lit(100.0) * (F.lit(1.0) - distance / farthest)))


def seeded_vector(word: Column, length: int, purpose: str) -> Column:
    """A vector spread evenly over [-1, 1), fixed by the word and its purpose.

    A replayed batch therefore starts its new words from the same values.
    """

    def element(i: Column) -> Column:
        digest = F.md5(F.concat_ws("|", word, F.lit(purpose), i.cast("string")))
        number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
        return number / F.lit(4294967296.0) * F.lit(2.0) - F.lit(1.0)

    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), element)


def column_sums(vector: str, length: int) -> list[Column]:
    """One sum per position; combines map-side, unlike collecting the vectors."""
    return [F.sum(F.col(vector)[i]).alias(f"_s{i}") for i in range(length)]


def from_columns(length: int) -> Column:
    """Put the columns of :func:`column_sums` back together as a vector."""
    return F.array(*[F.col(f"_s{i}") for i in range(length)])
