"""A value and an id in one fixed-width key, so that the greatest is found by a hash aggregate.

``max`` over a struct has no place in a hash table's fixed-width rows and sorts
instead; a decimal has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

_LOWEST = 1 << 31  # what makes every int positive; 0 is left for null
_LAST_ID = (1 << 63) - 1


def packable(value: DataType, tie: DataType) -> bool:
    """Whether :func:`greatest_key` holds values and ids of these types: up to int, and up to bigint."""
    small = (ByteType, ShortType, IntegerType)
    return isinstance(value, small) and isinstance(tie, (*small, LongType))


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(20,0)")


def greatest_key(value: Column, tie: Column) -> Column:
    """One number whose maximum has the greatest value and, of equal ones, the lowest ``tie``; null is lowest."""
    high = F.coalesce(value.cast("bigint") + F.lit(_LOWEST + 1), F.lit(0)).cast("decimal(10,0)")
    low = _whole(_LAST_ID) - tie.cast("decimal(20,0)")
    return (high * _whole(1 << 64) + low).cast("decimal(32,0)")


def key_value(key: Column) -> Column:
    """The int in a key, null if that was null."""
    high = ((key - key % _whole(1 << 64)) / _whole(1 << 64)).cast("bigint")
    return F.when(high > 0, (high - F.lit(_LOWEST + 1)).cast("int"))


def key_tie(key: Column) -> Column:
    """The bigint in a key."""
    return (_whole(_LAST_ID) - key % _whole(1 << 64)).cast("bigint")
