"""Membership in a set too large to broadcast, by a filter of bounded size.

A member sets one bit of a table of 64-bit slots. What finds its bit unset is
surely no member and needs no join; the rest may be one. The filter never
decides a result, only what has to be joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a filter at most (16 bytes each, 67 million bits); the bound on what is broadcast.
MAX_SLOTS = 1 << 20
BITS_PER_MEMBER = 16


def slots_for(members: int, most: int = MAX_SLOTS) -> int:
    """Slots for about 16 bits a member, a power of two up to ``most``."""
    wanted = max(1, members * BITS_PER_MEMBER // 64)
    return min(most, 1 << (wanted - 1).bit_length())


def _place(column: str, slots: int) -> tuple[Column, Column]:
    """The slot of a value and its bit there, from different parts of one hash."""
    hashed = F.xxhash64(column)
    return F.pmod(hashed, F.lit(slots)).cast("int"), F.shiftrightunsigned(hashed, 40).bitwiseAND(F.lit(63)).cast("int")


def member_filter(members: DataFrame, column: str, slots: int) -> DataFrame:
    """``_slot``, ``_bits``: at most ``slots`` rows, however many members there are."""
    slot, bit = _place(column, slots)
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return members.groupBy(slot.alias("_slot")).agg(F.bit_or(mask).alias("_bits"))


def flagged(rows: DataFrame, column: str, bits: DataFrame, slots: int, name: str = "_maybe") -> DataFrame:
    """``rows`` with ``name``: false where the value is surely no member. No shuffle of the rows.

    A null value is no member.
    """
    if slots > MAX_SLOTS:
        raise ValueError(f"a filter has at most {MAX_SLOTS} slots")
    slot, bit = _place(column, slots)
    told = rows.withColumn("_slot", F.when(F.col(column).isNotNull(), slot)).join(F.broadcast(bits), "_slot", "left")
    found = F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(F.lit(1).cast("bigint"))
    return told.select(*rows.columns, (F.coalesce(found, F.lit(0)) == 1).alias(name))


def without_strangers(rows: DataFrame, column: str, members: DataFrame, max_slots: int = MAX_SLOTS) -> DataFrame:
    """``rows`` without most of those whose value is no member; for a join with the members that follows."""
    slots = slots_for(members.count(), max_slots)
    told = flagged(rows, column, member_filter(members, column, slots), slots)
    return told.filter("_maybe").drop("_maybe")
