"""Work on key groups of any size: crowded keys cut into chunks, grids of blocks.

Plain equi-joins need none of this: Spark splits the partitions of a hot key at run
time (``spark.sql.adaptive.skewJoin``). Chunks are for joins whose *output* per key
is quadratic, where no key may become one task's work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"

#: Beyond so many partitions of a side several blocks share one; a parameter of :func:`pair_blocks`.
SIDE_PARTITIONS = 400


def crowded_keys(df: DataFrame, keys: Sequence[str], rows_per_chunk: int) -> DataFrame:
    """Every key with more than ``rows_per_chunk`` rows and its number of chunks, ``_chunks``.

    Partial counts go before the shuffle. All such keys are listed, however many;
    the list is joined to, not broadcast by force.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > rows_per_chunk).select(
        *keys, F.ceil(F.col("_n") / F.lit(rows_per_chunk)).cast("int").alias("_chunks")
    )


def spread(df: DataFrame, crowded: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Give each row of a crowded key one of the key's chunks, picked by a hash of ``by``."""
    chunks = F.coalesce(F.col("_chunks"), F.lit(1))
    return (
        df.join(crowded, list(keys), "left")
        .withColumn(SALT, F.pmod(F.xxhash64(*by), chunks).cast("int"))
        .drop("_chunks")
    )


def replicate(df: DataFrame, crowded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeat each row of a crowded key once for every chunk of that key."""
    last = F.coalesce(F.col("_chunks"), F.lit(1)) - 1
    return (
        df.join(crowded, list(keys), "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))
        .drop("_chunks")
    )


def _partition_of(number: int, partitions: int) -> int:
    """Where Spark deals out an int: its Murmur3 hash with seed 42, modulo."""
    mask = 0xFFFFFFFF
    k = number * 0xCC9E2D51 & mask
    k = (k << 15 | k >> 17) & mask
    h = 42 ^ k * 0x1B873593 & mask
    h = (h << 13 | h >> 19) & mask
    h = (h * 5 + 0xE6546B64 & mask) ^ 4
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return (h - (1 << 32) if h >> 31 else h) % partitions


def block_names(blocks: int, most: int = SIDE_PARTITIONS) -> list[int]:
    """Numbers for ``blocks`` blocks that :func:`pair_blocks` with ``spare=1`` deals out evenly, one to a partition."""
    partitions, held, names, number = max(1, min(blocks, most)), {}, [], 0
    quota = -(-blocks // partitions)
    while len(names) < blocks:
        at = _partition_of(number, partitions)
        if held.get(at, 0) < quota:
            held[at] = held.get(at, 0) + 1
            names.append(number)
        number += 1
    return names


def pair_blocks(left: DataFrame, right: DataFrame, blocks: tuple[int, int], work: Callable[[pa.Table, pa.Table], pa.Table],
                schema: str, most: int = SIDE_PARTITIONS, spare: int = 2) -> DataFrame:
    """``work`` on each block of the left rows with each of the right; ``_block`` numbers a row's.

    Every row is shuffled once and packed into its block; blocks meet in a product, pair
    by pair, and no row is repeated for it. ``blocks`` are their numbers on either side.
    A pair is much work on few bytes, so the number of partitions follows them.
    """

    def packed(rows: DataFrame, n: int, name: str) -> DataFrame:
        row = F.struct(*[c for c in rows.columns if c != "_block"])
        dealt = rows.repartition(max(1, min(spare * n, most)), "_block")
        return dealt.groupBy("_block").agg(F.collect_list(row).alias(name)).select(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sides = (pa.Table.from_struct_array(c.slice(i, 1).flatten()) for c in batch.columns)
                yield from work(*sides).to_batches()

    pairs = packed(left, blocks[0], "left").hint("shuffle_replicate_nl").crossJoin(packed(right, blocks[1], "right"))
    return pairs.mapInArrow(run, schema)


def fits(df: DataFrame, max_bytes: int, size: Column) -> bool:
    """Whether the rows of ``df`` have at most ``max_bytes`` bytes in all, ``size`` being a row's."""
    return (df.agg(F.sum(size)).first()[0] or 0) <= max_bytes
