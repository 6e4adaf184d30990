"""Nearest vectors by an index of distances to some pivots: blocks that cannot matter stay unread."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.operators.nearest import QUERIES_PER_BLOCK, _closest_in_block, _matrix, _ranked
from rillflow.operators.numbering import dense_ids
from rillflow.session import materialize

#: Folders of the index hold so many blocks.
BLOCKS_PER_PART = 64
#: More folders than this are not listed in a filter.
LISTED_PARTS = 10_000
#: Bounds give way by this much, relatively, to rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class PivotIndex:
    """``vectors(part, block, key, vector)``, ``bounds(block, n, low, high)`` and the pivots themselves."""

    vectors: DataFrame
    bounds: DataFrame
    pivots: np.ndarray
    key: str
    vector: str


def spread_out(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different points, each the farthest from those before it."""
    chosen = points[:1]
    if not len(points):
        return chosen
    distances = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(chosen) < count and distances.max() > 0:
        at = int(np.argmax(distances))
        chosen = np.append(chosen, points[at : at + 1], axis=0)
        distances = np.minimum(distances, np.sqrt(((points - points[at]) ** 2).sum(axis=1)))
    return chosen


def _to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """``[point, pivot]``: the distances, one pivot after the other to hold no more than the points."""
    return np.stack([np.sqrt(((points - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _placed(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            distances = _to_pivots(_matrix(pa.chunked_array([batch.column("vector")]), batch.num_rows), pivots)
            cell = np.argmin(distances, axis=1)
            flat = pa.array(distances.ravel())
            ends = pa.array(np.arange(0, len(flat) + 1, len(pivots)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("vector"),
                    pa.array(cell, pa.int32()),
                    pa.array(distances[np.arange(len(cell)), cell]),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                ["key", "vector", "cell", "near", "d"],
            )

    return run


def build_index(
    vectors: DataFrame, path: str, key: str = "word", vector: str = "vector", pivots: int = 16,
    rows_per_block: int = 1024, sample: int = 1024,
) -> None:
    """Write an index of all ``vectors`` to ``path``.

    The pivots are the most spread out of a ``sample`` of vectors (by the hash of
    the key). Every vector belongs to its nearest pivot; sorted by that and by
    the distance to it, the vectors are cut into blocks of ``rows_per_block``. Of
    each block the index keeps the least and greatest distance to every pivot.
    Rows without a vector are left out; vectors must be of one length.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull())
    some = rows.orderBy(F.xxhash64("key"), "key").limit(sample).select("vector").toArrow()
    points = _matrix(some["vector"], some.num_rows) if some.num_rows else np.zeros((0, 1))
    chosen = spread_out(points, pivots)
    key_type = rows.schema["key"].dataType.simpleString()
    placed = rows.mapInArrow(_placed(chosen), f"key {key_type}, vector array<double>, cell int, near double, d array<double>")
    numbered = dense_ids(materialize(placed, "pivot-placed"), ["cell", "near", "key"], "_nr")
    blocks = numbered.withColumn("block", F.floor(F.col("_nr") / F.lit(rows_per_block)).cast("long"))
    blocks = materialize(blocks.select("block", "key", "vector", "d"), "pivot-blocks")
    low, high = ([f(F.col("d")[j]) for j in range(len(chosen))] for f in (F.min, F.max))
    blocks.groupBy("block").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*low).cast("array<double>").alias("low"),
        F.array(*high).cast("array<double>").alias("high"),
    ).write.mode("overwrite").parquet(f"{path}/bounds")
    part = F.floor(F.col("block") / F.lit(BLOCKS_PER_PART)).cast("int")
    parts = blocks.select("block", "key", "vector", part.alias("part")).hint("rebalance", "part")
    writer = parts.sortWithinPartitions("part", "block").write.mode("overwrite").partitionBy("part")
    writer.option("parquet.bloom.filter.enabled#key", "true").parquet(f"{path}/vectors")
    pivot_rows = [(j, [float(x) for x in p]) for j, p in enumerate(chosen)]
    spark.createDataFrame(pivot_rows, "nr int, vector array<double>").write.mode("overwrite").parquet(f"{path}/pivots")


def open_index(spark: SparkSession, path: str, key: str = "word", vector: str = "vector") -> PivotIndex:
    """The index that :func:`build_index` wrote to ``path``."""
    pivots = [row.vector for row in spark.read.parquet(f"{path}/pivots").orderBy("nr").collect()]
    bounds = spark.read.schema("block long, n long, low array<double>, high array<double>").parquet(f"{path}/bounds")
    if not pivots:
        empty = spark.createDataFrame([], "block long, key string, vector array<double>, part int")
        return PivotIndex(empty, bounds, np.zeros((0, 1)), key, vector)
    return PivotIndex(spark.read.parquet(f"{path}/vectors"), bounds, np.array(pivots), key, vector)


def _bounded(batch: pa.RecordBatch, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block numbers; ``[query, block]``: no vector of the block is nearer than the one or farther than the other."""
    low, high = (_matrix(pa.chunked_array([batch.column(c)]), batch.num_rows) for c in ("low", "high"))
    least, most = np.zeros((len(distances), len(low))), np.full((len(distances), len(low)), np.inf)
    for j in range(distances.shape[1]):
        own = distances[:, j][:, None]
        np.maximum(least, np.maximum(low[:, j] - own, own - high[:, j]), out=least)
        np.minimum(most, own + high[:, j], out=most)
    slack = SLACK * (1 + most)
    return batch.column("block").to_numpy(), least - slack, most + slack


def _pairs(queries: np.ndarray, blocks: np.ndarray, least: np.ndarray, most: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(queries, pa.int32()), pa.array(blocks, pa.int64()), pa.array(least), pa.array(most)],
        ["nr", "block", "least", "most"],
    )


PAIRS = "nr int, block long, least double, most double"


def _first_blocks(distances: np.ndarray, count: int):
    """Of every batch of bounds, per query the ``count`` blocks that may hold the nearest, and the farthest one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                blocks, least, most = _bounded(batch, distances)
                take = min(count, len(blocks))
                near = np.argsort(least, axis=1, kind="stable")[:, :take]
                chosen = np.concatenate([near, np.argmax(most, axis=1)[:, None]], axis=1)
                nr = np.repeat(np.arange(len(distances)), take + 1)
                at = chosen.ravel()
                yield _pairs(nr, blocks[at], least[nr, at], most[nr, at])

    return run


def _other_blocks(distances: np.ndarray, reach: np.ndarray, farthest: np.ndarray):
    """The blocks that may hold a vector within a query's reach, or one beyond the farthest it knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                blocks, least, most = _bounded(batch, distances)
                nr, at = np.nonzero((least <= reach[:, None]) | (most > farthest[:, None]))
                yield _pairs(nr, blocks[at], least[nr, at], most[nr, at])

    return run


def _read(index: PivotIndex, pairs: DataFrame, known: DataFrame, schema: str) -> DataFrame:
    """The closest vectors of each query in its blocks; other blocks are not read."""
    parts = pairs.select(F.floor(F.col("block") / F.lit(BLOCKS_PER_PART)).cast("int").alias("part")).distinct()
    listed = [row.part for row in parts.limit(LISTED_PARTS + 1).collect()]
    rows = index.vectors
    if len(listed) <= LISTED_PARTS:
        rows = rows.filter(F.col("part").isin(listed))
    rows = rows.join(pairs.select("block").distinct(), "block", "left_semi").select("block", "key", "vector")
    asking = pairs.join(known, "nr").select("block", "query", "n", "point")
    return asking.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(_closest_in_block, schema)


def nearest_indexed(
    index: PivotIndex, queries: DataFrame, first_blocks: int = 2, queries_per_block: int = QUERIES_PER_BLOCK
) -> tuple[DataFrame, DataFrame]:
    """The n nearest of each of ``queries(word, n)``, as ``nearest.nearest_many`` has them, and ``(query, block)`` read.

    By the triangle inequality the distances to the pivots bound those to all
    vectors of a block. A query first reads the ``first_blocks`` blocks with the
    least lower bounds and the one with the greatest upper bound; that gives a
    reach within which its n nearest lie, and a distance that the farthest
    vector has at least. Then it reads the blocks whose bounds leave either open.
    The result is exact. Queries go in blocks of ``queries_per_block``, whose
    distances to the pivots go to all tasks.
    """
    key_type = index.vectors.schema["key"].dataType.simpleString()
    schema = f"query {key_type}, n int, key {key_type}, distance double, farthest double"
    asked = queries.select(F.col("word").cast(key_type).alias("query"), F.col("n").cast("int").alias("n")).distinct()
    points = asked.join(index.vectors.select(F.col("key").alias("query"), F.col("vector").alias("point")), "query", "left")
    points = materialize(points, "pivot-points")
    known = points.filter(F.col("point").isNotNull() & (F.col("n") > 0))
    known = materialize(dense_ids(known, ["query", "n", "point"], "_nr"), "pivot-queries")
    parts, read = None, None
    for start in range(0, known.count(), queries_per_block):
        block = known.filter((F.col("_nr") >= start) & (F.col("_nr") < start + queries_per_block))
        block = block.select((F.col("_nr") - start).cast("int").alias("nr"), "query", "n", "point")
        found, pairs = _of_block(index, block, first_blocks, schema)
        named = pairs.join(block, "nr").select("query", "block")
        parts, read = (found, named) if parts is None else (parts.unionByName(found), read.unionByName(named))
    if parts is None:
        spark = queries.sparkSession
        parts, read = spark.createDataFrame([], schema), spark.createDataFrame([], f"query {key_type}, block long")
    return _ranked(parts, points, index.key, key_type), read


def _of_block(index: PivotIndex, block: DataFrame, first_blocks: int, schema: str) -> tuple[DataFrame, DataFrame]:
    held = block.orderBy("nr").select("point", "n").toArrow()
    distances = _to_pivots(_matrix(held["point"], held.num_rows), index.pivots)
    offered = index.bounds.mapInArrow(_first_blocks(distances, first_blocks), PAIRS)
    by_least = Window.partitionBy("nr").orderBy("least", "block")
    by_most = Window.partitionBy("nr").orderBy(F.desc("most"), "block")
    first = offered.distinct().select(
        "nr", "block", F.row_number().over(by_least).alias("_near"), F.row_number().over(by_most).alias("_far")
    )
    first = materialize(first.filter((F.col("_near") <= first_blocks) | (F.col("_far") == 1)).select("nr", "block"), "pivot-first")
    found = materialize(_read(index, first, block, schema), "pivot-found")
    reach, farthest = np.full(held.num_rows, np.inf), np.zeros(held.num_rows)
    nearest_first = Window.partitionBy("query", "n").orderBy("distance", "key")
    ranked = found.withColumn("rank", F.row_number().over(nearest_first)).groupBy("query", "n").agg(
        F.max(F.when(F.col("rank") == F.col("n"), F.col("distance"))).alias("reach"), F.max("farthest").alias("farthest")
    )
    for row in ranked.join(block.select("nr", "query", "n"), ["query", "n"]).collect():
        reach[row.nr] = np.inf if row.reach is None else row.reach
        farthest[row.nr] = row.farthest
    rest = index.bounds.mapInArrow(_other_blocks(distances, reach, farthest), PAIRS).select("nr", "block")
    rest = materialize(rest.join(first, ["nr", "block"], "left_anti"), "pivot-rest")
    more = _read(index, rest, block, schema)
    return found.unionByName(more), first.unionByName(rest)
