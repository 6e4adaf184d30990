"""Nearest vectors by Euclidean distance, with closeness in percent of the farthest one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.casts import int_or_zero
from rillflow.functions.vectors import euclidean, similarity_percent
from rillflow.operators.joins import pair_blocks

QUERIES_PER_BLOCK = 1_024
VECTORS_PER_BLOCK = 8_192
BROADCAST_BYTES = 16 << 20  # of the vectors asked about


def parse_requests(lines: DataFrame, line: str = "line", default_n: int = 5) -> DataFrame:
    """``word [n]`` lines to ``word``, ``n`` and ``valid``.

    More than two pieces, or an n that is 0 or no number, makes a request invalid.
    """
    parts = F.split(line, " ")
    asked = F.when(F.size(parts) == 2, int_or_zero(parts[1])).otherwise(F.lit(default_n))
    return lines.select(
        F.lower(parts[0]).alias("word"),
        asked.alias("n"),
        ((F.size(parts) <= 2) & (asked != 0)).alias("valid"),
    )


def nearest(vectors: DataFrame, word: object, n: int, key: str = "word",
            vector: str = "vector") -> DataFrame:
    """The n vectors closest to that of ``word``: key, ``distance``, ``percent``.

    The word's own vector enters the plan as a scalar subquery, one value. Each
    task keeps its own n closest, so the shuffle carries n rows per task. An
    unknown word gives no rows; fewer than n others give fewer rows.
    """
    point = vectors.filter(F.col(key) == F.lit(word)).select(vector).scalar()
    beside = vectors.select(key, F.col(vector).alias("_vector"), point.alias("_point"))
    distances = beside.select(key, euclidean(F.col("_vector"), F.col("_point")).alias("distance"))
    farthest = distances.agg(F.max("distance")).scalar()
    closest = (
        distances.filter((F.col(key) != F.lit(word)) & F.col("distance").isNotNull())
        .orderBy("distance", key)
        .limit(n)
    )
    return closest.withColumn("percent", similarity_percent(F.col("distance"), farthest))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype("float64").reshape(rows, -1)


def _closest_in_block(queries: pa.Table, vectors: pa.Table) -> pa.Table:
    """Per query its n closest of the vectors, and the largest distance among them."""
    if not queries.num_rows or not vectors.num_rows:
        return pa.table({
            "query": queries["query"].slice(0, 0), "n": queries["n"].slice(0, 0),
            "key": vectors["key"].slice(0, 0), "distance": pa.array([], "float64"),
            "farthest": pa.array([], "float64"),
        })
    vectors = vectors.take(pc.sort_indices(vectors["key"]))  # of equal distances the lesser key is first
    distinct = vectors["key"].unique()
    codes = pc.index_in(vectors["key"], value_set=distinct).to_numpy()
    own = pc.fill_null(pc.index_in(queries["query"], value_set=distinct), -1).to_numpy()
    wanted = queries["n"].to_numpy()
    points = _matrix(queries["point"], queries.num_rows)
    others = _matrix(vectors["vector"], vectors.num_rows)
    squares = np.zeros((len(points), len(others)))
    for i in range(points.shape[1]):  # in the order of the elements, as the column form does
        gap = others[:, i][None, :] - points[:, i][:, None]
        squares += gap * gap
    distances = np.sqrt(squares, out=squares)
    farthest = distances.max(axis=1)
    distances[own[:, None] == codes[None, :]] = np.inf
    most = min(int(wanted.max()), len(others))
    bound = np.partition(distances, most - 1, axis=1)[:, most - 1]
    row, col = np.nonzero(distances <= bound[:, None])
    other = codes[col] != own[row]
    row, col = row[other], col[other]
    order = np.lexsort((col, distances[row, col], row))
    row, col = row[order], col[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    row, col = row[rank < wanted[row]], col[rank < wanted[row]]
    return pa.table({
        "query": queries["query"].take(row),
        "n": queries["n"].take(row),
        "key": vectors["key"].take(col),
        "distance": pa.array(distances[row, col]),
        "farthest": pa.array(farthest[row]),
    })


def _by_blocks(known: DataFrame, vectors: DataFrame, key: str, vector: str, n_queries: int,
               queries_per_block: int, vectors_per_block: int, schema: str) -> DataFrame:
    n_left = max(1, -(-n_queries // queries_per_block))
    n_right = max(1, -(-vectors.count() // vectors_per_block))

    def block(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int").alias("_block")

    left = known.select("query", "n", "point", block("query", n_left))
    right = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), block(key, n_right))
    return pair_blocks(left, right, (n_left, n_right), _closest_in_block, schema)


def nearest_many(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "word",
    vector: str = "vector",
    queries_per_block: int = QUERIES_PER_BLOCK,
    vectors_per_block: int = VECTORS_PER_BLOCK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The n nearest of each of ``queries(word, n)``.

    Columns: ``query``, ``n``, ``known``, ``rank``, the key, ``distance``, ``percent``. A
    query whose word has no vector is one row with ``known`` false.

    Every query must see every vector. Queries that make up one block of at most
    ``broadcast_bytes`` go to all tasks, and the vectors are read once where they
    lie. Otherwise both sides are cut into blocks and a task takes one block of
    each. Either way n rows per query are handed on by a batch or block.
    """
    asked = queries.select(F.col("word").alias("query"), F.col("n").cast("int").alias("n")).distinct()
    points = asked.join(
        vectors.select(F.col(key).alias("query"), F.col(vector).alias("point")), "query", "left"
    )
    known = points.filter(F.col("point").isNotNull() & (F.col("n") > 0))
    key_type = vectors.schema[key].dataType.simpleString()
    schema = f"query {key_type}, n int, key {key_type}, distance double, farthest double"
    asking = known.agg(F.count(F.lit(1)).alias("rows"), F.sum(8 * F.size("point") + 64).alias("bytes")).first()
    if asking.rows <= queries_per_block and (asking.bytes or 0) <= broadcast_bytes:
        block = known.select("query", "n", "point").toArrow()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _closest_in_block(block, pa.Table.from_batches([batch])).to_batches()

        parts = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector")).mapInArrow(run, schema)
    else:
        parts = _by_blocks(known, vectors, key, vector, asking.rows, queries_per_block, vectors_per_block, schema)
    return _ranked(parts, points, key, key_type)


def _ranked(parts: DataFrame, points: DataFrame, key: str, key_type: str) -> DataFrame:
    """The n nearest per query out of what the blocks found, and a row for each query without a vector."""
    per_query = Window.partitionBy("query", "n")
    found = (
        parts.withColumn("rank", F.row_number().over(per_query.orderBy("distance", "key")))
        .withColumn("farthest", F.max("farthest").over(per_query))
        .filter(F.col("rank") <= F.col("n"))
        .select(
            "query", "n", F.lit(True).alias("known"), "rank", F.col("key").alias(key), "distance",
            similarity_percent(F.col("distance"), F.col("farthest")).alias("percent"),
        )
    )
    unknown = points.filter(F.col("point").isNull()).select(
        "query", "n", F.lit(False).alias("known"), F.lit(None).cast("int").alias("rank"),
        F.lit(None).cast(key_type).alias(key), F.lit(None).cast("double").alias("distance"),
        F.lit(None).cast("bigint").alias("percent"),
    )
    return found.unionByName(unknown)
