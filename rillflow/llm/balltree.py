"""Exact top-k by inner product: ball trees per shard, searched by branch and bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.session import materialize

#: Sums of products up to here are exact in doubles.
EXACT = float(1 << 53)
LEAF = 64


class BallTree:
    """Points split in halves along their widest direction, each node a ball around its mean.

    Nodes are numbered breadth first; node i has the children 2i + 1 and 2i + 2
    and the points ``first[i]:last[i]`` of the sorted arrays. Equal points may end
    up on both sides of a split.
    """

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        depth = 0
        while len(points) > leaf << depth:
            depth += 1
        nodes = (2 << depth) - 1
        order = np.arange(len(points))
        self.depth = depth
        self.first, self.last = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        self.center, self.radius = np.zeros((nodes, points.shape[1])), np.zeros(nodes)
        self.lowest = np.full(nodes, np.iinfo(np.int64).max)
        self.last[0] = len(points)
        for node in range(nodes):
            a, b = self.first[node], self.last[node]
            if a == b:
                continue
            own = points[order[a:b]]
            self.center[node] = own.mean(axis=0)
            self.radius[node] = np.sqrt(((own - self.center[node]) ** 2).sum(axis=1).max())
            self.lowest[node] = ids[order[a:b]].min()
            if 2 * node + 2 < nodes:
                axis = int(np.argmax(own.var(axis=0)))
                order[a:b] = order[a:b][np.argsort(own[:, axis], kind="stable")]
                middle = (a + b) // 2
                for child, (x, y) in ((2 * node + 1, (a, middle)), (2 * node + 2, (middle, b))):
                    self.first[child], self.last[child] = x, y
        self.points, self.ids = points[order], ids[order]
        # Rounding of centre, radius and bound, relative to the largest values.
        self.slack = 1e-9 * (1.0 + float(np.abs(points).max(initial=0.0)) * points.shape[1])

    def bounds(self, queries: np.ndarray, norms: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """The most that the inner product of each query with a point of its node can be."""
        found = np.einsum("ij,ij->i", queries, self.center[nodes])
        return found + norms * (self.radius[nodes] + self.slack) + self.slack * (1.0 + np.abs(found))


def _scores(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles if no sum can lose a digit, else in integers."""
    most = float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0)) * points.shape[1]
    if most < EXACT:
        return queries @ points.T
    whole = np.vectorize(int, otypes=[object])
    return whole(queries).dot(whole(points).T)


class Best:
    """The k best of every query so far, by score, ties to the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k = k
        self.found: list[list[tuple]] = [[] for _ in range(queries)]
        #: Score to reach, from elsewhere or from the k-th of the own list, and the id that ties must beat.
        self.score = floor.astype(float)
        self.id = np.full(queries, np.iinfo(np.int64).max)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(ids) > self.k:
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= edge
            scores, ids = scores[keep], ids[keep]
        merged = {i: -s for s, i in self.found[query]}
        merged = {i: s for i, s in merged.items()}
        for score, i in zip(scores.tolist(), ids.tolist()):
            if i not in merged or score > merged[i]:
                merged[i] = score
        best = sorted((-int(s), i) for i, s in merged.items())[: self.k]
        self.found[query] = best
        if len(best) == self.k and -best[-1][0] >= self.score[query]:
            self.score[query], self.id[query] = -best[-1][0], best[-1][1]


def search(tree: BallTree, queries: np.ndarray, ids: np.ndarray, floor: np.ndarray, k: int) -> Best:
    """Branch and bound for a block of queries at once.

    All pairs of query and node that can still matter go down the tree level by
    level. The leaves of a query are taken in the order of their bounds, a few
    more in every round; after each, pairs whose bound is below the k-th score
    found are dropped. A bound equal to it stays while the node has a smaller id.
    """
    best = Best(len(queries), k, floor)
    norms = np.sqrt((queries**2).sum(axis=1))
    who, nodes = np.arange(len(queries)), np.zeros(len(queries), np.int64)

    def open_pairs(who, nodes, bound):
        score = best.score[who]
        open_end = np.isneginf(score)
        edge = np.abs(np.where(open_end, 0.0, score)) * 1e-12
        above, level = bound > score + edge, bound >= score - edge
        return open_end | above | (level & (tree.lowest[nodes] < best.id[who]))

    bound = tree.bounds(queries[who], norms[who], nodes)
    for _ in range(tree.depth):
        keep = open_pairs(who, nodes, bound)
        who, nodes = np.repeat(who[keep], 2), np.repeat(nodes[keep] * 2 + 1, 2)
        nodes[1::2] += 1
        some = tree.last[nodes] > tree.first[nodes]
        who, nodes = who[some], nodes[some]
        bound = tree.bounds(queries[who], norms[who], nodes)
    order = np.lexsort((-bound, who))
    who, nodes, bound = who[order], nodes[order], bound[order]
    starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, np.int64)
    place = np.arange(len(who)) - np.repeat(starts, np.diff(np.r_[starts, len(who)]))
    start, width = 0, 1
    while start <= (place.max() if len(place) else -1):
        now = np.flatnonzero((place >= start) & (place < start + width))
        now = now[open_pairs(who[now], nodes[now], bound[now])]
        now = now[np.argsort(nodes[now], kind="stable")]
        for part in np.split(now, np.flatnonzero(np.diff(nodes[now])) + 1):
            if not len(part):
                continue
            a, b = tree.first[nodes[part[0]]], tree.last[nodes[part[0]]]
            scores = _scores(tree.points[a:b], queries[who[part]])
            near = tree.ids[a:b]
            for row, query in enumerate(who[part]):
                mine = (near != ids[query]) & (scores[row] >= best.score[query])
                if mine.any():
                    best.add(query, scores[row][mine], near[mine])
        start, width = start + width, width * 2
    return best


def _matrix(blob: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(blob, np.float64).reshape(rows, -1)


def _block(kind: int):
    """A group of vectors as one row of bytes: ids and components as doubles."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        data = np.stack(group["v"].to_numpy()).astype(np.float64)
        ids = group["vec_id"].to_numpy(np.int64)
        return pd.DataFrame(
            {"d": [key[0]], "kind": [kind], "block": [key[1]], "ids": [ids.tobytes()], "data": [data.tobytes()]}
        )

    return run


def _searching(k: int):
    """Partitions sorted by shard, kind, block: a shard's vectors, then blocks of queries."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, shard = None, None
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids = np.frombuffer(row.ids, np.int64)
                data = _matrix(row.data, len(ids))
                if row.kind == 0:
                    tree, shard = BallTree(data, ids), (row.d, row.shard)
                    continue
                if shard != (row.d, row.shard):
                    continue
                floor = np.frombuffer(row.floor, np.float64) if row.floor is not None else np.full(len(ids), -np.inf)
                best = search(tree, data, ids, floor, k)
                out = [(int(i), n, -s) for i, found in zip(ids, best.found) for s, n in found]
                if out:
                    yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


FOUND = "query_id long, vec_id long, score long"


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    per_shard: int = 8192,
    per_block: int = 2048,
) -> DataFrame:
    """The ``k`` highest inner products of every query: ``query_id, rank, vec_id, score``.

    Both tables have ``vec_id`` and ``v``, an array of doubles holding whole
    numbers. The vectors are dealt into shards by a hash, each with a ball tree
    (:class:`BallTree`); the queries into blocks. Every query first searches one
    shard; its k-th score there goes along to all other shards, which drop what
    cannot reach it. Within a shard the bound tightens as leaves are searched
    (:func:`search`). Memory of a task: one shard and one block. Broadcast is the
    number of shards per vector length, eight bytes for each length that occurs and
    so bounded by the longest vector, whatever the number of vectors.

    Ties go to the smaller vec_id. A query does not find rows of its own vec_id.
    Vectors that are null, empty or hold a null or a non-finite component, and
    rows without vec_id, take no part. Vectors meet those of equal length only.
    Rows that repeat a vec_id count once if equal; if not, its best score counts.
    A query with fewer candidates has fewer rows; one without any has none.
    """
    spark = vectors.sparkSession
    good = "vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and abs(x) < double('infinity'))"

    def blocks(df: DataFrame, kind: int, size: int, name: str) -> tuple[DataFrame, DataFrame]:
        kept = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
        kept = kept.filter(good).withColumn("d", F.size("v"))
        lengths = materialize(
            kept.groupBy(F.col("d").alias("_d")).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts")),
            f"{name}-lengths",
        )
        dealt = kept.join(F.broadcast(lengths), F.col("d") == F.col("_d")).withColumn(
            "block", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
        )
        packed = dealt.groupBy("d", "block").applyInPandas(
            _block(kind), "d int, kind int, block int, ids binary, data binary"
        )
        return materialize(packed, name), lengths

    shards, per_length = blocks(vectors, 0, per_shard, "ball-shards")
    asked, _ = blocks(queries, 1, per_block, "ball-queries")
    shards = shards.withColumnRenamed("block", "shard")
    shards = shards.withColumn("block", F.lit(-1)).withColumn("floor", F.lit(None).cast("binary"))
    sent = (
        asked.join(F.broadcast(per_length), F.col("d") == F.col("_d"))
        .drop("_d")
        .withColumn("_seed", F.pmod(F.xxhash64("block"), F.col("parts")).cast("int"))
    )
    columns = ["d", "shard", "kind", "block", "ids", "data", "floor"]

    def searched(asking: DataFrame, name: str) -> DataFrame:
        both = shards.select(columns).unionByName(asking.select(columns))
        n = max(spark.sparkContext.defaultParallelism, 1)
        work = both.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), "d", "shard")
        work = work.sortWithinPartitions("d", "shard", "kind", "block")
        return materialize(work.mapInPandas(_searching(k), FOUND), name)

    none = F.lit(None).cast("binary")
    first = searched(sent.withColumn("shard", F.col("_seed")).withColumn("floor", none), "ball-first")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (
        first.withColumn("_rank", F.row_number().over(place)).filter(F.col("_rank") == k).select("query_id", "score")
    )
    floors = _with_floors(sent, kth)
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    rest = floors.withColumn("shard", F.explode(every)).filter(F.col("shard") != F.col("_seed"))
    found = first.unionByName(searched(rest, "ball-rest"))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (
        once.withColumn("rank", F.row_number().over(place))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _with_floors(sent: DataFrame, kth: DataFrame) -> DataFrame:
    """The blocks with the k-th score of each of their queries, minus infinity where unknown."""
    ids = sent.select("d", "block", "ids")

    def list_ids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids = np.frombuffer(row.ids, np.int64)
                yield pd.DataFrame({"d": row.d, "block": row.block, "place": np.arange(len(ids)), "query_id": ids})

    def pack_floors(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        values = group.sort_values("place")["score"].fillna(-np.inf).to_numpy(np.float64)
        return pd.DataFrame({"d": [key[0]], "block": [key[1]], "floor": [values.tobytes()]})

    listed = ids.mapInPandas(list_ids, "d int, block int, place int, query_id long").join(
        kth.select("query_id", F.col("score").cast("double").alias("score")), "query_id", "left"
    )
    floors = listed.groupBy("d", "block").applyInPandas(pack_floors, "d int, block int, floor binary")
    return sent.join(floors, ["d", "block"])


def quantized(column: str = "embedding"):
    """Components x as floor(256 x), x as double. Non-finite components stay non-finite or null."""
    return F.transform(
        F.col(column),
        lambda x: F.when(
            F.abs(x.cast("double")) < F.lit(float("inf")),
            F.floor(x.cast("double") * 256).cast("double"),
        ),
    )
