"""Graphs stored for many rounds of messages: edges lie where the vertices that send are.

Vertices are bucketed by id, edges twice, by each end, into the same number of
buckets. A round joins bucket with bucket; only messages, partly merged, are
shuffled.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.operators.graph import Graph
from rillflow.session import materialize, new_scratch

ENDS = ("src", "dst")


@dataclass(frozen=True)
class StoredGraph:
    """``light[end]`` is bucketed by that end; ``heavy[end]`` holds the edges of its crowded vertices.

    ``crowded[end]`` lists those vertices, fewer than ``buckets`` of them.
    """

    vertices: DataFrame
    light: dict[str, DataFrame]
    heavy: dict[str, DataFrame]
    crowded: dict[str, DataFrame]
    buckets: int
    tables: tuple[str, ...]


def _bucketed(df: DataFrame, key: str, buckets: int, name: str) -> tuple[DataFrame, str]:
    """Written by one task per bucket, as a table of the catalog over a folder in the shared scratch."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
        .option("path", new_scratch(spark, name)).saveAsTable(table)
    )
    return spark.table(table), table


def store(g: Graph, buckets: int | None = None) -> StoredGraph:
    """Lay out ``g``; ``buckets`` is the number of shuffle partitions unless given.

    A vertex is crowded on a side if it has more edges there than a bucket has on
    average. There are fewer of those than buckets, so their rows can be
    broadcast to their edges, which lie in no particular order: no bucket
    outgrows the others by one vertex. Edges with a null end never meet a vertex
    and are left out of the copy by that end; ids that only edges name should be
    vertices already (``build_graph``).
    """
    spark = g.edges.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = materialize(g.edges, "edges")
    mean = -(-edges.count() // n)
    light, heavy, crowded, tables = {}, {}, {}, []
    for end in ENDS:
        counts = edges.filter(F.col(end).isNotNull()).groupBy(end).agg(F.count(F.lit(1)).alias("_n"))
        crowded[end] = materialize(counts.filter(F.col("_n") > mean).select(end), "crowded")
        few = F.broadcast(crowded[end])
        rest = edges.filter(F.col(end).isNotNull()).join(few, end, "left_anti")
        light[end], table = _bucketed(rest.select(*g.edges.columns), end, n, f"edges_by_{end}")
        heavy[end] = materialize(edges.join(few, end, "left_semi").select(*g.edges.columns), f"edges-of-crowded-{end}")
        tables.append(table)
    vertices, table = _bucketed(g.vertices, "id", n, "vertices")
    return StoredGraph(vertices, light, heavy, crowded, n, (*tables, table))


def with_vertices(g: StoredGraph, vertices: DataFrame) -> StoredGraph:
    """The same edges with other vertices, stored for the next round."""
    stored, table = _bucketed(vertices, "id", g.buckets, "vertices")
    return replace(g, vertices=stored, tables=(*g.tables, table))


def drop(g: StoredGraph) -> None:
    """Take the tables out of the catalog; their folders go with the scratch."""
    for table in g.tables:
        g.vertices.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")


def edges_with(g: StoredGraph, end: str) -> DataFrame:
    """All edges with the attributes of one end, a struct ``<end>_attr``; no edge is shuffled."""
    struct = F.struct("id", *[c for c in g.vertices.columns if c != "id"])
    attributes = g.vertices.select(F.col("id").alias(end), struct.alias(f"{end}_attr"))
    few = attributes.join(F.broadcast(g.crowded[end]), end, "left_semi")
    order = [*g.light[end].columns, f"{end}_attr"]
    beside = g.light[end].join(attributes, end).select(*order)
    return beside.unionByName(g.heavy[end].join(F.broadcast(few), end).select(*order))


def aggregate_messages(g: StoredGraph, aggregates: list[Column], to_dst: Column | None = None,
                       to_src: Column | None = None) -> DataFrame:
    """A round of messages, merged at each vertex by ``aggregates`` of ``msg``.

    ``to_dst`` may use edge columns and ``src_attr``, ``to_src`` edge columns and
    ``dst_attr``: a message is made where its sender lies. Null is not sent,
    vertices without a message have no row.
    """
    sides = [
        edges_with(g, sender).select(F.col(receiver).alias("id"), message.alias("msg"))
        for sender, receiver, message in (("src", "dst", to_dst), ("dst", "src", to_src))
        if message is not None
    ]
    sent = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    return sent.filter(F.col("msg").isNotNull()).groupBy("id").agg(*aggregates)


def degrees(g: StoredGraph, end: str, name: str) -> DataFrame:
    """Edges per vertex on one side, for vertices that have any; counted inside the buckets."""
    counts = [
        part.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias(name))
        for part in (g.light[end], g.heavy[end])
    ]
    return counts[0].unionByName(counts[1])
