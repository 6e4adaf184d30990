"""Property graphs as two DataFrames, ``vertices(id, ...)`` and ``edges(src, dst, ...)``."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.packed import greatest_key, key_tie, key_value, packable


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame
    edges: DataFrame

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.vertices.columns if c != "id"]

    @property
    def edge_attributes(self) -> list[str]:
        return [c for c in self.edges.columns if c not in ("src", "dst")]


def edge_ends(edges: DataFrame) -> DataFrame:
    """Each vertex id an edge names, once."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def build_graph(vertices: DataFrame, edges: DataFrame, defaults: Mapping[str, object]) -> Graph:
    """A graph in which ids that only edges name become vertices with default attributes."""
    missing = edge_ends(edges).join(vertices.select("id"), "id", "left_anti")
    filled = missing.select(
        "id", *[F.lit(defaults[c]).alias(c) for c in vertices.columns if c != "id"]
    )
    return Graph(vertices.unionByName(filled.select(*vertices.columns)), edges)


def without_edges(vertices: DataFrame) -> Graph:
    """A graph of vertices only."""
    spark = vertices.sparkSession
    return Graph(vertices, spark.createDataFrame([], "src bigint, dst bigint"))


def map_vertices(g: Graph, **columns: Column) -> Graph:
    """The same graph with the given vertex columns set."""
    return Graph(g.vertices.withColumns(columns), g.edges)


def outer_join_vertices(g: Graph, other: DataFrame, defaults: Mapping[str, object]) -> Graph:
    """Add the columns of ``other(id, ...)``; vertices it lacks get the defaults."""
    joined = g.vertices.join(other, "id", "left")
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    return Graph(joined.withColumns(filled), g.edges)


def left_join_vertices(g: Graph, other: DataFrame) -> DataFrame:
    """All vertices with the columns of ``other(id, ...)``, null where it has no row."""
    return g.vertices.join(other, "id", "left")


def join_vertices(g: Graph, other: DataFrame, updates: Callable[[DataFrame], Mapping[str, Column]]) -> Graph:
    """Set vertex columns where ``other(id, ...)`` has a row; leave all other vertices as they were.

    ``updates`` gets the joined table and returns the new values for matched vertices.
    """
    joined = g.vertices.join(other.withColumn("_matched", F.lit(True)), "id", "left")
    changed = {
        c: F.when(F.col("_matched"), value).otherwise(F.col(c))
        for c, value in updates(joined).items()
    }
    return Graph(joined.withColumns(changed).select(*g.vertices.columns), g.edges)


def triplets(g: Graph, ends: tuple[str, ...] = ("src", "dst")) -> DataFrame:
    """Edges with the attributes of their ends as structs ``src_attr`` and ``dst_attr``.

    Name only the ends that are needed: each one is a join on the edges. Spark
    splits the partition of a vertex with very many edges at run time; a small
    vertex table it broadcasts.
    """
    result = g.edges
    for end in ends:
        attributes = g.vertices.select(
            F.col("id").alias(end), F.struct("id", *g.attributes).alias(f"{end}_attr")
        )
        result = result.join(attributes, end)
    order = ["src", "dst", *g.edge_attributes, *[f"{end}_attr" for end in ends]]
    return result.select(*order)


def in_degrees(g: Graph) -> DataFrame:
    """Edges in per vertex that has any."""
    return g.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))


def out_degrees(g: Graph) -> DataFrame:
    return g.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def with_degrees(g: Graph) -> Graph:
    """Both degrees on every vertex, 0 where it has no edge on that side.

    One aggregation over the edge ends instead of one per direction.
    """
    sides = F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    )
    degrees = (
        g.edges.select(F.inline(sides))
        .groupBy("id")
        .agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    )
    return outer_join_vertices(g, degrees, {"in_degree": 0, "out_degree": 0})


def equal_degrees(g: Graph) -> DataFrame:
    vertices = with_degrees(g).vertices
    return vertices.filter(F.col("in_degree") == F.col("out_degree"))


def aggregate_messages(
    g: Graph,
    aggregates: list[Column],
    to_dst: Column | None = None,
    to_src: Column | None = None,
    ends: tuple[str, ...] = ("src", "dst"),
) -> DataFrame:
    """Send a message along every edge and merge the messages at each vertex.

    ``to_dst`` and ``to_src`` are built from the columns of :func:`triplets`; a
    null message is not sent. ``aggregates`` merge the column ``msg``, partly
    before the shuffle. Vertices without a message have no row.
    """
    sides = [
        F.struct(F.col(end).alias("id"), message.alias("msg"))
        for end, message in (("dst", to_dst), ("src", to_src))
        if message is not None
    ]
    sent = triplets(g, ends).select(F.inline(F.array(*sides))).filter(F.col("msg").isNotNull())
    return sent.groupBy("id").agg(*aggregates)


def oldest_follower(g: Graph, name: str = "name", age: str = "age") -> DataFrame:
    """Per followed vertex the oldest follower; of equally old ones that with the lowest id.

    Ages up to int and ids up to bigint are merged as one number, by hashing, and
    the names are looked up for the winners only; other types are merged as
    structs, by sorting.
    """
    if packable(g.vertices.schema[age].dataType, g.edges.schema["src"].dataType):
        key = greatest_key(F.col(f"src_attr.{age}"), F.col("src"))
        merged = aggregate_messages(g, [F.max("msg").alias("m")], to_dst=key, ends=("src",))
        names = g.vertices.select(F.col("id").alias("_follower"), F.col(name).alias("follower_name"))
        told = merged.select("id", key_tie(F.col("m")).alias("_follower"), key_value(F.col("m")).alias("follower_age"))
        kind = g.vertices.schema[age].dataType
        return told.join(names, "_follower").select("id", "follower_name", F.col("follower_age").cast(kind))
    message = F.struct(
        F.col(f"src_attr.{age}").alias("age"),
        (-F.col("src")).alias("rank"),
        F.col(f"src_attr.{name}").alias("name"),
    )
    merged = aggregate_messages(g, [F.max("msg").alias("m")], to_dst=message, ends=("src",))
    return merged.select(
        "id", F.col("m.name").alias("follower_name"), F.col("m.age").alias("follower_age")
    )


def average_follower_age(g: Graph, age: str = "age") -> DataFrame:
    return aggregate_messages(
        g, [F.avg("msg").alias("avg_age")], to_dst=F.col(f"src_attr.{age}"), ends=("src",)
    )


# The sentences about followers.
OLDEST = "%s is the oldest follower of %s."
AVERAGE_AGE = "The average age of %s's followers is %s."
NO_FOLLOWERS = "%s does not have any followers."


def oldest_follower_sentences(g: Graph) -> DataFrame:
    """A sentence per vertex, also for those nobody follows."""
    told = F.format_string(OLDEST, "follower_name", "name")
    return left_join_vertices(g, oldest_follower(g)).select(
        "id", F.when(F.col("follower_name").isNull(), _no_followers()).otherwise(told).alias("text")
    )


def average_age_sentences(g: Graph) -> DataFrame:
    told = F.format_string(AVERAGE_AGE, "name", "avg_age")
    return left_join_vertices(g, average_follower_age(g)).select(
        "id", F.when(F.col("avg_age").isNull(), _no_followers()).otherwise(told).alias("text")
    )


def _no_followers() -> Column:
    return F.format_string(NO_FOLLOWERS, "name")


def subgraph(g: Graph, vertex: Column | None = None, edge: Column | None = None,
             triplet: Column | None = None) -> Graph:
    """Vertices that satisfy ``vertex``, and edges that satisfy the others and keep both ends.

    ``edge`` is built from edge columns; ``triplet`` from the columns of
    :func:`triplets`, which costs the joins to the ends.
    """
    edges = g.edges if edge is None else g.edges.filter(edge)
    if triplet is not None:
        edges = triplets(Graph(g.vertices, edges)).filter(triplet).select(*g.edges.columns)
    if vertex is None:
        return Graph(g.vertices, edges)
    vertices = g.vertices.filter(vertex)
    for end in ("src", "dst"):
        kept = vertices.select(F.col("id").alias(end))
        edges = edges.join(kept, end, "left_semi")
    return Graph(vertices, edges.select(*g.edges.columns))
