"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.operators.graph import Graph
from rillflow.session import new_scratch
from rillflow.sources.paths import delete


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a vertex on the smallest vertex around it.

    ``pairs(hi, lo)`` has ``hi > lo``. No neighbour list is ever built: the
    smallest neighbour is a plain minimum, and the join back is one whose hot
    keys Spark splits.
    """
    ends = F.array(
        F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
        F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")),
    )
    centers = (
        pairs.select(F.inline(ends))
        .groupBy(F.col("u").alias("lo"))
        .agg(F.least(F.min("v"), F.col("lo")).alias("m"))
    )
    return pairs.join(centers, "lo").select("hi", F.col("m").alias("lo")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Hang a vertex and its smaller neighbours on the smallest of them."""
    smallest = pairs.groupBy("hi").agg(F.min("lo").alias("m"))
    hung = F.array(
        F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
        F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
    )
    joined = pairs.join(smallest, "hi")
    return joined.select(F.inline(hung)).filter(F.col("hi") > F.col("lo")).distinct()


def stars(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges(src, dst)`` contracted to ``(hi, lo)``: each vertex and the lowest id it reaches.

    The edge set of every round goes to the shared scratch folder; the next round
    reads it, so a lost executor costs at most one round, and the plan stays short.
    """
    spark = edges.sparkSession
    pairs = (
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
        .distinct()
    )
    root = new_scratch(spark, "components")
    fingerprint = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))]
    previous = None
    for number in range(max_rounds):
        path = f"{root}/round={number}"
        if number:
            pairs = _small_star(_large_star(pairs))
        pairs.write.parquet(path)
        pairs = spark.read.schema(pairs.schema).parquet(path)
        current = tuple(pairs.agg(*fingerprint).first())
        if number > 1:
            delete(spark, f"{root}/round={number - 2}")
        if current == previous:
            return pairs
        previous = current
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def connected_components(g: Graph) -> DataFrame:
    """``id``, ``component``: the lowest vertex id that can be reached, direction ignored."""
    labels = stars(g.edges).select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return g.vertices.select("id").join(labels, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )
