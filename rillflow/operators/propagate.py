"""Messages along edges, round after round, until no vertex changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.operators.graph import Graph
from rillflow.session import new_scratch
from rillflow.sources.paths import delete


def propagate(
    g: Graph,
    start: DataFrame,
    message: Callable[[Column], Column],
    merge: Callable[[Column], Column],
    better: Callable[[Column, Column], Column],
    rounds: int | None = None,
    both_ways: bool = False,
) -> DataFrame:
    """``id, value``: what reaches each vertex from ``start(id, value)`` once nothing changes any more.

    A vertex whose value changed in the last round sends ``message(value)``, built
    from its value and the columns of the edge, along its edges (``both_ways``:
    against them too); null is not sent. ``merge`` is the aggregate of a vertex's
    messages, combined before the shuffle. A merged message counts where the vertex
    has no value yet or ``better(message, value)`` holds; it must not hold both
    ways round, else there is no end. ``rounds`` bounds the number of rounds.

    The rows that changed (the senders of the next round) and the values that did
    not are two folders per round in the shared scratch folder; a lost executor
    costs at most one round, and the folders of the round before last are
    deleted. Vertices nothing reaches have no row. Ids that only edges name take
    part. Edges are read from where ``g.edges`` lies; give a stored table.
    """
    spark = start.sparkSession
    root = new_scratch(spark, "propagate")
    edges = g.edges
    if both_ways:
        turned = [c for c in edges.columns if c not in ("src", "dst")]
        edges = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *turned))

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    changed = stored(start.filter(F.col("value").isNotNull()).groupBy("id").agg(merge(F.col("value")).alias("value")), "changed=0")
    state, number = changed, 0
    while (rounds is None or number < rounds) and not changed.isEmpty():
        number += 1
        senders = changed.select(F.col("id").alias("src"), F.col("value").alias("value"))
        sent = edges.join(senders, "src").select(F.col("dst").alias("id"), message(F.col("value")).alias("_sent"))
        heard = sent.filter(F.col("_sent").isNotNull()).groupBy("id").agg(merge(F.col("_sent")).alias("_heard"))
        news = heard.join(state, "id", "left").filter(F.col("value").isNull() | better(F.col("_heard"), F.col("value")))
        changed = stored(news.select("id", F.col("_heard").cast(start.schema["value"].dataType).alias("value")), f"changed={number}")
        kept = state.join(changed.select("id"), "id", "left_anti")
        state = stored(kept.unionByName(changed), f"state={number}")
        if number > 1:
            delete(spark, f"{root}/changed={number - 2}")
            delete(spark, f"{root}/state={number - 2}")
    return state


def hops(g: Graph, sources: DataFrame, both_ways: bool = False) -> DataFrame:
    """``id``, ``hops``: the least number of edges from any of ``sources(id)`` to each vertex they reach."""
    start = sources.select("id", F.lit(0).cast("bigint").alias("value"))
    found = propagate(g, start, lambda value: value + 1, F.min, lambda new, old: new < old, both_ways=both_ways)
    return found.withColumnRenamed("value", "hops")


def cheapest(g: Graph, sources: DataFrame, cost: str) -> DataFrame:
    """``id``, ``cost``: the least sum of the edge column ``cost`` (none below 0) on a way from ``sources(id)``."""
    kind = g.edges.schema[cost].dataType.simpleString()
    total = "double" if kind in ("float", "double") else "bigint"
    start = sources.select("id", F.lit(0).cast(total).alias("value"))
    found = propagate(g, start, lambda value: value + F.col(cost).cast(total), F.min, lambda new, old: new < old)
    return found.withColumnRenamed("value", "cost")
