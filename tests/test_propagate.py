"""Messages to a fixed point against breadth-first search and relaxation in plain Python."""

import random

from pyspark.sql import functions as F

from conftest import rows
from rillflow.operators import propagate
from rillflow.operators.graph import Graph


def graph(spark, edges):
    e = spark.createDataFrame(edges, "src long, dst long, cost int").repartition(3)
    return Graph(spark.createDataFrame([(0,)], "id long"), e)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def brute(edges, sources, step=lambda value, cost: value + 1):
    best = {s: 0 for s in sources}
    while True:
        moved = dict(best)
        for src, dst, cost in edges:
            if src in best and step(best[src], cost) < moved.get(dst, float("inf")):
                moved[dst] = step(best[src], cost)
        if moved == best:
            return sorted(best.items())
        best = moved


def test_chain(spark):
    edges = [(i, i + 1, 1) for i in range(7)]
    assert rows(propagate.hops(graph(spark, edges), ids(spark, 0))) == brute(edges, [0])
    assert rows(propagate.hops(graph(spark, edges), ids(spark, 5, 5, 40))) == [(5, 0), (6, 1), (7, 2), (40, 0)]
    backwards = propagate.hops(graph(spark, edges), ids(spark, 4), both_ways=True)
    assert rows(backwards) == [(i, abs(i - 4)) for i in range(8)]


def test_hot_vertex_and_cycles(spark):
    rng = random.Random(1)
    edges = [(0, i, rng.randint(0, 9)) for i in range(1, 300)] + [(i, 0, 1) for i in range(1, 300)]
    edges += [(rng.randint(1, 320), rng.randint(1, 320), rng.randint(0, 9)) for _ in range(400)] + [(5, 5, 0)]
    g = graph(spark, edges)
    assert rows(propagate.hops(g, ids(spark, 7))) == brute(edges, [7])
    assert rows(propagate.cheapest(g, ids(spark, 7), "cost")) == brute(edges, [7], lambda value, cost: value + cost)


def test_only_what_changed_sends_and_rounds_are_bounded(spark):
    edges = [(i, i + 1, 1) for i in range(10)]
    start = ids(spark, 0).withColumn("value", F.lit(5).cast("long"))
    two = propagate.propagate(
        graph(spark, edges), start, lambda value: F.when(F.col("dst") != 2, value), F.max, lambda new, old: new > old, rounds=4
    )
    assert rows(two) == [(0, 5), (1, 5)]  # a null message is not sent
    some = propagate.propagate(graph(spark, edges), start, lambda value: value, F.max, lambda new, old: new > old, rounds=3)
    assert rows(some) == [(0, 5), (1, 5), (2, 5), (3, 5)]


def test_nothing_to_send(spark):
    assert rows(propagate.hops(graph(spark, []), ids(spark, 3))) == [(3, 0)]
    assert rows(propagate.hops(graph(spark, [(1, 2, 1)]), ids(spark))) == []
