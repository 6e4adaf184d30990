import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rillflow.operators import graph, layout

N = 60


@pytest.fixture(scope="module")
def hub(spark):
    """A third of the edges start at one vertex, a third end at another; some name nobody or null."""
    rng = random.Random(5)
    edges = [(rng.randrange(N), rng.randrange(N), rng.randrange(9)) for _ in range(300)]
    edges += [(7, rng.randrange(N), 1) for _ in range(300)] + [(rng.randrange(N), 11, 2) for _ in range(300)]
    edges += [(None, 3, 1), (3, None, 1), (3, 3, 1)]
    vertices = spark.createDataFrame([(i, f"n{i}", i % 50) for i in range(N)], "id bigint, name string, age int")
    return graph.Graph(vertices, spark.createDataFrame(edges, "src bigint, dst bigint, attr int"))


@pytest.fixture(scope="module")
def stored(hub):
    stored = layout.store(hub, buckets=8)
    yield stored
    layout.drop(stored)


def test_crowded_vertices_are_apart(stored):
    assert (7,) in rows(stored.crowded["src"]) and (11,) in rows(stored.crowded["dst"])
    for end in layout.ENDS:
        assert stored.crowded[end].count() < stored.buckets
        assert stored.light[end].count() + stored.heavy[end].count() == 902


def test_edges_with_an_end(stored, hub):
    for end in layout.ENDS:
        expected = graph.triplets(hub, (end,)).select("src", "dst", "attr", f"{end}_attr.name")
        assert rows(layout.edges_with(stored, end).select("src", "dst", "attr", f"{end}_attr.name").na.fill(-1)) == rows(
            expected.na.fill(-1)
        )


def test_two_rounds_against_plain_sums(stored, hub):
    edges = [tuple(e) for e in hub.edges.collect()]
    age = {i: i % 50 for i in range(N)}
    first = Counter()
    for src, dst, attr in edges:
        if src is not None:
            first[dst] += age[src] * attr
    sums = layout.aggregate_messages(stored, [F.sum("msg").alias("s")], to_dst=F.col("src_attr.age") * F.col("attr"))
    assert {r.id: r.s for r in sums.collect()} == {v: s for v, s in first.items()}
    second = layout.with_vertices(stored, hub.vertices.join(sums, "id", "left").select("id", F.coalesce("s", F.lit(0)).alias("s")))
    both = Counter()
    for src, dst, attr in edges:
        if src is not None:
            both[dst] += first[src]
        if dst is not None:
            both[src] += first[dst]
    found = layout.aggregate_messages(
        second, [F.sum("msg").alias("s")], to_dst=F.col("src_attr.s"), to_src=F.col("dst_attr.s")
    )
    assert {r.id: r.s for r in found.collect()} == dict(both)
    layout.drop(second)
    assert not any(spark_table for spark_table in second.tables if hub.vertices.sparkSession.catalog.tableExists(spark_table))


def test_no_edge_is_shuffled(spark, hub):
    """Between the scan of the edges and the partial sums of the messages there is no exchange, in two rounds."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = layout.store(hub, buckets=8)
        for g in (first, layout.with_vertices(first, hub.vertices)):
            found = layout.aggregate_messages(
                g, [F.count("msg").alias("n")], to_dst=F.col("src_attr.age"), to_src=F.col("dst_attr.age")
            )
            plan = found._jdf.queryExecution().executedPlan().toString()
            shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert len(shuffles) == 1 and "hashpartitioning(id" in shuffles[0]
            assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning") < plan.index("SortMergeJoin")
            assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") >= 4
            light = layout.degrees(g, "src", "n")
            assert rows(light.filter("id = 7")) == rows(graph.out_degrees(hub).filter("id = 7"))
            layout.drop(g)
        plain = graph.aggregate_messages(hub, [F.count("msg").alias("n")], F.col("src_attr.age"), F.col("dst_attr.age"))
        assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_graph(spark, hub):
    empty = layout.store(graph.Graph(hub.vertices, hub.edges.limit(0)), buckets=4)
    assert layout.aggregate_messages(empty, [F.count("msg").alias("n")], to_dst=F.col("src_attr.age")).count() == 0
    assert layout.degrees(empty, "dst", "n").count() == 0
    layout.drop(empty)
