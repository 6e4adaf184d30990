import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rillflow.operators import components, graph

PEOPLE = [(1, "Alice", 28), (2, "Bob", 27), (3, "Charlie", 65), (4, "David", 42), (5, "Ed", 55), (6, "Fran", 50)]
LIKES = [(2, 1, 7), (2, 4, 2), (3, 2, 4), (3, 6, 3), (4, 1, 1), (5, 2, 2), (5, 3, 8), (5, 6, 3)]


@pytest.fixture(scope="module")
def social(spark):
    vertices = spark.createDataFrame(PEOPLE, "id bigint, name string, age int")
    edges = spark.createDataFrame(LIKES, "src bigint, dst bigint, attr int")
    return graph.build_graph(vertices, edges, {"name": "John Doe", "age": -1})


def test_default_vertex(spark, social):
    edges = social.edges.union(spark.createDataFrame([(1, 99, 1)], "src bigint, dst bigint, attr int"))
    g = graph.build_graph(social.vertices, edges, {"name": "John Doe", "age": -1})
    assert rows(g.vertices) == sorted([*PEOPLE, (99, "John Doe", -1)])


def test_views(social):
    assert rows(social.vertices.filter("age >= 30"), "name") == [("Charlie",), ("David",), ("Ed",), ("Fran",)]
    names = graph.triplets(social).select("src_attr.name", F.col("dst_attr.name").alias("other"), "attr")
    assert rows(names.filter("attr > 5"), "name", "other") == [("Bob", "Alice"), ("Ed", "Charlie")]
    assert names.count() == len(LIKES)


def test_degrees(social):
    assert rows(graph.in_degrees(social)) == [(1, 2), (2, 2), (3, 1), (4, 1), (6, 2)]
    assert rows(graph.out_degrees(social)) == [(2, 2), (3, 2), (4, 1), (5, 3)]
    assert rows(graph.with_degrees(social).vertices, "id", "in_degree", "out_degree") == [
        (1, 2, 0), (2, 2, 2), (3, 1, 2), (4, 1, 1), (5, 0, 3), (6, 2, 0)
    ]
    assert rows(graph.equal_degrees(social), "name") == [("Bob",), ("David",)]


def test_messages(social):
    assert [t for _, t in rows(graph.oldest_follower_sentences(social))] == [
        "David is the oldest follower of Alice.",
        "Charlie is the oldest follower of Bob.",
        "Ed is the oldest follower of Charlie.",
        "Bob is the oldest follower of David.",
        "Ed does not have any followers.",
        "Charlie is the oldest follower of Fran.",
    ]
    assert rows(graph.average_follower_age(social)) == [(1, 34.5), (2, 60.0), (3, 55.0), (4, 27.0), (6, 60.0)]
    assert rows(graph.average_age_sentences(social))[0][1] == "The average age of Alice's followers is 34.5."
    both = graph.aggregate_messages(
        social, [F.sum("msg").alias("s")], to_dst=F.lit(1), to_src=F.when(F.col("attr") > 5, 100)
    )
    assert rows(both) == [(1, 2), (2, 102), (3, 1), (4, 1), (5, 100), (6, 2)]


def test_equally_old_followers(spark):
    g = graph.Graph(
        spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", 1)], "id bigint, name string, age int"),
        spark.createDataFrame([(2, 3, 1), (1, 3, 1)], "src bigint, dst bigint, attr int"),
    )
    assert rows(graph.oldest_follower(g)) == [(3, "a", 5)]


def test_vertex_updates(spark, social):
    other = spark.createDataFrame([(1, 5)], "id bigint, points int")
    filled = graph.outer_join_vertices(social, other, {"points": 0}).vertices
    assert rows(filled, "id", "points")[:2] == [(1, 5), (2, 0)]
    joined = graph.join_vertices(social, other, lambda _: {"age": F.col("age") + F.col("points")})
    assert rows(joined.vertices)[:2] == [(1, "Alice", 33), (2, "Bob", 27)]
    assert rows(graph.map_vertices(social, age=F.lit(0)).vertices, "age") == [(0,)] * 6
    assert graph.left_join_vertices(social, other).filter("points is null").count() == 5


def test_subgraph_and_components(social):
    older = graph.subgraph(social, vertex=F.col("age") >= 30)
    assert rows(older.edges) == [(3, 6, 3), (5, 3, 8), (5, 6, 3)]
    assert rows(components.connected_components(older)) == [(3, 3), (4, 4), (5, 3), (6, 3)]
    assert rows(graph.subgraph(social, edge=F.col("attr") > 5).edges) == [(2, 1, 7), (5, 3, 8)]
    to_older = F.col("src_attr.age") < F.col("dst_attr.age")
    assert rows(graph.subgraph(social, triplet=to_older).edges) == [(2, 1, 7), (2, 4, 2), (5, 3, 8)]
    both = graph.subgraph(social, vertex=F.col("age") > 27, triplet=to_older)
    assert rows(both.edges) == [(5, 3, 8)]


def test_graph_without_edges(social):
    g = graph.without_edges(social.vertices)
    assert g.edges.count() == 0
    assert rows(components.connected_components(g)) == [(i, i) for i in range(1, 7)]


def lowest(pairs, n):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [(i, find(i)) for i in range(n)]


@pytest.mark.parametrize("kind", ["chain", "star", "random", "loops"])
def test_components_against_union_find(spark, monkeypatch, kind):
    rng = random.Random(kind)
    n = 60
    pairs = {
        "chain": [(i, i + 1) for i in rng.sample(range(n - 1), n - 1)],
        "star": [(n - 1, i) for i in range(n - 1)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(45)],
        "loops": [(i, i) for i in range(5)] + [(7, 3), (3, 7)],
    }[kind]
    g = graph.Graph(
        spark.range(n), spark.createDataFrame(pairs, "src bigint, dst bigint")
    )
    assert rows(components.connected_components(g)) == lowest(pairs, n)


def test_triplets_with_a_hot_vertex(spark):
    vertices = spark.range(100).withColumn("name", F.col("id").cast("string"))
    edges = spark.range(1, 100).select(F.col("id").alias("src"), F.lit(0).cast("bigint").alias("dst"))
    got = graph.triplets(graph.Graph(vertices, edges))
    assert rows(got.select("src", "dst_attr.name")) == [(i, "0") for i in range(1, 100)]
