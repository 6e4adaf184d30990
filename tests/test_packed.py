from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from conftest import rows
from rillflow.functions.packed import greatest_key, key_tie, key_value, packable
from rillflow.operators import graph

INTS = [-(1 << 31), -5, -1, 0, 1, 70, (1 << 31) - 1, None]
IDS = [-(1 << 63), -9, -1, 0, 1, 12, (1 << 63) - 1]


def test_keys_keep_the_order_and_come_apart(spark):
    pairs = spark.createDataFrame([(v, i) for v in INTS for i in IDS], "v int, i bigint")
    keyed = pairs.select("v", "i", greatest_key(F.col("v"), F.col("i")).alias("k"))
    back = keyed.select("v", "i", "k", key_value(F.col("k")).alias("v2"), key_tie(F.col("k")).alias("i2")).collect()
    assert all((r.v, r.i) == (r.v2, r.i2) for r in back)
    by_key = [(r.v, r.i) for r in sorted(back, key=lambda r: r.k)]
    lowest = -(1 << 40)
    assert by_key == sorted(by_key, key=lambda p: (lowest if p[0] is None else p[0], -p[1]))
    assert len({r.k for r in back}) == len(INTS) * len(IDS)


def test_types():
    assert packable(IntegerType(), LongType())
    assert not packable(LongType(), LongType()) and not packable(IntegerType(), StringType())


def followers(spark, kind):
    people = [(1, "a", -5), (2, "b", -5), (3, "c", None), (4, "d", 9), (5, "e", -7), (-6, "f", 9)]
    likes = [(2, 9), (1, 9), (5, 9), (3, 8), (3, 7), (5, 7), (4, 6), (-6, 6)]
    vertices = spark.createDataFrame(people, "id bigint, name string, age int").withColumn("age", F.col("age").cast(kind))
    return graph.Graph(vertices, spark.createDataFrame(likes, "src bigint, dst bigint"))


def test_oldest_follower_by_hash_and_by_sort(spark):
    expected = [(6, "f", 9), (7, "e", -7), (8, "c", None), (9, "a", -5)]
    for kind in ("int", "smallint", "bigint", "double"):
        found = graph.oldest_follower(followers(spark, kind))
        assert rows(found) == expected
        assert found.schema["follower_age"].dataType.simpleString() == kind


def test_the_plan_hashes(spark):
    def plan(kind):
        return graph.oldest_follower(followers(spark, kind))._jdf.queryExecution().executedPlan().toString()

    assert "HashAggregate" in plan("int") and "SortAggregate" not in plan("int")
    assert "SortAggregate" in plan("bigint")
    assert not packable(DoubleType(), LongType())
