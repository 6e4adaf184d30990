import pyarrow as pa
from pyspark.sql import functions as F

from conftest import rows
from rillflow.operators.joins import SALT, block_names, crowded_keys, fits, pair_blocks, replicate, spread
from rillflow.operators.numbering import dense_ids


def test_chunked_join_equals_plain_join(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k")
    )
    right = spark.createDataFrame([(7, "hot"), (7, "again"), (8, "x"), (60, "y")], "k bigint, v string")
    crowded = crowded_keys(left, ["k"], 100)
    assert rows(crowded) == [(7, 11)]
    chunked = spread(left, crowded, ["k"], ["id"]).join(replicate(right, crowded, ["k"]), ["k", SALT]).drop(SALT)
    assert rows(chunked, "k", "id", "v") == rows(left.join(right, "k"), "k", "id", "v")


def test_no_crowded_key_is_left_out(spark):
    """More crowded keys than any list used to hold, all of the same size."""
    left = spark.range(9000).select((F.col("id") % 3000).alias("k"), "id")
    assert crowded_keys(left, ["k"], 2).count() == 3000
    assert crowded_keys(left, ["k"], 3).count() == 0


def test_chunks_of_one_key_have_no_bound(spark):
    left = spark.range(50_000).select(F.lit(1).alias("k"))
    assert rows(crowded_keys(left, ["k"], 1)) == [(1, 50_000)]


def test_fits(spark):
    df = spark.createDataFrame([("abc",), ("de",)], "w string")
    assert fits(df, 5, F.octet_length("w")) and not fits(df, 4, F.octet_length("w"))
    assert fits(df.limit(0), 0, F.octet_length("w"))


def test_dense_ids(spark):
    words = [(f"w{(i * 7919) % 1000:04d}",) for i in range(1000)]
    df = dense_ids(spark.createDataFrame(words, "word string").repartition(7), ["word"], start=5)
    assert rows(df) == [(f"w{i:04d}", i + 5) for i in range(1000)]
    assert rows(dense_ids(spark.createDataFrame([], "word string"), ["word"])) == []


def test_blocks_meet_without_repeated_rows(spark):
    left = spark.range(40).select("id", (F.col("id") % 5).cast("int").alias("_block"))
    right = spark.range(30).select("id", (F.col("id") % 7).cast("int").alias("_block"))

    def work(one, other):
        assert one.num_rows == 8 and other.num_rows in (4, 5)
        return pa.table({"n": [one.num_rows * other.num_rows], "s": [sum(one["id"].to_pylist())]})

    pairs = pair_blocks(left, right, (5, 7), work, "n bigint, s bigint")
    got = pairs.collect()
    assert len(got) == 35 and sum(r.n for r in got) == 1200 and sum(r.s for r in got) == 780 * 7
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan
    assert pair_blocks(left.limit(0), right, (1, 7), work, "n bigint, s bigint").count() == 0


def test_each_named_block_has_a_partition(spark):
    """By their numbers several blocks would share one, and a task would hold the pairs of them all."""
    for n, most in ((1, 400), (7, 400), (40, 400), (50, 20)):
        names = block_names(n, most)
        dealt = spark.createDataFrame([(i,) for i in names], "_block int").repartition(min(n, most), "_block")
        held = dealt.groupBy(F.spark_partition_id()).count().collect()
        assert len(set(names)) == n and max(r[1] for r in held) == -(-n // min(n, most))
