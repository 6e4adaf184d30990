"""Look-ups of a few keys in a keyed table cut into buckets."""

import random

import pytest

from conftest import rows
from rillflow.sources import keyed

SCHEMA = "word string, n int, value double"


def table(spark, path, key=("word",), buckets=8, batches=5, full_every=3):
    """Batches of random rows upserted; the table as a dictionary."""
    rng = random.Random(1)
    keyed.create_table(spark, path, SCHEMA, buckets=buckets)
    now = {}
    for batch in range(batches):
        some = {(f"w{rng.randint(0, 80)}", rng.randint(0, 2)): rng.random() for _ in range(40)}
        if key == ("word",):
            some = {(w, 0): v for (w, _), v in some.items()}
        if batch == 1:
            some = {}  # a batch of nothing
        now |= some
        df = spark.createDataFrame([(w, n, v) for (w, n), v in some.items()], SCHEMA)
        keyed.upsert(df, path, list(key), batch, full_every=full_every)
    return now


@pytest.mark.parametrize("key", [("word",), ("word", "n")])
@pytest.mark.parametrize("buckets", [0, 8])
def test_lookup_after_upserts(spark, tmp_path, key, buckets, monkeypatch):
    path = str(tmp_path / "t")
    now = table(spark, path, key, buckets)
    everything = sorted((w, n, v) for (w, n), v in now.items())
    assert rows(keyed.read_table(spark, path, list(key)), "word", "n", "value") == everything
    asked = [("w1", 0), ("w2", 1), ("w3", 0), ("w3", 0), ("unknown", 0), (None, 0)]
    wanted = spark.createDataFrame(asked, "word string, n int")
    expected = [r for r in everything if r[: len(key)] in {a[: len(key)] for a in asked}]
    assert rows(keyed.lookup(spark, path, list(key), wanted), "word", "n", "value") == expected
    monkeypatch.setattr(keyed, "LISTED_KEYS", 1)
    assert rows(keyed.lookup(spark, path, list(key), wanted), "word", "n", "value") == expected
    assert keyed.lookup(spark, path, list(key), wanted.limit(0)).collect() == []


def test_only_the_buckets_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, buckets=16, batches=4)
    wanted = spark.createDataFrame([("w7",)], "word string")
    found = keyed.lookup(spark, path, ["word"], wanted)
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [(_bucket" in plan
    assert "PushedFilters: [IsNotNull(word), EqualTo(word,w7)]" in plan or "EqualTo(word,w7)" in plan
    assert rows(found, "word") == [("w7",)] or rows(found, "word") == []


def test_a_table_made_without_buckets_stays_as_it_is(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create_table(spark, path, SCHEMA)
    keyed.create_table(spark, path, SCHEMA, buckets=4)  # too late: it is there
    keyed.upsert(spark.createDataFrame([("a", 1, 1.0)], SCHEMA), path, ["word"], 0)
    wanted = spark.createDataFrame([("a",)], "word string")
    assert rows(keyed.lookup(spark, path, ["word"], wanted), "word", "n", "value") == [("a", 1, 1.0)]
