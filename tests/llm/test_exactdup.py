"""The extendible-hash index against a dictionary."""

from hashlib import sha256

import numpy as np
import pytest

from rillflow.llm import exactdup

DOCS = "doc_id long, text string, keep_id string"


def plain(text):
    return (text or "").encode().lower()


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(plain(text), []).append(doc_id)
    out, kept = [], set()
    for doc_id, text in rows:
        own = groups[plain(text)]
        keep = max((d for d in own if d is not None), default=None)
        stays = doc_id == keep and plain(text) not in kept
        if stays:
            kept.add(plain(text))
        out.append((doc_id, keep, len(own), stays, sha256(plain(text)).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash") for r in rows], DOCS).repartition(3)
    return sorted((tuple(r) for r in exactdup.exact_duplicates(df, **options).collect()), key=repr)


ROWS = [
    *[(i, f"text {i % 40}") for i in range(200)],
    *[(1000 + i, "Hot Text") for i in range(150)],
    (2001, "HOT TEXT"), (2002, "É"), (2003, "é"), (2004, ""), (2005, None), (2006, " "),
    (None, "hot text"), (None, "alone"), (None, "alone"), (3000, "twice"), (3000, "twice"), (3000, "other"),
    (4000, "long " * 50_000), (4001, "LONG " * 50_000), (4002, "long " * 50_000 + "x"),
]


@pytest.mark.parametrize("bits", [64, 17, 3])
def test_against_a_dictionary(spark, bits):
    assert found(spark, ROWS, capacity=4, key_bits=bits) == brute(ROWS)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_directory_doubles_until_buckets_fit():
    keys = np.zeros(1 << exactdup.MAX_DEPTH, np.int64)
    rng = np.random.default_rng(1)
    np.add.at(keys, rng.integers(0, len(keys), 5000), 1)
    keys[77] += 900
    directory = exactdup.Directory(keys, 50)
    buckets = directory.buckets()
    assert len(buckets) == len(keys)
    held = np.bincount(buckets, weights=keys)
    assert held.tolist() == directory.keys
    full = [b for b, n in enumerate(held) if n > 50]
    assert full == [buckets[77]] and directory.local[buckets[77]] == exactdup.MAX_DEPTH == directory.depth
    for bucket, depth in enumerate(directory.local):
        own = np.flatnonzero(buckets == bucket)
        assert len(own) == 1 << (exactdup.MAX_DEPTH - depth) == own[-1] - own[0] + 1


def test_directory_of_few_keys_is_one_bucket():
    keys = np.zeros(1 << exactdup.MAX_DEPTH, np.int64)
    keys[5] = 3
    assert exactdup.Directory(keys, 4).depth == 0
