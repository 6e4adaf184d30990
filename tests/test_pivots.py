"""The pivot index against all distances, and the blocks it leaves unread."""

import math
import random

import numpy as np
import pytest

from conftest import rows
from rillflow.operators import pivots


def brute(data, asked):
    points, out = {w: v for w, v in data if v is not None}, []
    for word, n in sorted(set(asked)):
        if word not in points:
            out.append((word, n, False, None, None, None, None))
            continue
        distances = {w: math.sqrt(sum((a - b) ** 2 for a, b in zip(v, points[word]))) for w, v in points.items()}
        farthest = max(distances.values())
        near = sorted((d, w) for w, d in distances.items() if w != word)[: max(n, 0)]
        for rank, (d, w) in enumerate(near, 1):
            out.append((word, n, True, rank, w, round(d, 9), math.floor(100 * (1 - d / farthest)) if farthest else None))
    return sorted(out, key=repr)


def found(spark, tmp_path, data, asked, **options):
    vectors = spark.createDataFrame(data, "word string, vector array<double>").repartition(3)
    pivots.build_index(vectors, str(tmp_path / "index"), **options)
    index = pivots.open_index(spark, str(tmp_path / "index"))
    answer, read = pivots.nearest_indexed(index, spark.createDataFrame(asked, "word string, n int"), queries_per_block=3)
    answer = answer.selectExpr("query", "n", "known", "rank", "word", "round(distance, 9)", "percent")
    return sorted((tuple(r) for r in answer.collect()), key=repr), read, index


def clustered(n, seed, size=4):
    rng = random.Random(seed)
    centres = [[rng.uniform(-50, 50) for _ in range(size)] for _ in range(6)]
    return [(f"w{i:04d}", [x + rng.gauss(0, 1) for x in centres[i % 6]]) for i in range(n)]


def test_exact_and_blocks_left_unread(spark, tmp_path):
    data = clustered(900, 1)
    asked = [(f"w{i:04d}", 5) for i in range(0, 900, 90)]
    got, read, index = found(spark, tmp_path, data, asked, rows_per_block=16, pivots=8)
    assert got == brute(data, asked)
    blocks = index.bounds.count()
    assert blocks == -(-900 // 16)
    assert read.count() == read.distinct().count() < 0.5 * blocks * len(asked)


@pytest.mark.parametrize("options", [{}, {"rows_per_block": 3, "pivots": 2}, {"rows_per_block": 5, "pivots": 40, "sample": 7}])
def test_ties_unknown_words_and_large_n(spark, tmp_path, options):
    rng = random.Random(2)
    data = [(f"w{i:02d}", [float(rng.randint(0, 2)) for _ in range(3)]) for i in range(60)] + [("none", None)]
    asked = [("w00", 3), ("w01", 100), ("w00", 1), ("nobody", 2), ("w05", 7), ("w05", 7), ("none", 1)]
    assert found(spark, tmp_path, data, asked, **options)[0] == brute(data, asked)


def test_few_vectors(spark, tmp_path):
    same = [("a", [1.0]), ("b", [1.0])]
    assert found(spark, tmp_path / "1", same, [("a", 1)])[0] == [("a", 1, True, 1, "b", 0.0, None)]
    assert found(spark, tmp_path / "2", same[:1], [("a", 1), ("z", 1)])[0] == [("z", 1, False, None, None, None, None)]
    assert found(spark, tmp_path / "3", [], [("a", 1)])[0] == [("a", 1, False, None, None, None, None)]
    assert found(spark, tmp_path / "4", same, [])[0] == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(200, 5))
    chosen = pivots.spread_out(points, 6)
    assert len(chosen) == 6 == len(np.unique(chosen, axis=0))
    distances = pivots._to_pivots(points, chosen)
    import pyarrow as pa

    block = pa.RecordBatch.from_pydict(
        {"block": [0], "low": [distances[:50].min(axis=0).tolist()], "high": [distances[:50].max(axis=0).tolist()]}
    )
    _, least, most = pivots._bounded(block, distances)
    true = np.sqrt(((points[:, None] - points[None, :50]) ** 2).sum(axis=2))
    assert (least[:, 0] <= true.min(axis=1)).all() and (most[:, 0] >= true.max(axis=1)).all()
