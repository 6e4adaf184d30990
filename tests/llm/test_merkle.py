"""Merkle trees and proofs against hashlib, level by level."""

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from rillflow.llm import merkle, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree long, path string, root string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    return h(*map(encoded, (doc_id, source, lang, None if n_chars is None else n_chars + more, text)))


def tree(leaves, arity):
    """The root and per leaf the (left, right) of every level."""
    nodes, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for path, i in zip(paths, at):
            run, j = runs[i // arity], i % arity
            path.append(("".join(run[:j]), "".join(run[j + 1 :])))
        nodes, at = [h(*run) for run in runs], [i // arity for i in at]
    return nodes[0], paths


def brute(rows, arity):
    least = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = [sorted((r for r in rows if r[2] == lang), key=lambda r: (*least(r[0]), leaf(r))) for lang in langs]
    made = [tree([leaf(r) for r in group], arity) for group in groups]
    root, above = tree([m[0] for m in made], arity)
    out = []
    for group, (subroot, paths), top in zip(groups, made, above):
        for row, path in zip(group, paths):
            whole = path + top
            tampered = row[0] is not None and crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, int(tampered))
            for left, right in whole:
                node = h(left, node, right)
            out.append((row[0], leaf(row), subroot, root, h(*(a + b for a, b in whole)), node))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "clash", "clash") for r in rows], DOCS).repartition(3)
    leaves = merkle.documents_manifest(df, **options)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    start = F.when(tampered, F.coalesce("changed", "leaf")).otherwise(F.col("leaf"))
    path = F.col("path")
    df = leaves.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(path), 256), merkle.folded(start, path)
    )
    return sorted((tuple(r) for r in df.collect()), key=repr)


ROWS = [
    *[(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(70)],
    *[(200 + i, "copy", "de", "s", 4) for i in range(9)],
    *[(300 + i, "ñandú €", "zh-漢", None, 7) for i in range(3)],
    (400, "alone", "fr", "s", 5), (401, None, None, None, None), (402, "", None, "", 0), (None, "x", "en", "s", 1),
    (5, "text 5", "en", "s2", 5), (5, "other", "en", "s2", 5), (500, "long " * 50_000, "", "s", 250_000),
    (-3, "minus", "en", "s", (1 << 63) - 2),
]


@pytest.mark.parametrize("arity, height", [(2, 6), (2, 1), (3, 2)])
def test_against_hashlib(spark, arity, height):
    assert found(spark, ROWS, arity=arity, height=height) == brute(ROWS, arity)


def test_sizes_around_a_block(spark):
    rows = [(100 * n + i, f"t{i}", f"l{n}", "s", i) for n in (1, 2, 3, 4, 5, 8, 9, 16, 17) for i in range(n)]
    assert found(spark, rows, height=2) == brute(rows, 2)
    assert found(spark, rows[:1]) == brute(rows[:1], 2)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_a_changed_document_does_not_verify(spark):
    df = queries.op11_merkle(spark, "/root/testdata/sf0.001")
    rows = df.collect()
    docs = {r.doc_id: r for r in queries.documents(spark, "/root/testdata/sf0.001").collect()}
    for r in rows:
        changed = crc32(str(r.doc_id).encode()) % 7 == 0 and docs[r.doc_id].n_chars is not None
        assert r.verified == (not changed)
    assert 0 < sum(r.verified for r in rows) < len(rows) == len(docs)
