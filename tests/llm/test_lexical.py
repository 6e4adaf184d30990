"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rillflow.llm import lexical

DOCS = "doc_id long, text string, terms string, n string, query long"
ITEMS = "item_id long, text string, rank int, score long"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(PATTERN.findall((text or "").translate(LOWER)))


def brute(docs, items, k=10):
    counts = [(doc_id, terms(text)) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    total, words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in items:
        asked, scored = terms(text), []
        for doc_id, c in counts:
            m = 25 + (75 * sum(c.values()) * total) // words
            score = sum(n * weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, n in asked.items() if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def found(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame([(*r, "clash", "clash", 1) for r in docs], DOCS).repartition(parts)
    i = spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS)
    return sorted((tuple(r) for r in lexical.top_documents(d, i, **options).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["ÄÖ", "ñu", "漢字", "X9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda size: " ".join(rng.choices(words, weights, k=size)) + rng.choice([".", "\n", "! "])
    docs = [(i, text(rng.randint(0, 60))) for i in range(n)]
    passage = text(25)
    docs += [(5000 + i, passage) for i in range(n // 3)]  # copies: equal scores
    docs += [(7000 + i, text(5) + passage) for i in range(20)]
    docs += [(8000, None), (8001, ""), (8002, "?!"), (None, passage), (None, "w1"), (8003, "w1"), (8003, "w1 w2")]
    docs += [(8004, "w7 " * 30_000), (8005, "w250 w251 " * 3)]
    items = [(i, text(rng.randint(1, 30))) for i in range(12)]
    items += [(100, passage), (100, passage), (101, None), (102, ""), (103, "unheard of"), (None, "W1 w2"), (104, "w1 w1 w1")]
    return docs, items


@pytest.mark.parametrize(
    "options", [{}, {"most_docs": 40, "block": 4}, {"per_block": 5, "block": 1}, {"most_postings": 200, "block": 16, "k": 3}]
)
def test_against_all_scores(spark, options):
    docs, items = corpus(1, 300)
    assert found(spark, docs, items, **options) == brute(docs, items, options.get("k", 10))


def test_no_documents_no_items(spark):
    docs, items = corpus(2, 5)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None)], items) == []


def test_terms_split_anywhere():
    text = "Ab,cd ÄB\x00x9—é _z" * 50
    assert lexical.term_counts(text.encode(), 7) == {t.encode(): n for t, n in terms(text).items()}


def test_blocks_are_skipped_and_bounds_hold():
    docs, items = corpus(3, 3000)
    counts = [terms(t) for _, t in docs]
    names = sorted(set().union(*counts))
    number = {t: i for i, t in enumerate(names)}
    df = Counter(t for c in counts for t in c)
    weights = np.array([math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) for t in names])
    sizes = np.array([len(c) for c in counts])
    ids = np.array([d if d is not None else 0 for d, _ in docs])
    tfs = np.array([n for c in counts for n in c.values()])
    norms = np.repeat([25 + sum(c.values()) for c in counts], sizes)
    flat = np.array([number[t] for c in counts for t in c])
    good = sizes > 0
    alone = np.array([d is None for d, _ in docs])[good]
    shard = lexical.Shard(ids[good], alone, sizes[good], flat, lexical.impacts_of(tfs, norms), weights, 16)
    for term in range(0, len(names), 7):
        rows, block = shard.blocks(term)
        assert sorted(rows) == sorted(shard.listed(term)) and (np.diff(block) >= 0).all()
        assert np.bincount(block).max() <= 16
        columns = np.arange(len(names))
        summary = shard.summaries(rows, block, columns)
        query = np.zeros(len(names), np.int64)
        query[::3] = weights[::3]
        assert (shard.scores(rows, query) <= (summary @ query)[block]).all()
    asked = []
    for _, text in items:
        own = {number[t]: n for t, n in terms(text).items() if t in number}
        at = np.array(sorted(own), np.int64)
        asked.append((at, np.array([own[t] * weights[t] for t in at.tolist()], np.int64)))
    search = lexical.Search(asked, weights, np.zeros(len(asked), np.int64), 10)
    search.add(shard)
    assert search.scored < search.blocks / 2
