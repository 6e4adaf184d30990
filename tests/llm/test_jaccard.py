"""The n-gram Jaccard join against all pairs."""

import random
import re
from itertools import combinations

import pytest

from rillflow.llm import jaccard

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, width=5):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent=80):
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for (i, (_, a)), (j, (_, b)) in combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            part[max(find(i), find(j))] = min(find(i), find(j))
    lowest = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            lowest[find(i)] = min(doc_id, lowest.get(find(i), doc_id))
    return sorted(
        ((d, len(s), lowest.get(find(i), d)) for i, (d, s) in enumerate(sets)), key=lambda r: (r[0] is None, r)
    )


def found(spark, rows):
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS).repartition(3)
    return sorted(
        (tuple(r) for r in jaccard.near_duplicates(df).collect()), key=lambda r: (r[0] is None, r)
    )


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        words[at : at + rng.choice([0, 1])] = [f"w{rng.randrange(5000)}"]
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for base in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 12, 40, 150]))]
        if base % 3 == 0:
            words += passage
        for _ in range(rng.choice([1, 3, 8])):
            text = " ".join(edited(rng, words, rng.choice([0, 1, 2, 4])))
            rows.append(text.title() if rng.random() < 0.2 else text)
    rows += rows[:4] + ["  ", "", None, None, "a b", "A  b", "a b c d e", "ÀB c", "àb c"]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert found(spark, rows) == brute(rows)


def test_chain_and_edge_of_the_threshold(spark):
    # 9 shingles, 8 shared: 8 of 10 is a link; 10 words with one more word each side.
    a = " ".join(f"x{i}" for i in range(13))
    b = " ".join(f"x{i}" for i in range(1, 14))
    c = " ".join(f"x{i}" for i in range(2, 15))
    rows = [(7, a), (3, b), (9, c), (1, "other words here they are")]
    assert found(spark, rows) == brute(rows)
    assert {r[2] for r in found(spark, rows)} == {1, 3}


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, None), (2, "z"), (2, "q r s t u v")]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_very_long_text(spark):
    assert found(spark, []) == []
    long = " ".join(f"w{i % 9973}" for i in range(60_000))
    rows = [(1, long), (2, long + " tail"), (3, "short")]
    assert found(spark, rows) == brute(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = list(enumerate(" ".join(edited(rng, base, rng.choice([1, 2, 3, 4]))) for _ in range(90)))
    assert found(spark, rows) == brute(rows)
