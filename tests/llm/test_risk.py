"""Quality counts by plain loops, binomial bounds by fractions, and the promise on planted strata."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import numpy as np
import pytest

from rillflow.llm import risk

DOCS = "doc_id long, text string, lang string, n_words string, step string, kept string"
LABELS = "doc_id long, quality int, hash string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines)
    )


TEXTS = [
    None, "", " ", "one", "a b c d e", "a b c d e a b c d e", "a a a a a a", "a b c d e f\na b c d e\n\n x\r\nx\r\n",
    "x\x0by\x0cz\x1f w v", "#$ %& |<>*", "ñandú 漢字 €\n" * 9, "a b c d e f g b c d e f h", "line\n\nline\nline \n" * 4,
]


def test_counts():
    rng = random.Random(4)
    more = [" ".join(rng.choices("abc", k=rng.randint(1, 60))) for _ in range(200)]
    for text in TEXTS + more + ["word " * 100_000]:
        found = risk.counts_of(None if text is None else text.encode())
        if len(text or "") < 1000:
            assert found == brute_counts(text), text
        else:
            assert found == (100_000, 400_000, 0, 0, 100_000, 1)


@pytest.mark.parametrize("n, p", [(1, 0.5), (10, 0.02), (40, 0.3), (217, 0.02), (500, 0.05)])
def test_binomial_tail_is_exact(n, p):
    exact = Fraction(p)
    total = Fraction(0)
    for x in range(min(n, 60)):
        total += comb(n, x) * exact**x * (1 - exact) ** (n - x)
        assert abs(risk.lower_tail(n, p, x) - float(total)) < 1e-9
    for delta in (0.2, 0.0125):
        most = risk.most_rejected(n, p, delta)
        assert most == -1 or risk.lower_tail(n, p, most) <= delta
        assert risk.lower_tail(n, p, most + 1) > delta
        if most >= 0:
            assert risk.upper_bound(n, most, delta) <= p + 1e-9
            assert risk.upper_bound(n, most + 1, delta) > p


def test_large_counts():
    assert risk.lower_tail(10**9, 0.02, 2 * 10**7 - 10**6) < 1e-9
    assert 0.49 < risk.lower_tail(10**7, 0.02, 2 * 10**5) < 0.51
    assert risk.lower_tail(10**6, 0.02, 10**6) == 1


def planted(n, seed=1):
    """Three strata: symbols betray the bad ones in the first, nothing does in the second, the third has few labels."""
    rng = random.Random(seed)
    docs, labels = [], []
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 7)))
    for i in range(n):
        lang = ["xx", "yy", None][i % 3]
        bad = rng.random() < 0.3
        words = [word() for _ in range(rng.randint(12, 30))]
        if bad and lang == "xx":
            words = [w + "##" for w in words]
        docs.append((i, " ".join(words), lang))
        if lang is not None or i < 60:
            labels.append((i, 0 if bad else 1))
    return docs, labels


def run(spark, docs, labels, **options):
    d = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in docs], DOCS).repartition(3)
    return risk.judge(d, spark.createDataFrame([(*r, "clash") for r in labels], LABELS), **options)


def test_rejects_what_labels_support_and_spares_the_good(spark):
    docs, labels = planted(3000)
    quality = dict(labels)
    rows = run(spark, docs, labels).collect()
    assert len(rows) == len(docs)
    by_lang = {"xx": [], "yy": [], None: []}
    for r in rows:
        assert tuple(r)[1:6] == brute_counts(docs[r.doc_id][1])[:5]
        by_lang[docs[r.doc_id][2]].append((quality.get(r.doc_id), r.kept, r.rejected_by))
    assert all(not kept and by == "symbols" for q, kept, by in by_lang["xx"] if q == 0)
    for some in by_lang.values():
        good = [kept for q, kept, _ in some if q == 1]
        assert np.mean(good) >= 0.98
    assert all(kept for _, kept, _ in by_lang[None])  # too few labels for any cutoff


def test_steps_and_cutoffs_by_brute_force(spark):
    docs, labels = planted(1500, 2)
    d = spark.createDataFrame([(*r, "", "", "") for r in docs], DOCS)
    counted = risk.features(d)
    cutoffs = {r.stratum: r for r in risk.certified_cutoffs(counted, spark.createDataFrame([(*r, "") for r in labels], LABELS)).collect()}
    levels = counted.select("doc_id", "stratum", *(c.alias(f"_{n}") for n, c in risk.rules().items())).collect()
    verdicts = {r.doc_id: r for r in run(spark, docs, labels).collect()}
    for r in levels:
        plan = cutoffs.get(r.stratum)
        steps = []
        for rule in range(len(risk.rules())):
            if plan:
                for step in range(risk.LEVELS - plan.targets[rule]):
                    if r[2 + rule] > risk.LEVELS - 1 - step:
                        steps.append(plan.offsets[rule] + step)
                        break
        rejected = bool(steps) and plan.last_step >= 0 and min(steps) <= plan.last_step
        v = verdicts[r.doc_id]
        assert v.base_failed == (v.n_words < 10 or 100 * v.n_repeat_words > 20 * v.n_words)
        assert v.kept == (not v.base_failed and not rejected)


def test_false_rejection_stays_below_alpha_in_most_draws():
    """The certified step on many random holdouts: a true risk above alpha passes with probability delta at most."""
    rng = np.random.default_rng(5)
    n, alpha, delta = 400, 0.05, 0.1
    most = risk.most_rejected(n, alpha, delta)
    wrong = (rng.binomial(n, alpha * 1.0001, 20_000) <= most).mean()
    assert wrong <= delta + 0.01


def test_odd_rows_and_empty_tables(spark):
    docs = [(1, None, None), (None, "a b c d e f g h i j k", "xx"), (2, "", "xx"), (2, "b " * 50, "xx"), (3, "x " * 9, None)]
    rows = sorted((tuple(r) for r in run(spark, docs, []).collect()), key=repr)
    assert [(r[0], r[-3], r[-2]) for r in rows] == [(1, True, False), (2, True, False), (2, True, False), (3, True, False), (None, False, True)]
    assert run(spark, [], [(1, 0), (1, None), (None, 1)]).collect() == []
    assert len(run(spark, docs, [(1, 0), (1, 1), (2, None), (None, 1)]).collect()) == len(docs)
