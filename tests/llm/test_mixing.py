"""Mixing and sharding: running sums, targets, positions, trees."""

import math
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from rillflow.llm import curriculum, hashtree
from rillflow.llm.running import running_sum

DOCS = "doc_id long, text string, lang string, source string, n_chars long, target string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, None, s, None, "clash") for d, t, s in rows], DOCS).repartition(3)


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        source = rng.choice(["a", "a", "a", "B", "ä", "zz", None])
        rows.append((i, " ".join(["w"] * rng.randrange(0, 40)), source))
    return rows + [(700, None, "a"), (701, "", None), (702, "only one", "lonely"), (703, "x " * 20_000, "B"), (704, None, "void")]


def filled(sizes, weights, share, cap):
    """Water filling by bisection."""
    low, high = 0.0, 1e12
    want = share * sum(sizes.values())
    for _ in range(300):
        level = (low + high) / 2
        got = sum(min(cap * sizes[s], level * weights[s]) for s in sizes)
        low, high = (level, high) if got < want else (low, level)
    return {s: min(cap * sizes[s], high * weights[s]) for s in sizes}


def test_curves_have_the_weights_asked_for():
    curves = (curriculum.STEADY, curriculum.GROWING, curriculum.FADING)
    assert [round(curriculum.mean_weight(c), 12) for c in curves] == [3.0, 1.0, 2.0]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_takes(spark, seed):
    rows = corpus(seed)
    got = curriculum.mix(table(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        sizes[r.source] += r.size
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    expected = filled(sizes, weights, 1.5, 2.0)
    words = {d: len((t or "").split()) for d, t, _ in rows}
    positions = defaultdict(list)
    for r in got:
        own = sum(t.words for t in r.takes)
        assert r.size == words[r.doc_id] and own <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source], rel=1e-9, abs=1e-9)
        taken[r.source] += own
        targets[r.source] = r.target
        positions[r.source] += [(t.position, t.words) for t in r.takes]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 1
        # The weight up to any time is the curve's integral.
        curve = (curriculum.STEADY, curriculum.GROWING, curriculum.FADING)[order.index(source) % 3]
        largest = max((w for _, w in positions[source]), default=0)
        for t in (0.2, 0.5, 0.8):
            up_to = [(a, b) for a, b in curve if a < t]
            a, b = up_to[-1], next(k for k in curve if k[0] >= t)
            w = a[1] + (b[1] - a[1]) * (t - a[0]) / (b[0] - a[0])
            part = curriculum.mean_weight([*up_to, (t, w)]) / curriculum.mean_weight(curve)
            met = sum(words for position, words in positions[source] if position <= t)
            assert abs(met - part * target) <= largest + 1


def test_reruns_agree_whatever_the_partitions(spark):
    rows = corpus()
    one, two = table(spark, rows), table(spark, rows[::-1]).repartition(7)
    assert sorted(map(str, curriculum.mix(one).collect())) == sorted(map(str, curriculum.mix(two).collect()))


def test_training_order(spark):
    rows = corpus(3)
    docs = table(spark, rows)
    mixed = curriculum.mix(docs)
    out = curriculum.in_training_order(docs, mixed)
    assert out.columns == docs.columns
    texts = {d: t for d, t, _ in rows}
    expected = Counter()
    for r in mixed.collect():
        for take in r.takes:
            expected[r.doc_id, take.words] += 1
    got = Counter((r.doc_id, len(r.text.split())) for r in out.collect())
    assert got == expected
    whole = [r for r in out.collect() if len(r.text.split()) == len((texts[r.doc_id] or "").split())]
    assert all(r.text == texts[r.doc_id] for r in whole) and len(whole) > 0.9 * sum(got.values())


def test_empty_and_wordless_tables(spark):
    assert curriculum.mix(table(spark, [])).collect() == []
    [row] = curriculum.mix(table(spark, [(1, None, None)])).collect()
    assert (row.size, row.target, row.takes) == (0, 0.0, [])


def test_repeated_rows_are_documents_of_their_own(spark):
    got = curriculum.mix(table(spark, [(1, "a b c d", "s")] * 6)).collect()
    assert len(got) == 6 and sum(t.words for r in got for t in r.takes) == 36


def test_running_sum_of_a_hot_group(spark):
    df = spark.range(5000).select(
        "id",
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 4).alias("g"),
        F.xxhash64("id").alias("h"),
        (F.col("id") % 7).alias("v"),
    )
    sums, expected = Counter(), {}
    for r in sorted(df.collect(), key=lambda r: r.h % (1 << 64)):
        expected[r.id] = sums[r.g]
        sums[r.g] += r.v
    got = {r.id: r.before for r in running_sum(df, "g", "h", ["id"], "v", "before").collect()}
    assert got == expected


def placed(spark, rows, tree, grown=None):
    return hashtree.shard_documents(table(spark, rows), tree, grown).collect()


def test_slots_sizes_and_growth(spark):
    rows = corpus() + [(None, "no id", "a"), (None, "no id", "a"), (5, "again", "a")]
    rows += [(1000 + i, f"text {i}", "a") for i in range(6000)]
    got = placed(spark, rows, hashtree.regular_tree(16), hashtree.regular_tree(17))
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(16))
    assert sum(r.size for r in got) == sum(len((t or "").encode()) + 1 for _, t, _ in rows)
    moved = sum(r.grown_shard != r.shard for r in got) / len(got)
    assert 0.04 < moved < 0.08
    assert max(map(len, slots.values())) < 1.3 * len(rows) / 16
    assert len({r.shard for r in got if r.doc_id is None}) == 1


def test_weights_decide_the_shares_and_confine_movement(spark):
    rows = [(i, "", None) for i in range(20_000)]
    tree = {"r1": {"k1": {0: 1.0, 1: 3.0}, "k2": {2: 2.0}}, "r2": {"k3": {3: 2.0, 4: 0.0}}}
    before = {r.doc_id: r for r in placed(spark, rows, tree)}
    share = Counter(r.shard for r in before.values())
    assert {s: round(n / 2500) for s, n in share.items()} == {0: 1, 1: 3, 2: 2, 3: 2}
    # Another split inside r1/k1 of the same sum moves nothing outside that rack.
    other = {"r1": {"k1": {0: 3.0, 1: 1.0}, "k2": {2: 2.0}}, "r2": {"k3": {3: 2.0}}}
    for r in placed(spark, rows, other):
        assert before[r.doc_id].rack == r.rack and (r.rack == "k1" or before[r.doc_id].shard == r.shard)


def test_empty_table_of_shards(spark):
    assert placed(spark, [], hashtree.regular_tree(16)) == []


def drawn_plainly(key, tree, seed=5):
    """Region, rack and shard by the definition: at each level the least exponential draw."""

    def hashed(*parts):
        h = 42
        for part in parts:
            raw = part.to_bytes(4, "little") if isinstance(part, int) else part.encode()
            h = xxhash.xxh64_intdigest(raw, seed=h)
        return h

    def least(children):
        if len(children) == 1:
            return children[0][0]
        rate = {n: -math.log((hashed(seed, str(n), key) >> 11) / 2**53 + 2.0**-54) / w for n, w in children}
        return min(rate, key=rate.get)

    def weight(node):
        return sum(map(weight, node.values())) if isinstance(node, dict) else node

    def children(node):
        return [(n, weight(below)) for n, below in node.items() if weight(below) > 0]

    region = least(children(tree))
    rack = least(children(tree[region]))
    return region, rack, least(children(tree[region][rack]))


def test_draws_against_the_definition(spark):
    rows = [(i, "", None) for i in range(-500, 1500)] + [(None, "", None)]
    uneven = {"r1": {"k1": {0: 1.0, 1: 3.0}, "k2": {2: 2.0}}, "r2": {"k3": {3: 2.0, 4: 0.0}}, "r3": {"k4": {5: 0.0}}}
    for tree in (uneven, hashtree.regular_tree(17)):
        for r in placed(spark, rows, tree):
            key = "\0null" if r.doc_id is None else str(r.doc_id)
            assert (r.region, r.rack, r.shard) == drawn_plainly(key, tree)


def test_a_grown_tree_has_a_shard_more():
    assert math.isclose(sum(1.0 for r in hashtree.regular_tree(17).values() for k in r.values() for _ in k), 17)
