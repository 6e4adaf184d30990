import pytest
from pyspark.sql import functions as F

from conftest import rows
from rillflow.operators import embedding, membership, vocabulary


def shuffled_rows(df):
    """Rows that the shuffles of a collected DataFrame have written, in the order of the plan."""
    df.collect()
    found, open_nodes = [], [df._jdf.queryExecution().executedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            open_nodes.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            open_nodes.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        open_nodes.extend(children.apply(i) for i in range(children.size()))
    return found


@pytest.mark.parametrize("slots", [1, 4, 1024])
def test_members_are_never_rejected(spark, slots):
    words = spark.range(3000).select(F.concat(F.lit("w"), "id").alias("word"), "id")
    members = words.filter("id % 3 = 0")
    bits = membership.member_filter(members, "word", slots)
    assert bits.count() <= slots
    told = membership.flagged(words, "word", bits, slots)
    assert told.filter("id % 3 = 0 and not _maybe").count() == 0
    assert told.count() == 3000
    if slots == 1024:  # 65,536 bits for 1,000 members: 1.5 % of the others are let through
        assert told.filter("id % 3 != 0 and _maybe").count() < 100


def test_sizes(spark):
    assert [membership.slots_for(n) for n in (0, 1, 16, 1000, 10**12)] == [1, 1, 4, 256, membership.MAX_SLOTS]
    words = spark.createDataFrame([("a",), (None,), ("a",)], "word string")
    told = membership.flagged(words, "word", membership.member_filter(words.limit(0), "word", 8), 8)
    assert rows(told.select("_maybe")) == [(False,)] * 3
    bits = membership.member_filter(words, "word", 8)
    assert rows(membership.flagged(words, "word", bits, 8).filter("word = 'a'"), "_maybe") == [(True,), (True,)]
    assert [r._maybe for r in membership.flagged(words, "word", bits, 8).filter("word is null").collect()] == [False]
    with pytest.raises(ValueError):
        membership.flagged(words, "word", bits, 2 * membership.MAX_SLOTS)


@pytest.fixture(scope="module")
def corpus(spark):
    """500 texts of 20 words: 17 of 90 known ones, and three that are nearly never the same twice."""
    alphabet = "bcdfghjklm"

    def name(n):
        return "".join(alphabet[int(d)] for d in f"{n:04d}")

    texts = [(i, " ".join([name((i * 7 + j) % 90) for j in range(17)] + [name(100 + (i * 3 + j) % 900) for j in range(3)]))
             for i in range(500)]
    vocab = spark.createDataFrame([(name(n), n, [0.0]) for n in range(90)], "word string, id int, vector array<double>")
    return spark.createDataFrame(texts + [(1, texts[1][1]), (600, None), (601, "")], "doc_id bigint, text string"), vocab


@pytest.mark.parametrize("most", [1, membership.MAX_SLOTS])
def test_new_words_with_and_without_broadcast(corpus, most):
    texts, vocab = corpus
    plain = rows(vocabulary.new_words_by_text(texts, vocab))
    assert len(plain) == 1500
    assert rows(vocabulary.new_words_by_text(texts, vocab, broadcast_bytes=0, max_slots=most)) == plain


def test_only_new_words_are_shuffled(corpus):
    texts, vocab = corpus
    found = vocabulary.new_words_by_text(texts, vocab, broadcast_bytes=0)
    assert max(shuffled_rows(found)) <= 1503  # of 10,020 words


def test_unknown_words_are_not_shuffled_for_the_contexts(spark, corpus):
    texts, vocab = corpus
    few = vocab.filter("id < 9")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sifted, plain = embedding.occurrences(texts, few, sift=True), embedding.occurrences(texts, few)
        assert rows(sifted) == rows(plain)
        assert max(shuffled_rows(sifted)) < max(shuffled_rows(plain)) / 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
