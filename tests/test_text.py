from pyspark.sql import functions as F

from conftest import rows
from rillflow.functions import text
from rillflow.functions.vectors import seeded_vector
from rillflow.operators import vocabulary


def test_tokens(spark):
    texts = ["  Hello,  World\tagain", "line\nbreak", "see http://t.co/x", "It's 42 `ok`", "", "123 !!", "Ärger ünd"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r[0] for r in df.select(text.tokens(F.col("t"))).collect()]
    assert got == [
        ["hello", "world", "again"], ["linebreak"], ["see", "httptcox"], ["it's", "`ok`"], [], [], ["rger", "nd"]
    ]


def test_word_rules(spark):
    words = ["httptco", "the", "won't", "", "dog"]
    df = spark.createDataFrame([(w,) for w in words], "w string").coalesce(1)
    assert [r[0] for r in df.select(text.may_become_word(F.col("w"))).collect()] == [
        False, False, False, False, True
    ]
    digits = spark.createDataFrame([("a1",), ("a",)], "w string").coalesce(1)
    assert [r[0] for r in digits.select(text.contains_digit(F.col("w"))).collect()] == [True, False]
    assert len(text.STOP_WORDS) == len(set(text.STOP_WORDS)) == 174


def test_kept_texts(spark):
    data = [(1, "x", "en", None), (2, "x", "en", "orig"), (3, "x", "de", None), (4, "x", None, None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, retweet_text string")
    assert rows(vocabulary.kept_texts(df)) == [(1, "x"), (2, "orig")]


def test_new_words(spark):
    texts = spark.createDataFrame([(1, "dog the dog cat"), (2, "dog bird http://x")], "doc_id bigint, text string")
    vocab = spark.createDataFrame([("cat", 0, [0.0])], "word string, id int, vector array<double>")
    assert rows(vocabulary.new_words_by_text(texts, vocab)) == [(1, "dog"), (2, "bird"), (2, "dog")]
    assert rows(vocabulary.new_words_by_text(texts, vocab, broadcast_bytes=0)) == [
        (1, "dog"), (2, "bird"), (2, "dog")
    ]
    assert rows(vocabulary.new_words(texts, vocab)) == [("bird",), ("dog",)]


def test_contenders(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 10), ("d", 11)], "word string, n bigint")
    seen = spark.createDataFrame([("a",), ("e",), ("a",)], "word string")
    assert rows(vocabulary.count_contenders(old, seen)) == [("a", 2), ("b", 2), ("c", 10), ("d", 11), ("e", 1)]
    assert rows(vocabulary.decay_contenders(old)) == [("b", 1), ("c", 9), ("d", 10)]
    vocab, weights, others = vocabulary.admit(old, 7, 3)
    assert rows(others) == [("a", 1), ("b", 2), ("c", 10)]
    assert rows(vocab, "word", "id") == [("d", 7)] and rows(weights, "id") == [(7,)]


def test_seeded_vectors(spark):
    df = spark.createDataFrame([(f"w{i}",) for i in range(500)], "w string")
    got = df.select(seeded_vector(F.col("w"), 4, "word").alias("v"), seeded_vector(F.col("w"), 4, "weight").alias("u"))
    values = [x for r in got.collect() for x in (*r.v, *r.u)]
    assert len(set(values)) == len(values) and all(-1 <= x < 1 for x in values)
    assert abs(sum(values) / len(values)) < 0.05
