"""Cross-parsing against a plain search, and held-out accuracy."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import language, queries

DOCS = "doc_id long, text string, lang string, source string, lang_pred string"

SAMPLES = {
    "en": [b"the quick brown fox jumps over the lazy dog", b"and the cat sat on the mat with the hat"],
    "de": ["der schnelle braune fuchs springt über den faulen hund".encode(), b"und die katze liegt auf dem dach"],
}


def slow_phrases(parser, samples, text):
    """Greedy longest matches, tried one by one, block by block."""
    known = [bytes(parser.classes[np.frombuffer(s, np.uint8)]) for s in samples]
    count = 0
    for start in range(0, len(text), language.BLOCK):
        block = bytes(parser.classes[np.frombuffer(text[start : start + language.BLOCK], np.uint8)])
        at = 0
        while at < len(block):
            size = 0
            while at + size < len(block) and any(block[at : at + size + 1] in s for s in known):
                size += 1
            at += max(1, size)
            count += 1
    return count


def test_phrases_against_a_plain_search():
    parser = language.CrossParser(SAMPLES)
    rng = random.Random(2)
    letters = "thequickbrownfxjmpsvlazydguüß  .7日"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 90))).encode() for _ in range(60)]
    texts += [b"the fox and the dog " * 150, b"", b"der hund", "über den hund ".encode() * 200, bytes(range(1, 256))]
    found = parser.phrases(texts)
    for at, name in enumerate(parser.languages):
        assert [slow_phrases(parser, SAMPLES[name], t) for t in texts] == found[at].tolist()


@pytest.mark.parametrize("seed", range(4))
def test_automaton_holds_all_substrings_and_no_others(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.randrange(3, 6) for _ in range(rng.randrange(1, 30))) for _ in range(4)]
    automaton = language.SuffixAutomaton()
    for text in texts:
        automaton.add(text)
    parts = {t[i:j] for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}

    def holds(part):
        state = 0
        for symbol in part:
            state = automaton.next[state].get(symbol)
            if state is None:
                return False
        return True

    assert all(map(holds, parts))
    for _ in range(300):
        part = bytes(rng.randrange(3, 6) for _ in range(rng.randrange(1, 9)))
        assert holds(part) == (part in parts)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 ... !!"), (None, "the dog and the cat"), (5, "der hund und die katze " * 9000)]
    rows += [(6, "the dog and the cat")] * 2
    df = spark.createDataFrame([(d, t, None, None, "clash") for d, t in rows], DOCS).repartition(2)
    got = language.identify(df, SAMPLES).select("row.*", "found.*").collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r[5:] for r in got}
    assert [by_id[i][0] for i in (1, 2, 3, None, 5, 6)] == ["und", "und", "und", "en", "de", "en"]
    assert all(0 <= r[6] <= 1 for r in got) and by_id[1] == ("und", 0.0, None)
    assert [r[0] for r in language.identify(df, {}).select("found.lang_pred").distinct().collect()] == ["und"]
    assert language.identify(df.limit(0), SAMPLES).collect() == []


def test_samples_are_bounded_and_leave_nulls_out(spark):
    rows = [(i, "the cat sat on the mat " * 50, "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, "no language", None), (101, None, "en"), (102, "", "fr")]
    df = spark.createDataFrame([(d, t, g, None, None) for d, t, g in rows], DOCS)
    samples = language.sample_texts(df, rows=5, chars=1000)
    assert {k: (len(v), sum(map(len, v))) for k, v in samples.items()} == {"en": (5, 1000), "de": (5, 1000)}


def test_samples_hold_different_texts_from_all_places(spark):
    copy = "all the same page again and again. " * 200
    rows = [(i, copy, "en") for i in range(300)]
    rows += [(1000 + i, "".join(f"{i} {n} " for n in range(900)), "en") for i in range(60)]
    rows += [(2000 + i, f"kurz {i}", "de") for i in range(4000)]
    rows += [(9000, "".join(f"seul {n} " for n in range(9000)), "fr")]
    df = spark.createDataFrame([(d, t, g, None, None) for d, t, g in rows], DOCS).repartition(4)
    samples = language.sample_texts(df)
    assert {k: sum(map(len, v)) for k, v in samples.items()} == {"en": 24_576, "de": 24_576, "fr": 24_576}
    assert len(samples["en"]) == 24 and sum(b"same page" in piece for piece in samples["en"]) <= 1
    assert len(set(samples["de"])) == len(samples["de"]) > 2000 and len(set(samples["fr"])) == 24
    starts = {piece.split()[3] for piece in samples["en"] if b"same" not in piece}
    assert len(starts) > 12  # a prefix would begin with the numbers 0, 1 everywhere
    assert language.sample_texts(df.limit(0)) == {}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_cross_parsing(spark, sf).collect()
    truth = dict(duckdb.sql(f"select doc_id, lang from '{sf}/documents.parquet'").fetchall())
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and 150 < len(held) < 350
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_flag(spark):
    df = spark.range(40).select(F.col("id").alias("doc_id")).unionByName(spark.sql("select cast(null as long) doc_id"))
    import zlib

    got = {r.doc_id: r.h for r in df.select("doc_id", language.held_out().alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(40)} | {None: False}
