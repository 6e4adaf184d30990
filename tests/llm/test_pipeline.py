"""The pipeline: what each stage keeps, and that all stages fit together."""

import random

import pytest

from test_jaccard import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

pipeline = pytest.importorskip("corpus_pipeline")


def table(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def corpus():
    rng = random.Random(8)
    words = "the of and to in is that for it with as was on be at by this have from or had not are but".split()
    rows = []
    for i in range(120):
        text = "\n".join(" ".join(rng.choice(words) + rng.choice(["", "s", "ing"]) for _ in range(12)) for _ in range(4))
        if i % 3 == 0:
            text += "\nall rights reserved"
        rows.append((i, text, "en", f"src{i % 4}", len(text)))
    rows += [(200 + i, rows[i][1], "en", "src1", rows[i][4]) for i in range(0, 30, 3)]
    rows += [(300, None, None, None, None), (301, "", "en", "src1", 0), (302, "12 34 !!", "en", "src1", 8)]
    rows += [(303, "日本語の文章です。" * 9, None, "src2", 81), (None, "the of and to in is that", "en", None, 24)]
    return rows + [(400, "the short", "en", "src3", 9)] * 2


def test_language_stage(spark):
    kept = pipeline.known_language(spark, table(spark, corpus()), "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    gone = {300, 301, 302, 303}
    assert sorted(map(str, kept.collect())) == sorted(
        str(r) for r in table(spark, [r for r in corpus() if r[0] not in gone]).collect()
    )


def test_line_stage(spark):
    docs = table(spark, corpus())
    out = pipeline.without_boilerplate(spark, docs, "")
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.collect():
        assert "all rights reserved" not in (r.text or "")
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_line_stage_keeps_a_text_with_many_copies(spark):
    rows = [r for r in corpus() if r[0] is not None and r[0] < 200]
    clean = "one clean text\nof two lines"
    rows += [(500 + i, clean, "en", "src1", len(clean)) for i in range(60)]  # a third of all rows
    rows += [(600 + i, clean, "en", "small", len(clean)) for i in range(5)]
    out = {r.doc_id: r.text for r in pipeline.without_boilerplate(spark, table(spark, rows), "").collect()}
    assert all(out[i] == clean for i in [*range(500, 560), *range(600, 605)])
    assert all("all rights reserved" not in out[i] for i in range(120))


def stay(rows):
    """Per component of different (doc_id, text), the one with the smallest doc_id; null last."""
    different = sorted({r[:2] for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))
    first = {}
    for (nr, _, component), (doc_id, text) in zip(sorted(brute([(i, t) for i, (_, t) in enumerate(different)])), different):
        first.setdefault(component, (doc_id, text))
    return sorted(first.values(), key=str)


def test_near_duplicate_stage(spark):
    rows = corpus()
    out = pipeline.without_near_duplicates(spark, table(spark, rows), "")
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == stay(rows)
    expected = {d for d, _, component in brute([r[:2] for r in rows]) if d is not None and d == component}
    assert {r.doc_id for r in out.collect()} == expected | {None}


def test_near_duplicates_with_repeated_and_null_ids(spark):
    one, two = "one two three four five six", "completely other words stand in here for once"
    rows = [
        (1, one, "en", "a", 1), (1, two, "en", "a", 1), (None, one, "en", "a", 1), (None, two + " again", "en", "a", 1),
        (None, two + " again", "en", "b", 1), (None, "a null id alone keeps its own text", "en", "a", 1),
        (2, one, "en", "a", 1), (2, one, "de", "a", 1), (7, "seven eight nine ten eleven", "en", "a", 1),
        (7, "seven eight nine ten eleven", "en", "a", 2), (8, None, "en", "a", 1), (None, None, "en", "a", 1),
    ]
    out = pipeline.without_near_duplicates(spark, table(spark, rows), "").collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == stay(rows)
    assert {(1, one), (1, two), (None, "a null id alone keeps its own text"), (8, None)} <= {(r.doc_id, r.text) for r in out}
    assert [r.n_chars for r in out if r.doc_id == 7] == [1]


def test_stages_end_to_end(spark, tmp_path):
    table(spark, corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    assert [name for name, _ in pipeline.STAGES] == ["language", "lines", "near_duplicates", "mixing", "packing"]
    got = pipeline.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in pipeline.STAGES[:4]:
        docs = stage(spark, docs, "")
    assert sum(r.start == 0 for r in got) == docs.count() > 100
    filled = {}
    for r in got:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 2048


def test_stages_take_an_empty_table(spark):
    docs = table(spark, [])
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0
    assert pipeline.STAGES[-1][1](spark, docs, "").count() == 0
