"""Packing: ids as the tokenizer gives them, every id once, windows without gaps."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from rillflow.llm import packing
from rillflow.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, offset string"

TEXTS = [
    "It's what they'll say, don't they? We've 123 and 4.5!",
    "Où est l'été Ça va ÉCOLE naïve straße ÜBER",
    "<|endoftext|> in the text <|startoftext|>x",
    "日本語のテキスト и кириллица ΣΊΣΥΦΟΣ İstanbul",
    "é combining   nbsp\ttab\x0bvt \x1c\x85 end",
    "a" * 5000,
    "",
    "   \n\n  ",
    "''s 's''t ''' don''t",
    "emoji 😀 x²y³ Ⅷ ½ ªº × ÷",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_tokenizer(tokenizer, text):
    pieces = packing._Pieces(tokenizer_path(), 1000)
    found = np.frombuffer(packing.token_bytes(text, pieces, 1), "<u4").tolist()
    assert found == ids_of(tokenizer, text)


def test_ids_of_random_texts(tokenizer):
    rng = random.Random(3)
    letters = "abcXYZéßÜñ0129 \n.,'!-_<|>\t­²µªÿ÷×"
    pieces = packing._Pieces(tokenizer_path(), 1000)
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert np.frombuffer(packing.token_bytes(text, pieces, 1), "<u4").tolist() == ids_of(tokenizer, text)


def check(df, rows, tokenizer, capacity):
    got = df.collect()
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_row].append(r)
        by_window[r.sequence_id].append(r)
    for parts in by_window.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append(ids_of(tokenizer, text))
    assert len(by_doc) == len(rows)
    for parts in by_doc.values():
        parts.sort(key=lambda r: r.start)
        total, at = parts[0].doc_tokens, 0
        crcs = []
        for r in parts:
            assert r.start == at and r.doc_tokens == total
            at += r.length
            crcs.append((r.start, r.length, r.ids_crc32))
        assert at == total
        ids = next(
            x for x in texts[parts[0].doc_id]
            if crcs == [(s, n, zlib.crc32(np.array(x[s : s + n], "<u4").tobytes())) for s, n, _ in crcs] and len(x) == total
        )
        texts[parts[0].doc_id].remove(ids)
    return got


def test_round_trip(spark, tokenizer):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(TEXTS).split()[:9]) * rng.randrange(1, 40)) for i in range(120)]
    rows += [(500, None), (500, None), (None, "x y"), (None, None), (7, "repeated id"), (9000, "w " * 30_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], DOCS).repartition(4)
    got = check(packing.pack(df, tokenizer_path(), capacity=256, per_group=40), rows, tokenizer, 256)
    windows = {r.sequence_id for r in got}
    assert sum(r.length for r in got) > 0.9 * 256 * len(windows)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), tokenizer_path()).collect() == []


def test_full_pieces_fill_windows(spark, tokenizer):
    rows = [(1, " ".join(["the"] * 511)), (2, " ".join(["the"] * 256))]
    df = spark.createDataFrame([(*r, "") for r in rows], DOCS)
    got = check(packing.pack(df, tokenizer_path(), capacity=256), rows, tokenizer, 256)
    assert sorted((r.doc_id, r.start, r.length) for r in got) == [(1, 0, 256), (1, 256, 256), (2, 0, 256), (2, 256, 1)]


def slow_sum_of_squares(lengths, capacity):
    """The rule tried on every level."""
    level, fills = [0] * (capacity + 1), []
    for size in lengths:
        best = None
        for h in range(capacity - size, -1, -1):
            if h and not level[h]:
                continue
            trial = list(level)
            trial[h] -= bool(h)
            trial[h + size] += 1
            cost = sum(n * n for n in trial[1:capacity])
            if best is None or cost < best[0]:
                best = cost, h
        h = best[1]
        level[h] -= bool(h)
        level[h + size] += 1
        fills.append(h)
    return fills


@pytest.mark.parametrize("seed", range(8))
def test_rule(seed):
    rng = random.Random(seed)
    lengths = [rng.randrange(1, 24) for _ in range(150)]
    window, offset, fills = packing.sum_of_squares(np.array(lengths), 24)
    assert offset.tolist() == slow_sum_of_squares(lengths, 24)
    sums = defaultdict(int)
    for w, n in zip(window, lengths):
        sums[w] += n
    assert [sums[w] for w in range(len(fills))] == fills.tolist()
