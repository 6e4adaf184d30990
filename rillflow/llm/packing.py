"""Packing documents into training windows of fixed length."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.text import in_chunks, texts_of
from rillflow.session import materialize

PIECES = "doc_id long, doc_row long, start long, length long, ids_crc32 long, doc_tokens long"


#: Printable ASCII and the Latin-1 letters: one code point each under NFC and in either case.
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")

#: How the tokenizer file cuts lower-cased plain text (fixed value, for letters of Latin-1).
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE writes a byte as the letter of its number, or else as the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + n for n, b in enumerate(hidden)}


class _Parts(dict):
    """part of a word -> its ids as bytes, from the tokenizer's BPE."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model, self.letters = tokenizer.model, _byte_letters()
        self.numbers = [struct.pack("<I", n) for n in range(tokenizer.get_vocab_size())]

    def __missing__(self, part: str) -> bytes:
        word = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        numbers = self.numbers
        found = self[part] = b"".join([numbers[token.id] for token in self.model.tokenize(word)])
        return found


class _Pieces(dict):
    """Stretch of text without blank or line feed -> its ids as little-endian 32-bit numbers.

    The tokenizer never joins text across white space, so a text's ids are those
    of its stretches, one after the other. Stretches of plain characters go to
    the BPE part by part, any other to the whole tokenizer. Both caches are
    emptied when they hold ``most`` entries.
    """

    def __init__(self, path: str, most: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.parts = _Parts(self.tokenizer)

    def __missing__(self, stretch: str) -> bytes:
        if len(self.parts) >= self.most:
            self.parts.clear()
        short = len(stretch) <= 64
        lower = stretch.lower() if short and stretch.isascii() and stretch.isprintable() else ""
        if lower.isalpha():
            found = self.parts[lower]
        elif lower[:-1].isalpha() and not lower[-1].isalnum():
            found = self.parts[lower[:-1]] + self.parts[lower[-1]]
        elif short and _PLAIN.fullmatch(stretch) and "<|" not in stretch:
            found = b"".join(map(self.parts.__getitem__, _PARTS.findall(stretch.lower())))
        else:
            ids = self.tokenizer.encode(stretch, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        if short:
            if len(self) >= self.most:
                self.clear()
            self[stretch] = found
        return found


def token_bytes(text: str, pieces: _Pieces, end_id: int) -> bytes:
    """The ids of a text, then ``end_id``, as little-endian 32-bit numbers."""
    if text.isascii() and "<|" not in text:
        text = text.lower()  # the tokenizer does so itself; fewer different stretches
    found = b"".join(map(pieces.__getitem__, text.replace("\n", " ").split(" ")))
    return found + struct.pack("<I", end_id)


def _cut(path: str, capacity: int, end_id: int, most: int):
    """Arrow batches of doc_id, text to pieces of at most ``capacity`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(path, most)
        width = 4 * capacity
        for batch in batches:
            texts, ids, numbers = texts_of(batch), batch.column("doc_id").to_pylist(), batch.column("doc_row").to_pylist()
            for first, last in in_chunks(texts):
                rows = []
                for row in range(first, last):
                    found = token_bytes((texts[row] or b"").decode(), pieces, end_id)
                    total = len(found) // 4
                    for at in range(0, len(found), width):
                        part = found[at : at + width]
                        rows.append((ids[row], numbers[row], at // 4, len(part) // 4, zlib.crc32(part), total))
                names = ["doc_id", "doc_row", "start", "length", "ids_crc32", "doc_tokens"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places lengths one after the other; returns window, offset and the windows' fills.

    ``level[h]`` counts the open windows filled to h. A length s goes to the level
    h with h + s <= capacity, an empty window standing for level 0, after which
    the sum of the squared counts of partly filled windows is smallest; among
    equals, to the fullest. Moving a window from h to h + s changes the sum by
    2 (level[h + s] - level[h] + 1), where full windows count for nothing.
    """
    level = np.zeros(capacity + 1, np.int64)
    opened: list[list[int]] = [[] for _ in range(capacity + 1)]
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = 0
    far = np.iinfo(np.int64).max
    fills: list[int] = []
    for row, size in enumerate(lengths.tolist()):
        top = capacity - size
        source, target = level[: top + 1], level[size:]
        change = 2 * (target - source) + 2
        change[0] = 2 * target[0] + 1
        change[top] = 1 - 2 * source[top]
        change[1:][source[1:] == 0] = far
        if top == 0:
            change[0] = 0
        best = top - int(np.argmin(change[::-1]))
        if best:
            number = opened[best].pop()
            level[best] -= 1
        else:
            number, count = count, count + 1
            fills.append(0)
        window[row], offset[row] = number, best
        fills[number] = best + size
        if best + size < capacity:
            opened[best + size].append(number)
            level[best + size] += 1
    return window, offset, np.array(fills, np.int64)


def _packed(capacity: int, enough: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_order", "doc_id", "start", "_piece"], kind="stable").reset_index(drop=True)
        window, offset, fills = sum_of_squares(group["length"].to_numpy(), capacity)
        group["_window"], group["offset"] = window, offset
        group["_open"] = fills[window] < enough * capacity
        return group

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 1,
    per_group: int = 2000,
    enough: float = 0.98,
    rounds: int = 3,
    cache: int = 400_000,
) -> DataFrame:
    """Pieces of all documents and their places in windows of ``capacity`` ids.

    A document's ids are those of the tokenizer file at ``tokenizer_path`` (to be
    found there on every executor), then ``end_id``. What is longer than a window
    is cut at multiples of ``capacity``; such a full piece is a window of its own.
    The rest are placed by the sum-of-squares rule (:func:`sum_of_squares`), in
    groups of about ``per_group`` pieces by a hash. Pieces in windows filled to
    less than ``enough`` are placed anew with those of other groups, at most
    ``rounds`` times; what is left then is a small part of the last groups.

    Result: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    and ``doc_row``, which tells rows with the same doc_id apart. Sequence ids are
    unique, not dense. A null or empty text is one piece holding ``end_id``. A
    null doc_id stays null. An empty table gives an empty table.
    """
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("doc_row"),
        F.col("text").cast("string").alias("text"),
    )
    pieces = materialize(
        read.mapInArrow(_cut(tokenizer_path, capacity, end_id, cache), PIECES).withColumn(
            "_piece", F.monotonically_increasing_id()
        ),
        "pack-pieces",
    )
    # Even numbers for pieces that fill a window, odd ones for the windows of the groups.
    done = [
        pieces.filter(F.col("length") == capacity).select(
            "*", (F.col("_piece") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
        )
    ]
    left = pieces.filter(F.col("length") < capacity)
    for number in range(rounds):
        waiting = left.count()
        if not waiting:
            break
        order = F.xxhash64(F.lit(number), "doc_id", "start", "ids_crc32")
        groups = max(1, round(waiting / per_group))
        keyed = left.withColumn("_order", order).withColumn("_group", F.pmod("_order", F.lit(groups)))
        schema = f"{PIECES}, _piece long, _order long, _group long, _window long, offset long, _open boolean"
        placed = materialize(keyed.groupBy("_group").applyInPandas(_packed(capacity, enough), schema), "pack-placed")
        finished = placed if number == rounds - 1 else placed.filter(~F.col("_open"))
        window = (F.col("_group") * (1 << 24) + F.col("_window")) * rounds + number
        done.append(finished.select(*pieces.columns, (window * 2 + 1).alias("sequence_id"), "offset"))
        left = placed.filter("_open").select(*pieces.columns)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.drop("_piece")
