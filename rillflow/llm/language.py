"""Language of a text by cross-parsing against samples of every language."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.running import fraction
from rillflow.llm.text import in_chunks
from rillflow.session import materialize

#: Texts are parsed in blocks of so many bytes, side by side.
BLOCK = 1024
#: Classes of bytes: end of block, bytes no sample holds, white space with all other ASCII.
END, STRANGE, OTHER = 0, 1, 2


def byte_classes(samples: list[list[bytes]]) -> np.ndarray:
    """The class of each byte: letters with case folded, what is no letter, and high bytes seen."""
    classes = np.full(256, STRANGE, np.uint8)
    classes[:128] = OTHER
    for n in range(26):
        classes[ord("a") + n] = classes[ord("A") + n] = 3 + n
    high = sorted({b for texts in samples for text in texts for b in set(text) if b > 127})
    for n, b in enumerate(high):
        classes[b] = 29 + n
    return classes


class SuffixAutomaton:
    """All substrings of some texts: one state per set of equal end positions."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, text: bytes) -> None:
        """Adds a text; substrings do not run on from the text before."""
        last = 0
        for symbol in text:
            if symbol in self.next[last]:
                last = self._suffix(last, symbol)
                continue
            now = self._state(self.length[last] + 1)
            at = last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = now
                at = self.link[at]
            self.link[now] = 0 if at < 0 else self._suffix(at, symbol)
            last = now

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def _suffix(self, at: int, symbol: int) -> int:
        """Where ``symbol`` leads from ``at``, split off its state if that holds longer strings too."""
        longer = self.next[at][symbol]
        if self.length[longer] == self.length[at] + 1:
            return longer
        split = self._state(self.length[at] + 1)
        self.next[split] = dict(self.next[longer])
        self.link[split] = self.link[longer]
        self.link[longer] = split
        while at >= 0 and self.next[at].get(symbol) == longer:
            self.next[at][symbol] = split
            at = self.link[at]
        return split

    def table(self, symbols: int) -> np.ndarray:
        """``table[state * symbols + symbol]``: 2 x next state + 1 if a phrase begins with the symbol.

        A phrase is the longest match; where it breaks, the next begins. A symbol
        that no sample holds is a phrase of its own. END begins nothing.
        """
        start = np.zeros(symbols, np.int32)
        for symbol, state in self.next[0].items():
            start[symbol] = state
        table = np.tile(2 * start + 1, (len(self.next), 1)).astype(np.int32)
        for state, edges in enumerate(self.next[1:], 1):
            for symbol, target in edges.items():
                table[state, symbol] = 2 * target
        table[:, END] = 0
        return table.ravel()


class CrossParser:
    """Counts the phrases into which texts fall against the samples of each language."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        self.classes = byte_classes([samples[name] for name in self.languages])
        self.symbols = int(self.classes.max()) + 1
        self.tables, self.log_length = [], []
        for name in self.languages:
            automaton = SuffixAutomaton()
            for text in samples[name]:
                automaton.add(bytes(self.classes[np.frombuffer(text, np.uint8)]))
            self.tables.append(automaton.table(self.symbols))
            self.log_length.append(math.log2(2 + sum(map(len, samples[name]))))

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """``[language, text]``: phrases of each text, parsed anew every BLOCK bytes."""
        sizes = np.array([len(text) for text in texts], np.int64)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = (np.cumsum(sizes) - sizes)[owner] + nth * BLOCK
        held = np.minimum(sizes[owner] - nth * BLOCK, BLOCK)
        order = np.argsort(-held, kind="stable")
        starts, held = starts[order], held[order]
        symbols = np.append(self.classes[np.frombuffer(b"".join(texts), np.uint8)], np.zeros(BLOCK, np.uint8))
        lanes = symbols[starts[:, None] + np.arange(BLOCK)] if len(starts) else np.zeros((0, BLOCK), np.uint8)
        lanes = np.ascontiguousarray(lanes.T).astype(np.int32)
        running = np.searchsorted(-held, -np.arange(1, BLOCK + 1), side="right")
        found = np.zeros((len(self.tables), len(texts)), np.int64)
        for at, table in enumerate(self.tables):
            state = np.zeros(len(starts), np.int32)
            count = np.zeros(len(starts), np.int32)
            for step in range(BLOCK):
                n = running[step]
                if not n:
                    break
                value = table[state[:n] * self.symbols + lanes[step, :n]]
                count[:n] += value & 1
                state[:n] = value >> 1
            found[at] = np.bincount(owner[order], weights=count, minlength=len(texts)).astype(np.int64)
        return found

    def classify(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bytes per phrase of each text.

        Phrases are normalised by the sample's length: phrases x log2(length) are
        about the bits a text costs given the sample. The score is the share of
        the winner among the languages' inverse costs.
        """
        count = np.maximum(self.phrases(texts), 1)
        bits = count * np.array(self.log_length)[:, None]
        best = np.argmin(bits, axis=0)
        share = (1 / bits) / (1 / bits).sum(axis=0)
        rows = np.arange(len(texts))
        return [self.languages[b] for b in best], share[best, rows], np.array([len(t) for t in texts]) / count[best, rows]


def sample_texts(
    labelled: DataFrame, rows: int = 24, chars: int = 24_576, most_chars: int = 2_457_600, most_listed: int = 1_000_000
) -> dict[str, list[bytes]]:
    """For each language, pieces of about ``rows`` different texts by their hash, ``chars`` bytes in all.

    ``labelled`` has lang and text; copies of a text count once. Every text brings
    a piece of ``chars / rows`` bytes from a place that its hash decides, or all of
    it if it is shorter: then more texts follow until the bytes are there. Where a
    language has too few texts for that, they bring more pieces. All languages
    together get ``most_chars`` bytes, so that of more than 100 each gets less.

    Texts are chosen by their hashes: a bound on the hash leaves about four times
    those needed, and their list (counted; beyond ``most_listed`` it is not
    broadcast) picks the pieces where the texts are read. No text is shuffled.
    """
    usable = labelled.filter("lang is not null and text is not null and length(text) > 0").select(
        "lang", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("_hash")
    )
    hashes = usable.select("lang", "_hash", F.octet_length("text").alias("_size")).distinct()
    hashes = materialize(hashes, "language-hashes")
    languages = hashes.select("lang").distinct().count()
    chars = max(rows, min(chars, most_chars // max(languages, 1)))
    part = chars // rows
    held = hashes.groupBy("lang").agg(F.sum(F.least("_size", F.lit(part))).alias("_held"))
    held = held.withColumnRenamed("lang", "_of")
    chosen = materialize(
        hashes.join(held, F.col("lang") == F.col("_of"))
        .filter(fraction(F.col("_hash")) < F.least(F.lit(1.0), F.lit(4.0 * chars) / F.col("_held")))
        .select("_of", F.col("_hash").alias("_chosen"), (F.col("_held") < chars).alias("_few")),
        "language-chosen",
    )
    listed = F.broadcast(chosen) if chosen.count() <= most_listed else chosen
    near = usable.join(listed, (F.col("lang") == F.col("_of")) & (F.col("_hash") == F.col("_chosen")))
    width = F.when(F.col("_few"), chars).otherwise(part)
    room = F.greatest(F.length("text") - width + 1, F.lit(1))
    start = F.pmod(F.xxhash64("_hash", F.lit(1)), room).cast("int") + 1
    pieces = near.select("lang", "_hash", F.substring("text", start, width).alias("text")).distinct()
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for row in pieces.collect():
        texts.setdefault(row.lang, []).append((row._hash % (1 << 64), row.text.encode()))
    return {lang: _pieces(sorted(some), part, chars) for lang, some in texts.items()}


def _pieces(texts: list[tuple[int, bytes]], part: int, chars: int) -> list[bytes]:
    """Pieces of ``part`` bytes, one of each text and then the next of each, ``chars`` bytes in all at most."""
    cut = []
    for hashed, text in texts:
        pieces = [text[at : at + part] for at in range(0, len(text), part)]
        first = hashed % len(pieces)
        cut.append(sorted(pieces[first:] + pieces[:first], key=len, reverse=True))  # full ones first
    found, left = [], chars
    for nth in range(max(map(len, cut), default=0)):
        for pieces in cut:
            if nth < len(pieces) and left:
                found.append(pieces[nth][:left])
                left -= len(found[-1])
    return found


def _identified(samples: dict[str, list[bytes]]):
    """An Arrow function of texts and whether they have a letter to ``lang_pred, score, phrase_bytes``.

    The automata are those of a task and go with it: the worker's next stage does not hold them.
    """

    @F.arrow_udf("lang_pred string, score double, phrase_bytes double")
    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        parser = None
        for column, lettered in columns:
            texts, usable = column.cast(pa.binary()).to_pylist(), lettered.to_pylist()
            names, scores, sizes = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
            for start, end in in_chunks(texts, 1 << 20):
                rows = [row for row in range(start, end) if usable[row] and samples]
                if rows:
                    parser = parser or CrossParser(samples)
                    for row, best, score, size in zip(rows, *parser.classify([texts[row] for row in rows])):
                        names[row], scores[row], sizes[row] = best, float(score), float(size)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.float64())],
                ["lang_pred", "score", "phrase_bytes"],
            )

    return run


def identify(docs: DataFrame, samples: dict[str, list[bytes]]) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``found``: ``lang_pred, score, phrase_bytes``, from the text alone.

    Null texts and texts without a letter are ``und`` with score 0 and null
    ``phrase_bytes`` (mean bytes of a phrase in the language chosen). So are all
    texts if there are no samples. Equal costs go to the language first by name.
    Whole texts are parsed, in blocks of 1024 bytes; a very long one spreads over
    many lanes of one table look-up. Every row is judged alone: no row is lost,
    repeated rows get the same answer, an empty table gives an empty table. The
    samples travel with the task, within the bound of :func:`sample_texts`.
    """
    text = F.col("row.text").cast("string")
    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.struct("*").alias("row")).withColumn("found", _identified(samples)(text, lettered))


def held_out(doc_id="doc_id"):
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
