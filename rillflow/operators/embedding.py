"""One training step of word vectors on a batch of texts.

For an occurrence of word w with vector x the model predicts its context as
softmax(W x); the target puts 1/n on each id among its n context positions. The
prediction depends on the word alone, so it is made once per distinct word and
weighted by the number of occurrences, and the targets of all occurrences add up
to one sparse table (word, context word, weight). Both forms have the same sums;
after the counting, no work grows with the number of texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.text import tokens
from rillflow.functions.vectors import add_scaled, column_sums, from_columns
from rillflow.operators.joins import fits, pair_blocks
from rillflow.operators.membership import without_strangers
from rillflow.operators.vocabulary import BROADCAST_BYTES, text_tokens, word_bytes
from rillflow.session import materialize

MAX_BLOCK_ROWS = 16_384
MIN_BLOCK_WORDS = 512
SLICE_ROWS = 1_024
SLICE_WORDS = 1 << 18
#: Pairs of words whose sums a task holds before it hands them on, and blocks of ids the sums travel in.
MAX_HELD_PAIRS = 1 << 21
MAX_ID_BLOCKS = 2_048
CODEC = "zstd"


def occurrences(texts: DataFrame, vocab: DataFrame, sift: bool = False) -> DataFrame:
    """The known words of each text in order: ``doc_id``, ``pos``, ``id``.

    A plain join by word; Spark splits the partitions of very common words. With
    ``sift`` a filter of the vocabulary, of bounded size, goes to the texts first,
    so hardly any unknown word is shuffled.
    """
    found = text_tokens(texts)
    if sift:
        found = without_strangers(found, "word", vocab)
    joined = found.join(vocab.select("word", "id"), "word")
    return joined.select("doc_id", "pos", "id")


def contexts(occurring: DataFrame, size: int) -> DataFrame:
    """Per occurrence the distinct ids within ``size`` known words, and the target value.

    ``context`` has no repetitions, ``value`` is one over the number of context
    positions: a word that fills two of them is still set once.
    """
    in_order = Window.partitionBy("doc_id").orderBy("pos")
    around = F.array(
        *[f("id", i).over(in_order) for i in range(1, size + 1) for f in (F.lead, F.lag)]
    )
    positions = F.filter("around", lambda v: v.isNotNull())
    return (
        occurring.withColumn("around", around)
        .withColumn("around", positions)
        .select(
            "doc_id", "pos", "id", F.array_distinct("around").alias("context"),
            F.when(F.size("around") > 0, F.lit(1.0) / F.size("around")).otherwise(F.lit(0.0)).alias("value"),
        )
    )


def context_totals(targets: DataFrame) -> DataFrame:
    """``id``, ``context_id``, ``weight``: the targets summed over all occurrences.

    The row with a null ``context_id`` holds the number of occurrences of the
    word, so one pass over the texts and one shuffle give both.
    """
    entries = F.concat(
        F.transform("context", lambda c: F.struct(c.alias("context_id"), F.col("value").alias("weight"))),
        F.array(F.struct(F.lit(None).cast("int").alias("context_id"), F.lit(1.0).alias("weight"))),
    )
    return (
        targets.select("id", F.inline(entries))
        .groupBy("id", "context_id")
        .agg(F.sum("weight").alias("weight"))
    )


def _summed(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weights of equal keys added up, by ascending key; keys are 0 or more."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(weight[order], first) if len(first) else weight


def _batch_sums(doc: np.ndarray, ids: np.ndarray, size: int, n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """The totals over some texts: ``ids`` (below ``n_ids``) are their known words in order, ``doc`` the text of each.

    A pair is the number id * (n_ids + 1) + context; ``n_ids`` as context counts the occurrences.
    """
    steps = [step for k in range(1, size + 1) for step in (k, -k)]
    near = np.full((len(steps), len(ids)), -1, np.int64)
    for row, step in zip(near, steps):
        here, there = (slice(None, -step), slice(step, None)) if step > 0 else (slice(-step, None), slice(None, step))
        row[here] = np.where(doc[here] == doc[there], ids[there], -1)
    positions = (near >= 0).sum(axis=0)
    for at in range(1, len(steps)):  # a word that fills two positions is set once
        near[at, (near[:at] == near[at]).any(axis=0)] = -1
    _, place = np.nonzero(near >= 0)
    kinds = len(steps) + 1  # pair and number of positions in one number: sorted plainly, then counted
    keys = (ids[place] * (n_ids + 1) + near[near >= 0]) * kinds + positions[place]
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    weight = np.diff(first, append=len(keys)) / (keys[first] % kinds)
    words, counts = np.unique(ids, return_counts=True)
    return _summed(
        np.concatenate([keys[first] // kinds, words * (n_ids + 1) + n_ids]), np.concatenate([weight, counts])
    )


def _packed(keys: np.ndarray, weight: np.ndarray, per_block: int) -> pa.RecordBatch:
    """Ascending keys and their weights as a row per block of ``per_block`` keys, steps from key to key compressed."""
    block = keys // per_block
    cuts = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(keys)]
    parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]

    def column(values: Iterator[np.ndarray]) -> pa.Array:
        return pa.array([pa.compress(v.tobytes(), codec=CODEC, asbytes=True) for v in values], pa.binary())

    return pa.RecordBatch.from_arrays(
        [
            pa.array(block[cuts[:-1]], pa.int32()), pa.array(np.diff(cuts), pa.int32()),
            column(np.diff(keys[p], prepend=0) for p in parts), column(weight[p] for p in parts),
        ],
        ["id_block", "n", "keys", "weights"],
    )


def _unpacked(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The keys and weights of each row of :func:`_packed`."""
    for n, *parts in zip(*(rows[c].to_pylist() for c in ("n", "keys", "weights"))):
        steps, weight = (pa.decompress(part, n * 8, codec=CODEC) for part in parts)
        yield np.cumsum(np.frombuffer(steps, np.int64)), np.frombuffer(weight, np.float64)


def _merged(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums over all parts; no more than a bounded number of pairs, or twice the result, is held."""
    held, n, most = [], 0, MAX_HELD_PAIRS
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n > most:
            held = [_summed(*map(np.concatenate, zip(*held)))]
            n = len(held[0][0])
            most = max(MAX_HELD_PAIRS, 2 * n)
    return _summed(*map(np.concatenate, zip(*held)))


def text_totals(texts: DataFrame, vocab: DataFrame, size: int,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """:func:`context_totals` of all texts. A null text has no words.

    A vocabulary of a checked size goes to the tasks, which number the words of their
    texts and sum the targets: only partial sums are shuffled, neither texts nor words.
    They travel packed, a row per task and block of ids, and a block is summed at once.
    A larger vocabulary is joined by word, after a filter of it has taken out
    what it surely lacks.
    """
    known = vocab.select("word", F.col("id").cast("int").alias("id"))
    if not fits(known, broadcast_bytes, word_bytes()):
        return context_totals(contexts(occurrences(texts, vocab, sift=True), size))
    table = known.toArrow()
    words = table["word"].combine_chunks()
    numbers, ranks = np.unique(table["id"].to_numpy().astype("int64"), return_inverse=True)
    n_ids = len(numbers)
    per_block = math.ceil(max(1, n_ids) / MAX_ID_BLOCKS) * (n_ids + 1)

    def slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lists = batch.column("tokens")
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        start = 0
        while start < len(lists):  # about so many words at once, a longer text alone
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + SLICE_WORDS, "right")))
            part = lists.slice(start, end - start)
            place = pc.index_in(part.flatten(), value_set=words)
            there = pc.is_valid(place).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(start, end), np.diff(ends[start:end], prepend=before))
            yield _batch_sums(doc[there], ranks[pc.drop_null(place).to_numpy()], size, n_ids)
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for sums in (sums for batch in batches for sums in slices(batch)):
            held.append(sums)
            n += len(sums[0])
            if n > MAX_HELD_PAIRS:
                held = [_merged(held)]
                n = len(held[0][0])
                if n > MAX_HELD_PAIRS // 2:
                    yield _packed(*held[0], per_block)
                    held, n = [], 0
        if n:
            yield _packed(*_merged(held), per_block)

    def total(rows: pa.Table) -> pa.Table:
        keys, weight = _merged(_unpacked(rows))
        ids, around = np.divmod(keys, n_ids + 1)
        counted = around == n_ids
        around[counted] = 0
        return pa.table({
            "id": pa.array(numbers[ids], pa.int32()),
            "context_id": pa.array(numbers[around], pa.int32(), mask=counted),
            "weight": pa.array(weight, pa.float64()),
        })

    parts = texts.select(tokens(F.col("text")).alias("tokens")).mapInArrow(
        run, "id_block int, n int, keys binary, weights binary"
    )
    return parts.groupBy("id_block").applyInArrow(total, "id int, context_id int, weight double")


def _rows(table: pa.Table, column: str) -> np.ndarray:
    flat = table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def _block_log_sums(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    sums = np.full(len(x), -np.inf)
    for start in range(0, len(w), SLICE_ROWS):
        part = w[start:start + SLICE_ROWS] @ x.T
        top = part.max(axis=0)
        sums = np.logaddexp(sums, top + np.log(np.exp(part - top).sum(axis=0)))
    return sums


def _log_sums(weights: pa.Table, words: pa.Table) -> pa.Table:
    """Per word of a block: log of the summed exponentials over a block of weight rows."""
    if not weights.num_rows or not words.num_rows:
        return pa.table({"id": pa.array([], "int32"), "log_sum": pa.array([], "float64")})
    sums = _block_log_sums(_rows(weights, "vector"), _rows(words, "vector"))
    return pa.table({"id": words["id"], "log_sum": pa.array(sums)})


def _dense_gradients(weights: pa.Table, words: pa.Table) -> pa.Table:
    """The softmax part of both gradients for a block of weight rows and a block of words.

    Words without ``log_sum`` meet all weight rows in this block, which then gives it.
    """
    if not weights.num_rows or not words.num_rows:
        sides, ids, grads = [], np.array([], "int32"), np.zeros((0, 1))
    else:
        w, x = _rows(weights, "vector"), _rows(words, "vector")
        n = words["n"].to_numpy()
        if "log_sum" in words.column_names:
            log_sum = words["log_sum"].to_numpy()
        else:
            log_sum = _block_log_sums(w, x)
        for_words = np.zeros_like(x)
        for_weights = np.empty_like(w)
        for start in range(0, len(w), SLICE_ROWS):
            part = w[start:start + SLICE_ROWS]
            p = np.exp(part @ x.T - log_sum)
            for_weights[start:start + SLICE_ROWS] = (p * n) @ x
            for_words += p.T @ part
        sides = ["w"] * len(w) + ["x"] * len(x)
        ids = np.concatenate([weights["id"].to_numpy(), words["id"].to_numpy()]).astype("int32")
        grads = np.vstack([for_weights, for_words])
    offsets = np.arange(len(ids) + 1, dtype="int32") * grads.shape[1]
    return pa.table(
        {
            "side": pa.array(sides, "string"),
            "id": pa.array(ids, "int32"),
            "grad": pa.ListArray.from_arrays(pa.array(offsets), pa.array(grads.ravel())),
        }
    )


def _blocked(weights: DataFrame, words: DataFrame, n_words: int, block_rows: int | None,
             work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on each pair of a block of weight rows and one of words.

    Weight rows come in blocks as large as a task holds; words in as many blocks
    as there are tasks, within limits.
    """
    tasks = int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = block_rows or MAX_BLOCK_ROWS
    cols = block_rows or min(MAX_BLOCK_ROWS, max(MIN_BLOCK_WORDS, math.ceil(n_words / tasks)))

    def own(size: int) -> Column:
        return F.floor(F.col("id") / size).cast("int")

    return pair_blocks(
        weights.withColumn("_block", own(rows)), words.withColumn("_block", own(cols)),
        (max(0, n_words - 1) // rows + 1, max(0, n_words - 1) // cols + 1), work, schema,
    )


def log_sums(vocab: DataFrame, weights: DataFrame, n_words: int,
             block_rows: int | None = None) -> DataFrame:
    """``id``, ``log_sum``: the logarithm of the softmax denominator of each word.

    Each task handles one block of weight rows and one of words; the partial
    sums of a word are as many as there are blocks. The largest exponent is taken
    out first, so nothing overflows.
    """
    words = vocab.select("id", "vector")
    parts = _blocked(
        weights.select("id", "vector"), words, n_words, block_rows, _log_sums, "id int, log_sum double"
    )
    top = F.max("log_sum")
    merged = parts.groupBy("id").agg(top.alias("top"), F.collect_list("log_sum").alias("all"))
    total = F.aggregate("all", F.lit(0.0), lambda acc, v: acc + F.exp(v - F.col("top")))
    return merged.select("id", (F.col("top") + F.log(total)).alias("log_sum"))


def gradients(totals: DataFrame, vocab: DataFrame, weights: DataFrame, n_words: int, length: int,
              block_rows: int | None = None) -> DataFrame:
    """``side``, ``id``, ``grad`` from the context totals.

    Side ``w``: the sum over all occurrences, per weight row. Side ``x``: the mean
    over the occurrences of a word, per word that occurs.
    """
    summed = materialize(totals, "context-totals")
    totals = summed.filter(F.col("context_id").isNotNull())
    counts = summed.filter(F.col("context_id").isNull()).select("id", F.col("weight").alias("n"))
    active = counts.join(vocab.select("id", "vector"), "id")
    words = active
    if n_words > (block_rows or MAX_BLOCK_ROWS):
        words = active.join(log_sums(active, weights, n_words, block_rows), "id")
    dense = _blocked(
        weights.select("id", "vector"), words, n_words, block_rows,
        _dense_gradients, "side string, id int, grad array<double>",
    )

    def scaled(factor: Column) -> Column:
        return F.transform("vector", lambda v: v * factor)

    for_weights = totals.join(active.select("id", "vector"), "id").select(
        F.lit("w").alias("side"), F.col("context_id").alias("id"),
        scaled(-F.col("weight")).alias("grad"),
    )
    rows = weights.select(F.col("id").alias("context_id"), "vector")
    for_words = totals.join(rows, "context_id").join(counts, "id").select(
        F.lit("x").alias("side"), "id", scaled(-F.col("weight") / F.col("n")).alias("grad")
    )
    return (
        dense.unionByName(for_weights).unionByName(for_words)
        .groupBy("side", "id")
        .agg(*column_sums("grad", length))
        .select("side", "id", from_columns(length).alias("grad"))
    )


def apply_gradients(vocab: DataFrame, weights: DataFrame, grads: DataFrame, n_texts: int,
                    rate: float) -> tuple[DataFrame, DataFrame]:
    """The stepped vocabulary and weights; rows without a gradient stay as they are."""

    def stepped(rows: DataFrame, side: str, factor: float) -> DataFrame:
        own = grads.filter(F.col("side") == side).select("id", "grad")
        moved = add_scaled(F.col("vector"), F.col("grad"), -factor)
        return rows.join(own, "id", "left").select(
            *[c for c in rows.columns if c != "vector"],
            F.when(F.col("grad").isNull(), F.col("vector")).otherwise(moved).alias("vector"),
        )

    return stepped(vocab, "x", rate), stepped(weights, "w", rate / n_texts)


def train_step(texts: DataFrame, vocab: DataFrame, weights: DataFrame, rate: float, size: int,
               length: int, n_texts: int | None = None, n_words: int | None = None,
               block_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One step on ``texts(doc_id, text)``. No texts or no words: nothing changes.

    The weight gradient is a mean over all texts, also those without a known
    word; the gradient of a word is a mean over its occurrences.
    """
    n_texts = texts.count() if n_texts is None else n_texts
    n_words = weights.count() if n_words is None else n_words
    if not n_texts or not n_words:
        return vocab, weights
    totals = text_totals(texts, vocab, size)
    grads = materialize(gradients(totals, vocab, weights, n_words, length, block_rows), "gradients")
    return apply_gradients(vocab, weights, grads, n_texts, rate)
