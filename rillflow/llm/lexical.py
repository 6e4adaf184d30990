"""Ranked search by words: posting lists in blocks of like documents, with exact bounds."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.running import fraction
from rillflow.llm.text import in_chunks, texts_of
from rillflow.operators.numbering import dense_ids
from rillflow.session import materialize

#: What is no part of a term becomes a blank: ASCII but digits and letters. A-Z become a-z.
_SEPARATED = bytes(
    b if b > 127 or chr(b).isalnum() and chr(b).islower() or chr(b).isdigit() else b + 32 if chr(b).isupper() else 32
    for b in range(128)
) + bytes(range(128, 256))

#: Dimensions of the projection by which the documents of a list are compared.
DIMENSIONS = 16


def term_counts(text: bytes | None, part: int = 1 << 20) -> Counter:
    """Terms of a UTF-8 text and how often each occurs, ``part`` bytes split at once."""
    plain, counts, start = (text or b"").translate(_SEPARATED), Counter(), 0
    while start < len(plain):
        end = plain.find(b" ", start + part)
        end = len(plain) if end < 0 else end
        counts.update(plain[start:end].split())
        start = end
    return counts


FORWARD = "doc_id long, n long, terms array<int>, tfs array<int>"


def _forward(numbers: dict[bytes, int]):
    """Arrow batches of doc_id, text to :data:`FORWARD`: terms with a number, n counts them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc_id").to_pylist()
            for start, end in in_chunks(texts):
                kept, sizes, terms, tfs, ends = [], [], [], [], [0]
                for row in range(start, end):
                    counts = term_counts(texts[row])
                    if not counts:
                        continue
                    kept.append(ids[row])
                    sizes.append(sum(counts.values()))
                    for term in counts.keys() & numbers.keys() if len(numbers) < len(counts) else counts:
                        number = numbers.get(term)
                        if number is not None:
                            terms.append(number)
                            tfs.append(counts[term])
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kept, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32())),
                    ],
                    ["doc_id", "n", "terms", "tfs"],
                )

    return run


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all spans, one span after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Shard:
    """Some documents by rows and by terms: the impacts of their terms, and blocks of a list."""

    def __init__(self, ids, alone, sizes, terms, impacts, weights, block: int):
        order = np.lexsort((ids, alone))
        starts = np.cumsum(sizes) - sizes
        entries = _spans(starts[order], sizes[order])
        self.ids, self.alone, self.sizes = ids[order], alone[order], sizes[order]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.terms, self.impacts = terms[entries], impacts[entries]
        self.weights, self.block = weights, block
        owner = np.repeat(np.arange(len(ids)), self.sizes)
        by_term = np.argsort(self.terms, kind="stable")
        self.lists = owner[by_term]
        self.list_starts = np.searchsorted(self.terms[by_term], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, self.terms, self.impacts)
        self._projected = None

    def listed(self, term: int) -> np.ndarray:
        return self.lists[self.list_starts[term] : self.list_starts[term + 1]]

    def entries(self, rows: np.ndarray) -> np.ndarray:
        return _spans(self.starts[rows], self.sizes[rows])

    def projected(self) -> np.ndarray:
        """A random projection of the weighted impacts, scaled to length 1, per document."""
        if self._projected is None:
            signs = np.random.default_rng(0).standard_normal((len(self.weights), DIMENSIONS)).astype(np.float32)
            owner = np.repeat(np.arange(len(self.ids)), self.sizes)
            value = (self.impacts * self.weights[self.terms]).astype(np.float64)
            found = np.stack(
                [np.bincount(owner, value * signs[self.terms, d], len(self.ids)) for d in range(DIMENSIONS)], axis=1
            ).astype(np.float32)
            norm = np.sqrt((found**2).sum(axis=1, keepdims=True))
            self._projected = found / np.maximum(norm, 1e-20)
        return self._projected

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents of a list, block after block, and the block of each.

        A list longer than a block is clustered: documents picked at even steps are
        the centres, and every document joins the one whose direction is nearest.
        Clusters of more than a block are cut.
        """
        rows = self.listed(term)
        if len(rows) <= self.block:
            return rows, np.zeros(len(rows), np.int64)
        points = self.projected()
        centres = points[rows[:: self.block]].T
        step = max(1, (1 << 22) // centres.shape[1])
        nearest = np.concatenate(
            [np.argmax(points[rows[at : at + step]] @ centres, axis=1) for at in range(0, len(rows), step)]
        )
        order = np.argsort(nearest, kind="stable")
        rows, nearest = rows[order], nearest[order]
        within = np.arange(len(rows)) - np.searchsorted(nearest, nearest)
        new = np.ones(len(rows), bool)
        new[1:] = (nearest[1:] != nearest[:-1]) | (within[1:] % self.block == 0)
        return rows, np.cumsum(new) - 1

    def summaries(self, rows: np.ndarray, block: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """``[block, column]``: the largest impact of each of the terms ``columns`` in a block."""
        place = np.full(len(self.weights), -1, np.int64)
        place[columns] = np.arange(len(columns))
        entries = self.entries(rows)
        owner = np.repeat(block, self.sizes[rows])
        at = place[self.terms[entries]]
        good = at >= 0
        found = np.zeros((int(block[-1]) + 1) * len(columns), np.int64)
        np.maximum.at(found, owner[good] * len(columns) + at[good], self.impacts[entries[good]])
        return found.reshape(-1, len(columns))

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores of documents against a query's weight per term."""
        entries = self.entries(rows)
        value = self.impacts[entries] * query[self.terms[entries]]
        sizes = self.sizes[rows]
        return np.add.reduceat(value, np.cumsum(sizes) - sizes)


class Search:
    """The best k documents of every query so far, shard after shard."""

    def __init__(self, queries: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, floors: np.ndarray, k: int):
        self.queries, self.weights, self.k = queries, weights, k
        self.floors = np.maximum(floors, 1)
        none = np.empty(0, np.int64)
        self.best = [(none, none.astype(bool), none) for _ in queries]  # score, id is null, id
        self.askers: dict[int, list[int]] = {}
        for number, (terms, _) in enumerate(queries):
            for term in terms.tolist():
                self.askers.setdefault(term, []).append(number)
        self.scored = self.skipped = self.blocks = 0

    def _least(self, number: int) -> int:
        """Scores below this are of no use."""
        score = self.best[number][0]
        return max(int(self.floors[number]), int(score[-1]) if len(score) == self.k else 0)

    def _passing(self, number: int, bounds: np.ndarray, shard: Shard, first: np.ndarray) -> np.ndarray:
        """Blocks that may hold a document better than the k-th; ``first`` are their first documents."""
        passing = bounds >= self._least(number)
        score, alone, ids = self.best[number]
        if len(score) == self.k:
            later = (shard.alone[first] > alone[-1]) | ((shard.alone[first] == alone[-1]) & (shard.ids[first] > ids[-1]))
            passing &= (bounds > score[-1]) | ~later
        return passing

    def _take(self, number: int, shard: Shard, rows: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self._least(number)
        if good.any():
            rows = rows[good]
            score, alone, ids = (
                np.concatenate(x) for x in zip(self.best[number], (scores[good], shard.alone[rows], shard.ids[rows]))
            )
            order = np.lexsort((ids, alone, -score))[: self.k]
            self.best[number] = (score[order], alone[order], ids[order])

    def add(self, shard: Shard) -> None:
        """Searches a shard: lists from the rarest term on, blocks from the highest bound on.

        The lists that are left can add no more to a document not seen yet than
        their largest impacts; a query for which that is too little is done.
        """
        rest = np.array([int((w * shard.most[t]).sum()) for t, w in self.queries], np.int64)
        seen = np.zeros((len(self.queries), len(shard.ids)), bool)
        dense = np.zeros(len(self.weights), np.int64)
        for term in sorted(self.askers, key=lambda t: (-self.weights[t], t)):
            if not shard.most[term]:
                continue
            asking = [q for q in self.askers[term] if rest[q] >= self._least(q)]
            if asking:
                rows, block = shard.blocks(term)
                columns = np.unique(np.concatenate([self.queries[q][0] for q in asking]))
                summary = shard.summaries(rows, block, columns)
                starts = np.flatnonzero(np.diff(block, prepend=-1))
                ends = np.append(starts[1:], len(rows))
                first = np.minimum.reduceat(rows, starts)
                self.blocks += len(starts) * len(asking)
            for q in asking:
                terms, weight = self.queries[q]
                bounds = summary[:, np.searchsorted(columns, terms)] @ weight
                dense[terms] = weight
                waiting, step = np.argsort(-bounds, kind="stable"), 4
                while len(waiting):
                    waiting = waiting[self._passing(q, bounds[waiting], shard, first[waiting])]
                    now, waiting, step = waiting[:step], waiting[step:], 2 * step
                    if len(now):
                        self.scored += len(now)
                        found = rows[_spans(starts[now], ends[now] - starts[now])]
                        found = found[~seen[q, found]]
                        seen[q, found] = True
                        if len(found):
                            self._take(q, shard, found, shard.scores(found, dense))
                dense[terms] = 0
            for q in self.askers[term]:
                terms, weight = self.queries[q]
                rest[q] -= int(weight[np.searchsorted(terms, term)] * shard.most[term])


def impacts_of(tfs: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """What an occurrence count is worth in a document of a length's norm."""
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * norms)


def _searching(queries, weights, floors, k: int, block: int, most_docs: int, most_postings: int):
    """Arrow batches of doc_id, norm, terms, tfs to the k best of every query in a task."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        held, docs, postings = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                terms = part.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tfs = part.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = part.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                norms = part.column("norm").to_numpy(zero_copy_only=False)
                ids = part.column("doc_id")
                held.append(
                    (
                        ids.fill_null(0).to_numpy(zero_copy_only=False),
                        ids.is_null().to_numpy(zero_copy_only=False),
                        sizes,
                        terms,
                        impacts_of(tfs, np.repeat(norms, sizes)),
                    )
                )
                docs, postings = docs + len(sizes), postings + len(terms)
                if docs >= most_docs or postings >= most_postings:
                    yield Shard(*map(np.concatenate, zip(*held)), weights, block)
                    held, docs, postings = [], 0, 0
        if held:
            yield Shard(*map(np.concatenate, zip(*held)), weights, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(queries, weights, floors, k)
        for shard in shards(batches):
            search.add(shard)
        for number, (score, alone, ids) in enumerate(search.best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(score), number, np.int64)),
                        pa.array(score, pa.int64()),
                        pa.array(ids, pa.int64(), mask=alone),
                    ],
                    ["query", "score", "doc_id"],
                )

    return run


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    b: int = 75,
    per_block: int = 1000,
    block: int = 64,
    most_docs: int = 16_384,
    most_postings: int = 2_000_000,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are
    ignored. Terms, weights and scores are those of a ranking by rarity, count and
    length in integers: a term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), a
    document's norm m is 100 - b + (b n N) div L, and a term adds its weight times
    (10^9 tf) div (1000 tf + 8 m) for each time the item holds it. Only scores above 0
    count; equal ones go by doc_id, null last.

    Items are taken in blocks of ``per_block``. One pass over the texts leaves, per
    document, the terms of a block's items (all other terms count in lengths only).
    The lists are made per shard, that is per run of ``most_docs`` documents or
    ``most_postings`` postings of a task, and a shard's blocks live as long as it
    does. A list that some item still needs is cut into blocks of about ``block``
    like documents (:meth:`Shard.blocks`); a block is skipped for an item only if its
    summary's bound is below the item's k-th score, or equal to it where every
    document of the block comes later. The k-th score goes from shard to shard; a
    first search over one shard's worth of documents gives all tasks a floor.

    Null or empty texts have no terms. Items without terms have no rows; items
    that repeat are items of their own. Repeated documents are all ranked. A very
    long text is split a megabyte at a time. No documents or no items: no rows.
    """
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select("item_id", F.col("text").cast("string").alias("text"))
    asked = materialize(dense_ids(asked, ["item_id", "text"], "_query"), "lexical-items")
    total = asked.count()
    result = None
    for start in range(0, total, per_block):
        held = asked.filter((F.col("_query") >= start) & (F.col("_query") < start + per_block)).orderBy("_query")
        counts = [term_counts((row.text or "").encode()) for row in held.select("text").collect()]
        found = _top_of_block(read, counts, k, b, block, most_docs, most_postings)
        named = found.select((F.col("query") + start).alias("_number"), "rank", "doc_id", "score")
        named = named.join(held, F.col("_number") == F.col("_query")).select("item_id", "rank", "doc_id", "score")
        result = named if result is None else result.unionByName(named)
    if result is None:
        item = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {item}, rank int, doc_id long, score long")
    return result


def _top_of_block(
    read: DataFrame, counts: list[Counter], k: int, b: int, block: int, most_docs: int, most_postings: int
) -> DataFrame:
    """``query, rank, doc_id, score`` for the items whose term counts are given."""
    names = sorted(set().union(*counts))
    numbers = {name: n for n, name in enumerate(names)}
    forward = materialize(read.mapInArrow(_forward(numbers), FORWARD), "lexical-forward")
    total = forward.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
    weights = np.zeros(len(names), np.int64)
    for row in forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        weights[row.term] = math.floor(1000 * math.log((2 * total.docs + 2) / (2 * row.df + 1)))
    queries = []
    for own in counts:
        terms = np.array(sorted(numbers[name] for name in own), np.int64)
        weight = np.array([own[names[t]] * weights[t] for t in terms.tolist()], np.int64)
        queries.append((terms[weight > 0], weight[weight > 0]))
    norm = F.lit(100 - b) + F.expr(f"({b} * n * {total.docs}L) div {total.words or 1}L")
    ready = forward.filter(F.size("terms") > 0).select("doc_id", norm.alias("norm"), "terms", "tfs")
    schema = "query long, score long, doc_id long"

    def search(some: DataFrame, floors: np.ndarray) -> DataFrame:
        ran = some.mapInArrow(_searching(queries, weights, floors, k, block, most_docs, most_postings), schema)
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        return ran.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    floors = np.zeros(len(queries), np.int64)
    part = most_docs / max(total.docs, 1)
    if part < 1:
        few = ready.filter(fraction(F.xxhash64("doc_id", "norm")) < part)
        for row in search(few, floors).filter(F.col("rank") == k).collect():
            floors[row["query"]] = row.score
    return search(ready, floors).select("query", "rank", "doc_id", "score")
