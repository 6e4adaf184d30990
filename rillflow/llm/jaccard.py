"""Near-duplicate documents: an exact Jaccard join on word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.running import same
from rillflow.llm.text import WordHashes, in_chunks, shingle_hashes, texts_of
from rillflow.operators.components import stars
from rillflow.session import materialize

#: Part of the shingles looked at in the first pass, in 64ths of the hash space.
FIRST_PASS = 16

#: Ranges of the hash space whose counts bound the difference of two sets.
RANGES = 64


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _class_of(found: np.ndarray) -> int:
    return int.from_bytes(blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def _prefix(n: int, percent: int) -> int:
    """Two sets that are alike share one of so many first elements in any common order."""
    return n + 1 + (-percent * n) // 100


def _first_pass(width: int, percent: int):
    """Arrow batches of doc_id, text to rows ``kind, key, id, n, u``.

    kind 0, one per document: key and id are its class (hash of its set) and
    doc_id, n its shingles, u those in the part looked at. kind 1 and 2: key is a
    shingle, id the class; 2 marks shingles outside the part, given by a set with
    fewer than a prefix inside it. A class repeated in a task gives these once.
    """
    bound = np.uint64(FIRST_PASS << 58)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("doc_id").to_pylist()
            for start, end in in_chunks(texts):
                docs: list[tuple] = []
                keys, owners, kinds = [], [], []
                for row in range(start, end):
                    found = shingle_hashes(texts[row], hashes, width)
                    n = len(found)
                    name = _class_of(found) if n else 0
                    inside = int(np.searchsorted(found, bound))
                    docs.append((name, ids[row], n, inside))
                    if not n or name in seen:
                        continue
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(name)
                    take = max(inside, _prefix(n, percent))
                    keys.append(found[:take])
                    owners.append(np.full(take, name, np.int64))
                    kinds.append(np.where(np.arange(take) < inside, 1, 2).astype(np.int8))
                columns = list(zip(*docs))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(len(docs), np.int8)),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.int32()),
                        pa.array(columns[3], pa.int32()),
                    ],
                    ["kind", "key", "id", "n", "u"],
                )
                if keys:
                    key = _signed(np.concatenate(keys))
                    none = pa.nulls(len(key), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(kinds)), pa.array(key), pa.array(np.concatenate(owners)), none, none],
                        ["kind", "key", "id", "n", "u"],
                    )

    return run


def _of_their_class(width: int):
    """Arrow batches of id, rows, text: only those whose text has the set of class ``id``.

    Drops nothing but other texts under a repeated doc_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("id").to_pylist()
            own = [_class_of(shingle_hashes(text, hashes, width)) == name for text, name in zip(texts, ids)]
            yield batch.filter(pa.array(own, pa.bool_()))

    return run


def _second_pass(width: int):
    """Arrow batches of id, text to a row ``key, id, n`` for every shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("id").to_pylist()
            for start, end in in_chunks(texts):
                sets = [shingle_hashes(text, hashes, width) for text in texts[start:end]]
                sizes = np.array([len(found) for found in sets], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_signed(np.concatenate(sets))),
                        pa.array(np.repeat(np.array(ids[start:end], np.int64), sizes)),
                        pa.array(np.repeat(sizes, sizes)),
                    ],
                    ["key", "id", "n"],
                )

    return run


def _sets(width: int):
    """Arrow batches of id, text to ``id, found``: the set as 64-bit numbers in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, ids = texts_of(batch), batch.column("id").to_pylist()
            for start, end in in_chunks(texts):
                sets = [shingle_hashes(text, hashes, width).tobytes() for text in texts[start:end]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[start:end], pa.int64()), pa.array(sets, pa.binary())], ["id", "found"]
                )

    return run


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 x intersection >= percent x union.

    The suffix filter goes first: cut at fixed hashes, the sets differ in each
    range by the difference of their counts at least.
    """
    total = len(x) + len(y)
    cuts = np.arange(1, RANGES, dtype=np.uint64) << np.uint64(58)
    counts = [np.diff(np.searchsorted(s, cuts), prepend=0, append=len(s)) for s in (x, y)]
    # |x| + |y| - 2 shared = what differs; 100 shared >= percent (total - shared).
    if (100 + percent) * (total - int(np.abs(counts[0] - counts[1]).sum())) < 2 * percent * total:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (total - shared)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are alike. Each set goes once to its join, then once per pair."""

    @F.pandas_udf("boolean")
    def checked(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(
            [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(left, right)],
            dtype=bool,
        )

    one = sets.select(F.col("id").alias("b"), F.col("found").alias("_right"))
    other = sets.select(F.col("id").alias("a"), F.col("found").alias("_left"))
    return pairs.join(one, "b").join(other, "a").filter(checked("_left", "_right")).select("a", "b")


def _postings(shingles: DataFrame, percent: int) -> DataFrame:
    """``key, id, n, pos``: the prefix of every set, rarest first, where another set has the key.

    The order is by the number of sets that hold a shingle, then by the shingle.
    Those that no other set holds come first; they need no row, only their number.
    """
    prefix = F.expr(f"n + 1 + floor(-{percent} * n / 100)")
    counted = shingles.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("df > 1")
    of = Window.partitionBy("id")
    return (
        counted.withColumn("_rank", F.row_number().over(of.orderBy("df", "key")))
        .withColumn("pos", F.col("n") - F.count(F.lit(1)).over(of) + F.col("_rank") - 1)
        .filter(F.col("pos") < prefix)
        .select("key", "id", "n", "pos")
    )


def _may_be_alike(x: str, y: str, percent: int):
    """Length filter and positional filter: so many elements at least are shared, so many can be."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    rest = F.least(n - F.col(f"{x}pos"), m - F.col(f"{y}pos"))
    return (F.greatest(n, m) * percent <= F.least(n, m) * 100) & (rest * (100 + percent) >= (n + m) * percent)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Documents linked by 100 x intersection >= ``percent`` x union of their shingle sets.

    Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, the smallest
    doc_id reachable by links. An exact prefix-filter join in these steps:

    1. Documents with equal sets are one class, known by a 64-bit hash of the set
       and the set's size.
    2. A first pass looks at a fixed quarter of the hash space, which is put before
       the rest in the common order. A class whose prefix is filled there by
       shingles that no other class has can have no link; the others go on.
    3. Over all shingles of those, the prefixes are taken rarest first.
    4. In every list of classes with a common prefix shingle, all are paired with
       the one that has the fewest rare shingles before it; filters on length and
       position, each pair once, suffix filter, exact check.
    5. Then every other pair of a list that passes the filters is checked, unless
       its ends are connected by then; what is connected needs no further link.

    Shingles are compared by 64-bit hashes. A null or wordless text has an empty
    set and is its own component. A null doc_id takes part; its row gets the
    component of its class, null if it is alone. Rows that repeat a doc_id are
    rows like others. Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = "kind tinyint, key long, id long, n int, u int"
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = Window.partitionBy("kind", "key")
    first = materialize(
        read.mapInArrow(_first_pass(width, percent), schema)
        .withColumn("_shared", F.min("id").over(every) < F.max("id").over(every))
        .filter("kind = 0 or _shared")
        .drop("_shared"),
        "near-first",
    )
    members = first.filter("kind = 0").select(F.col("key").alias("class"), F.col("id").alias("doc_id"), "n", "u")
    by_id = F.struct(F.col("doc_id").isNull(), "doc_id")
    classes = materialize(
        members.filter("n > 0")
        .groupBy("class", "n", "doc_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("u").alias("u"))
        .groupBy("class", "n")
        .agg(F.min("doc_id").alias("rep"), F.min_by("rows", by_id).alias("rows"), F.min("u").alias("u")),
        "near-classes",
    )
    shared = (
        first.filter("kind > 0")
        .select("kind", "key", F.col("id").alias("class"))
        .distinct()
        .groupBy("class")
        .agg(F.count(F.when(F.col("kind") == 1, 1)).alias("_inside"))
    )
    prefix = F.expr(f"n + 1 + floor(-{percent} * n / 100)")
    going_on = (
        classes.join(shared, "class")
        .filter(F.col("u") - F.col("_inside") < prefix)
        .select(F.col("class").alias("id"), "rep", "rows")
    )
    stored = materialize(
        read.join(going_on, same(F.col("doc_id"), F.col("rep")))
        .select("id", "rows", "text")
        .mapInArrow(_of_their_class(width), "id long, rows long, text string"),
        "near-texts",
    )
    texts = stored.filter("rows = 1").unionByName(stored.filter("rows > 1").dropDuplicates(["id"])).drop("rows")
    postings = materialize(
        _postings(texts.mapInArrow(_second_pass(width), "key long, id long, n int"), percent), "near-postings"
    )

    x = postings.select("key", *(F.col(c).alias(f"x_{c}") for c in ("id", "n", "pos")))
    centre = postings.groupBy("key").agg(
        F.min(F.struct("pos", "id", "n")).alias("c"), F.count(F.lit(1)).alias("_listed")
    )
    centre = centre.filter("_listed > 1").select("key", *(F.col(f"c.{c}").alias(f"y_{c}") for c in ("id", "n", "pos")))
    pair = [F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")]
    passes = (F.col("x_id") != F.col("y_id")) & _may_be_alike("x_", "y_", percent)
    tried = materialize(x.join(centre, "key").filter(passes).select(*pair).distinct(), "near-tried")
    found = materialize(_verified(tried, _sets_of(texts, tried, width), percent), "near-links")

    labels = stars(found.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    labelled = materialize(
        postings.join(labels.select(F.col("hi").alias("id"), "lo"), "id", "left").select(
            "key", "id", "n", "pos", F.coalesce("lo", "id").alias("comp")
        ),
        "near-labelled",
    )
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high"))
    open_lists = labelled.join(mixed.filter("_low < _high").select("key"), "key", "left_semi")
    x, y = (open_lists.select("key", *(F.col(c).alias(f"{s}{c}") for c in ("id", "n", "pos", "comp"))) for s in ("x_", "y_"))
    apart = (F.col("x_id") < F.col("y_id")) & (F.col("x_comp") != F.col("y_comp"))
    rest = x.join(y, "key").filter(apart & _may_be_alike("x_", "y_", percent)).select(*pair).distinct()
    rest = materialize(rest.join(tried, ["a", "b"], "left_anti"), "near-rest")
    more = _verified(rest, _sets_of(texts, rest, width), percent)
    links = found.unionByName(more).select(F.col("a").alias("src"), F.col("b").alias("dst"))

    ends = stars(links).select(F.col("hi").alias("class"), "lo")
    named = classes.join(ends, "class", "left").withColumn("lo", F.coalesce("lo", "class"))
    lowest = named.groupBy("lo").agg(F.min("rep").alias("component_id"))
    named = named.join(lowest, "lo").select(F.col("class").alias("_class"), F.col("n").alias("_n"), "component_id")
    return members.join(named, (F.col("class") == F.col("_class")) & (F.col("n") == F.col("_n")), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _sets_of(texts: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The sets of the documents that occur in pairs, stored for both sides of the check."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return materialize(
        texts.join(wanted, "id", "left_semi").mapInArrow(_sets(width), "id long, found binary"), "near-sets"
    )
