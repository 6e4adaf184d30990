"""Exact duplicates by an extendible-hash index in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.text import texts_of
from rillflow.session import materialize

#: The directory never has more than 2 to this power slots.
MAX_DEPTH = 16


class Directory:
    """Slots by the first bits of a key; each names a bucket, and several may name the same.

    A bucket with more than ``capacity`` keys is split by its next bit; if it has as
    many bits as the directory, the directory doubles first. A bucket that has
    ``MAX_DEPTH`` bits is not split any more: its keys are chained by their owner.
    """

    def __init__(self, keys_per_prefix: np.ndarray, capacity: int):
        self.depth = 0
        self.slots = np.zeros(1, np.int64)
        self.local = [0]
        self.keys = [int(keys_per_prefix.sum())]
        sums = np.concatenate([[0], np.cumsum(keys_per_prefix)])
        first = [0]
        waiting = [0]
        while waiting:
            bucket = waiting.pop()
            if self.keys[bucket] <= capacity or self.local[bucket] == MAX_DEPTH:
                continue
            if self.local[bucket] == self.depth:
                self.slots = np.repeat(self.slots, 2)
                self.depth += 1
            self.local[bucket] += 1
            half = 1 << (MAX_DEPTH - self.local[bucket])
            start, middle, end = first[bucket], first[bucket] + half, first[bucket] + 2 * half
            other = len(self.local)
            self.local.append(self.local[bucket])
            first.append(middle)
            self.keys[bucket] = int(sums[middle] - sums[start])
            self.keys.append(int(sums[end] - sums[middle]))
            shift = MAX_DEPTH - self.depth
            self.slots[middle >> shift : end >> shift] = other
            waiting += [bucket, other]

    def buckets(self) -> np.ndarray:
        """The bucket of every prefix of ``MAX_DEPTH`` bits."""
        return np.repeat(self.slots, 1 << (MAX_DEPTH - self.depth))


def _key(digest: bytes, bits: int) -> int:
    """The first ``bits`` bits of a digest at the top of a signed 64-bit key."""
    return int.from_bytes(digest[:8], "big", signed=True) >> (64 - bits) << (64 - bits)


def _digests(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [sha256((text or b"").lower()).digest() for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([_key(d, bits) for d in digests], pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                ["doc_id", "key", "digest"],
            )

    return run


ENTRY = "bucket long, key long, digest binary, text binary, top long, n long"


def _entries(buckets: np.ndarray, bits: int):
    """An entry for each different text of an Arrow batch: copies inside it are counted there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list] = {}
            for text, doc_id in zip(texts_of(batch), batch.column("doc_id").to_pylist()):
                text = (text or b"").lower()
                entry = found.setdefault(text, [None, 0])
                if doc_id is not None and (entry[0] is None or doc_id > entry[0]):
                    entry[0] = doc_id
                entry[1] += 1
            digests = [sha256(text).digest() for text in found]
            keys = [_key(d, bits) for d in digests]
            prefix = (np.array(keys, np.int64).view(np.uint64) >> np.uint64(64 - MAX_DEPTH)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(buckets[prefix]),
                    pa.array(keys, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(list(found), pa.binary()),
                    pa.array([top for top, _ in found.values()], pa.int64()),
                    pa.array([n for _, n in found.values()], pa.int64()),
                ],
                ["bucket", "key", "digest", "text", "top", "n"],
            )

    return run


GROUP = "bucket long, key long, chain int, digest binary, keep_id long, group_size long"


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in the order of their keys to one row per different text.

    The texts of one key are chained: an entry is compared byte by byte with those
    in the chain whose digest it has, and joins its equal or extends the chain.
    Only the chain of the current key is held.
    """
    current, chain = None, []
    names = ["bucket", "key", "chain", "digest", "keep_id", "group_size"]

    def rows(bucket, key, links):
        return [(bucket, key, n, link[0], link[2], link[3]) for n, link in enumerate(links)]

    def batch_of(done):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

    for batch in batches:
        done = []
        columns = [batch.column(c) for c in ("bucket", "key", "digest", "text", "top", "n")]
        for row in range(batch.num_rows):
            bucket, key, digest, text, top, n = (c[row].as_py() for c in columns)
            if (bucket, key) != current:
                if current is not None:
                    done += rows(*current, chain)
                current, chain = (bucket, key), []
            for link in chain:
                if link[0] == digest and link[1] == text:
                    link[2] = top if link[2] is None else link[2] if top is None else max(link[2], top)
                    link[3] += n
                    break
            else:
                if any(link[0] == digest for link in chain):
                    raise ValueError("two texts share a SHA-256 digest, which names the groups")
                chain.append([digest, text, top, n])
        if done:
            yield batch_of(done)
    if current is not None:
        yield batch_of(rows(*current, chain))


def exact_duplicates(docs: DataFrame, capacity: int = 256, key_bits: int = 64) -> DataFrame:
    """Groups of documents whose texts are the same once A-Z is lower-cased.

    Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``. Keys are
    the first bits of the text's SHA-256. How many different keys each 16-bit prefix
    has decides the directory (:class:`Directory`); a bucket holds ``capacity`` keys
    or, beyond two million, as many as keep the directory within its bound. The
    tasks that own the buckets get one entry per different text and input batch,
    however many copies there are, chain the texts of a key and compare bytes. The
    index they write, and the table of digests, lie in the shared folder.

    A null text counts as empty. Of rows that repeat the largest doc_id of a group
    one is kept. A null doc_id is smaller than any other. ``key_bits`` below 64
    makes collisions likely, for tests.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = materialize(
        read.mapInArrow(_digests(key_bits), "doc_id long, key long, digest binary"), "dup-digests"
    )
    prefix = F.shiftrightunsigned("key", 64 - MAX_DEPTH).cast("int").alias("prefix")
    histogram = members.select(prefix, "key").distinct().groupBy("prefix").count().collect()
    keys = np.zeros(1 << MAX_DEPTH, np.int64)
    for row in histogram:  # at most 2 ** MAX_DEPTH rows
        keys[row["prefix"]] = row["count"]
    directory = Directory(keys, max(capacity, int(keys.sum()) >> 13))
    entries = read.mapInArrow(_entries(directory.buckets(), key_bits), ENTRY).repartition("bucket")
    index = materialize(
        entries.sortWithinPartitions("bucket", "key", "digest").mapInArrow(_owned, GROUP), "dup-index"
    )
    groups = index.filter("group_size > 1").select(
        F.col("digest").alias("_digest"), "keep_id", "group_size"
    )
    twins = Window.partitionBy("doc_id", "digest").orderBy("doc_id")
    rows = members.withColumn("_nth", F.row_number().over(twins))
    joined = rows.join(groups, F.col("digest") == F.col("_digest"), "left")
    keep_id = F.when(F.col("_digest").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep_id) & (F.col("_nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
