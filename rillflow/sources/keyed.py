"""A keyed result table that micro-batches upsert into, as plain parquet folders.

``changes/version=N`` holds the rows that the N-th write set, ``full/version=N`` all
rows after it. Versions are the table's own: a write takes the newest finished
version plus one, whatever the number of the batch, so a stream that starts again
with a new checkpoint goes on where the table is. Each version has a marker that
names the writer and its batch; a replayed batch of the same writer finds its
marker and writes the same version again. A write costs what it changes. A reader
takes the newest full folder and the changes after it; the newest row of a key
counts. One writer at a time.

A table created with ``buckets`` has its folders cut by a hash of the key, and a
Bloom filter per file on a key of one column: :func:`lookup` reads the folders of
the keys asked for, and of those the row groups that may hold them.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from rillflow.session import materialize
from rillflow.sources.paths import delete, is_finished, last_finished, numbers, read_text, write_text

KINDS = ("full", "changes")
BUCKET = "_bucket"
#: More keys than this are joined to, not listed in a filter.
LISTED_KEYS = 1_000


def create_table(spark: SparkSession, path: str, schema: StructType | str, buckets: int = 0) -> None:
    """Create the table with its declared schema unless a finished full folder is there.

    ``buckets``: the number of folders by key of every version, for :func:`lookup`;
    so many that one holds a few files' worth of the table's rows. 0 is none.
    """
    if last_finished(spark, f"{path}/full", "version") is None:
        empty = spark.createDataFrame([], schema)
        write_text(spark, f"{path}/buckets", str(buckets))
        write_text(spark, f"{path}/schema", empty.schema.json())
        empty.write.mode("overwrite").parquet(f"{path}/full/version=0")


def _buckets(spark: SparkSession, path: str) -> int:
    return int(read_text(spark, f"{path}/buckets") or 0)


def _bucket_of(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, folder: str, key: list[str]) -> None:
    """One version. With buckets, one file in each bucket's folder, or more if it is large."""
    buckets = _buckets(df.sparkSession, path)
    if not buckets:
        df.write.mode("overwrite").parquet(f"{path}/{folder}")
        return
    cut = df.withColumn(BUCKET, _bucket_of(key, buckets)).hint("rebalance", BUCKET)
    writer = cut.write.mode("overwrite").partitionBy(BUCKET)
    if len(key) == 1:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key[0]}", "true")
    writer.parquet(f"{path}/{folder}")


def _versions(spark: SparkSession, path: str, kind: str) -> list[int]:
    folder = f"{path}/{kind}"
    return [n for n in numbers(spark, folder, "version") if is_finished(spark, folder, "version", n)]


def version_for(spark: SparkSession, path: str, writer: str, batch: int) -> int:
    """The version under which ``writer`` stores ``batch``: its own if it is a replay, else a new one."""
    newest = max((n for kind in KINDS for n in _versions(spark, path, kind)), default=0)
    if read_text(spark, f"{path}/markers/{newest}") == f"{writer} {batch}":
        return newest
    return newest + 1


def read_table(spark: SparkSession, path: str, key: list[str], before: int | None = None) -> DataFrame:
    """The current rows, or those before version ``before``. A table that was never created is an error."""
    return _newest(_parts(spark, path, before), key)


def _parts(spark: SparkSession, path: str, before: int | None = None) -> list[DataFrame]:
    """The versions that make up the table, each with its number."""
    base = last_finished(spark, f"{path}/full", "version", before)
    if base is None:
        raise FileNotFoundError(f"no finished table at {path}")
    later = [n for n in _versions(spark, path, "changes") if n > base and (before is None or n < before)]
    read = spark.read
    if _buckets(spark, path):  # a version without rows has no file then
        read = read.schema(StructType.fromJson(json.loads(read_text(spark, f"{path}/schema"))).add(BUCKET, IntegerType()))
    return [
        read.parquet(f"{path}/{kind}/version={n}").withColumn("_version", F.lit(n))
        for kind, chosen in (("full", [base]), ("changes", later))
        for n in chosen
    ]


def _newest(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """The newest row of each key."""
    parts = [part.drop(BUCKET) for part in parts]
    names = [c for c in parts[0].columns if c not in (*key, "_version")]
    if len(parts) == 1:
        return parts[0].drop("_version")
    rows = reduce(DataFrame.unionByName, parts)
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*names), "_version").alias("_row"))
    return newest.select(*key, *[F.col(f"_row.{c}").alias(c) for c in names])


def lookup(spark: SparkSession, path: str, key: list[str], wanted: DataFrame, before: int | None = None) -> DataFrame:
    """The current rows (before version ``before``) of the keys in ``wanted``, read from their buckets only.

    The driver takes the numbers of the buckets asked for, of which there are no
    more than the table has, and up to LISTED_KEYS keys of one column, which go to
    the scan as a filter: row groups whose Bloom filter or range has none of them
    are left unread. More keys are joined to. Keys the table lacks have no row; a
    null key has none either, and keys that repeat count once. A table without
    buckets is read whole.
    """
    asked = materialize(wanted.select(*key).dropna().distinct(), "keys-asked")
    parts = _parts(spark, path, before)
    if buckets := _buckets(spark, path):
        numbers_asked = [r[0] for r in asked.select(_bucket_of(key, buckets)).distinct().collect()]
        parts = [part.filter(F.col(BUCKET).isin(numbers_asked)) for part in parts]
    if len(key) == 1:
        listed = [r[0] for r in asked.limit(LISTED_KEYS + 1).collect()]
        if len(listed) <= LISTED_KEYS:
            return _newest([part.filter(F.col(key[0]).isin(listed)) for part in parts], key)
    return _newest([part.join(asked, key, "left_semi") for part in parts], key)


def upsert(df: DataFrame, path: str, key: list[str], batch: int, full_every: int = 50,
           writer: str = "", alive: Column | None = None) -> None:
    """Set the rows of ``df`` (one per key) in the table at ``path`` as batch ``batch`` of ``writer``.

    The marker is written first: a crash after it leaves an unfinished folder,
    which the replay overwrites. A full version keeps only the rows that are
    ``alive``; until then readers see the others too.
    """
    spark = df.sparkSession
    version = version_for(spark, path, writer, batch)
    write_text(spark, f"{path}/markers/{version}", f"{writer} {batch}")
    if version % full_every:
        _write(df, path, f"changes/version={version}", key)
        return
    old = read_table(spark, path, key, before=version)
    merged = old.join(df.select(*key), key, "left_anti").unionByName(df.select(*old.columns))
    if alive is not None:
        merged = merged.filter(alive)
    _write(merged, path, f"full/version={version}", key)
    _forget(spark, path, last_finished(spark, f"{path}/full", "version", version))


def _forget(spark: SparkSession, path: str, base: int) -> None:
    """Drop what is older than the full folder ``base``; that one stays for running readers."""
    for kind in KINDS:
        for n in numbers(spark, f"{path}/{kind}", "version"):
            if n < base:
                delete(spark, f"{path}/{kind}/version={n}")
                delete(spark, f"{path}/markers/{n}")
