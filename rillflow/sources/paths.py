"""Listing on whatever file system the path names."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, such as a marker."""
    fs, where = _open(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all. One that is there already is an error."""
    write_text(spark, f"{path}.part", text)
    fs, where = _open(spark, f"{path}.part")
    if not fs.rename(where, _open(spark, path)[1]):
        raise FileExistsError(path)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of all children, none without the folder."""
    fs, where = _open(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(where)] if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """What :func:`write_text` wrote, None without the file."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The ``N`` of all children ``<prefix>=N``, ascending; one listing."""
    matches = (re.fullmatch(rf"{prefix}=(-?\d+)", name) for name in names(spark, path))
    return sorted(int(match.group(1)) for match in matches if match)


def is_finished(spark: SparkSession, path: str, prefix: str, number: int) -> bool:
    """Whether the write of ``<prefix>=<number>`` has completed."""
    return exists(spark, f"{path}/{prefix}={number}/_SUCCESS")


def last_finished(spark: SparkSession, path: str, prefix: str, before: int | None = None) -> int | None:
    """The highest finished number (below ``before``), looking from the top down."""
    for number in reversed(numbers(spark, path, prefix)):
        if (before is None or number < before) and is_finished(spark, path, prefix, number):
            return number
    return None
