"""Entity files, tag-name files, and tag sets that belong to entities by line number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Columns ``id`` (0 for the first line, over files in name order) and ``line``.

    A file is read in splits. Inside a split the lines keep their order, so only
    the line count of each split has to be known to number all lines; the lines
    themselves are never sorted, and the table of counts, one row per split, is
    broadcast if Spark finds it small.
    """
    split = ["_file", "_start"]
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    sizes = lines.groupBy(*split).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *split, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return lines.join(offsets, split).select(
        (F.col("_offset") + F.col("_mid") - F.col("_first")).alias("id"), "line"
    )


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``id, title, artist``; quotes are ordinary characters."""
    return (
        spark.read.schema("id bigint, title string, artist string")
        .options(sep="\t", quote="", escape="", mode="PERMISSIVE")
        .csv(path)
    )


def read_tag_ids(spark: SparkSession, path: str) -> DataFrame:
    """One set of tag ids per line: ``id``, ``tag_ids``. A line ``#`` has no tags: null."""
    ids = F.array_distinct(F.split("line", " "))
    return numbered_lines(spark, path).select(
        "id", F.when(F.col("line") != "#", ids).alias("tag_ids")
    )


def read_tag_names(spark: SparkSession, path: str) -> DataFrame:
    """``id, name`` with the separator ``", "``; the last line of an id counts."""
    parts = F.split("line", ", ")
    return (
        numbered_lines(spark, path)
        .select(
            F.try_element_at(parts, F.lit(1)).try_cast("int").alias("tag_id"),
            F.try_element_at(parts, F.lit(2)).alias("tag"),
            F.col("id").alias("_line"),
        )
        .filter(F.col("tag_id").isNotNull() & F.col("tag").isNotNull())
        .groupBy("tag_id")
        .agg(F.max_by("tag", "_line").alias("tag"))
    )
