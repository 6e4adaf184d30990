"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.streaming import DataStreamReader

from rillflow.functions.casts import word_and_number

SHORT_TEXT_SCHEMA = "doc_id bigint, text string, lang string, retweet_text string"


def kafka_reader(spark: SparkSession, servers: str, topic: str, **options: str) -> DataStreamReader:
    """A reader on a topic. ``load()`` needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").options(**options)
    return reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)


def kafka_text(messages: DataFrame) -> DataFrame:
    """Message keys and values as text."""
    return messages.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def text_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of text files as they arrive in a folder: column ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def parquet_rows(spark: SparkSession, folder: str, schema: StructType | str,
                 files_per_batch: int = 1000) -> DataFrame:
    """Rows of parquet files as they arrive in a folder, for example short texts."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def keyed_numbers(lines: DataFrame, line: str = "value") -> DataFrame:
    """``word,number`` lines to ``word`` and ``value``; a bad number gives a null value."""
    pair = word_and_number(F.col(line))
    return lines.select(
        *[c for c in lines.columns if c != line],
        pair["word"].alias("word"),
        pair["value"].alias("value"),
    )
