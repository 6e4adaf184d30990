"""JSON-lines tables: reading, and writing in the four modes."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MODES = ("append", "overwrite", "ignore", "error")


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines. Give a schema in production: without one Spark reads the files twice."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def variant_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as ``line`` and ``parsed``, a variant; null where the line is no JSON object. No schema is needed.

    Empty lines are left out, as the JSON reader does.
    """
    lines = spark.read.text(path).select(F.col("value").alias("line")).filter(F.trim("line") != "")
    parsed = F.try_parse_json("line")
    return lines.select("line", F.when(F.schema_of_variant(parsed).startswith("OBJECT<"), parsed).alias("parsed"))


def variant_schema(lines: DataFrame) -> tuple[str, int]:
    """The type, a struct as SQL writes it, that all objects fit and the number of broken lines, from one aggregate.

    A field whose kind differs between lines is a variant; one that is always null is text.
    """
    found = lines.agg(
        F.schema_of_variant_agg("parsed").alias("schema"), F.count_if(F.col("parsed").isNull()).alias("broken")
    ).first()
    if not (found.schema or "").startswith("OBJECT<"):
        return "STRUCT<>", found.broken
    plain = [  # names in backticks stay as they are
        part if part.startswith("`") else re.sub(r"\bVOID\b(?!:)", "STRING", part.replace("OBJECT<", "STRUCT<"))
        for part in re.split("(`(?:[^`]|``)*`)", found.schema)
    ]
    return "".join(plain), found.broken


def read_variant_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, int]:
    """JSON lines without a schema: the rows, the broken lines (``line``), and how many those are.

    A broken line, or one that holds no object, costs its own row only. A field
    that drifts from one kind to another keeps both as a variant, to be cast by whoever knows.
    """
    lines = variant_lines(spark, path)
    schema, broken = variant_schema(lines)
    good = lines.filter(F.col("parsed").isNotNull())
    fields = F.struct() if schema == "STRUCT<>" else F.try_variant_get("parsed", "$", schema)
    return good.select(fields.alias("row")).select("row.*"), lines.filter(F.col("parsed").isNull()).select("line"), broken


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    df.write.mode(mode).json(path)


def schema_and_head(df: DataFrame, n: int = 2, *order: str) -> tuple[str, DataFrame]:
    """The printed schema and the first rows (in the order of some columns), for a look at a new table."""
    return df.schema.treeString(), (df.orderBy(*order) if order else df).limit(n)


def from_values(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(list(rows), schema)
