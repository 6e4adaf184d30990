"""Lines that stand on too large a part of a site's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.session import materialize

BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(BLANKS)).cast("binary")))


def _blank(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(BLANKS))) == 0


def boilerplate(
    pages: DataFrame, host: str, text: str, ratio: float = 0.05, min_pages: int = 5, copies_once: bool = False
) -> DataFrame:
    """``_host``, ``_bad``: for every host the keys of lines on more than ``ratio`` of its pages.

    Lines are compared without blanks at their ends, by their MD5; blank lines are
    never counted. A line counts once per page, and is boilerplate only from
    ``min_pages`` pages on. Counts are summed before the shuffle, by host and line,
    so neither a hot host nor a hot line is one task's work. A host has at most
    (its lines per page / ratio) such lines, hence the array. With ``copies_once``
    all pages of a host with the same text are one page.
    """
    known = pages.filter(F.col(host).isNotNull()).select(F.col(host).alias("_host"), F.col(text).alias("_text"))
    keys = F.array_distinct(
        F.transform(F.filter(_lines(F.col("_text")), lambda line: ~_blank(line)), _key)
    )
    if copies_once:
        known = known.select("_host", F.md5(F.col("_text").cast("binary")).alias("_hash"), keys.alias("_keys"))
        known = materialize(known.dropDuplicates(["_host", "_hash"]), "boilerplate-pages")
        keys = F.col("_keys")
    total = known.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    counts = (
        known.select("_host", F.explode(keys).alias("_line"))
        .groupBy("_host", "_line")
        .agg(F.count(F.lit(1)).alias("_with"))
        .filter(F.col("_with") >= min_pages)
    )
    return (
        counts.join(total, "_host")
        .filter(F.col("_with") > F.lit(float(ratio)) * F.col("_pages"))
        .groupBy("_host")
        .agg(F.collect_set("_line").alias("_bad"))
    )


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = 0.05,
    min_pages: int = 5,
    copies_once: bool = False,
) -> DataFrame:
    """All rows and columns of ``pages``; boilerplate lines are gone from ``text``.

    Adds ``n_lines`` and ``n_dropped``, replacing columns of those names. A page of
    nothing but boilerplate keeps its row, with an empty text. A null text stays
    null, with 0 lines; pages without host keep all their lines. Rows that repeat
    are pages of their own, unless ``copies_once`` makes one page of a host's equal
    texts: then a text does not lose its lines to its own copies.
    """
    bad = materialize(boilerplate(pages, host, text, ratio, min_pages, copies_once), "boilerplate")
    joined = pages.select(
        F.struct("*").alias("_row"), F.col(host).alias("_site"), _lines(F.col(text)).alias("_lines")
    ).join(bad, F.col("_site") == F.col("_host"), "left")
    good = F.filter("_lines", lambda line: _blank(line) | ~F.array_contains(F.col("_bad"), _key(line)))
    joined = joined.withColumn("_kept", F.when(F.col("_bad").isNull(), F.col("_lines")).otherwise(good))
    lines, kept = (F.coalesce(F.size(c), F.lit(0)).cast("long") for c in ("_lines", "_kept"))
    new = {
        text: F.array_join("_kept", "\n"),
        "n_lines": F.greatest(lines, F.lit(0)),
        "n_dropped": F.greatest(lines, F.lit(0)) - F.greatest(kept, F.lit(0)),
    }
    old = [F.col("_row").getField(c).alias(c) for c in pages.columns if c not in new]
    columns = {c: None for c in [*pages.columns, *new]}
    by_name = dict(zip([c for c in pages.columns if c not in new], old)) | {c: e.alias(c) for c, e in new.items()}
    return joined.select(*(by_name[c] for c in columns))
