"""Mixing sources to target weights that change in the course of training."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.running import running_sum, same
from rillflow.operators.numbering import dense_ids
from rillflow.session import materialize

#: A word: a run of anything but blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

KNOTS = "array<struct<t:double,w:double>>"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _knots(points: list[tuple[float, float]]) -> Column:
    return F.array(
        *(F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in points)
    ).cast(KNOTS)


#: Weights over training time 0 to 1, with means 3, 1 and 2: steady, growing, fading.
STEADY, GROWING, FADING = [(0, 3), (1, 3)], [(0, 0), (0.5, 1), (1, 2)], [(0, 4), (0.25, 2.25), (1, 1)]


def mean_weight(points: list[tuple[float, float]]) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


def repeating_schedules(sources: DataFrame, curves: list[list[tuple[float, float]]]) -> DataFrame:
    """``source``, ``knots``: the curves in turn over the sources by code point, null last."""
    ranked = dense_ids(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_rank")
    turn = F.col("_rank") % len(curves)
    knots = F.lit(None).cast(KNOTS)
    for at, curve in enumerate(curves):
        knots = F.when(turn == at, _knots(curve)).otherwise(knots)
    return ranked.select("source", knots.alias("knots"))


def integrated(schedules: DataFrame) -> DataFrame:
    """``source``, ``weight`` (integral of the curve), ``pieces`` with the area before each.

    Curves are straight between their knots, which ascend in ``t``; there are few
    knots, so the pieces of one source are one array.
    """
    pairs = F.arrays_zip(
        F.expr("slice(knots, 1, size(knots) - 1)").alias("a"), F.expr("slice(knots, 2, size(knots) - 1)").alias("b")
    )
    area = F.expr("transform(_pairs, p -> (p.b.t - p.a.t) * (p.a.w + p.b.w) / 2)")
    pieces = F.expr(
        "transform(_pairs, (p, i) -> struct(p.a.t as t, p.b.t - p.a.t as width, p.a.w as w,"
        " (p.b.w - p.a.w) / (p.b.t - p.a.t) as slope,"
        " aggregate(slice(_areas, 1, i), double(0), (x, y) -> x + y) as before))"
    )
    return (
        schedules.withColumn("_pairs", pairs)
        .withColumn("_areas", area)
        .select(
            "source",
            F.expr("aggregate(_areas, double(0), (x, y) -> x + y)").alias("weight"),
            pieces.alias("pieces"),
        )
    )


def fill_targets(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """Adds ``target`` to ``source, source_size, weight``: weight x level, at most cap x size.

    The level rises until the targets sum to ``share`` of all sizes: each round
    shares what the sources at their cap leave among the others. Rounds exchange
    four numbers with the driver; one more source at least is capped in each.
    """
    limit = F.col("source_size") * F.lit(float(cap))
    level = 0.0
    capped = -1
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        found = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count(F.when(full, True)).alias("capped"),
        ).first()
        if found.capped == capped or not found.weight:
            break
        capped = found.capped
        level = max(level, (share * found.size - found.taken) / found.weight)
    return sources.withColumn("target", F.least(limit, F.lit(level) * F.col("weight")))


def _position(area: Column, pieces: Column) -> Column:
    """The time at which the integral of the curve reaches ``area``."""
    piece = F.element_at(F.filter(pieces, lambda p: p["before"] <= area), -1)
    rest = area - piece["before"]
    root = F.sqrt(F.greatest(piece["w"] * piece["w"] + 2 * piece["slope"] * rest, F.lit(0.0)))
    bottom = piece["w"] + root
    return piece["t"] + F.least(F.when(bottom > 0, 2 * rest / bottom).otherwise(F.lit(0.0)), piece["width"])


def curriculum(
    sizes: DataFrame, schedules: DataFrame, share: float = 1.5, cap: float = 2.0, seed: int = 11
) -> DataFrame:
    """Which words of which document are trained on, and when.

    ``sizes`` has ``doc_id, source, size`` and any further columns, ``schedules``
    one row per source with ``knots``, the curve of its weight over time 0 to 1.
    The result has a row per input row: ``source_size``, ``target`` and ``takes``,
    an array of ``copy, words, position``. The documents of a source stand in a
    fixed random order (by seed and doc_id). The words demanded of a source up to
    time t are its target times the share of its curve's integral up to t; they
    are met by going through the source as often as needed. The last document
    of the last pass is taken in part, so the words taken are the target rounded
    down. ``position`` is the time at which demand reaches the middle of the take.

    Nulls: a null source is a source; a null size counts 0; a row without words is
    never taken. Rows that repeat a doc_id are documents of their own. An empty
    table gives an empty table. Only numbers are shuffled, no texts.
    """
    rows = materialize(
        sizes.withColumn("size", F.coalesce("size", F.lit(0)).cast("long")).withColumn(
            "_h", F.xxhash64(F.lit(seed), F.col("doc_id"))
        ),
        "mix-sizes",
    )
    curves = integrated(schedules).withColumnRenamed("source", "_curve")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    per_source = materialize(
        per_source.join(curves, same(F.col("source"), F.col("_curve")), "left").select(
            "source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"), "pieces"
        ),
        "mix-sources",
    )
    plan = fill_targets(per_source, share, cap).withColumnRenamed("source", "_source")
    placed = running_sum(rows, "source", "_h", ["doc_id", "size"], "size", "_before").join(
        plan, same(F.col("source"), F.col("_source")), "left"
    )
    takes = []
    for copy in range(math.ceil(cap)):
        start = F.col("_before") + F.lit(copy) * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - start)).cast("long")
        area = (start + words / 2) / F.col("target") * F.col("weight")
        takes.append(
            F.when(
                words > 0,
                F.struct(
                    F.lit(copy).alias("copy"), words.alias("words"), _position(area, F.col("pieces")).alias("position")
                ),
            )
        )
    return placed.withColumn("takes", F.array_compact(F.array(*takes))).drop(
        "_h", "_before", "_source", "weight", "pieces"
    )


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, seed: int = 11) -> DataFrame:
    """The curriculum over ``documents``, sources weighing 3, 1 and 2 in turn."""
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    schedules = repeating_schedules(docs.select("source").distinct(), [STEADY, GROWING, FADING])
    return curriculum(sizes, schedules, share, cap, seed)


def in_training_order(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as they are trained on: a row per take, range-sorted by position.

    A take of part of a document holds its first words,
    with single blanks between them. Columns are those of
    ``docs``; ``n_chars``, if there, follows the text. Rows that share doc_id and
    size get the takes of one of them.
    """
    taken = (
        mixed.filter(F.size("takes") > 0)
        .groupBy("doc_id", "size")
        .agg(F.min("takes").alias("_takes"))
        .withColumnsRenamed({"doc_id": "_id", "size": "_size"})
    )
    rows = (
        docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), n_words(F.col("text")).alias("_n"))
        .join(taken, same(F.col("_doc"), F.col("_id")) & (F.col("_n") == F.col("_size")))
        .select("_row", "_n", F.explode("_takes").alias("_take"))
    )
    words = F.regexp_extract_all("_row.text", F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, 1, F.col("_take.words").cast("int")), " ")
    text = F.when(F.col("_take.words") < F.col("_n"), part).otherwise(F.col("_row.text"))
    rows = rows.withColumn("_row", F.col("_row").withField("text", text))
    if "n_chars" in docs.columns:
        length = F.length("_row.text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("_row", F.col("_row").withField("n_chars", length))
    order = [F.col("_take.position"), F.col("_row.doc_id"), F.col("_take.copy")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_row.*")
