"""Quality rules whose cutoffs are certified on labelled documents to spare good ones."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.text import in_chunks, texts_of
from rillflow.session import materialize

#: Levels of every rule; a document is rejected by a rule above the rule's cutoff.
LEVELS = 100

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per(part: str, whole: str, of: int) -> Column:
    """``of`` x part / whole, rounded up; 0 of nothing."""
    up = F.ceil(F.col(part) * of / F.greatest(F.col(whole), F.lit(1)))
    return F.least(up, F.lit(LEVELS)).cast("int")


def rules() -> dict[str, Column]:
    """Name to level of every rule, 0 to LEVELS, from the counts of a document; high is bad."""
    return {
        "symbols": _per("n_symbols", "n_words", 100),
        "repeats": _per("n_repeat_words", "n_words", 100),
        "dup_lines": _per("n_dup_lines", "n_lines", 100),
        "long_words": _per("word_chars", "n_words", 5),
        "short_words": F.lit(LEVELS) - _per("word_chars", "n_words", 5),
    }


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that stand in a window of ``width`` words found twice or more in a text.

    Windows are numbered by the numbers of two windows that overlap in all but one
    word, so equal numbers are equal words.
    """
    if len(words) <= width:
        return 0
    index: dict[bytes, int] = {}
    codes = np.fromiter((index.setdefault(word, len(index)) for word in words), np.int64, len(words))
    for _ in range(width - 1):
        pairs = codes[:-1] * (int(codes.max()) + 1) + codes[1:]
        _, codes, seen = np.unique(pairs, return_inverse=True, return_counts=True)
        if seen.max() == 1:
            return 0
    twice = seen[codes] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    covered[: len(twice)] += twice
    covered[width : width + len(twice)] -= twice
    return int((np.cumsum(covered[:-1]) > 0).sum())


def counts_of(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """The counts of a text and its lines with a word."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(b"".join(words).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "stratum", "hash", *COUNTS, "n_lines"]
    for batch in batches:
        texts = texts_of(batch)
        for start, end in in_chunks(texts):
            found = [counts_of(text) for text in texts[start:end]]
            part = batch.slice(start, end - start)
            columns = [pa.array(c, pa.int64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:3]), *columns], names)


def features(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id, stratum, hash``, the counts and ``n_lines`` of every document.

    ``stratum`` is ``=`` and the value, or ``-`` for null. ``hash`` is the text's.
    """
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("-")).alias("stratum"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
        F.col("text").cast("string").alias("text"),
    )
    longs = ", ".join(f"{c} long" for c in (*COUNTS, "n_lines"))
    return read.mapInArrow(_counted, f"doc_id long, stratum string, hash long, {longs}")


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def log_mass(n: int, p: float, x: int) -> float:
    """The logarithm of the binomial probability of x out of n."""
    ways = math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1)
    return ways + x * math.log(p) + (n - x) * math.log1p(-p)


def lower_tail(n: int, p: float, x: int) -> float:
    """The probability of x or fewer out of n, each with probability p in (0, 1)."""
    if x >= n:
        return 1.0
    if x < 0:
        return 0.0
    if x > n * p:  # the shorter sum is that of the other side
        return 1.0 - lower_tail(n, 1 - p, n - x - 1)
    total, term, at = 0.0, 1.0, x
    while at >= 0 and term > 1e-17 * total:
        total += term
        term *= at / (n - at + 1) * (1 - p) / p
        at -= 1
    return min(1.0, math.exp(log_mass(n, p, x) + math.log(total)))


def most_rejected(n: int, alpha: float, delta: float) -> int:
    """The largest count of rejections out of n that rules out a risk above ``alpha``; -1 if none does.

    ``x`` out of n rules it out if a risk of ``alpha`` gives x or fewer with
    probability ``delta`` at most: the exact binomial test.
    """
    low, high = -1, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if lower_tail(n, alpha, middle) <= delta else (low, middle)
    return low


def upper_bound(n: int, x: int, delta: float) -> float:
    """The exact upper confidence bound of a risk seen x times out of n."""
    if x >= n:
        return 1.0
    low, high = x / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if lower_tail(n, middle, x) > delta else (low, middle)
    return high


PLAN = "stratum string, targets array<int>, offsets array<int>"


def _planned(names: list[str], alpha: float):
    """Of one stratum's counts per rule, level and quality: the strictest cutoff worth trying, and when.

    A cutoff gains the share of bad documents above it, less the share of good
    ones divided by ``alpha``. The best one of each rule is its target (the most
    lenient among equals); rules without gain are off, with target LEVELS. Rules
    follow one another by gain; ``offsets`` says at which step a rule begins.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        targets, gains = [], []
        for rule in range(len(names)):
            own = group[group["rule"] == rule]
            above = []
            for quality in (0, 1):
                some = own[own["quality"] == quality]
                counts = np.bincount(some["level"], weights=some["rows"], minlength=LEVELS + 1)
                higher = counts[::-1].cumsum()[::-1][1:]  # documents above each cutoff
                above.append(higher / max(counts.sum(), 1))
            gain = above[0] - above[1] / alpha
            best = LEVELS - 1 - int(np.argmax(gain[::-1]))
            targets.append(best if gain[best] > 0 else LEVELS)
            gains.append(max(gain[best], 0))
        offsets, at = [0] * len(names), 0
        for rule in sorted(range(len(names)), key=lambda r: -gains[r]):
            offsets[rule] = at
            at += LEVELS - targets[rule]
        return pd.DataFrame({"stratum": [group["stratum"].iloc[0]], "targets": [targets], "offsets": [offsets]})

    return run


def first_step(levels: list[str]) -> Column:
    """The step at which a document is rejected first: the least over its rules, null for never.

    Within a rule the cutoff falls by one a step, from LEVELS - 1 to the rule's target.
    """
    steps = [
        F.when(
            F.col(level) > F.element_at("targets", rule + 1),
            F.element_at("offsets", rule + 1) + F.lit(LEVELS) - F.col(level),
        )
        for rule, level in enumerate(levels)
    ]
    return F.least(*steps)


CERTIFIED = "stratum string, good long, rejected long, last_step int, bound double"


def _certified(alpha: float, delta: float):
    """Of one stratum's good held-out documents by step: the last step that is certified.

    Steps are tried from the most lenient on, up to the first that fails. What is
    rejected only grows, so that is the last step with few enough rejections.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        total = int(group["rows"].sum())
        most = most_rejected(total, alpha, delta)
        last, rejected = -1, 0
        if most >= 0:
            stepped = group.dropna(subset=["step"]).sort_values("step")
            before = stepped["rows"].cumsum().to_numpy()
            fails = np.flatnonzero(before > most)
            last = int(stepped["step"].iloc[fails[0]]) - 1 if len(fails) else 1 << 30
            rejected = int(stepped["rows"].to_numpy()[stepped["step"].to_numpy() <= last].sum())
        return pd.DataFrame(
            {
                "stratum": [group["stratum"].iloc[0]],
                "good": [total],
                "rejected": [rejected],
                "last_step": [last],
                "bound": [upper_bound(total, rejected, delta) if last >= 0 else 1.0],
            }
        )

    return run


def certified_cutoffs(counted: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Per stratum ``targets, offsets, good, rejected, last_step, bound``.

    ``counted`` is of :func:`features`, ``labels`` has doc_id and quality (1 good, 0
    bad, null unknown). Every different labelled text of a stratum counts once per
    quality, and only if the base rules keep it: copies are no further evidence.
    Half of them, by their hash, plan a path of ever stricter joint cutoffs. The
    good ones of the other half certify it: with probability 1 - ``delta`` no
    stratum loses more than ``alpha`` of its good documents, ``delta`` being
    shared by the strata (Bonferroni) while the steps of a path, tried in order up
    to the first failure, need no share of their own. ``bound`` is the exact upper
    bound of the stratum's risk. Strata with too few labels have ``last_step`` -1.
    """
    names = rules()
    labelled = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality"))
    labelled = labelled.filter("quality in (0, 1)").distinct()
    rows = counted.filter(~base_failed()).join(labelled, F.col("doc_id") == F.col("_id"))
    levels = [f"level_{rule}" for rule in range(len(names))]
    rows = rows.select(
        "stratum", "hash", "quality", *(c.alias(level) for level, c in zip(levels, names.values()))
    ).distinct()
    rows = materialize(rows.withColumn("fit", F.pmod(F.xxhash64("hash", F.lit(13)), F.lit(2)) == 0), "risk-labelled")
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(c).alias("level")) for r, c in enumerate(levels))))
    seen = rows.filter("fit").select("stratum", "quality", each.alias("one")).groupBy(
        "stratum", "quality", F.col("one.rule").alias("rule"), F.col("one.level").alias("level")
    )
    plan = seen.agg(F.count(F.lit(1)).alias("rows")).groupBy("stratum").applyInPandas(_planned(list(names), alpha), PLAN)
    plan = materialize(plan, "risk-plan")
    held = rows.filter("not fit and quality = 1").join(plan, "stratum").withColumn("step", first_step(levels))
    steps = materialize(held.groupBy("stratum", "step").agg(F.count(F.lit(1)).alias("rows")), "risk-steps")
    strata = max(1, steps.select("stratum").distinct().count())
    certified = steps.groupBy("stratum").applyInPandas(_certified(alpha, delta / strata), CERTIFIED)
    return plan.join(certified, "stratum")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``rejected_by`` of every document.

    ``docs`` has doc_id, text and the stratum's column, ``labels`` doc_id and quality;
    other columns are ignored. Words are ``[^\\x20\\x09-\\x0D]+``, with case. A document
    is kept unless the base rules or its stratum's certified cutoffs
    (:func:`certified_cutoffs`) reject it; ``rejected_by`` is ``base``, the rule that
    rejects it first on the stratum's path, or null. Strata without certified
    cutoffs, and without labels, lose nothing but what the base rules reject. A null
    text has no words; a null stratum is one of its own; rows that repeat are
    judged alike. Rows without doc_id have no label. Empty tables give empty
    tables; with no labels only the base rules hold.
    """
    counted = materialize(features(docs, stratum), "risk-features")
    cutoffs = certified_cutoffs(counted, labels, alpha, delta).withColumnRenamed("stratum", "_of")
    cutoffs = materialize(cutoffs.filter("last_step >= 0"), "risk-cutoffs")
    names = rules()
    levels = [f"level_{rule}" for rule in range(len(names))]
    joined = counted.withColumns(dict(zip(levels, names.values()))).join(cutoffs, F.col("stratum") == F.col("_of"), "left")
    step = first_step(levels)
    rejecting = [
        F.when(
            (F.col("step") >= F.element_at("offsets", r + 1))
            & (F.col("step") < F.element_at("offsets", r + 1) + F.lit(LEVELS) - F.element_at("targets", r + 1)),
            name,
        )
        for r, name in enumerate(names)
    ]
    judged = joined.withColumn("step", step).withColumn("base_failed", base_failed())
    rejected = F.coalesce(F.col("step") <= F.col("last_step"), F.lit(False))
    by = F.when(F.col("base_failed"), "base").when(rejected, F.coalesce(*rejecting))
    return judged.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"), by.alias("rejected_by"))
