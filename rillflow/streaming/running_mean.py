"""Means per word on an endless stream of ``word,number`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillflow.session import materialize, scratch_scope
from rillflow.sources.keyed import create_table, read_table, upsert, version_for
from rillflow.sources.paths import read_text

MEAN_SCHEMA = "word string, count float"
STATE_SCHEMA = "word string, total double, n bigint"
TRIGGER = "1 second"


def _trigger(seconds: str | None) -> dict:
    return {"availableNow": True} if seconds is None else {"processingTime": seconds}


def writer_of(spark, checkpoint: str) -> str:
    """The id of the query that the checkpoint belongs to; a new checkpoint has a new one."""
    return " ".join((read_text(spark, f"{checkpoint}/metadata") or "").split())


def good_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with a number. The progress of the query reports how many had none."""
    return pairs.observe(
        "pairs", F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("n_bad")
    ).filter(F.col("value").isNotNull())


def running_mean(pairs: DataFrame) -> DataFrame:
    """The mean of each word so far. Every task sums up its rows before the shuffle."""
    return good_pairs(pairs).groupBy("word").agg(F.avg("value").cast("float").alias("count"))


def write_running_mean(pairs: DataFrame, table: str, checkpoint: str,
                       every: str | None = TRIGGER) -> StreamingQuery:
    """Keep the keyed table ``(word, count)`` up to date; ``every=None`` stops at the end of input."""
    spark = pairs.sparkSession
    create_table(spark, table, MEAN_SCHEMA)

    def write(changed: DataFrame, batch: int) -> None:
        upsert(changed, table, ["word"], batch, writer=writer_of(spark, checkpoint))

    return (
        running_mean(pairs).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .foreachBatch(write)
        .start()
    )


def read_running_mean(spark, table: str) -> DataFrame:
    return read_table(spark, table, ["word"])


def mean_trace(rows: DataFrame, state: DataFrame, order: str, width: int = 100_000) -> DataFrame:
    """Each row with the mean of its word up to and including it.

    ``state(word, total, n)`` holds what came before. Rows are cut into stretches
    of about ``width`` rows each, by a range sort of the order column, whatever its
    values; a stretch starts from the totals of those before it, so even a word
    with most of the rows is spread over many tasks, and a word has a row per
    stretch at most where those are added up. The cut rows are written once, so
    that both passes see the same stretches. Rows equal in the order column are
    taken in any order among themselves.
    """
    stretches = max(1, -(-rows.count() // width))
    cut = materialize(
        rows.repartitionByRange(stretches, order).withColumn("_stretch", F.spark_partition_id()), "stretches"
    )
    sums = cut.groupBy("word", "_stretch").agg(F.sum("value").alias("s"), F.count("value").alias("c"))
    before = Window.partitionBy("word").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.join(state, "word", "left").select(
        "word", "_stretch",
        (F.coalesce("total", F.lit(0.0)) + F.coalesce(F.sum("s").over(before), F.lit(0.0))).alias("_total"),
        (F.coalesce("n", F.lit(0)) + F.coalesce(F.sum("c").over(before), F.lit(0))).alias("_n"),
    )
    within = Window.partitionBy("word", "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.col("_total") + F.sum("value").over(within)
    n = F.col("_n") + F.count("value").over(within)
    return cut.join(start, ["word", "_stretch"]).select(*rows.columns, (total / n).alias("mean"))


def write_mean_trace(pairs: DataFrame, order: str, out: str, checkpoint: str,
                     every: str | None = TRIGGER, width: int = 100_000) -> StreamingQuery:
    """One result row per input row, in ``out/trace``; the state per word is a keyed table.

    A batch reads the state before it and writes only folders of its own version of
    the state, so a replayed batch takes effect once and a new checkpoint goes on
    from the state. Its rows are read once.
    """
    spark = pairs.sparkSession
    create_table(spark, f"{out}/state", STATE_SCHEMA)

    def write(batch_rows: DataFrame, batch: int) -> None:
        session, writer = batch_rows.sparkSession, writer_of(spark, checkpoint)
        version = version_for(session, f"{out}/state", writer, batch)
        state = read_table(session, f"{out}/state", ["word"], before=version)
        kept = batch_rows.persist()
        try:
            with scratch_scope(session):
                trace = mean_trace(kept, state, order, width)
                trace.write.mode("overwrite").parquet(f"{out}/trace/batch={version}")
            added = kept.groupBy("word").agg(F.sum("value").alias("total"), F.count("value").alias("n"))
            touched = state.join(added.select("word"), "word", "left_semi")
            total = touched.unionByName(added).groupBy("word").agg(
                F.sum("total").alias("total"), F.sum("n").alias("n")
            )
            upsert(total, f"{out}/state", ["word"], batch, writer=writer)
        finally:
            kept.unpersist()

    return (
        good_pairs(pairs).writeStream.option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .foreachBatch(write)
        .start()
    )


def read_mean_trace(spark, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/trace").drop("batch")
