"""Training word vectors on a stream of short texts, batch by batch.

The state lies in ``vocab`` and ``weights``, one folder per version that changed it,
in the keyed tables ``contenders`` and ``metrics`` and in the file ``done``, which names
the last finished version and is written last. A batch sets the contenders it has
seen and no others: a decay is a number in the metrics, which a contender's count is
reduced by when it is read. Versions are the state's own: a
batch gets the last finished one plus one, whatever its number in the stream, so a
new checkpoint goes on from the state that is there. The file ``marker`` names the
stream and batch of the version under way; a batch that is replayed finds itself
there, starts from the state before it and writes the same folders again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillflow.operators.embedding import train_step
from rillflow.operators.vocabulary import (
    ADMIT_ABOVE, admit, changed_contenders, kept_texts, live_count, new_words,
)
from rillflow.session import materialize, scratch_scope
from rillflow.sources.keyed import create_table, lookup, read_table, upsert, version_for
from rillflow.sources.paths import delete, last_finished, numbers, read_text, write_text
from rillflow.streaming.running_mean import writer_of

SCHEMAS = {
    "vocab": "word string, id int, vector array<double>",
    "weights": "id int, vector array<double>",
}
#: ``decays``: how many there had been when ``n`` was set. An admitted word has n = 0.
CONTENDERS_SCHEMA = "word string, n bigint, decays bigint"
METRICS_SCHEMA = "batch bigint, n_words bigint, n_contenders bigint, n_texts bigint, n_decays bigint"


@dataclass(frozen=True)
class Settings:
    """Counts are in batches of ``every``: with ten seconds, a snapshot each five minutes.

    ``keep_versions`` and ``keep_snapshots`` are how many of the newest stay.
    """

    length: int = 16
    context: int = 2
    rate: float = 0.05
    lang: str = "en"
    admit_above: int = ADMIT_ABOVE
    decay_every: int = 60
    snapshot_every: int = 30
    every: str | None = "10 seconds"
    keep_versions: int = 3
    keep_snapshots: int = 2


def last_version(spark: SparkSession, state: str) -> int | None:
    """The last finished version, -1 before any batch, None where there is no state."""
    done = read_text(spark, f"{state}/done")
    return None if done is None else int(done)


def create_state(spark: SparkSession, state: str, snapshots: str | None = None) -> None:
    """Start a state, from the newest snapshot if there is one. One that is there stays."""
    if last_version(spark, state) is not None:
        return
    create_table(spark, f"{state}/metrics", METRICS_SCHEMA)
    create_table(spark, f"{state}/contenders", CONTENDERS_SCHEMA)
    if snapshots and last_finished(spark, f"{snapshots}/w", "batch") is not None:
        for name, df in load_snapshot(spark, snapshots).items():
            df.write.mode("overwrite").parquet(f"{state}/{name}/batch=-1")
    write_text(spark, f"{state}/done", "-1")


def load_state(spark: SparkSession, state: str, before: int | None = None) -> dict[str, DataFrame]:
    """The tables after the last finished version, or before it if that is ``before`` (a replay).

    A table that no version has written is empty; a state that was never created is an error.
    """
    done = last_version(spark, state)
    if done is None:
        raise FileNotFoundError(f"no training state at {state}")
    if before is not None:
        done = min(done, before - 1)
    _, decays = _counts_after(spark, state, done)
    stored = read_table(spark, f"{state}/contenders", ["word"], before=_contenders_before(spark, state, done + 1))
    live = stored.select("word", live_count(decays).alias("n")).filter("n > 0")
    tables = {}
    for name, schema in SCHEMAS.items():
        version = last_finished(spark, f"{state}/{name}", "batch", before=done + 1)
        if version is not None:
            tables[name] = spark.read.schema(schema).parquet(f"{state}/{name}/batch={version}")
        else:
            tables[name] = spark.createDataFrame([], schema)
    return tables | {"contenders": live}


def _counts_after(spark: SparkSession, state: str, version: int) -> tuple[int, int]:
    """How many contenders there are after a version, and how many decays there were."""
    row = read_table(spark, f"{state}/metrics", ["batch"]).filter(F.col("batch") == version).first()
    return (row.n_contenders, row.n_decays) if row else (0, 0)


def _contenders_before(spark: SparkSession, state: str, version: int) -> int:
    """The version of the contenders that ``version``, the newest or the one to come, sets."""
    return version_for(spark, f"{state}/contenders", "", version)


def save_snapshot(tables: dict[str, DataFrame], path: str, number: int, keep: int = 2) -> None:
    """Vocabulary and weights as ``words`` and ``w``; the newest ``keep`` snapshots stay."""
    spark = tables["vocab"].sparkSession
    tables["vocab"].write.mode("overwrite").parquet(f"{path}/words/batch={number}")
    tables["weights"].write.mode("overwrite").parquet(f"{path}/w/batch={number}")
    for kind in ("w", "words"):
        _prune(spark, f"{path}/{kind}", number, keep)


def load_snapshot(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The newest complete snapshot; empty tables without one."""
    newest = last_finished(spark, f"{path}/w", "batch")  # written after the words
    if newest is None:
        return {name: spark.createDataFrame([], SCHEMAS[name]) for name in ("vocab", "weights")}
    return {
        "vocab": spark.read.schema(SCHEMAS["vocab"]).parquet(f"{path}/words/batch={newest}"),
        "weights": spark.read.schema(SCHEMAS["weights"]).parquet(f"{path}/w/batch={newest}"),
    }


def _claimed(spark: SparkSession, state: str, writer: str, batch: int) -> int:
    """The version of a batch: the one it has claimed before if it is a replay, else a new one."""
    claim = f"{writer} {batch}"
    number, _, owner = (read_text(spark, f"{state}/marker") or "").partition(" ")
    if owner == claim:
        return int(number)
    version = last_version(spark, state) + 1
    write_text(spark, f"{state}/marker", f"{version} {claim}")
    return version


def process_batch(texts: DataFrame, batch: int, state: str, settings: Settings,
                  snapshots: str | None = None, writer: str = "") -> None:
    """Train on one batch with the words known before it, then count and admit its new words."""
    spark = texts.sparkSession
    with scratch_scope(spark):
        version = _claimed(spark, state, writer, batch)
        tables = load_state(spark, state, before=version)
        kept = kept_texts(texts, settings.lang).persist()
        try:
            _process(kept, version, tables, state, settings, snapshots)
        finally:
            kept.unpersist()


def _process(kept: DataFrame, version: int, tables: dict[str, DataFrame], state: str,
             settings: Settings, snapshots: str | None) -> None:
    spark = kept.sparkSession
    n_texts = kept.count()
    n_words = tables["weights"].count()

    def save(name: str, df: DataFrame) -> DataFrame:
        path = f"{state}/{name}/batch={version}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(SCHEMAS[name]).parquet(path)

    vocab, weights = tables["vocab"], tables["weights"]
    n_contenders, decays = _counts_after(spark, state, version - 1)
    table, changed = f"{state}/contenders", False
    decayed = decays + bool(version and version % settings.decay_every == 0)
    if n_texts:
        seen = materialize(new_words(kept, vocab), "seen")
        stored = lookup(spark, table, ["word"], seen, before=_contenders_before(spark, state, version))
        counted = materialize(changed_contenders(seen, stored, decays), "contenders")
        if n_words:
            vocab, weights = train_step(
                kept, vocab, weights, settings.rate, settings.context, settings.length,
                n_texts=n_texts, n_words=n_words,
            )
            changed = True
        ready = F.col("n") > settings.admit_above
        n_ready, n_new, n_known = counted.agg(
            F.count_if(ready), F.count_if(~ready & (F.col("before") == 0)), F.count_if(ready & (F.col("before") > 0))
        ).first()
        n_contenders += n_new - n_known
        if n_ready:
            more, more_weights, _ = admit(counted.select("word", "n"), n_words, settings.length, settings.admit_above)
            vocab = vocab.unionByName(more.select(*vocab.columns))
            weights = weights.unionByName(more_weights)
            n_words += n_ready
            changed = True
        now = counted.select("word", F.when(ready, 0).otherwise(F.col("n")).cast("bigint").alias("n"),
                             F.lit(decays).cast("bigint").alias("decays"))
        upsert(now, table, ["word"], version, alive=live_count(decayed) > 0)
    if decayed > decays:
        newest = read_table(spark, table, ["word"])
        n_contenders = newest.filter(live_count(decayed) > 0).count()
    if changed:
        vocab, weights = save("vocab", vocab), save("weights", weights)
    if snapshots and version and version % settings.snapshot_every == 0:
        save_snapshot({"vocab": vocab, "weights": weights}, snapshots, version, settings.keep_snapshots)
    counts = spark.createDataFrame([(version, n_words, n_contenders, n_texts, decayed)], METRICS_SCHEMA)
    upsert(counts.coalesce(1), f"{state}/metrics", ["batch"], version)
    write_text(spark, f"{state}/done", str(version))
    for name in SCHEMAS:
        _prune(spark, f"{state}/{name}", version, settings.keep_versions)


def _prune(spark: SparkSession, path: str, newest: int, keep: int) -> None:
    """Drop all but the newest versions. No later batch starts before the last finished one."""
    for old in [n for n in numbers(spark, path, "batch") if n <= newest][:-keep]:
        delete(spark, f"{path}/batch={old}")


def train_stream(texts: DataFrame, state: str, checkpoint: str, settings: Settings = Settings(),
                 snapshots: str | None = None) -> StreamingQuery:
    """Train on a stream of ``(doc_id, text, lang, retweet_text)``.

    A new state starts from the newest snapshot, if there is one.
    """
    spark = texts.sparkSession
    create_state(spark, state, snapshots)
    trigger = {"availableNow": True} if settings.every is None else {"processingTime": settings.every}

    def run(batch_texts: DataFrame, batch: int) -> None:
        process_batch(batch_texts, batch, state, settings, snapshots, writer_of(spark, checkpoint))

    return (
        texts.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(run)
        .start()
    )


def read_metrics(spark: SparkSession, state: str) -> DataFrame:
    """One row per version: words known, contenders, texts kept."""
    return read_table(spark, f"{state}/metrics", ["batch"]).drop("n_decays")
