"""A training corpus from documents: five stages, each an operator of ``rillflow.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import boilerplate, curriculum, jaccard, language, packing
from rillflow.llm.queries import documents, tokenizer_path
from rillflow.session import materialize

#: Stretches of text whose ids a task of the last stage remembers; its workers have worked for all stages.
CACHE = 150_000

#: Rows of a batch that goes to Python. Whole texts, and pairs of sets, make ten times as many a burden
#: on the executor beside its heap.
BATCH_ROWS = 1000

#: A text this long (bytes) that falls into phrases shorter than this is in no language learned.
LONG_ENOUGH, SHORTEST_PHRASE = 40, 1.6


def _prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter that the learned languages can spell.

    Null texts, texts without a letter and longer texts that fall into nearly
    single bytes (another script) go. Rows without doc_id are judged by their text
    as the others are; a null lang is not learned from.
    """
    _prepare(spark)
    samples = language.sample_texts(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    judged = language.identify(docs, samples)
    strange = (F.octet_length("row.text") >= LONG_ENOUGH) & (F.col("found.phrase_bytes") < SHORTEST_PHRASE)
    return judged.filter((F.col("found.lang_pred") != "und") & ~strange).select("row.*")


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand on too many different documents of their source."""
    cleaned = boilerplate.drop_boilerplate(docs, copies_once=True)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id (null last).

    Rows are told apart by doc_id and text, both of which may repeat or be null:
    different texts under one doc_id are different documents, and of rows equal in
    both one stays, the least by all columns.
    """
    _prepare(spark)
    key = F.xxhash64("doc_id", "text")
    keyed = docs.select(key.alias("doc_id"), "text")
    found = jaccard.near_duplicates(keyed).groupBy("doc_id", "component_id").agg(F.count(F.lit(1)).alias("rows"))
    ids = docs.select(F.col("doc_id").alias("id"), key.alias("_key")).distinct()
    first = F.min_by(F.struct("doc_id", "rows"), F.struct(F.col("id").isNull(), "id", "doc_id"))
    best = found.join(ids, F.col("doc_id") == F.col("_key")).groupBy("component_id").agg(first.alias("first"))
    best = best.groupBy(F.col("first.doc_id").alias("_kept")).agg(F.sum("first.rows").alias("_rows"))
    best = materialize(best, "pipeline-kept")
    joined = docs.select(F.struct("*").alias("_row"), key.alias("_key")).join(best, F.col("_key") == F.col("_kept"))
    result = joined.filter("_rows = 1").select("_row.*")
    if not best.filter("_rows > 1").isEmpty():
        other = F.xxhash64(F.lit(1), "_row.doc_id", "_row.text")  # texts that differ under one key all stay
        several = joined.filter("_rows > 1").groupBy("_key", other).agg(F.min("_row").alias("_row"))
        result = result.unionByName(several.select("_row.*"))
    return result


def in_training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the curriculum takes them, repeated ones repeated, in the order of training."""
    return curriculum.in_training_order(docs, curriculum.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 ids."""
    _prepare(spark)
    return packing.pack(docs, tokenizer_path(), cache=CACHE).drop("doc_row")


STAGES = [
    ("language", known_language),
    ("lines", without_boilerplate),
    ("near_duplicates", without_near_duplicates),
    ("mixing", in_training_order),
    ("packing", packed),
]

#: Suffix automata, hash order and packing have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before has written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
