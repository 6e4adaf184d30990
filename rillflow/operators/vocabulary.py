"""A vocabulary that grows with the words of the texts it sees.

``vocab(word, id, vector)``, ``weights(id, vector)``, ``contenders(word, n)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.text import chosen_text, may_become_word, tokens
from rillflow.functions.vectors import seeded_vector
from rillflow.operators.joins import fits
from rillflow.operators.membership import MAX_SLOTS, flagged, member_filter, slots_for
from rillflow.operators.numbering import dense_ids
from rillflow.session import materialize

ADMIT_ABOVE = 10
BROADCAST_BYTES = 32 << 20  # of words and ids, as the checked sum of their lengths


def word_bytes() -> Column:
    """What a row of word and id takes in a broadcast table, about."""
    return F.octet_length("word") + 40


def kept_texts(texts: DataFrame, lang: str = "en") -> DataFrame:
    """The texts in one language, a repost replaced by its original: ``doc_id``, ``text``."""
    others = [c for c in texts.columns if c not in ("text", "lang", "retweet_text")]
    return texts.filter(F.col("lang") == lang).select(
        *others, chosen_text(F.col("text"), F.col("retweet_text")).alias("text")
    )


def text_tokens(texts: DataFrame) -> DataFrame:
    """``doc_id``, ``pos``, ``word`` and any further columns but the text."""
    others = [c for c in texts.columns if c != "text"]
    return texts.select(*others, F.posexplode(tokens(F.col("text"))).alias("pos", "word"))


def new_words_by_text(texts: DataFrame, vocab: DataFrame,
                      broadcast_bytes: int = BROADCAST_BYTES, max_slots: int = MAX_SLOTS) -> DataFrame:
    """The distinct words of each text that may enter the vocabulary: ``doc_id``, ``word``.

    Known words go before the shuffle if the vocabulary, its size checked, can be
    broadcast. Of a larger one a filter goes to the texts: what it rejects is
    surely new, and of the rest only the distinct words are joined to the
    vocabulary. The few it lets through though they are new are then picked from
    the texts, which are read a second time for that.
    """
    once = F.explode(F.array_distinct(tokens(F.col("text")))).alias("word")
    found = texts.select("doc_id", once).filter(may_become_word(F.col("word")))
    known = vocab.select("word")
    if fits(known, broadcast_bytes, word_bytes()):
        return found.join(F.broadcast(known), "word", "left_anti").select("doc_id", "word").distinct()
    slots = slots_for(known.count(), max_slots)
    bits = materialize(member_filter(known, "word", slots), "vocabulary-filter")
    told = flagged(found, "word", bits, slots)
    doubtful = told.filter("_maybe").select("doc_id", "word")
    strangers = materialize(doubtful.select("word").distinct().join(known, "word", "left_anti"), "let-through")
    new = told.filter("not _maybe").select("doc_id", "word")
    return new.unionByName(doubtful.join(strangers, "word", "left_semi")).distinct()


def new_words(texts: DataFrame, vocab: DataFrame, *keys: str) -> DataFrame:
    """The distinct words of all texts (per ``keys``) that may enter the vocabulary.

    Repetitions are gone before the vocabulary is consulted, so no word is hot.
    """
    seen = text_tokens(texts).filter(may_become_word(F.col("word"))).select(*keys, "word").distinct()
    return seen.join(vocab.select("word"), "word", "left_anti")


def count_contenders(contenders: DataFrame, words: DataFrame) -> DataFrame:
    """One more for every word of the batch, however often the batch has it."""
    counted = words.select("word").distinct().withColumn("n", F.lit(1).cast("bigint"))
    return (
        contenders.select("word", F.col("n").cast("bigint").alias("n"))
        .unionByName(counted)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def decay_contenders(contenders: DataFrame) -> DataFrame:
    """One less for every contender; those that reach 0 are dropped."""
    return contenders.select("word", (F.col("n") - 1).alias("n")).filter("n >= 1")


def live_count(decays: int) -> Column:
    """What is left of ``n``, counted when ``decays`` decays were done, after so many of them; 0 is gone."""
    return F.greatest(F.col("n") - (F.lit(decays) - F.col("decays")), F.lit(0)).cast("bigint")


def changed_contenders(seen: DataFrame, stored: DataFrame, decays: int) -> DataFrame:
    """The words of a batch (``seen``, distinct) with their counts: ``word, before, n``.

    ``stored(word, n, decays)`` need only have the rows of these words. It is not
    rewritten for a decay: each row says how many decays it has gone through.
    """
    found = stored.select("word", live_count(decays).alias("before"))
    before = F.coalesce("before", F.lit(0)).cast("bigint")
    return seen.select("word").join(found, "word", "left").select("word", before.alias("before"), (before + 1).alias("n"))


def admit(contenders: DataFrame, vocab_size: int, length: int,
          above: int = ADMIT_ABOVE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Contenders counted more than ``above`` times become words.

    Gives their vocabulary rows, their weight rows, and the other contenders. Ids
    go on from ``vocab_size`` in the order of the words.
    """
    ready = dense_ids(contenders.filter(F.col("n") > above).select("word"), ["word"], start=vocab_size)
    ready = ready.withColumn("id", F.col("id").cast("int"))
    vocab = ready.select("word", "id", seeded_vector(F.col("word"), length, "word").alias("vector"))
    weights = ready.select("id", seeded_vector(F.col("word"), length, "weight").alias("vector"))
    return vocab, weights, contenders.filter(F.col("n") <= above)
