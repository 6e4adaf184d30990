"""Cleaning and splitting of short texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English words that never enter the vocabulary.
STOP_WORDS = (
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any", "are",
    "aren't", "as", "at", "be", "because", "been", "before", "being", "below", "between",
    "both", "but", "by", "can't", "cannot", "could", "couldn't", "did", "didn't", "do", "does",
    "doesn't", "doing", "don't", "down", "during", "each", "few", "for", "from", "further",
    "had", "hadn't", "has", "hasn't", "have", "haven't", "having", "he", "he'd", "he'll",
    "he's", "her", "here", "here's", "hers", "herself", "him", "himself", "his", "how", "how's",
    "i", "i'd", "i'll", "i'm", "i've", "if", "in", "into", "is", "isn't", "it", "it's", "its",
    "itself", "let's", "me", "more", "most", "mustn't", "my", "myself", "no", "nor", "not",
    "of", "off", "on", "once", "only", "or", "other", "ought", "our", "ours", "ourselves",
    "out", "over", "own", "same", "shan't", "she", "she'd", "she'll", "she's", "should",
    "shouldn't", "so", "some", "such", "than", "that", "that's", "the", "their", "theirs",
    "them", "themselves", "then", "there", "there's", "these", "they", "they'd", "they'll",
    "they're", "they've", "this", "those", "through", "to", "too", "under", "until", "up",
    "very", "was", "wasn't", "we", "we'd", "we'll", "we're", "we've", "were", "weren't", "what",
    "what's", "when", "when's", "where", "where's", "which", "while", "who", "who's", "whom",
    "why", "why's", "with", "won't", "would", "wouldn't", "you", "you'd", "you'll", "you're",
    "you've", "your", "yours", "yourself", "yourselves",
)

# Fixed value: every character outside this class is dropped, line breaks included.
DROPPED = "[^a-z`' \t]"


def purge(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), DROPPED, "")


def tokens(text: Column) -> Column:
    """The words of a text after the purge, in order, without empty ones."""
    return F.filter(F.split(purge(text), r"\s+"), lambda t: t != "")


def is_stop_word(word: Column) -> Column:
    return word.isin(*STOP_WORDS)


def contains_digit(word: Column) -> Column:
    return word.rlike("[0-9]")


def may_become_word(word: Column) -> Column:
    """Whether a token that is not in the vocabulary may be counted towards it."""
    return (word != "") & ~word.contains("http") & ~is_stop_word(word)


def chosen_text(text: Column, original: Column) -> Column:
    """The original of a repost where there is one, else the text itself."""
    return F.coalesce(original, text)
