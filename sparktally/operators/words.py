"""Word counts over text columns. A record is one row; texts are read whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.constants import LISTING_WORD_MIN_COUNT, WORD_MIN_COUNT, WORD_MIN_LENGTH
from sparktally.functions.text import words_of_description, words_of_markup, words_of_text
from sparktally.operators.aggregates import count_by


def count_words(
    records: DataFrame, words: Column, min_length: int = 1, min_count: int = 1
) -> DataFrame:
    """Occurrences of each word of at least ``min_length`` characters."""
    each = records.select(F.explode(words).alias("word")).filter(F.length("word") >= min_length)
    counts = count_by(each, ["word"])
    return counts.filter(F.col("count") >= min_count) if min_count > 1 else counts


def word_count(
    records: DataFrame,
    text: str = "value",
    min_length: int = WORD_MIN_LENGTH,
    min_count: int = WORD_MIN_COUNT,
) -> DataFrame:
    """Words between whitespace that are long and frequent enough."""
    return count_words(records, words_of_text(text), min_length, min_count)


def markup_word_count(records: DataFrame, text: str = "value") -> DataFrame:
    """All words of marked-up records. A tag must end in the record it begins in."""
    return count_words(records, words_of_markup(text))


def description_word_count(
    records: DataFrame, text: str = "description", min_count: int = LISTING_WORD_MIN_COUNT
) -> DataFrame:
    """Frequent lower-case ASCII words, most frequent first, then by word."""
    counts = count_words(records, words_of_description(text), min_count=min_count)
    return counts.orderBy(F.desc("count"), "word")
