"""Word splitting and cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktally.constants import (
    DIGITS,
    MARKUP_OR_SPACE,
    NON_BREAKING_SPACE,
    NON_LETTERS,
    PUNCTUATION,
    WHITESPACE,
)
from sparktally.functions.numbers import as_column


def split_words(value: Column | str) -> Column:
    """The pieces of a text between runs of whitespace."""
    return F.split(as_column(value), WHITESPACE)


def split_markup(value: Column | str) -> Column:
    """The pieces of a text between tags or whitespace; the tags themselves are dropped."""
    return F.split(as_column(value), MARKUP_OR_SPACE)


def spaces_for_nbsp(value: Column | str) -> Column:
    return F.replace(as_column(value), F.lit(NON_BREAKING_SPACE), F.lit(" "))


def without_punctuation(value: Column | str) -> Column:
    """The text without punctuation marks and digits."""
    return F.regexp_replace(as_column(value), f"[{PUNCTUATION}{DIGITS}]", "")


def words_of_text(value: Column | str) -> Column:
    return split_words(value)


def words_of_markup(value: Column | str) -> Column:
    """Words of a marked-up record: punctuation goes before the tags do, case is kept."""
    return split_markup(without_punctuation(spaces_for_nbsp(value)))


def words_of_description(value: Column | str) -> Column:
    """Lower-case ASCII words of free text: whatever else lies between them splits."""
    return F.split(F.lower(as_column(value)), NON_LETTERS)
