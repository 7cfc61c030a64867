"""Grouped and global aggregates.

Every grouped aggregate combines on the map side first, so a key that holds a third of
all rows sends one partial row per task into the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.functions.numbers import as_column, truncated, whole_percent


def total_by(
    rows: DataFrame, keys: Sequence[str | Column], totals: Mapping[str, Column | str]
) -> DataFrame:
    """Sums per group, each under its name."""
    sums = (F.sum(as_column(value)).alias(name) for name, value in totals.items())
    return rows.groupBy(*keys).agg(*sums)


def count_by(rows: DataFrame, keys: Sequence[str | Column], count: str = "count") -> DataFrame:
    """The number of rows per group."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def distinct_and_totals_by(
    rows: DataFrame,
    keys: Sequence[str],
    item: str,
    distinct: str,
    totals: Mapping[str, Column | str],
) -> DataFrame:
    """Distinct ``item`` values and any number of sums per group.

    Totals are first added up per (group, item), so the rows of a large group spread over
    all tasks by item, and only one row per distinct item goes on to the group.
    """
    per_item = total_by(rows, [*keys, item], totals)
    return per_item.groupBy(*keys).agg(
        F.count(item).alias(distinct), *(F.sum(name).alias(name) for name in totals)
    )


def one_value_by(rows: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key: the smallest, so that the result does not depend on row order.

    Distinct pairs come first, by hash: the smallest of texts takes a sort, which then sees
    few rows. (Spark drops a distinct below ``min``, but not below ``min_by``.)
    """
    pairs = rows.select(key, value).distinct()
    return pairs.groupBy(key).agg(F.min_by(value, value).alias(value))


def key_values(rows: DataFrame, key: str, value: str, row_key: Sequence[str]) -> DataFrame:
    """All (key, value) pairs with duplicates, clustered by key.

    The unique ``row_key`` ends the sort key, so range partitioning can cut through the
    rows of one large key.
    """
    return rows.orderBy(key, *row_key).select(key, value)


def distinct_key_values(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The distinct (key, value) pairs."""
    return rows.select(key, value).distinct()


def most_frequent_by(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value per key; a tie goes to the lowest value.

    Counting per (key, value) first keeps what reaches a key at its distinct values. NULL
    values are not counted; a key with no other value keeps a NULL.
    """
    counts = rows.groupBy(key, value).agg(F.count(value).alias("n"))
    best = F.min_by(value, F.struct(-F.col("n"), F.col(value)))
    return counts.groupBy(key).agg(best.alias(value))


def mean_of(
    rows: DataFrame, value: Column | str, mean: str = "mean", truncate: bool = True
) -> DataFrame:
    """The mean over all rows, of whole parts unless ``truncate`` is off.

    Whole parts are added up as integers, so the result is exact however the rows are split.
    """
    number = truncated(value) if truncate else as_column(value)
    return rows.agg(F.try_divide(F.sum(number), F.count(number)).alias(mean))


def ratio_percent(
    rows: DataFrame,
    part: Column | str,
    whole: Column | str,
    ratio: str = "ratio_pct",
    truncate: bool = True,
) -> DataFrame:
    """The sum of ``part`` in whole percent of the sum of ``whole``, both of whole parts.

    NULL if there are no rows or the whole adds up to 0.
    """
    part, whole = as_column(part), as_column(whole)
    if truncate:
        part, whole = truncated(part), truncated(whole)
    return rows.agg(whole_percent(F.sum(part), F.sum(whole)).alias(ratio))


def share_by(rows: DataFrame, key: str, count: str = "count", share: str = "share_pct") -> DataFrame:
    """Rows per group and their share of all rows in percent.

    The grand total is a scalar subquery over the same counts: no window over all groups
    in one task, and the exchange of the counts is reused.
    """
    counts = count_by(rows, [key], count)
    everything = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.col(count) * F.lit(100.0) / everything)


def means_by(
    rows: DataFrame, key: str, columns: Sequence[str], digits: int | None = None
) -> DataFrame:
    """The mean of each column per group, rounded to ``digits`` decimals if given.

    Only rows with a number in every column count, so that all means are of the same rows.
    """

    def mean(name: str) -> Column:
        value = F.avg(name)
        return (value if digits is None else F.round(value, digits)).alias(name)

    whole = [F.col(c).isNotNull() & ~F.isnan(c) for c in columns]
    return rows.filter(reduce(and_, whole)).groupBy(key).agg(*map(mean, columns))
