"""Joins of records with records, and of facts with lookups.

Only the rows of a top-k carry a broadcast hint, since k bounds them. Elsewhere Spark
broadcasts a side only below its size threshold, as estimated or as measured at run time,
and otherwise joins by sort-merge, where adaptive execution splits the partition of a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.functions.numbers import as_column
from sparktally.operators.aggregates import count_by, total_by


def join_records(
    left: DataFrame, right: DataFrame, on: str, columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on one key, reduced to ``columns``."""
    return left.join(right, on, how).select(*columns)


def total_by_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    by: Sequence[str],
    totals: Mapping[str, Column | str],
    how: str = "inner",
) -> DataFrame:
    """Totals of facts grouped by columns of a lookup table.

    Facts are added up per join key before the join. That leaves one row per key to join,
    so a hot key is gone before it meets the join, and the join itself needs no further
    shuffle of the facts. Sums of sums are sums, so the result is that of joining first.
    """
    per_key = total_by(facts, [on], totals)
    return total_by(per_key.join(lookup, on, how), by, {name: name for name in totals})


def count_by_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    by: Sequence[str],
    count: str = "count",
    how: str = "inner",
) -> DataFrame:
    """Count facts grouped by columns of a lookup table; counts per key before the join."""
    return total_by_lookup(facts, lookup, on, by, {count: F.lit(1)}, how)


def complete_few(few: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """The rows of a top-k with the columns of a lookup table that has one row per key.

    The k rows are broadcast, so the lookup table is scanned in place and not shuffled. The
    result has at most k rows again and can be completed from the next table.
    """
    return F.broadcast(few).join(lookup, on)


def count_with_names(
    facts: DataFrame, names: DataFrame, key: str, name: str, count: str = "count"
) -> DataFrame:
    """Facts per key with the name of the key, largest count first, then by key.

    A full outer join: a key without facts counts 0, a key without a name has a NULL name.
    Counting comes first, so the join sees one row per key. ``names`` has one row per key.
    """
    counts = count_by(facts, [key], count)
    joined = counts.join(names.select(key, name), key, "full_outer")
    return joined.select(key, name, F.coalesce(count, F.lit(0)).alias(count)).orderBy(
        F.desc(count), F.asc_nulls_first(key)
    )


def label_of(code: Column | str, labels: Mapping[int, str]) -> Column:
    """The label of a code from a fixed table; NULL for a code the table does not have."""
    pairs = chain.from_iterable((F.lit(key), F.lit(label)) for key, label in labels.items())
    return F.try_element_at(F.create_map(*pairs), as_column(code).cast("int"))


def with_label(rows: DataFrame, labels: DataFrame, code: str) -> DataFrame:
    """Rows with the columns of a label table; rows of an unknown code keep NULLs."""
    return rows.join(labels, code, "left")
