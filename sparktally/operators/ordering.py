"""Total sorts and exact top-k."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktally.constants import TOP_ROWS
from sparktally.functions.numbers import as_column
from sparktally.sources.folders import work_folder


def sort_rows(
    rows: DataFrame, by: Column | str, row_key: Sequence[str], descending: bool = False
) -> DataFrame:
    """All rows in total order.

    Spark samples the sort key and range-partitions on it. The unique ``row_key`` makes
    the order deterministic and lets the ranges cut through the rows of a frequent value.
    """
    return rows.orderBy(_direction(by, descending), *row_key)


def top_k(
    rows: DataFrame,
    by: Column | str,
    row_key: Sequence[str],
    k: int = TOP_ROWS,
    rank: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """The ``k`` rows with the largest value, in order; ties go by ascending ``row_key``.

    Each task keeps ``k`` rows, so nothing is sorted or shuffled whole. With ``rank`` the
    position is added as a column, over the ``k`` rows that are left. A ``k`` below 1 is
    taken as 1, with a warning.
    """
    if k < 1:
        warnings.warn(f"k is taken as 1, since {k} is too low", stacklevel=2)
        k = 1
    order = [_direction(by, descending), *row_key]
    first = rows.orderBy(*order).limit(k)
    if rank is None:
        return first
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def bottom_k(
    rows: DataFrame,
    by: Column | str,
    row_key: Sequence[str],
    k: int = TOP_ROWS,
    rank: str | None = None,
) -> DataFrame:
    """The ``k`` rows with the smallest value, in order."""
    return top_k(rows, by, row_key, k, rank, descending=False)


# How much more than its share the histogram of a large k lets through.
SLACK = 0.002
HISTOGRAM = 10_000


def top_k_of_any_size(
    rows: DataFrame,
    by: Column | str,
    row_key: Sequence[str],
    k: int,
    rank: str = "rank",
    descending: bool = True,
) -> DataFrame:
    """The ``k`` first rows with their ``rank``, for a ``k`` that no single task could hold.

    A histogram of the values, merged from all tasks, gives a threshold that about k rows pass;
    those are dealt by range, sorted and stored, and the rows of earlier partitions make up the
    rank. The histogram only saves work: if too few rows pass, all go on. Rows without a value are
    no candidates. ``rows`` is read up to four times.
    """
    spark = rows.sparkSession
    value = as_column(by).cast("double")
    rows = rows.filter(as_column(by).isNotNull())
    known = rows.count()
    share = k / max(known, 1) + SLACK
    near = rows
    if share < 1:
        at = 1 - share if descending else share
        cut = rows.agg(F.percentile_approx(value, at, HISTOGRAM)).first()[0]
        # Rounding to double keeps the order, so k rows at or beyond the threshold hold the first k.
        near = rows.filter(value >= cut if descending else value <= cut)
        near = near if near.count() >= k else rows
    order = [_direction(by, descending), *row_key]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = near.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    path = work_folder(spark, "top")
    laid.withColumn("_laid", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("_part", F.shiftrightunsigned("_laid", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per shuffle partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_laid").bitwiseAND((1 << 33) - 1)
    ranked = placed.join(F.broadcast(starts), "_part").withColumn(rank, F.col("_start") + inside + 1)
    return ranked.filter(F.col(rank) <= k).drop("_part", "_laid", "_start")


def _direction(by: Column | str, descending: bool) -> Column:
    column = as_column(by)
    return column.desc() if descending else column.asc()
