"""Reports over order lines with typed ``sales``, ``quantity`` and ``profit``.

A value that was not a number is NULL in the input and counts as 0 in totals.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.constants import TOP_ROWS
from sparktally.functions.dates import parse_short_date, sortable_date
from sparktally.functions.numbers import truncated
from sparktally.operators.aggregates import distinct_and_totals_by, total_by
from sparktally.operators.ordering import sort_rows, top_k


def or_zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0))


def amount() -> Column:
    return or_zero("sales") * or_zero("quantity")


def profit_by(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    return total_by(lines, keys, {"profit": or_zero("profit")})


def sales_by(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    return total_by(lines, keys, {"sales_amount": amount()})


def order_products(lines: DataFrame, amounts: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct products, total quantity and sales amount of each order.

    ``amounts`` are the sums to build instead of that of sales times quantity.
    """
    totals = {
        "total_quantity": or_zero("quantity").cast("bigint"),
        **(amounts or {"sales_amount": amount()}),
    }
    return distinct_and_totals_by(lines, ["order_id"], "product_id", "distinct_products", totals)


def with_parsed_date(
    rows: DataFrame, text: str = "order_date", as_of: datetime.date | None = None
) -> DataFrame:
    """Rows whose date text is valid, with the date in its place."""
    parsed = rows.withColumn(text, parse_short_date(text, as_of))
    return parsed.filter(F.col(text).isNotNull())


def sort_by_date(
    rows: DataFrame,
    row_key: Sequence[str],
    descending: bool = False,
    date: str = "order_date",
    text: str = "sortable_date",
) -> DataFrame:
    """Whole rows in date order, with the date as sortable text as well."""
    return sort_rows(rows, date, row_key, descending).withColumn(text, sortable_date(date))


def top_profits(
    lines: DataFrame, row_key: Sequence[str], k: int = TOP_ROWS, rank: str | None = None
) -> DataFrame:
    """The ``k`` most profitable lines, whole; a line without a numeric profit is no candidate."""
    return top_k(lines.filter(F.col("profit").isNotNull()), "profit", row_key, k, rank)


def whole_profits(lines: DataFrame, *columns: str) -> DataFrame:
    """The customer of each line with the whole part of its profit.

    Truncation keeps order, so ranking by profit first ranks by its whole part as well.
    """
    return lines.select(*columns, "customer_id", truncated("profit").alias("profit"))
