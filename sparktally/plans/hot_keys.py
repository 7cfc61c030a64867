"""The row joins of the reports with their hot keys spread by ``join_hot_records``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparktally.operators.aggregates import key_values
from sparktally.operators.hot_keys import join_hot_records
from sparktally.operators.orders import sort_by_date
from sparktally.plans.oracles import ORACLES
from sparktally.plans.queries import in_currency
from sparktally.plans.tables import LINE_DIGITS, LINE_KEY, Tables, line_profit


def spread_join_customer_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their orders, of which one customer may have a third."""
    tables = Tables(spark, folder)
    placed = tables.orders().select("customer_id", "order_id", "priority")
    customers = tables.customers().select("customer_id", "customer_name")
    joined = join_hot_records(placed, customers, "customer_id", ["order_id"])
    return joined.select("customer_name", "order_id", "priority")


def spread_customer_profit_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The profit of each line by customer, where one order or product may have a third of the lines."""
    tables = Tables(spark, folder)
    placed = tables.orders().select("order_id", "customer_id")
    lines = join_hot_records(tables.lines(), placed, "order_id", LINE_KEY)
    lines = join_hot_records(lines, tables.products(), "product_id", LINE_KEY, counted=tables.lines())
    lines = lines.withColumn("profit", line_profit())
    return in_currency(key_values(lines, "customer_id", "profit", LINE_KEY), "profit", LINE_DIGITS)


def spread_sort_by_date(spark: SparkSession, folder: str) -> DataFrame:
    """Lines in order of the dates of their orders, where one order may have a third of the lines."""
    tables = Tables(spark, folder)
    dates = tables.orders().select("order_id", "customer_id", "order_date")
    return sort_by_date(join_hot_records(tables.lines(), dates, "order_id", LINE_KEY), LINE_KEY)


HOT_KEY_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "spread_join_customer_orders": spread_join_customer_orders,
    "spread_customer_profit_rows": spread_customer_profit_rows,
    "spread_sort_by_date": spread_sort_by_date,
}
HOT_KEY_ORACLES = {
    "spread_join_customer_orders": ORACLES["join_customer_orders"],
    "spread_customer_profit_rows": ORACLES["customer_profit_rows"],
    "spread_sort_by_date": ORACLES["sort_by_date_asc"],
}
