"""The SQL form of the grouping and join reports, for users who work in SQL.

Each runs over DataFrames passed as arguments, so no view has to be registered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Lines are totalled per order before they meet it: an order with very many lines then joins
# as one row. Grouping by all selected columns cannot name a column that is not shown.
SALES_BY_DATE_AND = """
SELECT order_date, {key}, sum(amount) AS sales_amount
FROM (SELECT order_id{line_key}, sum(sales * quantity) AS amount FROM {{lines}} GROUP BY ALL)
JOIN {{orders}} USING (order_id)
GROUP BY ALL
"""

ORDER_PRODUCTS = """
SELECT order_id, count(DISTINCT product_id) AS distinct_products,
       sum(sales * quantity) AS sales_amount
FROM {lines}
GROUP BY ALL
"""

JOIN_CUSTOMER_ORDERS = """
SELECT customer_name AS name, comment
FROM {customers} JOIN {orders} USING (customer_id)
"""

# Orders are totalled before the join: the customer's name depends on the key, and a
# customer with very many orders then joins as one row.
CUSTOMER_ORDER_TOTAL = """
SELECT customer_id, customer_name AS name, total
FROM (SELECT customer_id, sum(total_price) AS total FROM {orders} GROUP BY ALL)
JOIN {customers} USING (customer_id)
"""


def sales_by_date_and(lines: DataFrame, orders: DataFrame, key: str) -> DataFrame:
    """Sales amount by date and a column of the orders (such as state) or lines (category)."""
    line_key = f", {key}" if key in lines.columns else ""
    text = SALES_BY_DATE_AND.format(key=key, line_key=line_key)
    return lines.sparkSession.sql(text, lines=lines, orders=orders)


def order_products(lines: DataFrame) -> DataFrame:
    return lines.sparkSession.sql(ORDER_PRODUCTS, lines=lines)


def join_customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return orders.sparkSession.sql(JOIN_CUSTOMER_ORDERS, customers=customers, orders=orders)


def customer_order_total(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return orders.sparkSession.sql(CUSTOMER_ORDER_TOTAL, customers=customers, orders=orders)
