"""One query per report, over the tables of a folder.

Amounts are computed as whole numbers of their smallest unit, which is exact whatever
the order of the rows, and returned as doubles. Where a lookup table is needed only for
grouping, facts are totalled per key before they meet it; where a top-k needs it only for
display, the k rows are picked first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.functions.numbers import (
    bit_parts,
    exact_amount,
    from_bit_parts,
    scaled,
    unscaled,
)
from sparktally.operators import listings, orders, transit, trips, words
from sparktally.operators.aggregates import (
    distinct_key_values,
    key_values,
    one_value_by,
    total_by,
)
from sparktally.operators.joins import (
    complete_few,
    count_by_lookup,
    join_records,
    total_by_lookup,
)
from sparktally.plans import statements
from sparktally.plans.tables import AMOUNT_DIGITS, LINE_DIGITS, LINE_KEY, Tables, line_amount

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def in_currency(rows: DataFrame, name: str, digits: int) -> DataFrame:
    """An amount in whole units as a double."""
    return rows.withColumn(name, unscaled(name, digits))


def total_in_currency(rows: DataFrame, name: str, digits: int) -> DataFrame:
    """A total that was added up in two parts as a double."""
    return rows.withColumn(name, unscaled(from_bit_parts(), digits)).drop("high", "low")


# Words.


@query
def word_count(tables: Tables) -> DataFrame:
    return words.word_count(tables.documents(), "text")


@query
def web_page_word_count(tables: Tables) -> DataFrame:
    return words.word_count(tables.pages(), "html")


@query
def html_word_count(tables: Tables) -> DataFrame:
    return words.markup_word_count(tables.pages(), "html")


@query
def listing_word_count(tables: Tables) -> DataFrame:
    return words.description_word_count(tables.documents(), "text")


# Order lines.


@query
def profit_by_customer(tables: Tables) -> DataFrame:
    totals = total_by_lookup(
        tables.profitable_lines(),
        tables.orders(),
        on="order_id",
        by=["customer_id"],
        totals=bit_parts("profit"),
    )
    return total_in_currency(totals, "profit", LINE_DIGITS)


@query
def customer_profit_rows(tables: Tables) -> DataFrame:
    lines = tables.profitable_lines().join(tables.orders(), "order_id")
    return in_currency(
        key_values(lines, "customer_id", "profit", LINE_KEY), "profit", LINE_DIGITS
    )


@query
def customer_profit_distinct(tables: Tables) -> DataFrame:
    lines = tables.profitable_lines().join(tables.orders(), "order_id")
    return in_currency(
        distinct_key_values(lines, "customer_id", "profit"), "profit", LINE_DIGITS
    )


@query
def sales_by_date_category(tables: Tables) -> DataFrame:
    # Totals per order and category first, so that the order join sees no hot order.
    parts = bit_parts("amount")
    per_order = total_by(tables.categorized_amounts(), ["order_id", "category"], parts)
    dated = per_order.join(tables.orders(), "order_id")
    totals = total_by(dated, ["order_date", "category"], {name: name for name in parts})
    return total_in_currency(totals, "sales_amount", AMOUNT_DIGITS)


@query
def sales_by_date_state(tables: Tables) -> DataFrame:
    totals = total_by_lookup(
        tables.lines(),
        tables.orders().join(tables.states(), "customer_id"),
        on="order_id",
        by=["order_date", "state"],
        totals=bit_parts(line_amount()),
    )
    return total_in_currency(totals, "sales_amount", AMOUNT_DIGITS)


@query
def order_distinct_products(tables: Tables) -> DataFrame:
    totals = orders.order_products(tables.lines(), bit_parts(line_amount()))
    return total_in_currency(totals, "sales_amount", AMOUNT_DIGITS)


@query
def distinct_customers(tables: Tables) -> DataFrame:
    with_lines = tables.lines().select("order_id").distinct()
    buyers = tables.orders().join(with_lines, "order_id", "left_semi").select("customer_id")
    named = buyers.distinct().join(tables.customers(), "customer_id")
    return one_value_by(named, "customer_id", "customer_name")


@query
def topk_profit(tables: Tables) -> DataFrame:
    rows = complete_few(top_lines(tables), tables.orders(), "order_id")
    rows = complete_few(rows, tables.customers(), "customer_id")
    rows = complete_few(rows, tables.nations(), "nation_id")
    columns = ["rank", *LINE_KEY, "customer_id", "customer_name", "state", "category"]
    return rows.select(*columns, "order_date", "quantity", "profit")


@query
def topk_clients(tables: Tables) -> DataFrame:
    rows = complete_few(top_lines(tables), tables.orders(), "order_id")
    return orders.whole_profits(rows, "rank")


def top_lines(tables: Tables) -> DataFrame:
    best = orders.top_profits(tables.profitable_lines(), LINE_KEY, rank="rank")
    return in_currency(best, "profit", LINE_DIGITS)


@query
def sort_by_date_asc(tables: Tables) -> DataFrame:
    """Dates are read from their text form; lines of an order without a valid one are left out."""
    return date_sorted_lines(tables, tables.dated_orders())


@query
def sort_by_date_desc(tables: Tables) -> DataFrame:
    return date_sorted_lines(tables, tables.orders(), descending=True)


def date_sorted_lines(tables: Tables, placed: DataFrame, descending: bool = False) -> DataFrame:
    dates = placed.select("order_id", "customer_id", "order_date")
    return orders.sort_by_date(tables.lines().join(dates, "order_id"), LINE_KEY, descending)


# Customers and orders.


@query
def join_customer_orders(tables: Tables) -> DataFrame:
    columns = ["customer_name", "order_id", "priority"]
    return join_records(tables.customers(), tables.orders(), "customer_id", columns)


@query
def customer_order_total(tables: Tables) -> DataFrame:
    totals = total_by_lookup(
        tables.orders(),
        tables.customers(),
        on="customer_id",
        by=["customer_id", "customer_name"],
        totals=bit_parts(scaled("total_price")),
    )
    return total_in_currency(totals, "total", AMOUNT_DIGITS)


@query
def customer_order_total_nonzero(tables: Tables) -> DataFrame:
    """Bulk orders by customer, without the customers who have none."""
    totals = total_by_lookup(
        tables.bulk_orders(),
        tables.customers(),
        on="customer_id",
        by=["customer_id", "customer_name"],
        totals=bit_parts("total_price"),
    )
    return total_in_currency(totals, "total", 0).filter(F.col("total") != 0)


# Transit.


@query
def stop_hourly_services(tables: Tables) -> DataFrame:
    return transit.services_of_stop(tables.stop_departures(), 1, "stop_id")


@query
def stop_mode_counts(tables: Tables) -> DataFrame:
    return transit.vehicle_counts(tables.stop_departures(), "stop_id")


@query
def top_tram_stops(tables: Tables) -> DataFrame:
    return transit.top_stops(tables.stop_departures(), "trams", "stop_id", rank="rank")


@query
def top_bus_stops(tables: Tables) -> DataFrame:
    return transit.top_stops(tables.stop_departures(), "buses", "stop_id", rank="rank")


@query
def top_all_stops(tables: Tables) -> DataFrame:
    return transit.top_stops(tables.stop_departures(), "trams + buses", "stop_id", rank="rank")


@query
def stop_hour_traffic(tables: Tables) -> DataFrame:
    return transit.stop_hour_traffic(tables.hub_departures(), "stop_id")


# Trips.


@query
def peak_hours(tables: Tables) -> DataFrame:
    return trips.passengers_by_hour(tables.trips())


@query
def top_days_of_month(tables: Tables) -> DataFrame:
    return trips.top_days_of_month(tables.trips(), rank="rank")


@query
def daily_top_payment(tables: Tables) -> DataFrame:
    return trips.top_payment_by_day(tables.payments())


@query
def zone_demand(tables: Tables) -> DataFrame:
    return trips.zone_demand(tables.trips(), tables.zones())


@query
def passenger_frequency(tables: Tables) -> DataFrame:
    return trips.passenger_frequency(tables.trips())


@query
def tip_ratio_pct(tables: Tables) -> DataFrame:
    return trips.tip_ratio(tables.fares())


@query
def avg_trip_length(tables: Tables) -> DataFrame:
    return trips.mean_distance(tables.trips())


@query
def avg_trip_price(tables: Tables) -> DataFrame:
    return trips.mean_price(tables.trip_prices())


# Listings.


@query
def top_hosts(tables: Tables) -> DataFrame:
    counts = count_by_lookup(
        tables.lines().withColumnRenamed("supplier_id", "host_id"),
        tables.hosts(),
        on="host_id",
        by=["host_id", "host_name"],
        count="listings",
    )
    return listings.most_listings_first(counts)


@query
def cheapest_listings(tables: Tables) -> DataFrame:
    return listings.cheapest_listings(tables.listings(), "ECONOMY", rank="rank")


@query
def room_type_share(tables: Tables) -> DataFrame:
    return listings.room_type_share(tables.listings())


@query
def neighbourhood_centroid(tables: Tables) -> DataFrame:
    return listings.neighbourhood_centroid(tables.places(), digits=6)


# The SQL statements.


@query
def sql_sales_by_date_state(tables: Tables) -> DataFrame:
    placed = tables.orders().join(tables.states(), "customer_id")
    sales = statements.sales_by_date_and(tables.decimal_lines(), placed, "state")
    return with_double(sales, "sales_amount")


@query
def sql_sales_by_date_category(tables: Tables) -> DataFrame:
    lines = tables.decimal_lines().join(tables.products(), "product_id")
    sales = statements.sales_by_date_and(lines, tables.orders(), "category")
    return with_double(sales, "sales_amount")


@query
def sql_order_products(tables: Tables) -> DataFrame:
    return with_double(statements.order_products(tables.decimal_lines()), "sales_amount")


@query
def sql_join_customer_orders(tables: Tables) -> DataFrame:
    comments = tables.orders().withColumnRenamed("priority", "comment")
    return statements.join_customer_orders(tables.customers(), comments)


@query
def sql_customer_order_total(tables: Tables) -> DataFrame:
    priced = tables.orders().withColumn("total_price", exact_amount("total_price"))
    return with_double(statements.customer_order_total(tables.customers(), priced), "total")


def with_double(rows: DataFrame, name: str) -> DataFrame:
    return rows.withColumn(name, F.col(name).cast("double"))
