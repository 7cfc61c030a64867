"""The reports over raw input files: reader, operators, result.

``PROGRAMS`` maps a report to a function of the session and the input folder. Further
keyword arguments are the parameters of the report, such as ``k``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.constants import DEFAULT_ROOM_TYPE, DEFAULT_STOP, TOP_DAYS, TOP_ROWS
from sparktally.operators import listings, orders, transit, trips, words
from sparktally.operators.aggregates import distinct_key_values, key_values, one_value_by
from sparktally.operators.joins import join_records, total_by_lookup
from sparktally.sources import readers
from sparktally.sources.checked import read_checked_listings, read_checked_order_lines
from sparktally.sources.layouts import TRIPS, ZONES, read_by_header
from sparktally.sources.shapes import MixedLines

Program = Callable[..., DataFrame]
PROGRAMS: dict[str, Program] = {}
# Reports on what files hold besides, or on folders with several tables in them.
FOLDER_PROGRAMS: dict[str, Program] = {}

# The row number identifies an order line.
ROW_KEY = ["row_id"]


def program(run: Program) -> Program:
    PROGRAMS[run.__name__] = run
    return run


def folder_program(run: Program) -> Program:
    FOLDER_PROGRAMS[run.__name__] = run
    return run


# Text.


@program
def word_count(
    spark: SparkSession,
    path: str,
    min_length: int = 4,
    min_count: int = 3,
    tasks: int | None = None,
) -> DataFrame:
    lines = readers.spread(readers.read_text(spark, path), tasks)
    return words.word_count(lines, "value", min_length, min_count)


@program
def web_page_word_count(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """The word count with its default thresholds, over the lines of web pages."""
    return word_count(spark, path, tasks=tasks)


@program
def html_word_count(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    return words.markup_word_count(readers.spread(readers.read_text(spark, path), tasks))


# Order lines.


@program
def profit_by_customer(spark: SparkSession, path: str) -> DataFrame:
    return orders.profit_by(readers.read_order_lines(spark, path), ["customer_id"])


@program
def customer_profit_rows(spark: SparkSession, path: str) -> DataFrame:
    return key_values(order_profits(spark, path), "customer_id", "profit", ROW_KEY)


@program
def customer_profit_distinct(spark: SparkSession, path: str) -> DataFrame:
    return distinct_key_values(order_profits(spark, path), "customer_id", "profit")


def order_profits(spark: SparkSession, path: str) -> DataFrame:
    lines = readers.read_order_lines(spark, path)
    return lines.withColumn("profit", orders.or_zero("profit"))


@program
def sales_by_date_category(spark: SparkSession, path: str) -> DataFrame:
    return orders.sales_by(readers.read_order_lines(spark, path), ["order_date", "category"])


@program
def sales_by_date_state(spark: SparkSession, path: str) -> DataFrame:
    return orders.sales_by(readers.read_order_lines(spark, path), ["order_date", "state"])


@program
def order_distinct_products(spark: SparkSession, path: str) -> DataFrame:
    return orders.order_products(readers.read_order_lines(spark, path))


@program
def distinct_customers(spark: SparkSession, path: str) -> DataFrame:
    lines = readers.read_order_lines(spark, path)
    return one_value_by(lines, "customer_id", "customer_name")


@program
def topk_clients(spark: SparkSession, path: str, k: int = TOP_ROWS) -> DataFrame:
    lines = readers.read_order_lines(spark, path)
    return orders.whole_profits(orders.top_profits(lines, ROW_KEY, k))


@program
def topk_profit(spark: SparkSession, path: str, k: int = TOP_ROWS) -> DataFrame:
    return orders.top_profits(readers.read_order_lines(spark, path), ROW_KEY, k)


@program
def sort_by_date_asc(spark: SparkSession, path: str) -> DataFrame:
    lines = orders.with_parsed_date(readers.read_order_lines(spark, path))
    return orders.sort_by_date(lines, ROW_KEY)


@program
def sort_by_date_desc(spark: SparkSession, path: str) -> DataFrame:
    lines = orders.with_parsed_date(readers.read_order_lines(spark, path))
    return orders.sort_by_date(lines, ROW_KEY, descending=True)


# Customers and orders.


@program
def join_customer_orders(spark: SparkSession, path: str) -> DataFrame:
    customers, placed = readers.read_customers(spark, path), readers.read_orders(spark, path)
    names = customers.select("custkey", "name")
    return join_records(names, placed, "custkey", ["name", "comment"])


@program
def customer_order_total(spark: SparkSession, path: str, keep_zero: bool = True) -> DataFrame:
    """``keep_zero=False`` leaves out customers whose orders add up to nothing."""
    customers, placed = readers.read_customers(spark, path), readers.read_orders(spark, path)
    totals = total_by_lookup(placed, customers, "custkey", ["custkey", "name"], {"total": "totalprice"})
    return totals if keep_zero else totals.filter(F.col("total") != 0)


@program
def customer_order_total_nonzero(spark: SparkSession, path: str) -> DataFrame:
    return customer_order_total(spark, path, keep_zero=False)


# Transit.


@program
def stop_hourly_services(spark: SparkSession, path: str, stop: str = DEFAULT_STOP) -> DataFrame:
    return transit.services_of_stop(readers.read_departures(spark, path), stop)


@program
def stop_mode_counts(spark: SparkSession, path: str) -> DataFrame:
    return transit.vehicle_counts(readers.read_departures(spark, path))


@program
def top_tram_stops(spark: SparkSession, path: str, k: int = TOP_ROWS) -> DataFrame:
    return transit.top_stops(readers.read_departures(spark, path), "trams", k=k)


@program
def top_bus_stops(spark: SparkSession, path: str, k: int = TOP_ROWS) -> DataFrame:
    return transit.top_stops(readers.read_departures(spark, path), "buses", k=k)


@program
def top_all_stops(spark: SparkSession, path: str, k: int = TOP_ROWS) -> DataFrame:
    return transit.top_stops(readers.read_departures(spark, path), "trams + buses", k=k)


@program
def stop_hour_traffic(spark: SparkSession, path: str) -> DataFrame:
    return transit.stop_hour_traffic(readers.read_departures(spark, path))


# Trips.


@program
def peak_hours(spark: SparkSession, path: str) -> DataFrame:
    return trips.passengers_by_hour(readers.read_trips(spark, path))


@program
def top_days_of_month(spark: SparkSession, path: str, k: int = TOP_DAYS) -> DataFrame:
    return trips.top_days_of_month(readers.read_trips(spark, path), k)


@program
def daily_top_payment(spark: SparkSession, path: str) -> DataFrame:
    return trips.top_payment_by_day(readers.read_trips(spark, path))


@program
def zone_demand(spark: SparkSession, path: str, zones: str, files: str = "*") -> DataFrame:
    """``zones`` is the zone lookup; trips are in the ``files`` of the input folder."""
    taken = readers.read_trips(spark, path, files)
    return trips.zone_demand(taken, readers.read_zones(spark, zones))


@folder_program
def zone_demand_one_folder(spark: SparkSession, path: str) -> DataFrame:
    """Trips and the zone lookup are both in the input folder, told apart by their headers."""
    taken = read_by_header(spark, path, TRIPS, others=[ZONES])
    return trips.zone_demand(taken, read_by_header(spark, path, ZONES, others=[TRIPS]))


@program
def passenger_frequency(spark: SparkSession, path: str) -> DataFrame:
    return trips.passenger_frequency(readers.read_trips(spark, path))


@program
def tip_ratio_pct(spark: SparkSession, path: str) -> DataFrame:
    return trips.tip_ratio(readers.read_trips(spark, path))


@program
def avg_trip_length(spark: SparkSession, path: str) -> DataFrame:
    return trips.mean_distance(readers.read_trips(spark, path))


@program
def avg_trip_price(spark: SparkSession, path: str) -> DataFrame:
    return trips.mean_price(readers.read_trips(spark, path))


# Listings.


@program
def top_hosts(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return listings.top_hosts(readers.read_listings(spark, path, multi_line))


@program
def cheapest_listings(
    spark: SparkSession,
    path: str,
    room_type: str = DEFAULT_ROOM_TYPE,
    k: int = TOP_ROWS,
    multi_line: bool = True,
) -> DataFrame:
    return listings.cheapest_listings(readers.read_listings(spark, path, multi_line), room_type, k)


@program
def room_type_share(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return listings.room_type_share(readers.read_listings(spark, path, multi_line))


@program
def neighbourhood_centroid(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return listings.neighbourhood_centroid(readers.read_listings(spark, path, multi_line))


@program
def listing_word_count(
    spark: SparkSession, path: str, min_count: int = 101, multi_line: bool = True
) -> DataFrame:
    descriptions = readers.read_listings(spark, path, multi_line)
    return words.description_word_count(descriptions, "description", min_count)


# What the readers reject.


@folder_program
def rejected_order_lines(spark: SparkSession, path: str) -> DataFrame:
    return read_checked_order_lines(spark, path).rejected()


@folder_program
def rejected_listings(spark: SparkSession, path: str) -> DataFrame:
    return read_checked_listings(spark, path).rejected()


# Customers and orders in one folder, told apart by the shape of their lines.


@folder_program
def mixed_join_customer_orders(spark: SparkSession, path: str) -> DataFrame:
    mixed = MixedLines(spark, path)
    customers = mixed.customers().select("custkey", "name")
    return join_records(customers, mixed.orders(), "custkey", ["name", "comment"])


@folder_program
def mixed_customer_order_total(spark: SparkSession, path: str) -> DataFrame:
    mixed = MixedLines(spark, path)
    totals = {"total": "totalprice"}
    return total_by_lookup(mixed.orders(), mixed.customers(), "custkey", ["custkey", "name"], totals)
