"""The operators' inputs as views over the warehouse tables.

Keys are foreign keys: a line has its order, product and supplier, an order its customer,
a customer its nation. A report therefore joins only the tables whose columns it uses;
leaving out the others changes no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.constants import SHORT_DATE
from sparktally.functions.dates import field
from sparktally.functions.numbers import exact_amount, number_or_zero, scaled
from sparktally.operators.orders import with_parsed_date

# Identifies a line: the line number alone repeats within an order.
LINE_KEY = ["order_id", "line_number", "product_id", "supplier_id", "sales"]

# Decimals of the amounts that are computed as whole numbers: a price has two, and so do
# a discount and a tax rate, so their product has four.
AMOUNT_DIGITS = 2
LINE_DIGITS = 4

# Stops that make a hub.
HUB_STOPS = 8

# Orders count in bulk by whole multiples of this amount; many customers have none.
BULK_AMOUNT = 400_000


class Tables:
    """The Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Order lines.

    def lines(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_extendedprice").alias("sales"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount"),
        )

    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("unit_price"),
        )

    def orders(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_totalprice").alias("total_price"),
            F.col("o_orderpriority").alias("priority"),
        )

    def bulk_orders(self) -> DataFrame:
        """Orders with their price in whole multiples of ``BULK_AMOUNT``, mostly 0."""
        multiples = F.floor(F.col("total_price") / BULK_AMOUNT)
        return self.orders().withColumn("total_price", multiples)

    def dated_orders(self) -> DataFrame:
        """Orders whose date is read from ``M/d/yy`` text; orders without a valid one are left out."""
        text = F.date_format("order_date", SHORT_DATE)
        return with_parsed_date(self.orders().withColumn("order_date", text))

    def customers(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").alias("nation_id"),
        )

    def nations(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("state")
        )

    def states(self) -> DataFrame:
        """The state of each customer."""
        return self.customers().join(self.nations(), "nation_id").drop("nation_id")

    def categorized_amounts(self) -> DataFrame:
        """Amount and category of each line; only these go into the next shuffle."""
        amounts = self.lines().select("order_id", "product_id", line_amount().alias("amount"))
        return amounts.join(self.products(), "product_id").select("order_id", "category", "amount")

    def profitable_lines(self) -> DataFrame:
        """Lines with their profit: discounted sales less the list price of the goods."""
        lines = self.lines().join(self.products(), "product_id")
        return lines.withColumn("profit", line_profit())

    def decimal_lines(self) -> DataFrame:
        """Lines with decimal sales and integer quantities, for plain SQL sums."""
        return self.lines().withColumns(
            {"sales": exact_amount("sales"), "quantity": F.col("quantity").cast("smallint")}
        )

    # Transit departures.

    def departures(self, stop: Column) -> DataFrame:
        return self.read("events").select(
            stop.alias("stop_id"),
            (event_number() % 8 + 1).alias("route"),
            (F.col("event_id") % 2).cast("string").alias("direction"),
            F.date_format("ts", "HH:mm:ss").alias("departure_time"),
        )

    def stop_departures(self) -> DataFrame:
        return self.departures(F.col("user_id"))

    def hub_departures(self) -> DataFrame:
        """Departures of hubs of eight stops each, so that every traffic class occurs at any scale."""
        return self.departures(F.expr(f"user_id div {HUB_STOPS}"))

    # Taxi trips.

    def trips(self) -> DataFrame:
        return self.read("events").select(
            F.col("ts").alias("pickup"),
            (event_number() % 7).alias("passengers"),
            F.col("value").alias("distance"),
            event_number().alias("zone_id"),
        )

    def zones(self) -> DataFrame:
        """Zones of every fifth id from 0 to 120: some have no trips, many trips have no zone."""
        return self.read("nation").select(
            (F.col("n_nationkey") * 5).alias("zone_id"), F.col("n_name").alias("zone")
        )

    def payments(self) -> DataFrame:
        code = field("o_orderpriority", "-", 1)
        return self.read("orders").select(
            F.col("o_orderdate").alias("pickup"), number_or_zero(code, "int").alias("payment_type")
        )

    def fares(self) -> DataFrame:
        """The tax of each line as its tip, in whole currency units."""
        price, tax = scaled("l_extendedprice"), scaled("l_tax")
        tip, total = price * tax, price * (F.lit(100) + tax)
        return self.read("lineitem").select(
            whole_units(tip, LINE_DIGITS).alias("tip"),
            whole_units(total, LINE_DIGITS).alias("total"),
        )

    def trip_prices(self) -> DataFrame:
        return self.read("orders").select(F.col("o_totalprice").alias("total"))

    # Listings.

    def listings(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_type").alias("room_type"),
            F.col("p_retailprice").alias("price"),
        )

    def hosts(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").alias("host_id"), F.col("s_name").alias("host_name")
        )

    def places(self) -> DataFrame:
        return self.read("embeddings").select(
            F.col("label").alias("neighbourhood"),
            F.get("embedding", 0).cast("double").alias("lat"),
            F.get("embedding", 1).cast("double").alias("lon"),
        )

    # Texts.

    def documents(self) -> DataFrame:
        return self.read("documents").select("text")

    def pages(self) -> DataFrame:
        return self.read("pages").select("html")


def line_amount() -> Column:
    """Sales times quantity in units of ``AMOUNT_DIGITS`` decimals."""
    return scaled("sales") * F.col("quantity").cast("bigint")


def line_profit() -> Column:
    """Profit in units of ``LINE_DIGITS`` decimals."""
    revenue = scaled("sales") * (F.lit(100) - scaled("discount"))
    return revenue - scaled("unit_price") * F.col("quantity").cast("bigint") * 100


def whole_units(value: Column, digits: int) -> Column:
    """The whole part of an amount in units of ``digits`` decimals."""
    return F.call_function("div", value, F.lit(10**digits).cast("bigint"))


def event_number() -> Column:
    """The number in the JSON properties of an event; 0 where there is none."""
    return number_or_zero(F.get_json_object("props", "$.k"), "int")
