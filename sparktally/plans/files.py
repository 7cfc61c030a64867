"""Queries over files: a table is written in the shape of an input file and read back.

Each checks a reader or a writer as a whole against SQL on the table that the files were made of.
The files go to a fresh folder, see ``folders.work_folder``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.operators import transit, trips, words
from sparktally.operators.joins import join_records, total_by_lookup
from sparktally.operators.ordering import top_k_of_any_size
from sparktally.plans.queries import in_currency, sales_by_date_state
from sparktally.plans.tables import LINE_DIGITS, LINE_KEY, Tables
from sparktally.sources import readers
from sparktally.sources.checked import read_checked_order_lines
from sparktally.sources.folders import work_folder
from sparktally.sources.layouts import DEPARTURES, LISTINGS, TRIPS, ZONES, Layout, read_by_header
from sparktally.sources.published import publish, read_published
from sparktally.sources.quoted import read_split_listings
from sparktally.sources.shapes import MixedLines

Query = Callable[[SparkSession, str], DataFrame]
FILE_QUERIES: dict[str, Query] = {}

CSV = {"header": True, "quote": '"', "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
# One order line in so many is spoilt.
SPOILT = 10


def file_query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    FILE_QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def laid_out(layout: Layout, **columns: Column) -> list[Column]:
    """All columns of a layout; those not given are empty."""
    return [columns.get(name, F.lit(None)).cast("string").alias(name) for name in layout.types()]


# Text.


@file_query
def text_file_word_count(tables: Tables) -> DataFrame:
    """Documents as text files, of many lines each."""
    path = work_folder(tables.spark, "texts")
    tables.documents().filter("text IS NOT NULL").write.text(path)
    return words.word_count(readers.read_text(tables.spark, path), "value")


# Quoted files.


@file_query
def split_listings(tables: Tables) -> DataFrame:
    """Listings with newlines, quotes and commas in their descriptions, columns in another order."""
    size = F.concat(F.lit('size "'), F.col("p_size").cast("string"), F.lit('", '))
    columns = laid_out(
        LISTINGS,
        id=F.col("p_partkey"),
        description=F.concat("p_name", F.lit("\n"), size, "p_type"),
        host_id=F.col("p_size"),
        host_name=F.col("p_brand"),
        room_type=F.col("p_type"),
        price=F.col("p_retailprice"),
    )
    path = work_folder(tables.spark, "listings")
    tables.read("part").select(*reversed(columns)).write.options(**CSV).csv(path)
    found = read_split_listings(tables.spark, path)
    return found.select("id", "description", "host_id", "host_name", "room_type", F.col("price").cast("double"))


@file_query
def peak_hours_by_header(tables: Tables) -> DataFrame:
    """Trips in files with two orders of columns and two spellings of their names."""
    path = work_folder(tables.spark, "trips")
    write_trips(tables, path)
    return trips.passengers_by_hour(read_by_header(tables.spark, path, TRIPS))


@file_query
def zone_demand_one_folder(tables: Tables) -> DataFrame:
    """Trips and the zone lookup in one folder, told apart by their headers."""
    path = work_folder(tables.spark, "taxis")
    write_trips(tables, path)
    zones = tables.zones().select(*laid_out(ZONES, zone_id=F.col("zone_id"), zone=F.col("zone")))
    zones.withColumnRenamed("zone_id", "LocationID").write.options(**CSV).mode("append").csv(path)
    taken = read_by_header(tables.spark, path, TRIPS, others=[ZONES])
    return trips.zone_demand(taken, read_by_header(tables.spark, path, ZONES, others=[TRIPS]))


def write_trips(tables: Tables, path: str) -> None:
    columns = laid_out(
        TRIPS,
        pickup=F.date_format("pickup", "yyyy-MM-dd HH:mm:ss"),
        passengers=F.col("passengers"),
        distance=F.col("distance"),
        zone_id=F.col("zone_id"),
    )
    rows = tables.trips()
    rows.filter("passengers < 3").select(*columns).write.options(**CSV).csv(path)
    spelt = {ours: theirs for theirs, ours in TRIPS.names.items()}
    others = rows.filter("passengers >= 3").select(*reversed(columns)).withColumnsRenamed(spelt)
    others.write.options(**CSV).mode("append").csv(path)


@file_query
def stop_mode_counts_by_header(tables: Tables) -> DataFrame:
    """Departures in a semicolon-separated file with its columns in another order."""
    path = work_folder(tables.spark, "departures")
    columns = laid_out(DEPARTURES, **{c: F.col(c) for c in ("stop_id", "route", "direction", "departure_time")})
    tables.stop_departures().select(*reversed(columns)).write.options(**{**CSV, "sep": ";"}).csv(path)
    return transit.vehicle_counts(read_by_header(tables.spark, path, DEPARTURES), "stop_id")


# Rejected lines.


@file_query
def order_line_rejects(tables: Tables) -> DataFrame:
    """Order lines, a tenth of them spoilt: rows by reason, and the sales of the good ones."""
    checked = read_checked_order_lines(tables.spark, spoilt_order_lines(tables))
    totals = checked.rows.groupBy(F.coalesce("reason", F.lit("none")).alias("reason")).agg(
        F.count("*").alias("rows"), F.sum(F.when(F.col("reason").isNull(), F.col("sales"))).alias("sales")
    )
    return totals.withColumn("sales", F.col("sales").cast("double"))


def spoilt_order_lines(tables: Tables) -> str:
    lines = tables.lines().join(tables.orders(), "order_id")
    turn = (F.col("order_id") + F.col("line_number")) % SPOILT
    kind = F.when(turn == 0, F.col("product_id") % 4)
    columns = {name: F.lit("x") for name in Layout(readers.schemas.ORDER_LINES).types()} | {
        "order_id": F.col("order_id"),
        "order_date": F.when(kind == 3, "13/32/16").otherwise(F.date_format("order_date", "M/d/yyyy")),
        "customer_name": F.lit('Gute, "Claire"'),
        "sales": F.when(kind == 1, "n/a").otherwise(F.col("sales").cast("string")),
        "quantity": F.when(kind == 2, "one").otherwise(F.col("quantity").cast("int").cast("string")),
        "discount": F.lit("0"),
        "profit": F.lit("1.5"),
    }

    def written(name: str, column: Column) -> Column:
        text = column.cast("string")
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')) if name == "customer_name" else text

    whole = F.concat_ws(",", *[written(name, column) for name, column in columns.items()])
    short = F.regexp_replace(whole, ",[^,]*$", "")
    path = work_folder(tables.spark, "order-lines")
    lines.select(F.when(kind == 0, short).otherwise(whole).alias("value")).write.text(path)
    return path


# Customers and orders in one folder.


def mixed_lines(tables: Tables) -> MixedLines:
    """Customers, orders (a third without a comment) and lines of neither shape in the same files."""
    empty = F.lit("")
    customer = [F.col("customer_id"), F.col("customer_name"), empty, F.col("nation_id"), empty, empty, empty, empty]
    comment = F.when(F.col("order_id") % 3 == 0, "").otherwise(F.col("priority"))
    order = [F.col("order_id"), F.col("customer_id"), empty, F.format_string("%.2f", "total_price")]
    order += [F.col("order_date"), F.col("priority"), empty, empty, comment]

    def line(fields: list[Column]) -> Column:
        return F.concat(F.concat_ws("|", *[f.cast("string") for f in fields]), F.lit("|")).alias("value")

    path = work_folder(tables.spark, "mixed")
    nations = tables.nations().select(line([F.col("nation_id"), F.col("state")]))
    everything = tables.customers().select(line(customer)).union(tables.orders().select(line(order))).union(nations)
    # Dealt anew, so that files hold lines of all shapes.
    everything.repartition(4).write.text(path)
    return MixedLines(tables.spark, path)


@file_query
def mixed_join_customer_orders(tables: Tables) -> DataFrame:
    mixed = mixed_lines(tables)
    customers = mixed.customers().select("custkey", "name")
    joined = join_records(customers, mixed.orders(), "custkey", ["name", "orderkey", "comment"])
    return joined.withColumnsRenamed({"name": "customer_name", "orderkey": "order_id"})


@file_query
def mixed_customer_order_total(tables: Tables) -> DataFrame:
    mixed = mixed_lines(tables)
    totals = total_by_lookup(
        mixed.orders(), mixed.customers(), "custkey", ["custkey", "name"], {"total": "totalprice"}
    )
    named = totals.withColumnsRenamed({"custkey": "customer_id", "name": "customer_name"})
    return named.withColumn("total", F.col("total").cast("double"))


@file_query
def mixed_line_shapes(tables: Tables) -> DataFrame:
    """How many lines are customers, orders, or neither."""
    mixed = mixed_lines(tables)
    shapes = {"customer": mixed.customers(), "order": mixed.orders(), "other": mixed.others()}
    counts = [rows.agg(F.lit(name).alias("shape"), F.count("*").alias("rows")) for name, rows in shapes.items()]
    return counts[0].union(counts[1]).union(counts[2])


# Published results.


@file_query
def published_sales(tables: Tables) -> DataFrame:
    """Sales in order of date and state, published as text and read back with their places."""
    path = work_folder(tables.spark, "published")
    publish(sales_by_date_state(tables).orderBy("order_date", "state"), path)
    fields = F.split("value", "\t")
    return read_published(tables.spark, path).select(
        "place",
        F.get(fields, 0).cast("date").alias("order_date"),
        F.get(fields, 1).alias("state"),
        F.get(fields, 2).cast("double").alias("sales_amount"),
    )


# Rankings that are too long for one task.


@file_query
def top_third_of_profits(tables: Tables) -> DataFrame:
    """The more profitable third of all lines, with their ranks."""
    lines = tables.profitable_lines()
    best = top_k_of_any_size(lines, "profit", LINE_KEY, tables.read("lineitem").count() // 3)
    return in_currency(best, "profit", LINE_DIGITS).select("rank", *LINE_KEY, "profit")
