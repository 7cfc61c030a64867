"""Readers that keep what they reject.

Rows come with the file and the line that they are from and, if they break a rule, the reason:
the first rule broken. Good rows and rejected ones together are all rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.functions.dates import parse_short_date
from sparktally.sources import schemas
from sparktally.sources.layouts import LISTINGS, Layout
from sparktally.sources.quoted import read_by_records


class Checked:
    """``rows`` with ``file``, ``line`` and ``reason`` (NULL for good rows)."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows

    def good(self) -> DataFrame:
        return self.rows.filter("reason IS NULL").drop("file", "line", "reason")

    def rejected(self) -> DataFrame:
        """``file``, ``line`` as it was, and ``reason``."""
        return self.rows.filter("reason IS NOT NULL").select("file", "line", "reason")

    def reasons(self) -> DataFrame:
        """Rows by reason; that of good rows is NULL."""
        return self.rows.groupBy("reason").agg(F.count("*").alias("rows"))


def reason(rules: Mapping[str, Column]) -> Column:
    """The name of the first condition that holds."""
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])


def is_no(name: str, kind: str) -> Column:
    """A value that is there but does not have the type."""
    return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def read_checked_order_lines(spark: SparkSession, path: str, dated: bool = True) -> Checked:
    """Order lines by position, one line of text each, with typed columns.

    Rejected for a wrong number of fields, sales, a quantity or a profit that is no number, and
    unless ``dated`` is off an order date that is none.
    """
    layout = Layout(schemas.ORDER_LINES)
    types = layout.types()
    scanned = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    texts = ", ".join(f"{name} STRING" for name in types)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}
    parsed = F.from_csv("line", f"{texts}, malformed STRING", options)
    # A header names its columns where numbers would be.
    rows = scanned.filter("line <> ''").select("file", "line", parsed.alias("p")).select("file", "line", "p.*")
    rows = rows.filter("NOT (malformed IS NULL AND lower(trim(sales)) = 'sales')")
    rules = {
        "fields": F.col("malformed").isNotNull(),
        **{name: is_no(name, types[name]) for name in ("sales", "quantity", "profit")},
    }
    if dated:
        rules["order_date"] = parse_short_date("order_date").isNull()
    typed = {name: F.col(name).try_cast(kind) for name, kind in types.items() if kind != "string"}
    return Checked(rows.withColumn("reason", reason(rules)).drop("malformed").withColumns(typed))


def read_checked_listings(spark: SparkSession, path: str) -> Checked:
    """Listings by header, also with newlines in fields.

    Rejected for a wrong number of fields, and an id or a price that is none.
    """
    types = schemas.LISTING_TYPES
    rows = read_by_records(spark, path, LISTINGS).withColumnRenamed("text", "line")
    broken = {name: F.col(name).try_cast(types[name]).isNull() for name in ("id", "price")}
    found = reason({"fields": F.col("malformed"), **broken})
    typed = {name: F.col(name).try_cast(kind) for name, kind in types.items()}
    return Checked(rows.withColumn("reason", found).drop("malformed", "record").withColumns(typed))
