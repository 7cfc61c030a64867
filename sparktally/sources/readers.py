"""Readers of the input files.

All schemas are given, so no reader makes a pass over the data to find out types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.functions.numbers import number_or_null
from sparktally.sources import schemas


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text lines, one row per line, in the column ``value``."""
    return spark.read.text(path)


def read_order_lines(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated order lines under a header; a quoted field may hold commas."""
    return _read_delimited(spark, path, schemas.ORDER_LINES)


def read_departures(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated departures under a header; the time stays text."""
    return _read_delimited(spark, path, schemas.DEPARTURES, sep=";")


def read_trips(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """Comma-separated trips under a header; blank lines are skipped."""
    options = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "pathGlobFilter": files}
    return _read_delimited(spark, path, schemas.TRIPS, **options)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup under a header, with quoted names."""
    return _read_delimited(spark, path, schemas.ZONES)


def read_listings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Comma-separated listings under a header; quoted fields may hold commas and newlines.

    A row with a wrong number of fields is left out; a value that is no number is NULL. A file
    with newlines inside fields cannot be split, so one task reads it: keep such files small
    and many, or turn ``multi_line`` off where no field spans lines.
    """
    options = {
        "multiLine": multi_line,
        "columnNameOfCorruptRecord": "malformed",
        # Fields can only be counted if all of them are parsed.
        "columnPruning": False,
    }
    raw = _read_delimited(spark, path, schemas.LISTINGS, **options)
    # Spark refuses to filter on the malformed column alone, so the id (any or none) goes with it.
    any_id = F.length(F.concat_ws("", "id")) >= 0
    rows = raw.filter(F.col("malformed").isNull() & any_id).drop("malformed")
    return rows.withColumns(
        {name: number_or_null(name, kind) for name, kind in schemas.LISTING_TYPES.items()}
    )


def read_customers(spark: SparkSession, path: str, files: str = "customer*") -> DataFrame:
    """Pipe-separated customers without a header, from the matching files of a folder."""
    return _read_piped(spark, path, schemas.CUSTOMERS, files)


def read_orders(spark: SparkSession, path: str, files: str = "orders*") -> DataFrame:
    """Pipe-separated orders without a header, from the matching files of a folder."""
    return _read_piped(spark, path, schemas.ORDERS, files)


def _read_delimited(spark: SparkSession, path: str, schema: str, **options: object) -> DataFrame:
    quoted = spark.read.options(header=True, quote='"', escape='"', mode="PERMISSIVE")
    return quoted.options(**options).schema(schema).csv(path)


def _read_piped(spark: SparkSession, path: str, schema: str, files: str) -> DataFrame:
    # No quoting: a quote in a comment is an ordinary character.
    piped = spark.read.options(sep="|", quote="", mode="PERMISSIVE", pathGlobFilter=files)
    return piped.schema(schema).csv(path).drop("line_end")


def spread(records: DataFrame, tasks: int | None = None) -> DataFrame:
    """The records over ``tasks`` tasks; by default the plain scan.

    For work that costs far more than reading, such as splitting texts, over few files that
    cannot be split. The caller decides; nothing is measured.
    """
    return records.repartition(tasks) if tasks else records
