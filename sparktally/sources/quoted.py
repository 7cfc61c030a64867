"""Quoted CSV with newlines inside fields, many tasks to a file.

Spark splits a file into blocks of lines. A newline ends a record if an even number of quotes comes
before it, so it takes the parity of the quotes before each line: quotes are counted per
block, the counts added up over the blocks of a file, and over the lines of a block. Lines that
are records by themselves, nearly all, go on as they are; only those of records with newlines in
them are brought together, by number of the record.

Every quote must be part of a quoted field, as ``""`` inside it; a file with a stray quote has its
parity wrong from there on. Lines may end in CR LF; empty lines between records are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktally.functions.numbers import number_or_null
from sparktally.sources import schemas
from sparktally.sources.layouts import LISTINGS, Layout, fields_by_header


# Columns that a file can have.
MOST_COLUMNS = 64


def read_records(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """``file``, ``record`` (from 1, the header) and ``text`` of each record."""
    scanned = spark.read.options(lineSep="\n", pathGlobFilter=files).text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = scanned.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Ascends with the lines of a block.
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
        (quotes % 2).alias("odd"),
    )
    block = Window.partitionBy("file", "block").orderBy("line")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    inside = lines.withColumn("within", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)

    # A line starts a record if the parity before it is even. How many lines do depends on the
    # parity before the block.
    def starts(parity: int) -> F.Column:
        return F.sum((F.col("within") == parity).cast("bigint"))

    blocks = inside.groupBy("file", "block").agg(
        F.sum("odd").alias("odd"), starts(0).alias("if_even"), starts(1).alias("if_odd")
    )
    # Windows over the blocks of a file, some hundred MB each.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parity = blocks.withColumn("parity", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    mine = F.when(F.col("parity") == 0, F.col("if_even")).otherwise(F.col("if_odd"))
    counted = parity.withColumn("first", F.coalesce(F.sum(mine).over(earlier), F.lit(0)))
    counted = counted.select("file", "block", "parity", "first")

    is_start = (F.col("within") + F.col("parity")) % 2 == 0
    upto = block.rowsBetween(Window.unboundedPreceding, 0)
    numbered = inside.join(counted, ["file", "block"]).select(
        "file",
        "block",
        "line",
        "text",
        is_start.alias("starts"),
        ((F.col("within") + F.col("parity") + F.col("odd")) % 2 == 0).alias("ends"),
        (F.col("first") + F.sum(is_start.cast("bigint")).over(upto)).alias("record"),
    )
    whole = numbered.filter("starts AND ends").select("file", "record", "text")
    parts = numbered.filter("NOT (starts AND ends)").groupBy("file", "record")
    in_order = F.sort_array(F.collect_list(F.struct("block", "line", "text")))
    joined = parts.agg(F.array_join(in_order.getField("text"), "\n").alias("text"))
    records = whole.unionByName(joined.select("file", "record", "text"))
    return records.withColumn("text", F.regexp_replace("text", "\r$", "")).filter("text <> ''")


def read_by_records(spark: SparkSession, path: str, layout: Layout, files: str = "*") -> DataFrame:
    """The layout's columns as text, with ``file``, ``record``, ``text`` and ``malformed``.

    Each file's columns are those of its header, in any order. A record with more or fewer
    fields than the header is malformed, and its columns are NULL.
    """
    records = read_records(spark, path, files)
    options = {"sep": layout.separator, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    ddl = ", ".join(f"f{i} STRING" for i in range(MOST_COLUMNS))
    # Without its quoted parts, a record has a separator between any two fields.
    bare = F.regexp_replace("text", '"[^"]*"', "")
    count = F.length(bare) - F.length(F.replace(bare, F.lit(layout.separator), F.lit(""))) + 1
    listed = records.withColumn("parsed", F.from_csv(F.col("text"), ddl, options)).select(
        "file",
        "record",
        "text",
        count.alias("count"),
        F.array(*[F.col(f"parsed.f{i}") for i in range(MOST_COLUMNS)]).alias("fields"),
    )
    headers = listed.filter("record = 1").select(
        "file", F.col("fields").alias("header"), F.col("count").alias("header_count")
    )
    rows = listed.filter("record > 1").join(headers, "file")
    malformed = F.col("count") != F.col("header_count")
    columns = {
        name: F.when(~F.col("malformed"), F.nullif(column, F.lit("")))
        for name, column in fields_by_header(layout, "fields", "header").items()
    }
    return rows.withColumn("malformed", malformed).select(
        "file", "record", "text", "malformed", *[column.alias(name) for name, column in columns.items()]
    )


def read_split_listings(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """Listings as of ``readers.read_listings``, from files of any size, columns by header."""
    rows = read_by_records(spark, path, LISTINGS, files).filter("NOT malformed")
    types = schemas.LISTING_TYPES
    return rows.select(
        *[number_or_null(c, types[c]).alias(c) if c in types else F.col(c) for c in LISTINGS.types()]
    )
