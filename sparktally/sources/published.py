"""Text results that are published whole: written aside, described, then renamed.

A published folder has the result's files and, under ``_manifest``, one row per file: its place in
the order of the result, its rows and a checksum of its lines. A folder without a manifest, or with
files that differ from it, is refused. The order of the rows is that of the files, and of the
lines within them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktally.sources.folders import files_in, hadoop_path, rename
from sparktally.sources.writers import write_tab_separated

MANIFEST = "file STRING, place INT, rows BIGINT, checksum DECIMAL(38,0)"


class Unpublished(ValueError):
    """A folder that is not the whole result of one run."""


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def described(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``rows`` and ``checksum`` of the files of a folder."""
    # Sums do not depend on how files are split.
    checksum = F.sum(F.xxhash64("value").cast("decimal(38,0)"))
    return file_lines(spark, path).groupBy("file").agg(F.count("*").alias("rows"), checksum.alias("checksum"))


def publish(rows: DataFrame, path: str) -> None:
    """Writes rows, in their order, as tab-separated text under a path that must not exist yet.

    Until all files and the manifest are written, they are in a folder of another name, so that
    a run that fails leaves nothing under the path.
    """
    spark = rows.sparkSession
    staged = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    write_tab_separated(rows, staged)
    # Files are numbered in the order of the partitions that they were written from.
    by_name = Window.orderBy("file")
    manifest = described(spark, staged).withColumn("place", F.row_number().over(by_name) - 1)
    manifest.select("file", "place", "rows", "checksum").coalesce(1).write.json(f"{staged}/_manifest")
    rename(spark, staged, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    folder, system = hadoop_path(spark, f"{path}/_manifest/_SUCCESS")
    if not system.exists(folder):
        raise Unpublished(f"{path} has no manifest")
    return spark.read.schema(MANIFEST).json(f"{path}/_manifest")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """``place`` (from 0, in the order of the result) and ``value`` of each line.

    Checks the manifest first, which reads the files once more.
    """
    manifest = read_manifest(spark, path)
    if not files_in(spark, path):
        return spark.createDataFrame([], "place BIGINT, value STRING")
    found = described(spark, path).withColumnsRenamed({"rows": "its_rows", "checksum": "its_checksum"})
    same = F.col("rows").eqNullSafe(F.col("its_rows")) & F.col("checksum").eqNullSafe(F.col("its_checksum"))
    differing = manifest.join(found, "file", "full_outer").filter(~same)
    if wrong := [row.file for row in differing.select("file").limit(10).collect()]:
        raise Unpublished(f"{path} differs from its manifest in {', '.join(wrong)}")

    lines = file_lines(spark, path)
    # Places: rows of earlier files, of earlier blocks of the file, of earlier lines of the block.
    in_order = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("rows").over(in_order), F.lit(0)).alias("first"))
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows")
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("line")) - 1
    placed = lines.withColumn("within", within).join(starts.join(files, "file"), ["file", "block"])
    return placed.select((F.col("first") + F.col("start") + F.col("within")).alias("place"), "value")
