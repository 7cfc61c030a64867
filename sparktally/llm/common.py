"""Shared folders, written intermediate tables, and joins that survive hot keys."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A key is hot if it has more than one in so many of all rows. Fewer than so many keys can be
# hot, whatever the size of the table, which bounds every broadcast of hot keys.
HOT_SHARE = 1000

# The bytes that split words wherever a contract says ``[^\x20\x09-\x0D]+``.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, from ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of its own; a cluster is
    refused, as its machines do not share local folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="sparktally-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/sparktally/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions this cluster's shuffles have, by its setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written as a Parquet table in the shared folder and read back.

    The table cuts the lineage: it outlives every executor, and later steps neither
    recompute it nor depend on shuffle files. Zstandard makes texts a good third smaller than
    Spark's default codec.
    """
    path = fresh_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query are deleted at its end, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row per ``key``.

    ``size`` is the column of ``groups`` with the rows of each key and ``total`` their sum.
    Rows of hot keys (fewer than ``HOT_SHARE`` keys, hence a bounded broadcast) are joined
    where they are; the others by sort-merge, where no key can have more than one in
    ``HOT_SHARE`` rows. ``rows`` is read twice, so it should be a stored table.
    """
    hot = groups.filter(F.col(size) * F.lit(HOT_SHARE) > F.lit(total))
    cold = groups.filter(F.col(size) * F.lit(HOT_SHARE) <= F.lit(total))
    near = rows.join(F.broadcast(hot), key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return near.unionByName(far)


def ascii_lower(text: Column) -> Column:
    """The text with A-Z in lower case and everything else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def numbered(rows: DataFrame, order: list[str], column: str, name: str) -> DataFrame:
    """The rows, stored, with their place from 0 in this order.

    Rows are dealt by range, so ``order`` should tell the rows of a frequent key apart. Only the
    number of rows of each shuffle partition goes through one task.
    """
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order)
    laid = dealt.sortWithinPartitions(*order).withColumn("_laid", F.monotonically_increasing_id())
    laid = stored(laid, name)
    part = F.shiftrightunsigned("_laid", 33)
    counts = laid.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # One row per shuffle partition.
    placed = laid.withColumn("_part", part).join(F.broadcast(starts), "_part")
    inside = F.col("_laid").bitwiseAND((1 << 33) - 1)
    return placed.withColumn(column, F.col("_start") + inside).drop("_part", "_laid", "_start")


def give_back() -> None:
    """Returns the memory that this Python worker holds but does not use.

    Workers outlive their tasks, and an executor has several of them beside its own memory.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def lean(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` on the batches of a task, with unused memory returned at its end."""

    def run(batches: Batches) -> Batches:
        yield from work(batches)
        give_back()

    return run
