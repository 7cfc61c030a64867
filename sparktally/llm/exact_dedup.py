"""Exact deduplication against a persistent digest index.

The index is a Parquet table of SHA-256 digests, bucketed and sorted by digest. A batch is
reduced to one row per digest, anti-joined with the index by sort-merge (the index side needs
no shuffle), and what is new is appended.

Defined cases: a NULL text counts as empty; empty texts are one group. Rows with the same id
and text are one document, share one decision and each count in ``group_size``. A NULL id
never wins against another id; a group of NULL ids only keeps them all, under a NULL
``keep_id``. An empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.llm.common import attach, fresh_path, shuffle_partitions, stored


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class DigestIndex:
    """Digests seen so far: ``digest``, ``keep_id`` (the id that stays) and ``batch``.

    ``path`` names the folder of the index; a later session opens it again with the same
    ``buckets``. Size those so that a bucket of digests (some 50 bytes a row) fits a task.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int) -> None:
        self.spark = spark
        self.buckets = buckets
        self.name = f"digest_index_{hashlib.md5(path.encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, fresh: DataFrame) -> None:
        """Adds digests that the index lacks; each bucket of the batch becomes one sorted file."""
        dealt = fresh.select("digest", "keep_id", "batch").repartition(self.buckets, "digest")
        dealt.write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").mode(
            "append"
        ).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def deduplicate(
        self, docs: DataFrame, id_column: str, text_column: str, batch: str | None = None
    ) -> DataFrame:
        """One row per document of the batch, and the batch's new digests into the index.

        Returns ``id``, ``digest``, ``keep_id``, ``group_size`` (rows of the batch with this
        text) and ``kept``. A text that the index holds already, from another batch, is kept by
        no row of this one.

        ``batch`` names the batch; by default its name follows from its ids and digests. A batch
        that is run again, after a failure at whatever point, gets the decisions of the first
        run: what the index has under its name counts as new, and nothing is appended twice.
        """
        rows = stored(
            docs.select(
                F.col(id_column).cast("bigint").alias("id"),
                text_digest(F.col(text_column)).alias("digest"),
            ),
            "digests",
        )
        if batch is None:
            summed = F.sum(F.xxhash64("id", "digest").cast("decimal(38,0)"))
            count, total = rows.agg(F.count("*"), summed).first()
            batch = f"{count}:{total}"
        groups = stored(
            rows.groupBy("digest").agg(
                F.max("id").alias("keep_id"), F.count("*").alias("group_size")
            ),
            "digest-groups",
        )
        fresh = groups.join(self.table().hint("merge"), "digest", "left_anti")
        self.append(fresh.withColumn("batch", F.lit(batch)))
        # The index now has each digest of the batch once, under this batch or an earlier one.
        index = self.table().withColumnsRenamed({"keep_id": "index_id", "batch": "index_batch"})
        decided = groups.join(index.hint("merge"), "digest").select(
            "digest",
            F.col("index_id").alias("keep_id"),
            "group_size",
            (F.col("index_batch") == batch).alias("is_new"),
        )
        total = rows.count()
        found = attach(rows, stored(decided, "decided"), "digest", "group_size", total)
        return found.select(
            "id",
            "digest",
            "keep_id",
            "group_size",
            (F.col("is_new") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        )


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder, with as many buckets as the session's shuffles."""
    return DigestIndex(spark, fresh_path(spark, "digest-index"), shuffle_partitions(spark))
