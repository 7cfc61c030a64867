"""Global shuffle into shards by a two-pass external shuffle.

Pass 1 scatters the records by seeded hashes into buckets that fit a task's memory. Pass 2
shuffles each bucket by Fisher-Yates and writes it. A record's shard depends on its id and the
number of shards only (the shard with the highest seeded hash of id and shard): with one more
shard, records move only into the new one.

Defined cases: a NULL text has 8 bytes (the size of its id) and checksum 0. Records with the
same id share a shard, NULL ids included; each gets its own slot. Their bucket depends on the
text too, so only rows repeated in both id and text must fit in a bucket together. An empty
table gives no rows. Other columns travel along; those named like a result column are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from sparktally.llm.common import fresh_path, give_back, stored

# Shuffle partitions for each bucket, so that hardly any gets several, however many buckets there are.
PLACES = 4
RESULT = ["size", "text_crc32", "shard", "part", "slot", "grown_shard"]


def best_shard(key: Column, shards: int, seed: int) -> Column:
    """The shard from 0 to ``shards`` - 1 with the highest hash for this key."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.xxhash64(F.lit(seed), key, i)
    )
    return (F.array_position(hashes, F.array_max(hashes)) - 1).cast("int")


def fisher_yates(count: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of 0 to ``count`` - 1."""
    order = np.arange(count)
    if count < 2:
        return order
    last = np.arange(count - 1, 0, -1)
    picks = np.random.default_rng(seed).integers(0, last + 1)
    places = order.tolist()
    for i, j in zip(last.tolist(), picks.tolist(), strict=True):
        places[i], places[j] = places[j], places[i]
    return np.array(places)


def shard_records(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int = 24,
    seed: int = 7,
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """The records, written as one folder per shard and read back.

    Adds ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``shard``, ``slot`` (place
    in the shard, gapless from 0) and ``grown_shard`` (the shard if there were one more).
    """
    spark = docs.sparkSession
    key, text = F.col(id_column), F.col(text_column)
    placed = docs.drop(*[c for c in RESULT if c not in (id_column, text_column)]).withColumns(
        {
            "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8,
            "text_crc32": F.crc32(F.coalesce(text, F.lit(""))),
            "shard": best_shard(key, shards, seed),
        }
    )
    narrow = stored(placed.select(id_column, "size", "text_crc32", "shard"), "placed")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // (shards * bucket_bytes)))
    part = F.pmod(F.xxhash64(F.lit(seed + 1), key, F.col("text_crc32")), F.lit(parts)).cast("int")

    # Where each bucket starts within its shard.
    counts = narrow.groupBy("shard", part.alias("part")).agg(F.count("*").alias("rows"))
    before = F.expr(
        "sum(rows) OVER (PARTITION BY shard ORDER BY part "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    starts = counts.select("shard", "part", F.coalesce(before, F.lit(0)).alias("start"))

    scattered = placed.withColumns(
        {"part": part, "grown_shard": best_shard(key, shards + 1, seed)}
    ).repartition(PLACES * shards * parts, "shard", "part")
    schema = StructType([*scattered.schema.fields]).add("slot", LongType())

    def shuffle(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left.append_column("slot", pa.array([], pa.int64()))
        shard_no, part_no = left["shard"][0].as_py(), left["part"][0].as_py()
        # A fixed order first, so that reruns agree whatever order the records came in.
        keys = [(c, "ascending") for c in (id_column, "text_crc32", "size")]
        left = left.take(pc.sort_indices(left, sort_keys=keys))
        left = left.take(pa.array(fisher_yates(left.num_rows, [seed, shard_no, part_no])))
        give_back()
        start = right["start"][0].as_py()
        return left.append_column(
            "slot", pa.array(np.arange(start, start + left.num_rows), pa.int64())
        )

    path = fresh_path(spark, "shards")
    buckets = scattered.groupBy("shard", "part")
    buckets.cogroup(starts.groupBy("shard", "part")).applyInArrow(shuffle, schema).write.partitionBy(
        "shard"
    ).parquet(path)
    written = StructType([f for f in schema.fields if f.name != "shard"]).add("shard", IntegerType())
    return spark.read.schema(written).parquet(path).drop("part")

