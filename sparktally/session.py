"""Session settings shared by the runner, the benchmark and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Results must not depend on the zone of the machine.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: merges small shuffle partitions, splits the hot ones of a
    # join and turns a join into a broadcast one once the real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A session that runs many reports should compile the code of each only once.
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def build_session(
    name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the settings above.

    ``shuffle_partitions`` is the number before adaptive merging. On a cluster aim at
    128-256 MB of shuffle data per partition at the widest exchange (about 8,000 per TB
    shuffled); adaptive execution merges what turns out smaller.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
