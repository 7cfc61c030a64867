"""Row joins whose hot keys are spread by design, whatever adaptive execution does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it has more than one in so many of all rows. Fewer than so many keys can be
# hot, whatever the size of the table, which bounds the broadcast of the hot keys.
HOT_SHARE = 1000
# Pieces of all rows for each shuffle partition: pieces are dealt by hash, so that several small
# ones fill partitions more evenly than one large one.
PIECES = 8


def hot_keys(facts: DataFrame, on: str, share: int = HOT_SHARE) -> DataFrame:
    """``on`` and ``_pieces``, the pieces to cut its rows into, for each hot key.

    Counts the rows per key, which combines on the map side and reads only the column of the key.
    """
    spark = facts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = facts.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_rows"))
    total = facts.count()
    pieces = F.ceil(F.col("_rows") * F.lit(PIECES * parts) / F.lit(max(total, 1)))
    return counts.filter(F.col("_rows") * share > total).select(on, pieces.cast("int").alias("_pieces"))


def join_hot_records(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    row_key: Sequence[str],
    how: str = "inner",
    share: int = HOT_SHARE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of facts, of which one key may have a large share, with few rows per key of a lookup.

    The rows of a hot key are cut into pieces by a hash of ``row_key``, which tells facts apart, and
    the rows of the lookup are repeated for each piece of their key: at most ``PIECES`` times the
    shuffle partitions and one for each hot key, over all keys. All else is dealt by the key alone.
    A task that is run again deals its rows as before. Keys are counted in ``counted`` if ``facts`` take
    work to make, such as another join; it only has to have about their keys. ``how`` is ``inner`` or ``left``; facts without
    a key have no partner and are spread as well.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"{how} joins repeat rows of the lookup that have no partner")
    hot = hot_keys(facts if counted is None else counted, on, share)
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = F.when(F.col(on).isNull(), PIECES * parts).otherwise(F.coalesce("_pieces", F.lit(1)))
    # Fewer than ``share`` keys.
    few = F.broadcast(hot)
    cut = facts.join(few, on, "left").withColumn("_piece", F.pmod(F.xxhash64(*row_key), pieces).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    repeated = lookup.join(few, on, "left").withColumn("_piece", copies)
    return cut.drop("_pieces").join(repeated.drop("_pieces"), [on, "_piece"], how).drop("_piece")
