"""A corpus pipeline: reject toxic texts, drop near duplicates, decontaminate, mix, shard.

Each stage takes (session, documents, table folder) and returns the documents it keeps with
their columns as they were; the last one adds shard and slot. Every stage's result is written
to the shared folder and read back as the next one's input. No SQL expresses the whole (the
first two stages cannot be); ``tests/llm`` checks each stage against its definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.llm.common import stored, table
from sparktally.llm.decontamination import clean_documents
from sparktally.llm.mixing import mix_sources, repeat_documents
from sparktally.llm.sharding import shard_records
from sparktally.llm.simhash import near_duplicates
from sparktally.llm.toxicity import score_toxicity

ORACLE_SQL = None


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents under names that no operator uses for its own, and those names."""
    names = {name: f"c{i}_{name}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def given_back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(f"`{ours}`").alias(name) for name, ours in names.items()])


def reject_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score is below the limit.

    Each row is judged by itself: those repeated or without an id like any other. NULL and empty
    texts get the score of no words; texts of any length are read whole.
    """
    mine, names = set_apart(docs)
    labels = table(spark, folder, "labels").withColumnRenamed("doc_id", names["doc_id"])
    found = score_toxicity(mine, labels, names["doc_id"], names["text"])
    return given_back(found.filter("predicted = 0"), names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; documents without an id stay.

    Groups are the components of fingerprints of three-word shingles within three bits. Rows are grouped by a key of their own: rows with one id but different texts are documents
    like any other, those equal in id and text are copies. Among rows of a group with one id
    the order of a hash of their texts decides. NULL and empty texts are copies of each other.
    """
    mine, names = set_apart(docs)
    doc_id, text = names["doc_id"], names["text"]
    # Stored, so that a row has the same key each time it is read.
    keyed = stored(mine.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    named = keyed.filter(F.col(doc_id).isNotNull())
    groups = near_duplicates(named, id_column="_row", text_column=text)
    order = named.select("_row", F.struct(doc_id, F.xxhash64(text), "_row").alias("order"))
    firsts = groups.join(order, groups["id"] == order["_row"]).groupBy("component_id")
    kept = firsts.agg(F.min("order").alias("first")).select(F.col("first._row").alias("_row"))
    left = named.join(kept, "_row", "left_semi").unionByName(keyed.filter(F.col(doc_id).isNull()))
    return given_back(left, names)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without any window of the benchmark; those without words stay.

    Each row is judged by itself, whatever its id; texts of any length are read whole.
    """
    mine, names = set_apart(docs)
    found = clean_documents(mine, table(spark, folder, "benchmark"), text_column=names["text"])
    return given_back(found, names)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, rounded without bias; ids can be NULL.

    Documents without words are taken by no mix. Rows are told apart by a key of their own.
    """
    mine, names = set_apart(docs)
    # Stored, so that a row has the same key each time it is read.
    keyed = stored(mine.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    mixed = mix_sources(
        keyed, names["doc_id"], names["text"], names["source"], row_column="_row", in_words=True
    )
    return given_back(repeat_documents(keyed, mixed.taken(), "_row"), names)


def shard(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents in shards, in seeded random order.

    Repeated rows, and those without an id or a text, are records like any other. Columns named
    like one that sharding adds (``size``, ``text_crc32``, ``shard``, ``slot``, ``grown_shard``) are
    replaced by it.
    """
    return shard_records(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
