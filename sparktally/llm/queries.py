"""The opN queries over the tables of a folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.llm.bpe import decode, encode, read_vocabulary
from sparktally.llm.collocations import collocations
from sparktally.llm.common import ascii_lower, table
from sparktally.llm.decontamination import find_hits, hit_words
from sparktally.llm.exact_dedup import new_index
from sparktally.llm.html_extraction import extract_text
from sparktally.llm.line_dedup import repeated_lines
from sparktally.llm.merkle import Manifest, leaf_digest
from sparktally.llm.mixing import mix_sources
from sparktally.llm.quality import score_quality
from sparktally.llm.sharding import shard_records
from sparktally.llm.simhash import near_duplicates
from sparktally.llm.toxicity import score_toxicity
from sparktally.llm.warc import new_archive


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = new_archive(spark)
    archive.write(table(spark, folder, "pages"), "page_id", "url", "html")
    return archive.records().select(
        F.col("id").alias("page_id"),
        F.length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return new_index(spark).deduplicate(documents, "doc_id", "text").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return shard_records(documents).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every line to remove."""
    return repeated_lines(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = extract_text(table(spark, folder, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return score_quality(documents, labels).withColumnRenamed("id", "doc_id")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mix_sources(table(spark, folder, "documents"), in_words=True)
    return mix.taken().select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(
        F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id"
    )


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = find_hits(documents, items, keep=["doc_id"])
    listed = F.array_join(F.array_sort("hit_items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.size("hit_from") > 0).alias("contaminated"),
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = score_toxicity(documents, labels, keep=["doc_id"])
    return found.select("doc_id", "held_out", "score", "predicted")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    vocabulary = read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = encode(documents, vocabulary, public_tokenizers.PATTERN, keep=["doc_id"])
    return decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    documents = table(spark, folder, "documents").select(*names)
    *fields, text = [F.col(name) for name in names]
    # A fifth of the texts, by id, is tampered with.
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = documents.select(
        F.col("doc_id").cast("bigint").alias("id"),
        "source",
        leaf_digest([*fields, text]).alias("leaf"),
        F.when(tampered, leaf_digest([*fields, ascii_lower(text)])).alias("offered"),
    )
    return Manifest(leaves).proofs("offered").withColumnRenamed("id", "doc_id")


LLM_QUERIES = {
    "op1_warc": op1_warc,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_sharding": op3_sharding,
    "op4_simhash": op4_simhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_bpe": op12_bpe,
    "op13_merkle": op13_merkle,
}
