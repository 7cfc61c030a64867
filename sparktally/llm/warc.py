"""Content-addressed WARC archive.

An archive is two Parquet tables. ``payloads`` stores the bytes of each distinct payload once,
bucketed and sorted by SHA-256; ``headers`` stores every record's exact header block. Records
are rebuilt by a join on the digest, and every payload is verified against its digest and
length as it is read. Equal payloads of at least ``min_revisit_bytes`` are one response, that
with the smallest id, and revisits that refer to it.

Defined cases: a NULL payload is empty; payloads below the minimum are all responses, but are
stored once as well. A NULL id is the smallest only among NULL ids. Rows repeated with the same
id and payload are records of their own and, if they are the smallest, all responses. A later
batch stores only payloads that the archive lacks, and its records of a payload with an earlier
response are revisits to that. One writer at a time. A NULL
URI gives a header without WARC-Target-URI. An empty table gives an empty archive. Columns
other than id, URI and payload are not read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktally.llm.common import HOT_SHARE, attach, fresh_path, shuffle_partitions, stored

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2026-01-01T00:00:00Z"
EOL = "\r\n"


def record_urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def header_block(uri: Column, date: str) -> Column:
    """The header lines of a record, each ended by CR LF, without the blank line.

    Reads the columns ``id``, ``digest``, ``bytes``, ``record_type`` and ``refers_to``.
    """
    revisit = F.col("record_type") == "revisit"
    digest = F.lower(F.hex("digest"))
    clean = F.regexp_replace(uri, r"[\r\n]", "")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))

    return F.concat_ws(
        "",
        F.lit("WARC/1.1" + EOL),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_urn(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        F.when(revisit, line("WARC-Refers-To", record_urn(F.col("refers_to")))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
    )


class Archive:
    """The archive in a folder; ``buckets`` is fixed when it is first written."""

    def __init__(self, spark: SparkSession, path: str, buckets: int) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.name = f"warc_payloads_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, bytes BIGINT, copies BIGINT, "
            "payload BINARY) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
            f"INTO {buckets} BUCKETS LOCATION '{self.path}/payloads'"
        )

    def payloads(self) -> DataFrame:
        """Stored payloads, each verified: bytes that do not match their digest fail the job."""
        right = (F.sha2("payload", 256) == F.lower(F.hex("digest"))) & (
            F.length("payload") == F.col("bytes")
        )
        fail = F.raise_error(F.concat(F.lit("damaged payload "), F.hex("digest")))
        checked = F.when(right, F.col("payload")).otherwise(fail.cast("binary"))
        return self.spark.table(self.name).withColumn("payload", checked)

    def headers(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/headers")

    def responses(self, min_bytes: int) -> DataFrame | None:
        """``digest``, ``earlier_id`` and ``earlier_seen`` of payloads with a response; None at first."""
        try:
            headers = self.headers()
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        first = headers.filter((F.col("record_type") == "response") & (F.col("bytes") >= min_bytes))
        named = first.groupBy("digest").agg(F.min("id").alias("earlier_id"))
        return stored(named.withColumn("earlier_seen", F.lit(True)), "responses")

    def write(
        self,
        pages: DataFrame,
        id_column: str,
        uri_column: str,
        payload_column: str,
        min_revisit_bytes: int = 100,
        date: str = WARC_DATE,
    ) -> None:
        """Adds one record per row. The payload is text, kept in UTF-8.

        A write that failed can be repeated: it leaves payloads at most, which are not stored again.
        """
        earlier = self.responses(min_revisit_bytes)
        payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
        rows = pages.select(
            F.col(id_column).alias("id"),
            F.col(uri_column).cast("string").alias("uri"),
            F.unhex(F.sha2(payload, 256)).alias("digest"),
            F.length(payload).cast("bigint").alias("bytes"),
            payload.alias("payload"),
        )
        # Equal payloads meet on the map side first: a payload that a third of the pages share
        # is moved once per task.
        once = rows.groupBy("digest").agg(
            F.first("bytes").alias("bytes"),
            F.count("*").alias("copies"),
            F.first("payload").alias("payload"),
        )
        stored_before = self.spark.table(self.name).select("digest")
        if not stored_before.isEmpty():
            once = once.join(stored_before.hint("merge"), "digest", "left_anti")
        once.repartition(self.buckets, "digest").write.bucketBy(self.buckets, "digest").sortBy(
            "digest"
        ).option("compression", "zstd").format("parquet").mode("append").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

        narrow = stored(rows.drop("payload"), "records")
        firsts = narrow.groupBy("digest").agg(
            F.min("id").alias("first_id"), F.count("*").alias("copies")
        ).withColumn("seen", F.lit(False))
        if earlier is not None:
            seen = F.col("earlier_seen").isNotNull()
            firsts = firsts.join(earlier, "digest", "left").select(
                "digest",
                F.when(seen, F.col("earlier_id")).otherwise(F.col("first_id")).alias("first_id"),
                "copies",
                seen.alias("seen"),
            )
        total = narrow.count()
        records = attach(narrow, stored(firsts, "firsts"), "digest", "copies", total)
        other = F.col("seen") | ~F.col("id").eqNullSafe(F.col("first_id"))
        again = (F.col("bytes") >= min_revisit_bytes) & other
        typed = records.withColumns(
            {
                "record_type": F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
                "refers_to": F.when(again, F.col("first_id")),
                "hot": F.col("copies") * HOT_SHARE > F.lit(total),
            }
        )
        typed.select(
            "id",
            "digest",
            "bytes",
            "record_type",
            "refers_to",
            "copies",
            "hot",
            header_block(F.col("uri"), date).alias("header"),
        ).write.mode("append").parquet(f"{self.path}/headers")

    def records(self) -> DataFrame:
        """Every record with its header block and its full payload, revisits included.

        Payloads are read bucket by bucket and not shuffled; the narrow headers go to them.
        Payloads of hot digests (fewer than ``HOT_SHARE`` a batch) are dealt to several tasks instead.
        """
        headers, payloads = self.headers(), self.payloads().select("digest", "copies", "payload")
        cold = headers.filter(~F.col("hot")).drop("copies")
        merged = cold.join(payloads.drop("copies").hint("merge"), "digest")

        pieces = 64
        salted = headers.filter("hot").drop("copies").withColumn(
            "salt", F.pmod(F.xxhash64("id", "header"), F.lit(pieces))
        )
        hot_digests = headers.filter("hot").select("digest").distinct()
        copies = (
            payloads.drop("copies")
            .join(F.broadcast(hot_digests), "digest", "left_semi")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)).cast("array<bigint>")))
        )
        dealt = salted.join(copies.hint("merge"), ["digest", "salt"]).drop("salt")
        return merged.unionByName(dealt).drop("hot")

    def record_bytes(self) -> DataFrame:
        """``id`` and ``record``: each record as it stands in a WARC file.

        Header block, blank line, payload (none for a revisit) and two line ends.
        """
        body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
        ends = F.lit((EOL + EOL).encode())
        record = F.concat(F.col("header").cast("binary"), F.lit(EOL.encode()), body, ends)
        return self.records().select("id", record.alias("record"))


def new_archive(spark: SparkSession) -> Archive:
    """An empty archive in the shared folder, with as many buckets as the session's shuffles."""
    return Archive(spark, fresh_path(spark, "warc"), shuffle_partitions(spark))
