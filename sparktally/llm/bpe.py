"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

A vocabulary maps byte strings to ranks, a pattern cuts text into pieces (pre-tokens), and each piece
is encoded by itself. Pieces depend on what comes before them only through where they start: if
the cuts of two overlapping chunks meet in one place, they agree from there on. So a long text is
dealt in chunks that overlap; each chunk is cut on its own, in parallel; cuts of neighbours are
stitched at a place that both have, and each chunk then encodes the pieces between its two
stitches. A text of at most ``CHUNK`` characters is one chunk, encoded where it is read.

Cuts close to the end of a chunk may be due to the end, not to the text, and are not used
(``GUARD``). Where neighbours have no cut in common, as within a single piece longer than the
overlap, the document is encoded as a whole, in one task: exact, but not in parallel.

Decoding joins the bytes of the ids.

Defined cases: NULL and empty texts have no tokens. Rows may repeat and ids be NULL: rows are kept
apart by a key of their own. Special tokens are ordinary text. Very long texts are whole: nothing
is cut off. Columns of documents named like a result column (``ids``, ``decoded``) are replaced.
An empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from sparktally.llm.common import stored

# Characters of a chunk, and how many of the next chunk's it also holds.
CHUNK = 32_768
OVERLAP = 2_048
# Characters that a cut may have looked beyond itself: three of a contraction, one of white space.
GUARD = 4
# Pieces whose ids a worker remembers, some 300 bytes each.
REMEMBERED = 1 << 17
# Bytes of text, or of ids, that a worker holds as Python objects at once, besides one row.
PORTION = 1 << 19

OVERLAPS = "_row bigint, _chunk int, start bigint, head array<bigint>, tail array<bigint>"


def read_vocabulary(path: str) -> bytes:
    """The file of ranks, a line with a token in base64 and its rank each; read on the driver."""
    with open(path, "rb") as file:
        return file.read()


@functools.lru_cache(maxsize=4)
def ranks_of(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}


class Codec:
    """Encodes pieces one by one, and remembers the frequent ones."""

    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        self.pieces = regex.compile(pattern).findall
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(vocabulary), special_tokens={})
        # A piece by itself: the encoding would cut it again, by what follows it.
        self.encode_piece = functools.lru_cache(maxsize=REMEMBERED)(encoding._encode_single_piece)

    def ids(self, pieces: list[str]) -> list[int]:
        return list(itertools.chain.from_iterable(map(self.encode_piece, pieces)))


@functools.lru_cache(maxsize=2)
def codec(vocabulary: bytes, pattern: str) -> Codec:
    """One per worker, whatever the number of its tasks."""
    return Codec(vocabulary, pattern)


@functools.lru_cache(maxsize=4)
def token_bytes(vocabulary: bytes) -> pa.Array:
    """The bytes of each id; ids without any are empty."""
    ranks = ranks_of(vocabulary)
    found = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        found[rank] = token
    return pa.array(found, pa.large_binary())


def portions(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``PORTION`` bytes of a column of texts or lists of int."""
    values = batch.column(column)
    is_list = pa.types.is_list(values.type)
    sizes = pc.fill_null(pc.list_value_length(values) if is_list else pc.binary_length(values), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64) * (4 if is_list else 1))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PORTION, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def cuts_of(pieces: list[str], start: int) -> np.ndarray:
    """Where each piece starts, and the end of the last one."""
    return start + np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])


def chunk_starts(length: int, chunk: int) -> range:
    return range(0, max(length, 1), chunk)


def stitches(chunks: list[tuple[int, list[int], list[int]]]) -> list[int] | None:
    """Where each chunk takes over from the one before, from (start, head, tail) of each.

    ``tail`` has the cuts in the part that the next chunk holds as well, ``head`` those in the
    part that the chunk before holds. None if two neighbours have no cut in common.
    """
    taken = [chunks[0][0]]
    for (_, _, tail), (_, head, _) in itertools.pairwise(chunks):
        common = set(head).intersection(tail)
        # The chunk before is right from its own stitch on.
        common = {cut for cut in common if cut >= taken[-1]}
        if not common:
            return None
        taken.append(min(common))
    return taken


def encode(
    docs: DataFrame,
    vocabulary: bytes,
    pattern: str,
    text_column: str = "text",
    keep: list[str] | None = None,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The columns ``keep`` of the documents (all by default) with ``ids``, an array of int."""
    keep = [c for c in docs.columns if c != "ids" and (keep is None or c in keep)]
    schema = StructType([*[docs.schema[c] for c in keep], StructField("ids", ArrayType(IntegerType()))])
    is_long = F.coalesce(F.length(text_column) > chunk, F.lit(False))
    carried = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)], F.col(text_column).alias("_text"))
    columns = [f"_c{i}" for i in range(len(keep))]
    flat_schema = StructType([StructField(f"_c{i}", schema[c].dataType) for i, c in enumerate(keep)] + [schema["ids"]])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(vocabulary, pattern)
        for part in (part for batch in batches for part in portions(batch, "_text")):
            ids = [found.ids(found.pieces(text.as_py() or "")) for text in part.column("_text")]
            arrays = [*[part.column(c) for c in columns], pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "ids"])

    short = carried.filter(~is_long).mapInArrow(whole, flat_schema)

    # Long texts: chunks in a table of their own, under a key of their row.
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                starts = chunk_starts(len(text), chunk)
                # A portion of chunks at a time.
                for some in itertools.batched(starts, max(1, PORTION // chunk), strict=False):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "_row": pa.array([row] * len(some), pa.int64()),
                            "_chunk": pa.array([s // chunk for s in some], pa.int32()),
                            "_chunks": pa.array([len(starts)] * len(some), pa.int32()),
                            "start": pa.array(some, pa.int64()),
                            "text": pa.array([text[s : s + chunk + overlap] for s in some], pa.string()),
                        }
                    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(vocabulary, pattern)
        for batch in batches:
            heads, tails = [], []
            for start, text in zip(batch.column("start").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                cuts = cuts_of(found.pieces(text), start)
                sure = cuts[cuts <= start + len(text) - GUARD]
                heads.append(sure[sure < start + overlap])
                tails.append(sure[sure >= start + chunk])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("_row", "_chunk", "start")]
                + [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)],
                names=["_row", "_chunk", "start", "head", "tail"],
            )

    def stitch(table: pa.Table) -> pa.Table:
        rows = table.sort_by("_chunk").to_pylist()
        taken = stitches([(r["start"], r["head"], r["tail"]) for r in rows])
        froms = taken or [None] * len(rows)
        upto = [*froms[1:], None]
        return pa.table(
            {
                "_row": pa.array([r["_row"] for r in rows], pa.int64()),
                "_chunk": pa.array([r["_chunk"] for r in rows], pa.int32()),
                "_from": pa.array(froms, pa.int64()),
                "_upto": pa.array(upto, pa.int64()),
            }
        )

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(vocabulary, pattern)
        for part in (part for batch in batches for part in portions(batch, "text")):
            ids = []
            for row in part.select(["start", "text", "_from", "_upto"]).to_pylist():
                pieces = found.pieces(row["text"][row["_from"] - row["start"] :])
                if row["_upto"] is not None:
                    # The stitch is a cut of this chunk as well.
                    pieces = pieces[: int(np.searchsorted(cuts_of(pieces, row["_from"]), row["_upto"]))]
                ids.append(found.ids(pieces))
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), part.column("_chunk"), pa.array(ids, pa.list_(pa.int32()))],
                names=["_row", "_chunk", "ids"],
            )

    keyed = stored(carried.filter(is_long).withColumn("_row", F.monotonically_increasing_id()), "bpe-long")
    chunks = stored(
        keyed.select("_row", "_text").mapInArrow(
            deal, "_row bigint, _chunk int, _chunks int, start bigint, text string"
        ),
        "bpe-chunks",
    )
    # What neighbours are compared by: the cuts in their overlaps, a few KB a chunk.
    overlaps = chunks.select("_row", "_chunk", "start", "text").mapInArrow(cut, OVERLAPS)
    places = stored(
        overlaps.groupBy("_row").applyInArrow(stitch, "_row bigint, _chunk int, _from bigint, _upto bigint"),
        "bpe-stitches",
    )
    stitched = chunks.join(places.filter("_from IS NOT NULL"), ["_row", "_chunk"])
    encoded = stitched.select("_row", "_chunk", "start", "text", "_from", "_upto").mapInArrow(
        encode_chunks, "_row bigint, _chunk int, ids array<int>"
    )
    # As many ids meet in a row as the row has itself.
    joined = encoded.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_chunk", "ids"))).alias("parts"))
    joined = joined.select("_row", F.flatten(F.col("parts.ids")).alias("ids"))
    long = keyed.drop("_text").join(joined, "_row").select(*columns, "ids")
    unstitched = places.filter("_from IS NULL").select("_row").distinct()
    rest = keyed.join(unstitched, "_row", "left_semi").select(*columns, "_text").mapInArrow(whole, flat_schema)
    everything = short.unionByName(long).unionByName(rest)
    return everything.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)], "ids")


def decode(rows: DataFrame, vocabulary: bytes, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``decoded``, the bytes of their ``ids``."""
    keep = [c for c in rows.columns if c != "decoded" and (keep is None or c in keep)]
    schema = StructType([*[rows.schema[c] for c in keep], StructField("decoded", BinaryType())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(vocabulary)
        for part in (part for batch in batches for part in portions(batch, "_ids")):
            ids = part.column("_ids")
            sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pa.int64())
            lists = pa.LargeListArray.from_arrays(offsets, tokens.take(ids.flatten()))
            decoded = pc.binary_join(lists, pa.scalar(b"", pa.large_binary())).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], decoded], names=[*keep, "decoded"])

    return rows.select(*keep, F.col("ids").alias("_ids")).mapInArrow(joined, schema)
