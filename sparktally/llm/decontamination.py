"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window_words`` consecutive words of an item; a shorter item is one window. Its tokens
are its shingles of ``shingle_words`` words (all of its words, if it has fewer), ordered by rarity,
counted over all documents. Full containment makes the rarest shingle of a window its necessary
prefix: a document can hold the window only where it has that shingle, and nowhere if no document
has it. Places of documents with such a shingle are joined with the offsets and lengths of the
windows that it is the prefix of. The offset gives the place where a window would start (positional
bound), which must lie within the document (length bound); the words there are then joined with the
windows as text, which is the exact check.

Documents are read twice in place; what is shuffled are counts of shingles, and places with the words
around them. A bitmap of fixed size, the only thing that goes to all tasks, keeps most places back whose shingle
is none of the benchmark's; what it lets through by chance finds no partner in the join. Both
joins cut hot shingles and hot windows into pieces.

Defined cases: NULL and empty texts have no words and no hits; items without words have no
windows. Items with a NULL id mark words but are not listed. Repeated items and documents count
like any other row. Columns of documents named like a result column are replaced. A very long text
is read whole, by one task, as it is one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sparktally.llm.common import Batches, ascii_lower, lean, stored
from sparktally.operators.hot_keys import join_hot_records

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
# Bits of the bitmap of shingles, in parts of 2^15 as Spark builds them: 2 MB in all.
BITMAP_BITS = 24
PART_BITS = 15
# Texts are taken in portions of so many characters.
PORTION = 4_000_000
# Words after A-Z are in lower case: digits, a-z and everything beyond ASCII.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)
HITS = ["n_words", "hit_from", "hit_to", "hit_items"]
# Odd multipliers for the words of a shingle.
MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
MIX = np.uint64(0xFF51AFD7ED558CCD)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The texts of a batch one by one, so that a batch is never held twice."""
    return (x.as_py() for x in column)


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` words from each place on, as int64."""
    places = len(words) - size + 1
    if places <= 0:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(crc32, words), np.uint64, len(words))
    mixed = np.full(places, size, np.uint64)
    for k in range(size):
        mixed += (hashes[k : k + places] + np.uint64(k + 1)) * np.uint64(MULTIPLIERS[k % len(MULTIPLIERS)])
        mixed ^= mixed >> np.uint64(29)
        mixed *= MIX
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    bits = hashes & (len(bitmap) * 8 - 1)
    return (bitmap[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 != 0


def bitmap_of(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """2^``bits`` bits, those of the lowest bits of the values set; as many rows as it has parts are collected."""
    bit = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    parts = rows.groupBy(F.shiftright(bit, PART_BITS).alias("part")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(F.lit((1 << PART_BITS) - 1))).alias("bits")
    )
    whole = np.zeros(1 << bits - 3, np.uint8)
    size = 1 << PART_BITS - 3
    for row in parts.collect():
        whole[row.part * size : (row.part + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return whole


def item_windows(items: DataFrame, id_column: str, text_column: str, words: int) -> DataFrame:
    """``item`` (as text), ``window`` (its words, joined by spaces) and ``length``, one row per place."""
    found = F.regexp_extract_all(ascii_lower(F.col(text_column)), F.lit(WORD_PATTERN), F.lit(0))
    rows = items.select(F.col(id_column).cast("string").alias("item"), found.alias("words"))
    length = F.least(F.size("words"), F.lit(words))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    windows = F.transform(starts, lambda i: F.array_join(F.slice("words", i, length), " "))
    return rows.filter(F.size("words") > 0).select(
        "item", F.explode(windows).alias("window"), length.alias("length")
    )


def shingles_of_windows(windows: DataFrame, shingle_words: int) -> DataFrame:
    """``window``, ``length``, ``offset`` and ``shingle`` of each distinct window and place in it."""

    def shingles(batches: Batches) -> Batches:
        for batch in batches:
            texts = [text.encode().split(b" ") for text in texts_of(batch["window"])]
            found = [shingle_hashes(words, min(shingle_words, len(words))) for words in texts]
            column = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "shingles"])

    distinct = windows.select("window", "length").distinct()
    listed = distinct.mapInArrow(lean(shingles), "window string, length int, shingles array<long>")
    return listed.select("window", "length", F.posexplode("shingles").alias("offset", "shingle"))


def shingle_counts(docs: DataFrame, text_column: str, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """``shingle`` and ``n``, how often documents have it, for all whose bit is set."""

    def count(batches: Batches) -> Batches:
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for text in texts_of(batch.column(0)):
                words = words_of(text)
                for size in sizes:
                    hashes = shingle_hashes(words, size)
                    found.append(hashes[marked(bitmap, hashes)])
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], names=["shingle", "n"])

    counted = docs.select(text_column).mapInArrow(lean(count), "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n"))


def window_index(windows: DataFrame, shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """Each distinct window that documents may have, with its items, its prefix and the offset of that.

    A window with a shingle that was counted nowhere occurs nowhere.
    """
    ranked = shingles.join(counts, "shingle", "left")
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")
    prefixes = ranked.groupBy("window", "length").agg(F.min(order).alias("rarest"))
    owners = windows.groupBy("window").agg(F.collect_set("item").alias("items"))
    return prefixes.filter(F.col("rarest.n") > 0).join(owners, "window").select(
        "window", "length", "items", F.col("rarest.shingle").alias("prefix"), F.col("rarest.offset").alias("offset")
    )


def places_of_prefixes(
    docs: DataFrame, keep: list[str], text_column: str, bitmap: np.ndarray, sizes: list[int], reach: int
) -> DataFrame:
    """``kept`` (the columns to carry along), ``n_words`` and ``places`` of each document.

    A place has its shingle and the words around it that a window could have, from word ``first`` on.
    """
    around = pa.struct([("place", pa.int32()), ("prefix", pa.int64()), ("first", pa.int32()), ("words", pa.string())])

    def places_in(words: list[bytes]) -> list[tuple]:
        found = []
        for size in sizes:
            hashes = shingle_hashes(words, size)
            for place in np.flatnonzero(marked(bitmap, hashes)).tolist():
                first = max(0, place - reach + 1)
                near = b" ".join(words[first : place + reach]).decode()
                found.append({"place": place, "prefix": int(hashes[place]), "first": first, "words": near})
        return found

    def search(batches: Batches) -> Batches:
        for batch in batches:
            start = held = 0
            lengths, places = [], []
            for row, text in enumerate(texts_of(batch["text"])):
                words = words_of(text)
                lengths.append(len(words))
                places.append(places_in(words))
                held += sum(len(p["words"]) for p in places[-1])
                if held > PORTION or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["kept"].slice(start, len(lengths)),
                            pa.array(lengths, pa.int64()),
                            pa.array(places, pa.list_(around)),
                        ],
                        names=["kept", "n_words", "places"],
                    )
                    start, held, lengths, places = row + 1, 0, [], []

    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text_column).alias("text"))
    place = StructType(
        [
            StructField("place", IntegerType()),
            StructField("prefix", LongType()),
            StructField("first", IntegerType()),
            StructField("words", StringType()),
        ]
    )
    schema = StructType(
        [rows.schema["kept"], StructField("n_words", LongType()), StructField("places", ArrayType(place))]
    )
    return rows.mapInArrow(lean(search), schema)


def occurrences(documents: DataFrame, index: DataFrame) -> DataFrame:
    """``_row``, ``start``, ``end`` and ``items`` of each window in each document."""
    candidates = documents.select("_row", "n_words", F.explode("places").alias("p")).select("_row", "n_words", "p.*")
    shapes = index.select("prefix", "offset", "length").distinct()
    placed = join_hot_records(candidates, shapes, "prefix", ["_row", "place"])
    start = F.col("place") - F.col("offset")
    fitting = placed.withColumn("start", start).withColumn("end", start + F.col("length"))
    fitting = fitting.filter((F.col("start") >= 0) & (F.col("end") <= F.col("n_words")))
    words = F.slice(F.split("words", " "), F.col("start") - F.col("first") + 1, F.col("length"))
    # A document can meet one window by the prefixes of several.
    texts = fitting.select("_row", "start", "end", F.array_join(words, " ").alias("window")).distinct()
    return join_hot_records(
        stored(texts, "windows-of-documents"), index.select("window", "items"), "window", ["_row", "start"]
    ).drop("window")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with those that touch or overlap joined."""
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def merge_spans(batches: Batches) -> Batches:
    """Per document the places where its merged spans begin and end, and its items in order."""
    for batch in batches:
        spans = [merged([(s["start"], s["end"]) for s in row.as_py()]) for row in batch["spans"]]
        items = [sorted(row.as_py()) for row in batch["items"]]
        numbers = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch["_row"],
                pa.array([[start for start, _ in row] for row in spans], numbers),
                pa.array([[end for _, end in row] for row in spans], numbers),
                pa.array(items, pa.list_(pa.string())),
            ],
            names=["_row", *HITS[1:]],
        )


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    keep: list[str] | None = None,
    window_words: int = WINDOW_WORDS,
    shingle_words: int = SHINGLE_WORDS,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """The documents with what they share with the benchmark.

    Adds ``n_words``; ``hit_from`` and ``hit_to``, the word places of the merged hit spans; and
    ``hit_items``, the ids (as text) of the items with occurring windows. ``keep`` names the
    columns of ``docs`` to carry along, all by default. ``bitmap_bits`` is at least 15.
    """
    keep = [c for c in keep or docs.columns if c not in HITS]
    windows = stored(item_windows(items, item_id_column, item_text_column, window_words), "windows")
    shingles = stored(shingles_of_windows(windows, shingle_words), "window-shingles")
    size = F.least("length", F.lit(shingle_words))
    # At most ``shingle_words`` rows.
    sizes = sorted(row[0] for row in windows.select(size).distinct().collect())
    counts = shingle_counts(docs, text_column, bitmap_of(shingles, "shingle", bitmap_bits), sizes)
    index = stored(window_index(windows, shingles, counts), "window-index")
    prefixes = bitmap_of(index, "prefix", bitmap_bits)
    placed = places_of_prefixes(docs, keep, text_column, prefixes, sizes, window_words)
    # Stored, so that a row has the same key each time it is read.
    documents = stored(placed.withColumn("_row", F.monotonically_increasing_id()), "places")
    spans = occurrences(documents, index).groupBy("_row").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    hits = spans.mapInArrow(
        lean(merge_spans), "_row long, hit_from array<int>, hit_to array<int>, hit_items array<string>"
    )
    none = F.array().cast("array<int>")
    return documents.select("_row", "kept", "n_words").join(hits, "_row", "left").select(
        "kept.*",
        "n_words",
        F.coalesce("hit_from", none).alias("hit_from"),
        F.coalesce("hit_to", none).alias("hit_to"),
        F.coalesce("hit_items", F.array().cast("array<string>")).alias("hit_items"),
    )


def hit_words() -> Column:
    """Words inside any hit span."""
    lengths = F.zip_with("hit_from", "hit_to", lambda a, b: (b - a).cast("bigint"))
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda total, n: total + n)


def clean_documents(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """The documents without any window of the benchmark, with their columns as they were.

    Only a key and the text go through Python workers.
    """
    key = "_row"
    while key in docs.columns:
        key = f"_{key}"
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = find_hits(keyed, items, keep=[key], **names)
    hit = found.filter(F.size("hit_from") > 0).select(key)
    return keyed.join(hit, key, "left_anti").select(*docs.columns)
