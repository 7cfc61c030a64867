"""Mixing sources to target weights, by blocks of fixed length.

The words of each source, its documents in seeded order, are packed into blocks of
``block_words``. A source's target gives it a number of slots; each slot draws its output shard
by a seeded hash, so that the counts of a source over the shards are one multinomial draw. Slot
k of a source maps to block (a*k + b) mod n, a permutation of the source's n blocks that repeats
only after all n; slots and blocks are joined by source and block number.

Defined cases: a NULL text has no words, a text without words is never taken; a NULL source is
a source of its own and sorts last; NULL and repeated ids are documents like any other; without
any word all targets are 0. Columns other than id, text and source are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARDS = 24
# Multipliers of the permutations: primes, of which at least one does not divide n. With
# numbers of blocks below 9 * 10^11 no product leaves 64 bits.
PRIMES = (9_999_991, 9_999_973, 9_999_971)
# Slots are generated in two steps of at most so many, not as one array per source.
STEP = 65_536
# Fractions of documents are added up exactly, in whole numbers of 1 / UNIT.
UNIT = 1 << 24


@dataclass
class Mix:
    """``documents``: id, source, size, start (its first word's place in the source);
    ``sources``: source, source_size, target, blocks, slots; ``pieces``: the documents' parts
    of each block; ``slots``: shard and block of each slot."""

    documents: DataFrame
    sources: DataFrame
    pieces: DataFrame
    slots: DataFrame
    block_words: int = BLOCK_WORDS

    def taken_pieces(self) -> DataFrame:
        """The mix itself: for each slot of each shard the pieces of documents that fill it.

        Slots grow with the corpus, though Spark takes them for as few as the sources they
        come from; the hint keeps them from being broadcast.
        """
        filled = self.slots.hint("merge").join(self.pieces, ["key", "block"])
        if "room" not in self.slots.columns:
            return filled
        # The last slot of a source can be cut: what lies before the cut stays.
        kept = F.least(F.col("words"), F.expr(f"room - (start + from - block * {self.block_words})"))
        return filled.withColumn("words", kept).filter("words > 0").withColumn("to", F.expr("from + words")).drop("room")

    def taken(self) -> DataFrame:
        """Each document with ``taken``, the words that the mix takes from it."""
        words = F.sum("words").alias("taken")
        takes = self.taken_pieces().groupBy("key", "start").agg(words)
        documents = self.documents
        some = documents.filter("size > 0").join(takes, ["key", "start"], "left")
        none = documents.filter("size = 0").withColumn("taken", F.lit(None).cast("bigint"))
        both = some.unionByName(none).withColumn("taken", F.coalesce("taken", F.lit(0)))
        sources = self.sources.select("key", "source_size", "target")
        return both.join(sources, "key")


def small_number(text: Column) -> Column:
    """A number below 2^28 from a text."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, block_words: int) -> DataFrame:
    """Target, blocks and slots of each source (``key``, ``source``, ``source_size``).

    Sources share all words by weight. One whose share is above ``MAX_REPEATS`` times its size
    stops there, and the excess is shared again among the others: in order of cap per weight
    the first sources stop at their caps, and the rest get the same level per weight. The
    windows here run over one row per source.
    """
    place = F.expr("row_number() OVER (ORDER BY source ASC NULLS LAST) - 1")
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS)).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * MAX_REPEATS
    )
    order = "(ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN {} AND {})"
    earlier = order.format("UNBOUNDED PRECEDING", "1 PRECEDING")
    later = order.format("CURRENT ROW", "UNBOUNDED FOLLOWING")
    levels = ranked.withColumn(
        "level",
        F.expr(
            f"(sum(source_size) OVER () - coalesce(sum(cap) OVER {earlier}, 0))"
            f" / CAST(sum(weight) OVER {later} AS DOUBLE)"
        ),
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    # The level falls or stays until it fits for the first time, and rises never after.
    first = F.expr("first(fits, true) OVER (ORDER BY cap / weight, source ASC NULLS LAST "
                   "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
    leveled = levels.withColumn("fits", fits).withColumn("common", first)
    target = F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight"))
    return leveled.select(
        "key",
        "source",
        "source_size",
        target.alias("target"),
        F.ceil(F.col("source_size") / block_words).alias("blocks"),
        F.floor(target / block_words + 0.5).alias("slots"),
    )


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 11,
    row_column: str | None = None,
    in_words: bool = False,
) -> Mix:
    """The mix of ``docs``. With ``row_column``, a key of the rows, documents carry it as ``row``,
    and those of one id, or of none, are in seeded order of their texts.

    A target is dealt in whole slots, as if each block were full, or with ``in_words`` to the
    word: so many full passes over the source as fit its target, then slots of one more pass,
    in which the partial block comes last, with the last slot cut.
    """
    keyed = [] if row_column is None else [F.col(row_column).alias("row")]
    order = [F.lit(str(seed)), F.col(id_column).cast("string")]
    if row_column is not None:
        order.append(F.coalesce(F.xxhash64(text_column), F.lit(0)).cast("string"))
    source = F.col(source_column).cast("string")
    sized = stored(
        docs.select(
            F.col(id_column).alias("id"),
            source.alias("source"),
            F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("key"),
            F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0))
            .cast("bigint")
            .alias("size"),
            F.md5(F.concat_ws("|", *order)).alias("h"),
            *keyed,
        ).withColumn("chunk", F.substring("h", 1, 3)),
        "sized",
    )
    # Running sums in two levels: 4,096 chunks of each source, then the rows of a chunk. A
    # source with a third of all rows is spread over all tasks.
    chunks = sized.groupBy("key", "chunk").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    chunks = chunks.withColumn("base", running("words", "key", "chunk"))
    documents = stored(
        sized.join(chunks.select("key", "chunk", "base"), ["key", "chunk"])
        .withColumn("start", F.col("base") + running("size", "key, chunk", "h, id, size"))
        .select("id", "source", "key", "size", "start", *(["row"] if keyed else [])),
        "started",
    )
    sizes = chunks.groupBy("key").agg(F.sum("words").alias("source_size"))
    named = F.when(F.col("key") != "n", F.expr("substring(key, 2)"))
    sources = source_targets(sizes.withColumn("source", named), block_words)
    if in_words:
        rest = F.expr("CAST(round(target) AS BIGINT) % source_size")
        passes = F.expr("CAST(round(target) AS BIGINT) div source_size")
        dealt = passes * F.col("blocks") + F.ceil(rest / block_words)
        sources = sources.withColumns(
            {
                "slots": F.when(F.col("source_size") > 0, dealt).otherwise(F.lit(0).cast("bigint")),
                "cut": F.when(F.col("source_size") > 0, rest % block_words),
            }
        )
    sources = stored(sources, "sources")

    last = F.expr(f"(start + size - 1) div {block_words}")
    first = F.expr(f"start div {block_words}")
    block = F.col("block")
    pieces = (
        documents.filter("size > 0")
        .select("*", F.explode(F.sequence(first, last)).alias("block"))
        .withColumn("from", F.greatest(F.lit(0), block * block_words - F.col("start")))
        .withColumn("to", F.least("size", (block + 1) * block_words - F.col("start")))
        .select("key", "block", "id", "start", "from", "to", (F.col("to") - F.col("from")).alias("words"))
    )
    multiplier = F.coalesce(
        *[F.when(F.col("blocks") % p != 0, F.lit(p)) for p in PRIMES]
    ).cast("bigint")
    shift = small_number(F.concat_ws("|", F.lit(str(seed)), F.col("key")))
    steps = sources.filter("slots > 0").select(
        "key",
        "blocks",
        "slots",
        multiplier.alias("a"),
        shift.alias("b"),
        *(["cut"] if in_words else []),
        F.explode(F.expr(f"sequence(0L, (slots - 1) div {STEP})")).alias("step"),
    )
    numbers = F.expr(f"sequence(step * {STEP}, least((step + 1) * {STEP}, slots) - 1)")
    room = F.when((F.col("slot") == F.col("slots") - 1) & (F.col("cut") > 0), F.col("cut"))
    numbered = steps.repartition("key", "step").select("*", F.explode(numbers).alias("slot"))
    if in_words:
        numbered = numbered.withColumn("room", F.coalesce(room, F.lit(block_words).cast("bigint")))
    turn = F.col("slot") % F.col("blocks")
    # The partial block is the last one of the source; this order ends each pass with it.
    place = F.col("a") * (turn + 1) + F.col("blocks") - 1 if in_words else F.col("a") * turn + F.col("b")
    drawn = small_number(F.concat_ws("|", F.lit(str(seed)), F.col("key"), F.col("slot").cast("string")))
    slots = numbered.select(
        "key",
        "slot",
        (drawn % shards).cast("int").alias("shard"),
        (place % F.col("blocks")).alias("block"),
        *(["room"] if in_words else []),
    )
    return Mix(documents, sources, pieces, slots, block_words)


def running(column: str, keys: str, order: str) -> Column:
    """The sum of the rows before this one."""
    return F.expr(
        f"coalesce(sum({column}) OVER (PARTITION BY {keys} ORDER BY {order} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )


def slot_counts(mix: Mix) -> DataFrame:
    """The multinomial draw: slots of each source in each shard."""
    return mix.slots.groupBy("shard", "key").agg(F.count("*").alias("slots"))


def whole_copies(taken: DataFrame, seed: int = 11) -> DataFrame:
    """``taken`` with ``copies``, how often each document is repeated as a whole (0 to 3 times).

    A document's rate, taken / size, is rounded up or down without bias: along the documents of
    a source, in order of their lengths, the fractions add up from a seeded start, and each
    whole number passed is one copy more. Neighbours are alike in length, so that the copies of
    a source have about the words that the mix takes from it.
    """
    size_class = F.when(F.col("size") > 0, F.floor(F.log2("size") * 4)).otherwise(F.lit(-1))
    part = F.coalesce(F.expr(f"(taken % size) * {UNIT}L div size"), F.lit(0).cast("bigint"))
    rows = taken.withColumns(
        {
            "class": size_class,
            "piece": F.pmod(F.xxhash64("key", "start"), F.lit(64)),
            "part": F.when(F.col("size") > 0, part).otherwise(F.lit(0).cast("bigint")),
        }
    )
    rows = stored(rows, "rates")
    # Two levels again, as a source can have a third of all rows.
    sums = rows.groupBy("key", "class", "piece").agg(F.sum("part").alias("parts"))
    sums = sums.withColumn("earlier", running("parts", "key", "class, piece")).drop("parts")
    shift = small_number(F.concat_ws("|", F.lit(f"{seed}|copies"), F.col("key"))) % UNIT
    placed = rows.join(sums, ["key", "class", "piece"]).withColumn(
        "before", F.col("earlier") + running("part", "key, class, piece", "start, size") + shift
    )
    copies = F.expr(f"(before + part) div {UNIT}L - before div {UNIT}L + coalesce(taken div nullif(size, 0), 0)")
    return placed.withColumn("copies", copies.cast("int")).select(*taken.columns, "copies")


def repeat_documents(docs: DataFrame, taken: DataFrame, row_column: str) -> DataFrame:
    """Whole documents, each as often as ``whole_copies`` says, without ``row_column``.

    ``row_column`` tells the rows of ``docs`` apart, and ``taken`` has it as ``row``; ids, which
    can be NULL or repeated, play no part.
    """
    rates = whole_copies(taken).filter("copies > 0").select("row", "copies")
    joined = docs.join(rates, docs[row_column] == F.col("row"))
    return joined.select(
        *[docs[c] for c in docs.columns if c != row_column],
        F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"),
    ).drop("_copy")
