"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Lines with equal sets are one set, which the first of them
(smallest doc id, then line number) stands for. Two sets match if their Jaccard similarity is
at least 0.8. A line is removed if an earlier line has the same set or one that matches.

Words have one order for all lines: the longest first, as long words are rare, then by hash.
Neighbours in this order make the links of a set. Of two matching sets x and y of n and m words,
a word that only x has breaks two links of x, a word that only y has at most one: (2 n - m) / 3
links of x at most, and as m is at least 0.8 n, no more than 0.4 n. So the sets share one of
their first floor(0.4 n) + 1 and floor(0.4 m) + 1 links, their prefixes (sets of fewer than four
words match no other). Two words that follow each other are far rarer than one.

Sets that share a link are out if their sizes differ too much (length filter), if their parities
(a bit per hash of words, 128 bits for long sets) differ in more bits than matching sets differ in words, or if they
share too few links (count filter): of the set whose prefix ends first in the order, each link
that the other set has is in the other's prefix. What passes is verified on the whole sets of
words, by 64 bits of each; the lines concerned are read again for that.

Links are shuffled once. Those that one set has, nearly all, are counted out; the rows of the
others are sorted by link and place. A set first meets the earliest set of most of its links, and
is closed if they match: one pair per set, however large a group of near copies is. Only pairs
whose later set is open go on, again the one with most links first. Links of few sets are done
within that sort; only the sets of the others are joined.

Defined cases: a NULL text has no lines; lines without words are never removed. Rows with the
same id are one document as far as order goes: lines in the same place do not remove each
other. A NULL id comes first. An empty table gives no rows. Columns other than id and text are
not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktally.llm.common import WORD, attach, shuffles_dropped, stored

COUNTERS = 1 << 18
CLASS_BITS = 5
# The longest word and more, and an id before all others.
LONGEST = (1 << CLASS_BITS) - 1
NO_ID = -(1 << 63)
# Bits of the bitmap that tells which lines verification has to read again, in parts of 2^15 as
# Spark builds them: 8 MB in all, broadcast.
BITMAP_BITS = 26
PART_BITS = 15
# A set meets so many of the sets before it in the sort that finds shared links. Links of few
# enough sets, one more, are done with that; only the others are joined.
BEFORE = 16
# Links are shuffled in so many parts, one after the other, a power of two: the files of one part
# are gone before the next.
PARTS = 8
# Sets of so many words have 128 bits of parity, smaller ones 64.
LONG = 100
# What names a set: 128 bits of its words' hashes and its size.
NAME = ["h1", "h2", "n"]
# White space inside a line other than the space.
SPACES = "\t\x0b\x0c\r"


def lines_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``line_no`` (from 0) and ``line``."""
    return docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.posexplode(F.split(text_column, "\n")).alias("line_no", "line"),
    )


def pieces_of(line: Column) -> Column:
    """The words in order and some empty pieces, in half the time of a pattern for words."""
    odd = F.lit(False)
    for space in SPACES:
        odd = odd | F.contains(line, F.lit(space))
    return F.split(F.when(odd, F.translate(line, SPACES, " " * len(SPACES))).otherwise(line), " ")


def hashes_of(line: Column) -> Column:
    """The set of the words, 64 bits of each."""
    hashes = F.array_distinct(F.transform(pieces_of(line), lambda word: F.xxhash64(word)))
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def frequency_classes(lines: DataFrame) -> list[int]:
    """The class of frequency (powers of two) of each counter, 0 to 31; the counters cover all lines."""
    words = lines.select(F.explode(pieces_of(F.col("line"))).alias("word")).filter("word != ''")
    counter = F.xxhash64("word").bitwiseAND(COUNTERS - 1).cast("int")
    counts = words.groupBy(counter.alias("counter")).agg(F.count("*").alias("n"))
    classes = [0] * COUNTERS
    for row in counts.collect():  # at most COUNTERS rows
        classes[row.counter] = min(row.n.bit_length(), LONGEST)
    return classes


def ordered_keys(line: Column, classes: list[int] | None) -> Column:
    """The set's words as numbers in their order: 5 bits of rank, 58 of hash."""

    def whole(rank: Column, h: Column) -> Column:
        key = F.shiftleft(rank, 63 - CLASS_BITS).bitwiseOR(F.shiftrightunsigned(h, 1 + CLASS_BITS))
        # Never NULL, and declared so: Spark sorts arrays of plain numbers fastest.
        return F.coalesce(key, F.lit(0).cast("bigint"))

    if classes is None:

        def key(word: Column) -> Column:
            rank = LONGEST - F.least(F.octet_length(word), F.lit(LONGEST))
            return whole(rank.cast("bigint"), F.xxhash64(word))

        keys = F.array_distinct(F.transform(pieces_of(line), key))
        return F.sort_array(F.array_remove(keys, key(F.lit(""))))
    # Folded by Spark into one array.
    looked_up = F.split(F.lit(",".join(map(str, classes))), ",").cast("array<bigint>")
    counter = lambda h: h.bitwiseAND(COUNTERS - 1).cast("int")
    return F.sort_array(F.transform(hashes_of(line), lambda h: whole(F.get(looked_up, counter(h)), h)))


def line_sets(
    docs: DataFrame, id_column: str, text_column: str, classes: list[int] | None = None
) -> DataFrame:
    """Lines with words: place, ``h1``, ``h2`` and ``n`` (which name the set), parities, ``prefix``.

    ``classes`` order the words by ``frequency_classes`` instead of length, for one more pass
    over all words.
    """
    lines = lines_of(docs, id_column, text_column).filter(F.col("line").rlike(WORD))
    keyed = lines.withColumn("keys", ordered_keys(F.col("line"), classes))
    n = F.size("keys")

    def link(key: Column, place: Column) -> Column:
        # 32 bits: links that share them give a pair too many, never one too few.
        return F.shiftright(F.xxhash64(key, F.get("keys", place + 1)), 32).cast("int")

    return keyed.select(
        "id",
        "line_no",
        F.xxhash64(F.lit(1), "keys").alias("h1"),
        F.xxhash64(F.lit(2), "keys").alias("h2"),
        F.xxhash64("line").alias("line_hash"),
        n.alias("n"),
        parity("keys", lambda key: F.lit(1).cast("bigint")).alias("parity"),
        F.when(n >= LONG, parity("keys", lambda key: F.shiftright(key, 6).bitwiseAND(1))).alias("half"),
        F.transform(F.slice("keys", F.lit(1), prefix_links(n)), link).alias("prefix"),
    )


def prefix_links(n: Column) -> Column:
    """How many links the prefix of a set of ``n`` words has."""
    return F.when(n < 4, 0).otherwise(F.floor(n * F.lit(2) / F.lit(5)) + 1).cast("int")


def parity(keys: str, times: Callable[[Column], Column]) -> Column:
    """64 bits, each set if an odd number of the keys falls on it; a key counts 0 or 1 times.

    Two sets differ in at least as many words as their parities differ in bits. The bits of keys
    that count and of those that do not differ apart, so parities of both kinds tell more.
    """

    def turned(bits: Column, key: Column) -> Column:
        bit = F.call_function("shiftleft", times(key), key.bitwiseAND(F.lit(63)).cast("int"))
        return bits.bitwiseXOR(bit)

    return F.aggregate(keys, F.lit(0).cast("bigint"), turned)


def alike_enough(left: Callable[[str], Column], right: Callable[[str], Column]) -> Column:
    """The length and parity filters; ``left`` and ``right`` give a set's columns by name."""
    n, m = left("n"), right("n")
    whole, half = (left(bits).bitwiseXOR(right(bits)) for bits in ("parity", "half"))
    apart = F.coalesce(F.bit_count(half) + F.bit_count(whole.bitwiseXOR(half)), F.bit_count(whole))
    return (apart * 9 <= n + m) & (F.least(n, m) * 5 >= F.greatest(n, m) * 4)


def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows twice, with ``l_`` and ``r_`` before the names of their columns."""
    return tuple(rows.select(*[F.col(c).alias(side + c) for c in rows.columns]) for side in ("l_", "r_"))


def prefix_rows(sets: DataFrame) -> DataFrame:
    """A row per set and link of its prefix; ``id`` may be that of the set's first line."""
    place = F.coalesce("id", F.lit(NO_ID)).alias("id")
    return sets.select("set", place, "n", "parity", "half", F.explode("prefix").alias("key"))


def shared_links(rows: DataFrame) -> DataFrame:
    """The links that several ``sets`` have, and of those of two sets the ones that pass the filters.

    Most links have one set, so they are counted in hash tables before anything is sorted.
    """
    totals = rows.groupBy("key").agg(
        F.count("*").alias("sets"),
        F.count("half").alias("halves"),
        F.sum("n").alias("words"),
        F.min("n").alias("least"),
        F.bit_xor("parity").alias("whole"),
        F.bit_xor("half").alias("half"),
        # All columns are read, so that the rows and their totals share one shuffle.
        *[function(c).alias(f"{c}_{function.__name__}") for c in ("set", "id") for function in (F.min, F.max)],
    )
    both = F.bit_count("half") + F.bit_count(F.col("whole").bitwiseXOR(F.col("half")))
    apart = F.when(F.col("halves") == 2, both).otherwise(F.bit_count("whole"))
    alike = (apart * 9 <= F.col("words")) & (F.col("least") * 9 >= F.col("words") * 4)
    some = (F.col("set_min") < F.col("set_max")) & (F.col("id_min") <= F.col("id_max"))
    return totals.filter((F.col("sets") > 1) & some & ((F.col("sets") > 2) | alike)).select("key", "sets")


def sharing_rows(rows: DataFrame) -> DataFrame:
    """The rows whose link several sets have, and the sets that they meet by it.

    ``pivot`` is the earliest set with the link. ``others`` are all those before the row, where
    the sort has them: ``many`` tells that it has not. Both hold only what passes the filters.
    Rows that nothing of this concerns are left out.
    """
    link = Window.partitionBy("key").orderBy("id", "set")
    whole = link.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = rows.repartition("key")
    shared = dealt.join(shared_links(dealt).hint("shuffle_hash"), "key")
    one = F.struct("id", "set", "n", "parity", "half")
    met = shared.withColumn("many", F.col("sets") > BEFORE + 1).withColumn("_first", F.first(one).over(whole))
    met = met.withColumn("_before", F.collect_list(one).over(link.rowsBetween(-BEFORE, -1)))
    is_later = F.col("set") != F.col("_first.set")
    pivot = F.when(is_later & alike_enough(F.col, lambda name: F.col(f"_first.{name}")), F.col("_first.set"))
    others = F.filter("_before", lambda other: ~F.col("many") & alike_enough(F.col, lambda name: other[name]))
    found = met.withColumn("pivot", pivot).withColumn("others", others)
    found = found.filter(F.col("many") | F.col("pivot").isNotNull() | (F.size("others") > 0))
    return found.select(*rows.columns, "many", "pivot", "others")


def pairs_with_first(sharing: DataFrame) -> DataFrame:
    """Each set with the pivot of most of its links: one pair, whatever the size of a group of near copies."""
    met = sharing.filter("pivot IS NOT NULL").groupBy("set", "pivot").agg(F.count("*").alias("c"))
    best = met.groupBy("set").agg(F.max(F.struct("c", "pivot")).alias("best"))
    return best.select(F.col("set").alias("l_set"), F.col("best.pivot").alias("r_set"))


def pairs_with_others(sharing: DataFrame, closed: DataFrame) -> DataFrame:
    """All pairs of sets that pass the filters, but those whose later set is closed."""
    met = sharing.select("set", "id", "n", F.explode("others").alias("other"))
    pairs = met.select(
        # Either may be the later one if both ids are equal.
        F.when(F.col("other.id") < F.col("id"), F.col("set")).alias("later"),
        F.least("set", "other.set").alias("l_set"),
        F.greatest("set", "other.set").alias("r_set"),
        F.when(F.col("set") < F.col("other.set"), F.col("n")).otherwise(F.col("other.n")).alias("l_n"),
        F.when(F.col("set") < F.col("other.set"), F.col("other.n")).otherwise(F.col("n")).alias("r_n"),
    )
    pairs = pairs.join(closed.withColumnRenamed("set", "later"), "later", "left_anti")
    rows = sharing.filter("many").select("set", "id", "n", "parity", "half", "key")
    return in_common(pairs.unionByName(pairs_of_rows(rows, closed)))


def enough_in_common() -> Column:
    """The count filter, on the number ``c`` of prefix links that two sets share."""
    n, m = F.col("l_n"), F.col("r_n")

    def apart(n: Column, m: Column) -> Column:
        return (prefix_links(n) - F.col("c")) * 3 <= n * 2 - m

    return apart(n, m) | apart(m, n)


def in_common(met: DataFrame) -> DataFrame:
    """The pairs that pass the count filter; ``met`` has a row per pair and link."""
    counted = met.groupBy("l_set", "r_set", "l_n", "r_n").agg(F.count("*").alias("c"), F.first("later").alias("later"))
    return counted.filter(enough_in_common()).select("l_set", "r_set", "later", "c")


def pairs_of_rows(rows: DataFrame, closed: DataFrame) -> DataFrame:
    """Pairs of sets by each link they share, but those whose later set is closed."""
    flagged = rows.join(closed.withColumn("closed", F.lit(True)), "set", "left")
    left, right = sides(flagged.withColumn("open", F.col("closed").isNull()).drop("closed"))
    # Either may be the later one if both ids are equal.
    later_open = ((F.col("l_id") <= F.col("r_id")) & F.col("r_open")) | (
        (F.col("r_id") <= F.col("l_id")) & F.col("l_open")
    )
    alike = alike_enough(lambda name: F.col(f"l_{name}"), lambda name: F.col(f"r_{name}"))
    # All conditions read both sides, so that the sides stay the same and share their shuffle.
    met = left.join(
        right,
        (F.col("l_key") == F.col("r_key")) & (F.col("l_set") < F.col("r_set")) & alike & later_open,
    )
    later = F.when(F.col("l_id") < F.col("r_id"), F.col("r_set")).when(
        F.col("r_id") < F.col("l_id"), F.col("l_set")
    )
    return met.select(later.alias("later"), "l_set", "r_set", "l_n", "r_n")


def pairs_by_prefix(sets: DataFrame, closed: DataFrame) -> DataFrame:
    """All pairs of sets that pass the filters, but those whose later set is closed."""
    return in_common(pairs_of_rows(prefix_rows(sets), closed)).select("l_set", "r_set")


def bitmap_of(hashes: DataFrame, name: str) -> DataFrame:
    """2^``BITMAP_BITS`` bits, one set for each hash: parts of 4 KB, those without a bit left out."""
    bit = F.col(name).bitwiseAND((1 << BITMAP_BITS) - 1)
    return hashes.groupBy(F.shiftright(bit, PART_BITS).alias("part")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND((1 << PART_BITS) - 1)).alias("bits")
    )


def may_be_in(rows: DataFrame, name: str, bitmap: DataFrame) -> DataFrame:
    """The rows whose hash has its bit set."""
    bit = F.col(name).bitwiseAND((1 << BITMAP_BITS) - 1)
    parts = rows.withColumn("part", F.shiftright(bit, PART_BITS)).join(F.broadcast(bitmap), "part")
    place = F.shiftright(bit.bitwiseAND((1 << PART_BITS) - 1), 3).cast("int")
    byte = F.conv(F.hex(F.substring("bits", place + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), bit.bitwiseAND(7).cast("int"))
    return parts.filter(byte.bitwiseAND(mask) > 0).drop("part", "bits")


def words_of(
    docs: DataFrame, sets: DataFrame, pairs: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """The words of the sets in ``pairs``, which come from the first line of each."""
    ends = pairs.select(F.col("l_set").alias("set")).union(pairs.select("r_set")).distinct()
    concerned = stored(sets.select("set", "n", "first").join(ends, "set", "left_semi"), "line-concerned")
    lines = lines_of(docs, id_column, text_column).withColumn("line_hash", F.xxhash64("line"))
    again = may_be_in(lines, "line_hash", bitmap_of(concerned.select("first.line_hash"), "line_hash"))
    again = again.select(F.struct("id", "line_no", "line_hash").alias("first"), "line")
    # Several rows may have the place and line of one first.
    found = concerned.join(again, "first").dropDuplicates(["set"])
    spot = F.struct("first.id", "first.line_no").alias("spot")
    return stored(found.select("set", "n", spot, hashes_of(F.col("line")).alias("words")), "line-words")


def matched(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The later ``set`` of each pair that matches."""
    left, right = sides(words)
    common = F.size(F.array_intersect("l_words", "r_words"))
    alike = (
        pairs.join(left, "l_set").join(right, "r_set").filter(common * 9 >= (F.col("l_n") + F.col("r_n")) * 4)
    )
    # Sets whose first lines share a place (in rows with one id) do not remove each other.
    is_left = F.col("r_spot") < F.col("l_spot")
    later = alike.filter(is_left | (F.col("l_spot") < F.col("r_spot"))).select(
        F.when(is_left, F.col("l_set")).otherwise(F.col("r_set")).alias("set")
    )
    return stored(later.distinct(), "line-matches")


def matched_best_first(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """As ``matched``; of each later set first the pair with most links, the others only if that does not match."""
    best = pairs.groupBy("later").agg(F.max(F.struct("c", "l_set", "r_set")).alias("best"))
    by_best = matched(best.select("best.l_set", "best.r_set"), words)
    # Without an earlier id there is no later set yet; those pairs stay.
    others = pairs.join(by_best.withColumnRenamed("set", "later"), "later", "left_anti")
    return by_best.union(matched(others.select("l_set", "r_set"), words))


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``line_no`` and ``reason`` (same or similar) of every line to remove."""
    # Each step stores its rows, so the files of its shuffles need not outlive it.
    with shuffles_dropped(docs.sparkSession):
        return found_lines(docs, id_column, text_column)


def found_lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    lines = stored(line_sets(docs, id_column, text_column), "lines")
    grouped = lines.groupBy(*NAME).agg(
        F.min(F.struct("id", "line_no", "line_hash")).alias("first"),
        F.first("parity").alias("parity"),
        F.first("half").alias("half"),
        F.first("prefix").alias("prefix"),
        F.count("*").alias("rows"),
    )
    sets = stored(grouped.withColumn("set", F.monotonically_increasing_id()), "line-sets")
    links = prefix_rows(sets.withColumn("id", F.col("first.id")))
    part = F.col("key").bitwiseAND(PARTS - 1)
    parts = [stored(sharing_rows(links.filter(part == k)), "line-sharers") for k in range(PARTS)]
    sharing = functools.reduce(DataFrame.union, parts)
    pairs = stored(pairs_with_first(sharing), "line-pairs")
    by_first = matched(pairs, words_of(docs, sets, pairs, id_column, text_column))
    pairs = stored(pairs_with_others(sharing, by_first), "line-pairs")
    by_others = matched_best_first(pairs, words_of(docs, sets, pairs, id_column, text_column))
    later = by_first.union(by_others).distinct().withColumn("later", F.lit(True))

    known = sets.select("set", *NAME, "first", "rows").join(later, "set", "left")
    known = known.withColumn("similar", F.col("later").isNotNull())
    decided = stored(
        known.filter(F.col("similar") | (F.col("rows") > 1)).select(
            F.struct(*NAME).alias("name"),
            F.col("first.id").alias("first_id"),
            F.col("first.line_no").alias("first_no"),
            "rows",
            "similar",
        ),
        "line-decisions",
    )
    # A set of one line is its first; only the lines of the others have to be looked up.
    alone = decided.filter("rows = 1").select(
        F.col("first_id").alias("id"), F.col("first_no").alias("line_no"), "similar"
    )
    several = decided.filter("rows > 1")
    # Most lines are alone and need no shuffle.
    placed = may_be_in(lines, "h1", bitmap_of(several.select("name.h1"), "h1"))
    placed = stored(placed.select("id", "line_no", F.struct(*NAME).alias("name")), "line-repeats")
    joined = attach(placed, several, "name", "rows", lines.count())
    is_first = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("line_no") == F.col("first_no"))
    several = joined.filter(F.col("similar") | ~is_first).select("id", "line_no", "similar")
    return alone.union(several).select(
        "id", "line_no", F.when(F.col("similar"), "similar").otherwise("same").alias("reason")
    )


def without_lines(
    docs: DataFrame, removed: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents without the removed lines; columns as they were."""
    gone = removed.groupBy(F.col("id").alias("_id")).agg(F.collect_set("line_no").alias("_gone"))
    joined = docs.join(gone, docs[id_column].cast("bigint").eqNullSafe(F.col("_id")), "left")
    kept = F.filter(
        F.split(docs[text_column], "\n"), lambda line, no: ~F.array_contains("_gone", no)
    )
    text = F.when(F.col("_gone").isNull(), docs[text_column]).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias(c) if c == text_column else docs[c] for c in docs.columns])
