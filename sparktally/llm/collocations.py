"""Phrases of two to five words that are commoner than their parts suggest.

Texts are dealt into blocks of numbered words, one language each. Phrases are counted by length: a
phrase can only be frequent if the two that are one word shorter are, so each round counts, within
each block, those phrases whose two parts have been found frequent in all blocks together.

A block's counts are a counting quotient filter: the word numbers of a phrase are packed into one
number, which is permuted invertibly (a Feistel network over just as many bits as it has); its
first bits are the quotient, all others the remainder, and the entries are sorted by both.
Quotients are stored as differences, remainders and counts in as few bytes as they need; nothing
is lost, so the phrase can be had back from its entry. As the permutation spreads phrases evenly,
ranges of quotients share out the work: the filters of all blocks are merged range by range, and
each block is told which of its entries are frequent.

Scores are exact decimals. Results go by the score of a phrase's weakest cut.

Defined cases: a NULL text is empty, a NULL language ``und``. Repeated rows count again. A text of
any length is read whole. Ties are ranked by phrase, in byte order. Without frequent phrases, as for
an empty table, there are no rows. Columns other than language and text are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktally.llm.common import stored

LONGEST = 5
# Words of a block; a longer text is a block of its own. Small, so that a block and what its round
# makes of it need tens of megabytes.
BLOCK_WORDS = 1 << 21
# Blocks whose words are merged in one task, on average; a block has some 100,000 different ones.
WORD_BLOCKS = 8
# Entries that a range of quotients holds at most, on average, over all blocks.
RANGE_ENTRIES = 1 << 20
PUNCTUATION = b".,;:!?\x0a\x0b\x0c\x0d"
UPPER = bytes(range(65, 91))
CLEANED = bytes.maketrans(UPPER + b"\t" + PUNCTUATION, UPPER.lower() + b" " + b"\n" * len(PUNCTUATION))
BREAK = 0

BLOCKS = "block bigint, lang string, words array<string>, counts binary, tokens binary"
# Parts of the words of a block, and what comes back: frequent words, or their numbers in a block.
WORD_PARTS = "block bigint, lang string, part int, words array<string>, locals binary, counts binary"
WORD_IDS = "block bigint, lang string, n bigint, words array<string>, locals binary, ids binary, counts binary"
# Rows of a round: the state of a block or a part of its filter, which starts with entry ``base``.
ROUNDS = (
    "block bigint, lang string, part int, base bigint, tokens binary, alive binary, "
    "quotients binary, remainders array<binary>, counts binary"
)
MERGED = "block bigint, lang string, entries binary, quotients binary, remainders array<binary>, counts binary"
ARROW_TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<string>": pa.list_(pa.string()),
    "array<binary>": pa.list_(pa.binary()),
}


def arrow_schema(columns: str) -> pa.Schema:
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])


# Numbers in few bytes


def squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes each as the largest needs, byte by byte, compressed."""
    most = int(numbers.max()) if len(numbers) else 0
    size = max(1, -(-most.bit_length() // 8))
    columns = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
    return bytes([size]) + zstandard.compress(columns.T.tobytes(), 1)


def unsqueezed(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(size, -1)
    columns = np.zeros((planes.shape[1], 8), np.uint8)
    columns[:, :size] = planes.T
    return columns.view("<u8").reshape(-1).astype(np.uint64)


# Permuted numbers of phrases


class Packing:
    """How phrases of ``size`` words of ``bits`` bits become a quotient and remainders.

    The number of a phrase has size * bits bits. Its parts are the quotient and remainders of up to
    64 bits each. ``permuted`` and ``restored`` are inverse to each other.
    """

    ROUNDS = 4

    def __init__(self, size: int, bits: int, quotient_bits: int) -> None:
        self.size, self.bits = size, bits
        width = size * bits
        first = max(1, min(quotient_bits, width // 2, 62))
        rest = width - first
        pieces = -(-rest // 64)
        self.widths = [first] + [rest // pieces + (i < rest % pieces) for i in range(pieces)]

    def _mask(self, part: int) -> np.uint64:
        return np.uint64((1 << self.widths[part]) - 1)

    def _turns(self) -> list[tuple[int, int, np.uint64]]:
        count = len(self.widths)
        return [
            (part, (part + 1) % count, np.uint64((0x9E3779B97F4A7C15 * (turn * count + part + 1)) & (2**64 - 1)))
            for turn in range(self.ROUNDS)
            for part in range(count)
        ]

    @staticmethod
    def _stirred(values: np.ndarray, salt: np.uint64) -> np.ndarray:
        x = values + salt
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def permuted(self, words: np.ndarray) -> list[np.ndarray]:
        """The parts of the phrases in the rows of ``words``."""
        parts = self._dealt(words)
        for part, other, salt in self._turns():
            parts[part] = parts[part] ^ (self._stirred(parts[other], salt) & self._mask(part))
        return parts

    def restored(self, parts: list[np.ndarray]) -> np.ndarray:
        parts = list(parts)
        for part, other, salt in reversed(self._turns()):
            parts[part] = parts[part] ^ (self._stirred(parts[other], salt) & self._mask(part))
        return self._gathered(parts)

    def _overlaps(self) -> Iterator[tuple[int, int, int, int, int]]:
        """(part, its shift, word, its shift, bits) of each stretch of bits, from the lowest up."""
        words = [(self.size - 1 - i, self.bits) for i in range(self.size)]
        parts = [(i, self.widths[i]) for i in reversed(range(len(self.widths)))]
        part = word = part_shift = word_shift = 0
        while word < len(words):
            bits = min(words[word][1] - word_shift, parts[part][1] - part_shift)
            yield parts[part][0], part_shift, words[word][0], word_shift, bits
            part_shift, word_shift = part_shift + bits, word_shift + bits
            if part_shift == parts[part][1]:
                part, part_shift = part + 1, 0
            if word_shift == words[word][1]:
                word, word_shift = word + 1, 0

    def _dealt(self, words: np.ndarray) -> list[np.ndarray]:
        parts = [np.zeros(len(words), np.uint64) for _ in self.widths]
        for part, up, word, down, bits in self._overlaps():
            piece = (words[:, word] >> np.uint64(down)) & np.uint64((1 << bits) - 1)
            parts[part] |= piece << np.uint64(up)
        return parts

    def _gathered(self, parts: list[np.ndarray]) -> np.ndarray:
        words = np.zeros((len(parts[0]), self.size), np.uint64)
        for part, down, word, up, bits in self._overlaps():
            piece = (parts[part] >> np.uint64(down)) & np.uint64((1 << bits) - 1)
            words[:, word] |= piece << np.uint64(up)
        return words


def in_order(parts: list[np.ndarray]) -> np.ndarray:
    return np.lexsort(parts[::-1])


def written_filter(parts: list[np.ndarray], counts: np.ndarray) -> dict:
    """The columns of a sorted filter."""
    return {
        "quotients": squeezed(np.diff(parts[0], prepend=np.uint64(0))),
        "remainders": [squeezed(part) for part in parts[1:]],
        "counts": squeezed(counts),
    }


def read_filter(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    quotients = np.cumsum(unsqueezed(row["quotients"]), dtype=np.uint64)
    return [quotients, *map(unsqueezed, row["remainders"])], unsqueezed(row["counts"])


def merged_filters(filters: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The merged parts and counts, and for each entry of the filters, one after the other, its place."""
    parts = [np.concatenate(some) for some in zip(*[parts for parts, _ in filters], strict=True)]
    counts = np.concatenate([counts for _, counts in filters])
    if not len(counts):
        return parts, counts, np.zeros(0, np.int64)
    order = in_order(parts)
    parts = [part[order] for part in parts]
    starts = np.ones(len(order), bool)
    starts[1:] = np.logical_or.reduce([part[1:] != part[:-1] for part in parts])
    places = np.empty(len(order), np.int64)
    places[order] = np.cumsum(starts) - 1
    firsts = np.flatnonzero(starts)
    return [part[firsts] for part in parts], np.add.reduceat(counts[order], firsts), places


def phrases_of(tokens: np.ndarray, alive: np.ndarray, packing: Packing) -> tuple[np.ndarray, tuple]:
    """Where phrases start whose two parts are alive, and their entries, as of ``merged_filters``."""
    places = np.flatnonzero(alive[:-1] & alive[1:])
    parts = packing.permuted(tokens[places[:, None] + np.arange(packing.size)])
    return places, merged_filters([(parts, np.ones(len(places), np.uint64))])


# Blocks


def numbered_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbers of words, of a block's own; pieces and texts end in ``BREAK``."""
    task = TaskContext.get()
    key = itertools.count((task.partitionId() if task else 0) << 32)
    pending: dict[str, list[bytes]] = defaultdict(list)
    sizes: dict[str, int] = defaultdict(int)

    def block(lang: str) -> pa.RecordBatch:
        numbers: dict[bytes, int] = defaultdict(itertools.count().__next__)
        # The empty word, between two spaces, is skipped.
        skip, stop = numbers[b""], numbers[b"\n"]
        del sizes[lang]
        words = b" \n ".join(pending.pop(lang)).replace(b"\n", b" \n ").split(b" ")
        tokens = np.fromiter((numbers[word] for word in words), np.int64, len(words))
        tokens = tokens[tokens != skip] - stop
        counts = np.bincount(tokens, minlength=len(numbers) - 1)[1:]
        found = [word.decode() for word in itertools.islice(numbers, 2, None)]
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([next(key)], pa.int64()),
                "lang": pa.array([lang], pa.string()),
                "words": pa.array([found], pa.list_(pa.string())),
                "counts": pa.array([squeezed(counts)], pa.binary()),
                "tokens": pa.array([squeezed(tokens)], pa.binary()),
            }
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            cleaned = (text.as_py() or "").encode().translate(CLEANED)
            pending[lang].append(cleaned)
            # Six bytes a word, or so.
            sizes[lang] += len(cleaned) // 6 + 1
            if sizes[lang] >= BLOCK_WORDS or sum(sizes.values()) >= 4 * BLOCK_WORDS:
                yield block(max(sizes, key=sizes.get))
    for lang in list(pending):
        yield block(lang)


def dealt_words(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The words of each block in 2 ** bits parts, by hash."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            words, counts = row.column("words").flatten(), unsqueezed(row.column("counts")[0].as_py())
            hashes = np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words))
            parts = hashes >> (32 - bits)
            order = np.argsort(parts, kind="stable")
            ends = np.flatnonzero(np.diff(parts[order], append=-1)) + 1
            rows = []
            for some in (order[start:end] for start, end in itertools.pairwise([0, *ends])):
                rows.append(
                    {
                        "block": row.column("block")[0].as_py(),
                        "lang": row.column("lang")[0].as_py(),
                        "part": int(parts[some[0]]),
                        "words": words.take(pa.array(some)).to_pylist(),
                        "locals": squeezed(some),
                        "counts": squeezed(counts[some]),
                    }
                )
            yield from pa.Table.from_pylist(rows, arrow_schema(WORD_PARTS)).to_batches()

    return deal


def merged_words(least: int, parts: int) -> Callable[[pa.Table], pa.Table]:
    """The frequent words of a part with their numbers, and the numbers of each block's words.

    Numbers start from 1 and tell the words of one language apart.
    """

    def merge(table: pa.Table) -> pa.Table:
        rows = table.select(["block", "lang", "part", "locals", "counts"]).to_pylist()
        lang, part = rows[0]["lang"], rows[0]["part"]
        coded = table["words"].combine_chunks().flatten().dictionary_encode()
        own = coded.indices.to_numpy()
        counts = [unsqueezed(row["counts"]) for row in rows]
        totals = np.zeros(len(coded.dictionary), np.uint64)
        np.add.at(totals, own, np.concatenate(counts))
        frequent = np.flatnonzero(totals >= least)
        words = coded.dictionary.take(pa.array(frequent))
        order = pc.sort_indices(words).to_numpy()
        ids = np.zeros(len(totals), np.int64)
        ids[frequent[order]] = np.arange(len(order)) * parts + part + 1
        out = [
            {
                "lang": lang,
                "n": int(totals.sum()),
                "words": words.to_pylist(),
                "ids": squeezed(ids[frequent]),
                "counts": squeezed(totals[frequent]),
            }
        ]
        done = 0
        for row, some in zip(rows, counts, strict=True):
            found = ids[own[done : done + len(some)]]
            done += len(some)
            if found.any():
                places = unsqueezed(row["locals"])[found > 0]
                out.append(
                    {"block": row["block"], "lang": lang, "locals": squeezed(places), "ids": squeezed(found[found > 0])}
                )
        return pa.Table.from_pylist(out, arrow_schema(WORD_IDS))

    return merge


def listed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in (row for batch in batches for row in batch.to_pylist()):
        size = len(row["words"])
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([row["lang"]] * size, pa.string()),
                "word": pa.array(row["words"], pa.string()),
                "id": pa.array(unsqueezed(row["ids"]).astype(np.int64), pa.int64()),
                "a": pa.array(unsqueezed(row["counts"]).astype(np.int64), pa.int64()),
            }
        )


class Rounds:
    """Counts of phrases, by length. ``least`` is the frequency that counts as frequent."""

    def __init__(self, docs: DataFrame, lang_column: str, text_column: str, least: int) -> None:
        self.least = least
        texts = docs.select(F.coalesce(lang_column, F.lit("und")).alias("lang"), F.col(text_column).alias("text"))
        self.blocks = stored(texts.mapInArrow(numbered_blocks, BLOCKS), "phrase-blocks")
        part_bits = (self.blocks.count() // WORD_BLOCKS).bit_length()
        dealt = self.blocks.select("block", "lang", "words", "counts").mapInArrow(dealt_words(part_bits), WORD_PARTS)
        self.found = stored(
            dealt.groupBy("lang", "part").applyInArrow(merged_words(least, 1 << part_bits), WORD_IDS), "phrase-words"
        )
        merged = self.found.filter("block IS NULL")
        # ``lang`` and ``n``, its words; and ``lang``, ``word``, ``id``, ``a`` of the frequent ones.
        self.sizes = stored(merged.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-langs")
        listed = merged.select("lang", "words", "ids", "counts")
        self.words = stored(listed.mapInArrow(listed_words, "lang string, word string, id bigint, a bigint"), "phrase-ids")
        bits = int(self.words.agg(F.max("id")).first()[0] or 1).bit_length()
        most = int(self.sizes.agg(F.max("n")).first()[0] or 1)
        self.packings = [Packing(size, bits, most.bit_length()) for size in range(2, LONGEST + 1)]
        # Filters are dealt by the first bits of the quotient; as many as the largest language needs.
        first = min(packing.widths[0] for packing in self.packings)
        self.range_bits = min(first, (most // RANGE_ENTRIES).bit_length())

    def _packing(self, size: int) -> Packing:
        return self.packings[size - 2]

    def _round(self, blocks: DataFrame, found: DataFrame, size: int) -> DataFrame:
        """From blocks and what is frequent of them to their phrases of ``size`` words."""
        step = self._first() if size == 2 else self._next(size)
        dealt = blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(step, ROUNDS)
        return stored(dealt, f"phrase-round-{size}")

    def _first(self) -> Callable[[pa.Table, pa.Table], pa.Table]:
        counted = self._counted(2)

        def step(block: pa.Table, known: pa.Table) -> pa.Table:
            if not block.num_rows:
                return arrow_schema(ROUNDS).empty_table()
            tokens = unsqueezed(block["tokens"][0].as_py()).astype(np.int64)
            ids = np.zeros(int(tokens.max(initial=0)) + 1, np.uint64)
            for row in known.to_pylist():
                ids[unsqueezed(row["locals"]).astype(np.int64) + 1] = unsqueezed(row["ids"])
            tokens = ids[tokens]
            return counted(block, tokens, tokens != BREAK)

        return step

    def _next(self, size: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        counted, packing = self._counted(size), self._packing(size - 1)

        def step(block: pa.Table, frequent: pa.Table) -> pa.Table:
            if not block.num_rows or not frequent.num_rows:
                return arrow_schema(ROUNDS).empty_table()
            tokens = unsqueezed(block["tokens"][0].as_py())
            before = np.frombuffer(zstandard.decompress(block["alive"][0].as_py()), np.uint8)
            before = np.unpackbits(before, count=len(tokens)).astype(bool)
            # The entries of the round before, in the same order.
            places, (parts, _, entries) = phrases_of(tokens, before, packing)
            kept = np.zeros(len(parts[0]), bool)
            for some in frequent["entries"].to_pylist():
                kept[unsqueezed(some).astype(np.int64)] = True
            places = places[kept[entries]]
            alive, covered = np.zeros(len(tokens), bool), np.zeros(len(tokens), bool)
            alive[places] = True
            for i in range(size - 1):
                covered[places + i] = True
            tokens[~covered] = BREAK
            return counted(block, tokens, alive)

        return step

    def _counted(self, size: int) -> Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table]:
        """The state of a block, and its filter of the phrases whose two parts are ``alive``."""
        packing = self._packing(size)
        shift, is_last = packing.widths[0] - self.range_bits, size == LONGEST

        def counted(block: pa.Table, tokens: np.ndarray, alive: np.ndarray) -> pa.Table:
            places, (parts, counts, _) = phrases_of(tokens, alive, packing)
            names = {"block": block["block"][0].as_py(), "lang": block["lang"][0].as_py()}
            rows = []
            if len(places) and not is_last:
                bits = zstandard.compress(np.packbits(alive).tobytes(), 1)
                rows.append({**names, "tokens": squeezed(tokens), "alive": bits})
            dealt = (parts[0] >> np.uint64(shift)).astype(np.int64)
            ends = np.flatnonzero(np.diff(dealt, append=-1)) + 1 if len(places) else []
            for start, end in itertools.pairwise([0, *ends]):
                some = written_filter([part[start:end] for part in parts], counts[start:end])
                rows.append({**names, "part": int(dealt[start]), "base": int(start), **some})
            return pa.Table.from_pylist(rows, arrow_schema(ROUNDS))

        return counted

    def merged(self, state: DataFrame, size: int) -> DataFrame:
        """The filters of all blocks merged by range of quotients, frequent entries only.

        One row per range with its merged filter (``block`` is NULL), and one per block and
        range with the block's own entries that are frequent.
        """
        least, last = self.least, size == LONGEST

        def merge(table: pa.Table) -> pa.Table:
            rows = table.to_pylist()
            filters = [read_filter(row) for row in rows]
            parts, counts, places = merged_filters(filters)
            kept = counts >= least
            out = []
            if kept.any():
                out.append({"lang": rows[0]["lang"], **written_filter([part[kept] for part in parts], counts[kept])})
            done = 0
            for row, (_, own) in zip(rows, filters, strict=True):
                alive = np.flatnonzero(kept[places[done : done + len(own)]])
                done += len(own)
                if len(alive) and not last:
                    out.append({"block": row["block"], "lang": row["lang"], "entries": squeezed(alive + row["base"])})
            return pa.Table.from_pylist(out, arrow_schema(MERGED))

        filters = state.filter("part IS NOT NULL").select(
            "block", "lang", "part", "base", "quotients", "remainders", "counts"
        )
        return stored(filters.groupBy("lang", "part").applyInArrow(merge, MERGED), f"phrase-merged-{size}")

    def phrases(self) -> DataFrame:
        """``lang``, ``ids`` (of words) and ``a`` of all frequent phrases, from one word up."""
        everything = self.words.select("lang", F.array("id").alias("ids"), "a")
        blocks = self.blocks.select("block", "lang", "tokens")
        frequent = self.found.filter("block IS NOT NULL").select("block", "locals", "ids")
        for size in range(2, LONGEST + 1):
            state = self._round(blocks, frequent, size)
            merged = self.merged(state, size)
            filters = merged.filter("block IS NULL").select("lang", "quotients", "remainders", "counts")
            everything = everything.unionByName(
                filters.mapInArrow(unpacked(self._packing(size)), "lang string, ids array<bigint>, a bigint")
            )
            blocks = state.filter("part IS NULL").select("block", "lang", "tokens", "alive")
            frequent = merged.filter("block IS NOT NULL").select("block", "entries")
        return stored(everything, "phrases")


def unpacked(packing: Packing) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts, counts = read_filter(row)
                ids = packing.restored(parts).astype(np.int64)
                offsets = pa.array(np.arange(len(ids) + 1) * packing.size, pa.int32())
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([row["lang"]] * len(ids), pa.string()),
                        "ids": pa.ListArray.from_arrays(offsets, pa.array(ids.reshape(-1), pa.int64())),
                        "a": pa.array(counts.astype(np.int64), pa.int64()),
                    }
                )

    return rows


def collocations(
    docs: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    least: int = 100,
    most: int = 2000,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's first phrases."""
    rounds = Rounds(docs, lang_column, text_column, least)
    phrases = rounds.phrases()
    candidates = phrases.filter(F.size("ids") > 1)

    cuts = candidates.select(
        "lang", "ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")
    ).select(
        "*",
        F.expr("slice(ids, 1, k)").alias("left_ids"),
        F.expr("slice(ids, k + 1, size(ids) - k)").alias("right_ids"),
    )
    left = phrases.select("lang", F.col("ids").alias("left_ids"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("ids").alias("right_ids"), F.col("a").alias("r"))
    score = F.expr(
        "(CAST(1000 AS DECIMAL(38, 0)) * a * n) div (CAST(l AS DECIMAL(38, 0)) * r)"
    ).cast("bigint")
    scored = cuts.join(left, ["lang", "left_ids"]).join(right, ["lang", "right_ids"]).join(rounds.sizes, "lang")
    weakest = scored.groupBy("lang", "ids", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # A phrase inside a longer one that is as frequent is also inside one of just one word more.
    longer = candidates.filter(F.size("ids") > 2)
    inside = [F.expr(f"slice(ids, {start}, size(ids) - 1)") for start in (1, 2)]
    covered = longer.select("lang", F.explode(F.array(*inside)).alias("ids"), "a").distinct()
    kept = weakest.join(covered, ["lang", "ids", "a"], "left_anti")

    spelt = (
        kept.select("lang", "ids", F.posexplode("ids").alias("place", "id"))
        .join(rounds.words.select("lang", "id", "word"), ["lang", "id"])
        .groupBy("lang", "ids")
        .agg(F.array_join(F.sort_array(F.collect_list(F.struct("place", "word"))).getField("word"), " ").alias("phrase"))
    )
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        kept.join(spelt, ["lang", "ids"])
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        .withColumn("rank", F.row_number().over(first).cast("bigint"))
        .filter(F.col("rank") <= most)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
