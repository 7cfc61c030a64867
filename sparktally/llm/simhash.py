"""SimHash near-deduplication with a Gray-order hierarchical index.

Every document gets a 64-bit fingerprint. Two fingerprints within three bits agree in at least
one of four 16-bit blocks, so each fingerprint goes to four groups, one per block and value;
a group is an upper node of the index, whose members share its masked bits. Groups that are
still too large are split by the next blocks of the remaining bits in the same way. Within a
group fingerprints are sorted by Gray rank, runs of eight form a node that keeps the mask and
pattern of the bits they share, and so on upwards; a search goes down from the top, adds up the
differences on the bits new at each node, and drops a node with all its members as soon as the
sum exceeds the limit.

A task keeps of the links it finds in a group a spanning forest only, which has the same
components and at most one link per member. Components over all groups come from alternating
large-star and small-star joins; no links, components or fingerprints reach the driver.

Defined cases: NULL, empty and blank texts have fingerprint 0, which links like any other.
Fewer than three words are one shingle. Equal fingerprints are one node, however many documents
have them; rows with the same id are rows of their own. A component without any id has a NULL
component_id. An empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import attach, lean, shuffle_partitions, stored

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
# Groups above this many fingerprints are split by further bits; a task searches few at a time.
GROUP_LIMIT = 20_000
# Rows that a search task should get on average, pairs that it may hold at once.
TASK_ROWS = 500_000
PAIRS_AT_ONCE = 2_000_000
FAN = 8
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
LANES = np.uint64(0x0101010101010101)


def shingles_of(text: str | None, size: int) -> Iterator[bytes]:
    """Shingles of the text's words, A-Z lowered, joined by single spaces."""
    words = text.encode().translate(UPPER).split() if text else []
    if not words:
        return iter(())
    if len(words) < size:
        return iter((b" ".join(words),))
    return map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))


def fingerprint(shingles: Iterator[bytes]) -> int:
    """A bit is 1 if it is set in over half of the hashes; as a signed 64-bit number."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    if not len(hashes):
        return 0
    # Eight bits at a time in the byte lanes of a sum of at most 255 hashes.
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    bits = 0
    for low in range(8):
        lanes = ((padded >> np.uint64(low)) & LANES).reshape(-1, 255).sum(axis=1)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for lane, count in enumerate(counts.tolist()):
            if 2 * count > len(hashes):
                bits |= 1 << (8 * lane + low)
    return bits - (1 << 64) if bits >> 63 else bits


def fingerprints(docs: DataFrame, id_column: str, text_column: str, prints) -> DataFrame:
    """``id``, ``tag`` and ``fp``; ``prints`` gives the (tag, fingerprint) pairs of a text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [prints(t.as_py()) for t in batch.column(1)]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            pairs = [pair for f in found for pair in f]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array([tag for tag, _ in pairs], pa.int64()),
                    pa.array([fp for _, fp in pairs], pa.int64()),
                ],
                names=["id", "tag", "fp"],
            )

    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("t"))
    return rows.mapInArrow(lean(each), "id long, tag long, fp long")


def gray_rank(bits: Column) -> Column:
    """The place of a 64-bit word in Gray order, as a signed number in the same order."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def split_masks(taken: int, max_bits: int) -> list[int]:
    """``taken`` with each of ``max_bits`` + 1 equal shares of the other bits added."""
    free = [b for b in range(64) if not taken >> b & 1]
    shares = np.array_split(np.array(free, dtype=object), max_bits + 1)
    return [taken | sum(1 << int(b) for b in share) for share in shares]


def routed(distinct: DataFrame, max_bits: int, group_limit: int) -> DataFrame:
    """``fp``, ``tag``, ``mask``, ``value``: the groups in which each fingerprint meets its neighbours.

    Each round fixes another share of the bits for the members of groups above the limit.
    Four rounds fix 44 bits (with three differing ones), so that even the densest group has at
    most 2^20 different members.
    """
    masks = split_masks(0, max_bits)
    rows, done = keyed(distinct.select("fp", "tag"), [(None, masks)]), []
    for _ in range(3):
        rows = stored(rows, "routed")
        large = stored(
            rows.groupBy("tag", "mask", "value").agg(F.count("*").alias("n")).filter(F.col("n") > group_limit),
            "large-groups",
        ).select("tag", "mask", "value")
        if large.isEmpty():
            break
        rest = rows.join(large, ["tag", "mask", "value"], "left_anti")
        done.append(rest.select("fp", "tag", "mask", "value"))
        again = [(m, split_masks(m, max_bits)) for m in masks]
        rows = keyed(rows.join(large, ["tag", "mask", "value"], "left_semi"), again)
        masks = sorted({m for _, more in again for m in more})
    for part in done:
        rows = rows.unionByName(part)
    return rows


def keyed(rows: DataFrame, choices: list[tuple[int | None, list[int]]]) -> DataFrame:
    """Each fingerprint once per next mask; ``choices`` has the next masks by present mask."""
    literals = [(old, F.array(*[F.lit(signed(m)) for m in new])) for old, new in choices]
    if choices[0][0] is None:
        masks = literals[0][1]
    else:
        masks = F.coalesce(*[F.when(F.col("mask") == signed(old), new) for old, new in literals])
    exploded = rows.select("fp", "tag", F.explode(masks).alias("mask"))
    return exploded.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))


def search_groups(max_bits: int):
    """Finds the links within the groups of a partition that is sorted by group and Gray rank."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy() for i in range(4)]))
            if sum(h.shape[1] for h in held) < 4 * GROUP_LIMIT:
                continue
            rows = np.concatenate(held, axis=1)
            same = (rows[1:] == rows[1:, -1:]).all(axis=0)
            cut = len(same) - np.argmin(same[::-1]) if not same.all() else 0
            held = [rows[:, cut:]]  # the last group may go on in the next batch
            if cut:
                yield linked(rows[:, :cut], max_bits)
        if held:
            yield linked(np.concatenate(held, axis=1), max_bits)

    return search


def linked(rows: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Links (tag, a, b) that connect what is connected within the groups of ``rows``."""
    fp, tag = np.ascontiguousarray(rows[0]).view(np.uint64), rows[1]
    fresh = np.ones(len(fp), bool)
    fresh[1:] = (rows[1:, 1:] != rows[1:, :-1]).any(axis=0)
    group = np.cumsum(fresh) - 1
    sizes = np.bincount(group)
    several = sizes[group] > 1
    fp, tag = fp[several], tag[several]
    group = np.unique(group[several], return_inverse=True)[1]
    label = np.arange(len(fp))
    if len(fp):
        levels = hierarchy(fp, group)
        # Queries in chunks whose members could not make too many pairs even if all were close.
        size = np.bincount(group)[group]
        chunk = np.cumsum(size) // PAIRS_AT_ONCE
        for part in np.split(np.arange(len(fp)), np.flatnonzero(np.diff(chunk)) + 1):
            a, b = neighbours(fp, group, part, levels, max_bits)
            label = united(label, a, b)
    ends = np.flatnonzero(label != np.arange(len(fp)))
    signed_fp = fp.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(tag[ends]), pa.array(signed_fp[ends]), pa.array(signed_fp[label[ends]])],
        names=["tag", "a", "b"],
    )


def hierarchy(fp: np.ndarray, group: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels from the leaves to one node per group: ones, mask, first child, number of children."""
    ones, zeros = fp, ~fp
    full = np.full(len(fp), ~np.uint64(0))
    levels = [(ones, full, np.arange(len(fp)), np.zeros(len(fp), np.int64))]
    while len(group) > group[-1] + 1:
        starts = np.searchsorted(group, np.arange(group[-1] + 1))
        place = np.arange(len(group)) - starts[group]
        first = np.flatnonzero(place % FAN == 0)
        ones = np.bitwise_and.reduceat(ones, first)
        zeros = np.bitwise_and.reduceat(zeros, first)
        children = np.diff(np.append(first, len(group)))
        group = group[first]
        levels.append((ones, ones | zeros, first, children))
    return levels


def neighbours(fp, group, queries, levels, max_bits) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, leaf before it in the order) that differ in at most ``max_bits`` bits."""
    query, node = queries, group[queries]
    mask = levels[-1][1][node]
    apart = np.bitwise_count((fp[query] ^ levels[-1][0][node]) & mask).astype(np.int64)
    for upper, lower in zip(levels[:0:-1], levels[-2::-1], strict=True):
        _, masks, first, children = upper
        count = children[node]
        parent = np.repeat(np.arange(len(node)), count)
        offset = np.arange(len(parent)) - np.repeat(np.cumsum(count) - count, count)
        child = first[node][parent] + offset
        query, apart, seen = query[parent], apart[parent], masks[node][parent]
        new = lower[1][child] & ~seen
        apart = apart + np.bitwise_count((fp[query] ^ lower[0][child]) & new)
        keep = apart <= max_bits
        query, node, apart = query[keep], child[keep], apart[keep]
    before = node < query
    return query[before], node[before]


def united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links (a, b): the smallest member of each connected set."""
    while True:
        low = np.minimum(label[a], label[b])
        if (low == label[a]).all() and (low == label[b]).all():
            return label
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]


def stars(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every linked node."""
    links = stored(
        links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(),
        "links",
    )
    checks = F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
    state = links.agg(F.count("*"), checks).first()
    while True:
        # Large star: neighbours above a node go to its smallest neighbour.
        both = stored(
            links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root"))),
            "both-ways",
        )
        large = hung(both, F.least(F.min("root"), F.first("node")), F.col("root") > F.col("node"))
        # Small star: neighbours below a node, and the node itself, go to the smallest.
        down = stored(large, "large-star")
        small = hung(down, F.min("root"), F.lit(True)).unionByName(
            down.groupBy("node").agg(F.min("root").alias("root"))
        )
        links = stored(small.filter("node <> root").distinct(), "small-star")
        before, state = state, links.agg(F.count("*"), checks).first()
        if state == before:
            return links


def hung(links: DataFrame, smallest: Column, which: Column) -> DataFrame:
    """Links (neighbour, smallest neighbour) for the neighbours of every node."""
    groups = stored(
        links.groupBy("node").agg(smallest.alias("least"), F.count("*").alias("n")), "smallest"
    )
    total = links.count()
    joined = attach(links, groups, "node", "n", total).filter(which)
    hung_links = joined.select(F.greatest("root", "least").alias("node"), F.least("root", "least").alias("root"))
    return hung_links.filter("node <> root").distinct()


def links_within(distinct: DataFrame, max_bits: int, group_limit: int) -> DataFrame:
    """``tag``, ``a``, ``b``: links that connect the fingerprints of a tag within ``max_bits``.

    ``distinct`` has each (tag, fp) once. Every link stands for fingerprints connected within
    a group; together they have the components of all links.
    """
    groups = routed(distinct, max_bits, group_limit)
    rows = (max_bits + 1) * distinct.count()
    partitions = max(shuffle_partitions(distinct.sparkSession), rows // TASK_ROWS)
    sorted_groups = (
        groups.withColumn("gray", gray_rank(F.col("fp")))
        .repartition(partitions, "tag", "mask", "value")
        .sortWithinPartitions("tag", "mask", "value", "gray")
        .select("fp", "tag", "mask", "value")
    )
    return sorted_groups.mapInArrow(lean(search_groups(max_bits)), "tag long, a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """``id``, ``fp`` and ``component_id``, the smallest id reachable by links."""

    def one(text: str | None) -> list[tuple[int, int]]:
        return [(0, fingerprint(shingles_of(text, shingle_words)))]

    rows = stored(fingerprints(docs, id_column, text_column, one), "fingerprints")
    distinct = stored(
        rows.groupBy("tag", "fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n")), "distinct"
    )
    roots = stars(links_within(distinct, max_bits, group_limit))

    members = stored(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_id", "n", F.coalesce("root", "fp").alias("root")
        ),
        "members",
    )
    components = stored(
        members.groupBy("root").agg(
            F.min("first_id").alias("component_id"), F.count("*").alias("fps")
        ),
        "components",
    )
    named = attach(members, components, "root", "fps", members.count())
    named = stored(named.select("fp", "n", "component_id"), "named")
    return attach(rows, named, "fp", "n", rows.count()).select("id", "fp", "component_id")
