"""A Merkle manifest of a dataset, with a witness for every row.

Rows are leaves. The leaves of one source, in order of their ids, make a tree of arity 16; the
roots of the sources, in order of their names, make another one on top of them. A witness is what
it takes to fold a leaf up to the root: of each run on the way the place and the other digests.

Leaves are numbered by a range sort and dealt into aligned blocks of ``BLOCK`` leaves. Within a
block they are appended one by one to a ``Frontier``: each open subtree keeps the witnesses of what
is below it, and as soon as its last sibling arrives, they are all extended by its digest. The roots
of the blocks are in turn leaves that are appended, by blocks again, until a source has one root.
Afterwards the witnesses are extended downwards: a block is appended once more together with the
witness that its root got. No task sees more than a block, whatever the size of a source.

Defined cases: a NULL or missing value is ``-`` in a leaf, an empty text ``0:``. Rows with a NULL
id come first in their source, rows with a NULL source are a source of their own, before all others.
Rows with one id are in order of their leaves; rows that are equal altogether have equal leaves at
places of their own, so it does not matter which of them is where. Very long texts only count
by their digest. An empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import attach, numbered, stored

ARITY = 16
BLOCK_LEVELS = 2
BLOCK = ARITY**BLOCK_LEVELS
DIGITS = 64

Step = tuple[int, bytes]
STEPS = "array<struct<place:int,others:binary>>"
ARROW_STEPS = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.binary())]))


def digest_of(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


class Frontier:
    """The open subtrees of a tree of ``height`` levels that grows by aligned appends.

    ``append`` takes a digest and the list that holds its witness, which later appends extend in
    place. ``close`` completes what is still open; then ``roots`` has the digests at the top.
    """

    def __init__(self, height: int) -> None:
        self.height = height
        self.open: list[list[tuple[bytes, list[list[Step]]]]] = [[] for _ in range(height)]
        self.roots: list[bytes] = []

    def append(self, digest: bytes, witness: list[Step]) -> None:
        self._place(0, digest, [witness])

    def close(self) -> list[bytes]:
        for level in range(self.height):
            if self.open[level]:
                self._complete(level)
        return self.roots

    def _place(self, level: int, digest: bytes, below: list[list[Step]]) -> None:
        if level == self.height:
            self.roots.append(digest)
            return
        self.open[level].append((digest, below))
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        joined = b"".join(digest for digest, _ in run)
        for place, (_, below) in enumerate(run):
            others = joined[: place * DIGITS] + joined[(place + 1) * DIGITS :]
            for witness in below:
                witness.append((place, others))
        self._place(level + 1, digest_of(joined), [w for _, below in run for w in below])


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // ARITY)
        levels += 1
    return levels


def fold(digest: bytes, witness: list[Step]) -> bytes:
    """The root that a leaf leads to."""
    for place, others in witness:
        digest = digest_of(others[: place * DIGITS] + digest + others[place * DIGITS :])
    return digest


def grown_block(table: pa.Table) -> tuple[pa.Table, list[list[Step]], bytes]:
    """A block's nodes in order, their witnesses within the block, and its root."""
    table = table.sort_by("at")
    frontier = Frontier(min(BLOCK_LEVELS, height_of(table["n"][0].as_py())))
    witnesses: list[list[Step]] = [[] for _ in range(table.num_rows)]
    for digest, witness in zip(table["digest"].to_pylist(), witnesses, strict=True):
        frontier.append(digest.encode(), witness)
    (root,) = frontier.close()
    return table, witnesses, root


def in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / BLOCK).cast("bigint"))


def block_roots(nodes: DataFrame) -> DataFrame:
    """The next rows to append: ``tree``, ``at``, ``digest`` and ``n``, one per block, stored."""

    def root_of(table: pa.Table) -> pa.Table:
        table, _, root = grown_block(table)
        n = -(-table["n"][0].as_py() // BLOCK)
        return pa.table(
            {
                "tree": table["tree"][:1].cast(pa.string()),
                "at": table["block"][:1],
                "digest": pa.array([root.decode()]),
                "n": pa.array([n], pa.int64()),
            }
        )

    narrow = in_blocks(nodes).select("tree", "block", "at", "digest", "n")
    roots = narrow.groupBy("tree", "block").applyInArrow(root_of, "tree string, at bigint, digest string, n bigint")
    return stored(roots, "merkle-blocks")


def extended(
    nodes: DataFrame, higher: DataFrame, schema: str, result: Callable[[pa.Table, list, dict], pa.Table]
) -> DataFrame:
    """Appends each block once more, with the witness of its root.

    ``higher`` has one row per (``tree``, ``at`` of the block) with ``steps``. ``result`` makes the
    rows out of the block's nodes in order, their whole witnesses and the row of ``higher``.
    """

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        above = right.to_pylist()[0]
        steps = [(step["place"], step["others"]) for step in above["steps"]]
        table, witnesses, _ = grown_block(left)
        return result(table, [witness + steps for witness in witnesses], above)

    blocks = higher.withColumnRenamed("at", "block")
    return (
        in_blocks(nodes)
        .groupBy("tree", "block")
        .cogroup(blocks.groupBy("tree", "block"))
        .applyInArrow(extend, schema)
    )


def with_steps(table: pa.Table, witnesses: list[list[Step]], above: dict) -> pa.Table:
    steps = [[{"place": p, "others": o} for p, o in witness] for witness in witnesses]
    return pa.table(
        {
            "tree": table["tree"].cast(pa.string()),
            "at": table["at"],
            "root": pa.array([above["root"]] * table.num_rows, pa.string()),
            "steps": pa.array(steps, ARROW_STEPS),
        }
    )


STEPS_SCHEMA = f"tree string, at bigint, root string, steps {STEPS}"


def witnesses_of(nodes: DataFrame) -> DataFrame:
    """``tree``, ``at``, the ``root`` of the tree and the ``steps`` to it, one row per node."""
    alone = nodes.filter("n = 1").select(
        "tree", "at", F.col("digest").alias("root"), F.array().cast(STEPS).alias("steps")
    )
    if nodes.filter("n > 1").isEmpty():
        return alone
    rest = nodes.filter("n > 1")
    higher = witnesses_of(block_roots(rest))
    return alone.unionByName(extended(rest, higher, STEPS_SCHEMA, with_steps))


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of the values one after the other, each as byte count, ``:`` and text, or ``-``."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[written(c) for c in columns]), 256)


class Manifest:
    """The tree over the rows ``id``, ``source``, ``leaf`` and whatever else they have.

    ``id`` is a bigint, ``source`` a string, ``leaf`` 64 lower-case hex digits.
    """

    def __init__(self, leaves: DataFrame) -> None:
        # Spark compares strings by their bytes; the sign keeps NULL before all names.
        tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
        keyed = leaves.withColumn("tree", tree).withColumn("_key", F.monotonically_increasing_id())
        # The key of the row tells rows apart that are equal altogether.
        rows = numbered(stored(keyed, "merkle-leaves"), ["tree", "id", "leaf", "_key"], "_place", "merkle-order")
        sizes = stored(
            rows.groupBy("tree").agg(F.min("_place").alias("_first"), F.count("*").alias("n")), "merkle-sizes"
        )
        self.total = rows.count()
        placed = attach(rows, sizes, "tree", "n", self.total)
        placed = placed.withColumn("at", F.col("_place") - F.col("_first"))
        self.nodes = stored(placed.withColumnRenamed("leaf", "digest").drop("_key", "_place", "_first"), "merkle-nodes")
        inner = stored(witnesses_of(block_roots(self.nodes)), "merkle-inner")
        roots = inner.filter("at = 0").select("tree", F.col("root").alias("digest"))
        named = numbered(roots, ["tree"], "at", "merkle-sources").withColumnRenamed("tree", "name")
        tops = named.select(F.lit("").alias("tree"), "at", "digest").withColumn("n", F.lit(named.count()))
        top = witnesses_of(stored(tops, "merkle-tops")).select("at", F.col("root").alias("top"), F.col("steps").alias("top_steps"))
        # ``name``, ``digest`` (root of the source), ``top`` (root of all) and ``top_steps``.
        self.sources = stored(named.join(top, "at").drop("at"), "merkle-roots")
        by_tree = self.sources.withColumnRenamed("name", "tree").join(sizes.select("tree", "n"), "tree")
        self.blocks = attach(inner, by_tree, "tree", "n", self.total).select(
            "tree",
            "at",
            F.col("digest").alias("subroot"),
            F.col("top").alias("root"),
            F.concat("steps", "top_steps").alias("steps"),
        )

    def root(self) -> str | None:
        """The digest of everything; None of an empty table."""
        first = self.sources.select("top").first()
        return first.top if first else None

    def witnesses(self) -> DataFrame:
        """``tree``, ``at``, ``root`` and ``steps`` of every leaf; some 6 KB a row."""
        return extended(self.nodes, self.blocks, STEPS_SCHEMA, with_steps)

    def proofs(self, offered: str) -> DataFrame:
        """``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

        ``offered`` names a column of the leaves, with the digests to verify; NULL stands for the
        leaf itself.
        """

        def proved(table: pa.Table, witnesses: list[list[Step]], above: dict) -> pa.Table:
            leaves, given = table["digest"].to_pylist(), table[offered].to_pylist()
            proof = [digest_of(b"".join(o for _, o in w)).decode() for w in witnesses]
            folded = [
                fold((other or leaf).encode(), w).decode()
                for leaf, other, w in zip(leaves, given, witnesses, strict=True)
            ]
            rows = table.num_rows
            return pa.table(
                {
                    "id": table["id"],
                    "leaf": pa.array(leaves, pa.string()),
                    "subroot": pa.array([above["subroot"]] * rows, pa.string()),
                    "root": pa.array([above["root"]] * rows, pa.string()),
                    "proof_sha256": pa.array(proof, pa.string()),
                    "folded_root": pa.array(folded, pa.string()),
                    "verified": pa.array([f == above["root"] for f in folded], pa.bool_()),
                }
            )

        schema = (
            "id bigint, leaf string, subroot string, root string, proof_sha256 string, "
            "folded_root string, verified boolean"
        )
        narrow = self.nodes.select("tree", "at", "n", "digest", "id", offered)
        return extended(narrow, self.blocks, schema, proved)
