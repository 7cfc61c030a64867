"""Collocations, byte-level BPE and the Merkle manifest against brute force, and their defined cases."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from sparktally.llm import bpe, collocations, merkle, queries
from sparktally.llm.exact_dedup import new_index
from sparktally.llm.mixing import mix_sources

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (5, "a b c. A b c", "en", "s1", 1),
    (5, "a b c. A b c", "en", "s1", 1),
    (4, None, None, None, None),
    (6, "", "en", "s1", 0),
    (7, " \n\t ", None, None, 3),
    (None, "x y,z", "en", "", 3),
    (None, "x y,z", "en", "", 3),
    (11, "Größe ñandú 東京 'll  it's\r\n\r\n  42,000 €€ " * 40, "de", "s3", 1),
    (12, "word " * 30_000, "en", "s2", 1),
    (13, "ab" * 40_000 + "\n\n \n", "en", "s2", 1),
]


def odd_rows(spark):
    rows = [(*row, "clash", 1.5, 7, [1]) for row in ODD]
    schema = DOCS + ", phrase string, leaf double, at int, ids array<int>"
    return spark.createDataFrame(rows, schema).repartition(3)


def tuples(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


# Collocations


def phrases_by_hand(rows, least, most):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        cleaned = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for mark in ".,;:!?\n\x0b\x0c\r":
            cleaned = cleaned.replace(mark, "\n")
        for piece in cleaned.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for size in range(1, 6):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    found = []
    candidates = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    for (lang, words), a in candidates.items():
        n = totals[lang]
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            other == lang and len(longer) > len(words) and b >= a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), b in candidates.items()
        )
        if not inside:
            found.append((lang, -score, -a, " ".join(words).encode(), left, right, n))
    found.sort()
    ranks, out = Counter(), []
    for lang, score, a, phrase, left, right, n in found:
        ranks[lang] += 1
        if ranks[lang] <= most:
            out.append((lang, ranks[lang], phrase.decode(), -a, left, right, n, -score))
    return sorted(out, key=repr)


def test_phrases_equal_brute_force_over_many_blocks(spark, monkeypatch):
    # Blocks and ranges so small that there are many of them; Spark's workers are given the sizes.
    chosen = random.Random(3)
    words = [f"w{i}" for i in range(12)] + ["É", "new", "york", "city", "New", "\xa0"]
    rows = []
    for n in range(400):
        text = "".join(chosen.choice(words) + chosen.choice([" ", " ", " ", "\t", ", ", "\n", " . "]) for _ in range(60))
        rows.append((n, text + " New York City hall " * (n % 3), chosen.choice(["en", "de", None]), "s", 1))
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    monkeypatch.setattr(collocations, "RANGE_ENTRIES", 1000)
    monkeypatch.setattr(collocations, "WORD_BLOCKS", 1)
    found = collocations.collocations(docs, least=6, most=300)
    expected = phrases_by_hand([(row[1], row[2]) for row in rows], 6, 300)
    assert len(expected) > 500
    assert tuples(found) == expected
    rounds = collocations.Rounds(docs, "lang", "text", 6)
    assert rounds.blocks.count() >= 16 and rounds.range_bits >= 3


def test_texts_end_blocks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "BLOCK_WORDS", 10)
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b", "a", "c"] * 9, "text": ["x y. z x", "y", None, "q\tr"] * 9})
    blocks = list(collocations.numbered_blocks(iter([batch])))
    counts = Counter()
    for block in blocks:
        words, lang = block["words"][0].as_py(), block["lang"][0].as_py()
        own = collocations.unsqueezed(block["counts"][0].as_py())
        tokens = collocations.unsqueezed(block["tokens"][0].as_py())
        assert Counter(tokens[tokens > 0].tolist()) == Counter({i + 1: n for i, n in enumerate(own.tolist())})
        counts.update({(lang, w): n for w, n in zip(words, own.tolist(), strict=True)})
    assert counts == {("a", "x"): 18, ("a", "y"): 9, ("a", "z"): 9, ("b", "y"): 9, ("c", "q"): 9, ("c", "r"): 9}
    assert len(blocks) > 3 and len({b["block"][0].as_py() for b in blocks}) == len(blocks)


@pytest.mark.parametrize(("size", "bits", "quotient"), [(2, 1, 5), (2, 12, 22), (5, 14, 25), (5, 30, 40), (4, 33, 60)])
def test_permuted_numbers_are_restored(size, bits, quotient):
    packing = collocations.Packing(size, bits, quotient)
    assert sum(packing.widths) == size * bits and max(packing.widths) <= 64
    words = np.random.default_rng(1).integers(0, 1 << bits, (3000, size)).astype(np.uint64)
    parts = packing.permuted(words)
    assert (packing.restored(parts) == words).all()
    # Filters keep every entry and its count, and merge as sums.
    distinct, counts, places = collocations.merged_filters([(parts, np.ones(3000, np.uint64))] * 2)
    row = collocations.written_filter(distinct, counts)
    again, read = collocations.read_filter(row)
    assert all((a == b).all() for a, b in zip(again, distinct, strict=True)) and (read == counts).all()
    known = Counter(map(tuple, words.tolist()))
    assert dict(zip(map(tuple, packing.restored(again).tolist()), read.tolist(), strict=True)) == {k: 2 * n for k, n in known.items()}
    assert (packing.restored([part[places[:3000]] for part in again]) == words).all()


def test_phrases_of_odd_rows(spark):
    docs = odd_rows(spark)
    expected = phrases_by_hand([(row[1], row[2]) for row in ODD], 2, 2000)
    assert tuples(collocations.collocations(docs, least=2)) == expected
    assert collocations.collocations(docs.limit(0)).count() == 0


# Byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def encoding(vocabulary):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strange_texts():
    chosen = random.Random(5)
    pieces = ["a", "it's", "'ll", "'", " ", "  ", "\n", "\n\n ", "\t", "42", "é", "東京", "€!", "x" * 30, "<|endoftext|>", " ", "🙂"]
    texts = ["".join(chosen.choice(pieces) for _ in range(chosen.randrange(0, 400))) for _ in range(60)]
    return [*texts, "y" * 700, " " * 700, "", None]


@pytest.mark.parametrize(("chunk", "overlap"), [(bpe.CHUNK, bpe.OVERLAP), (100, 60), (40, 20), (9, 8), (64, 5)])
def test_ids_are_those_of_the_library(spark, vocabulary, encoding, chunk, overlap):
    texts = strange_texts()
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    found = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    decoded = bpe.decode(found, vocabulary).collect()
    assert {row.doc_id: row.ids for row in decoded} == {n: encoding.encode_ordinary(t or "") for n, t in enumerate(texts)}
    assert {row.doc_id: bytes(row.decoded) for row in decoded} == {n: (t or "").encode() for n, t in enumerate(texts)}


def test_stitches():
    # (start, cuts shared with the chunk before, cuts shared with the next chunk)
    assert bpe.stitches([(0, [0, 3], [10, 14]), (10, [10, 12, 14], [20, 22]), (20, [21, 22], [])]) == [0, 10, 22]
    assert bpe.stitches([(0, [0], [11]), (10, [10, 12], [])]) is None


def test_tokens_of_odd_rows(spark, vocabulary, encoding):
    docs = odd_rows(spark)
    found = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN)
    assert found.columns == [*[c for c in docs.columns if c != "ids"], "ids"]
    expected = sorted(((r[0], r[1], encoding.encode_ordinary(r[1] or "")) for r in ODD), key=repr)
    assert tuples(found, "doc_id", "text", "ids") == expected
    assert bpe.encode(docs.limit(0), vocabulary, public_tokenizers.PATTERN).count() == 0


# Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest_by_hand(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of each row."""

    def leaf(row):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes):
        """The root, and the (place, others) of each node on its way."""
        ways, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            upper, upper_below = [], []
            for start in range(0, len(nodes), 16):
                run = nodes[start : start + 16]
                for i in range(len(run)):
                    for node in below[start + i]:
                        ways[node].append((i, "".join(run[:i]), "".join(run[i + 1 :])))
                upper.append(digest("".join(run)))
                upper_below.append([n for some in below[start : start + 16] for n in some])
            nodes, below = upper, upper_below
        return nodes[0], ways

    by_source = {}
    for doc_id, text, lang, source, n_chars in rows:
        own = (doc_id, source, lang, n_chars, text)
        key = (source is not None, (source or "").encode())
        by_source.setdefault(key, []).append((doc_id is not None, doc_id or 0, leaf(own), own))
    trees = {key: sorted(some) for key, some in sorted(by_source.items())}
    climbed = {key: climb([row[2] for row in some]) for key, some in trees.items()}
    root, tops = climb([climbed[key][0] for key in trees])
    out = []
    for top, (key, some) in zip(tops, trees.items(), strict=True):
        subroot, ways = climbed[key]
        for (_, _, own_leaf, own), way in zip(some, ways, strict=True):
            folded = own_leaf
            if own[0] is not None and zlib.crc32(str(own[0]).encode()) % 5 == 0 and own[4] is not None:
                folded = leaf((*own[:4], own[4].translate({c: c + 32 for c in range(65, 91)})))
            for _, before, after in way + top:
                folded = digest(before + folded + after)
            proof = digest("".join(before + after for _, before, after in way + top))
            out.append((own[0], own_leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def proved(docs):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select(
        F.col("doc_id").alias("id"),
        "source",
        merkle.leaf_digest([*fields, F.col("text")]).alias("leaf"),
        F.when(
            F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
            merkle.leaf_digest([*fields, queries.ascii_lower(F.col("text"))]),
        ).alias("offered"),
    )
    return merkle.Manifest(leaves)


def test_manifest_equals_brute_force_over_several_blocks(spark):
    # One source of more than a block of blocks, one of a block and one leaf, many small ones.
    sizes = {"hot": 4200, "exact": 256, "over": 257, "one": 1, **{f"s{i}": i % 18 + 1 for i in range(30)}}
    rows = [(i, f"Text {i}", "en", s, i) for s, n in sizes.items() for i in range(n)]
    rows += [(None, "no id", None, None, 1), (None, "no id", None, None, 1), (3, "A", None, "hot", 1)]
    manifest = proved(spark.createDataFrame(rows, DOCS).repartition(7))
    found = manifest.proofs("offered")
    assert tuples(found) == manifest_by_hand(rows)
    assert found.filter("verified").count() < len(rows)
    assert manifest.root() == found.first().root


def test_witnesses_fold_to_the_root(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(900)]
    manifest = proved(spark.createDataFrame(rows, DOCS))
    leaves = {(r.tree, r["at"]): r.digest for r in manifest.nodes.collect()}
    whole = manifest.witnesses().collect()
    assert len(whole) == 900
    for row in whole:
        steps = [(s.place, bytes(s.others)) for s in row.steps]
        assert merkle.fold(leaves[row.tree, row["at"]].encode(), steps).decode() == row.root == manifest.root()


def test_manifest_of_odd_rows(spark):
    assert tuples(proved(odd_rows(spark)).proofs("offered")) == manifest_by_hand([row[:5] for row in ODD])
    none = proved(odd_rows(spark).limit(0))
    assert none.proofs("offered").count() == 0 and none.root() is None


# Repeated batches, and sources smaller than a block


def test_a_batch_that_is_run_again_gets_the_same_decisions(spark):
    index = new_index(spark)
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (None, None)], "doc_id long, text string")
    columns = ("id", "keep_id", "group_size", "kept")
    decided = tuples(index.deduplicate(first, "doc_id", "text"), *columns)
    rows = index.table().count()
    assert tuples(index.deduplicate(first.repartition(3), "doc_id", "text"), *columns) == decided
    assert index.table().count() == rows
    second = spark.createDataFrame([(7, "a"), (8, "c")], "doc_id long, text string")
    assert tuples(index.deduplicate(second, "doc_id", "text", batch="second"), "id", "kept") == [(7, False), (8, True)]
    assert tuples(index.deduplicate(second, "doc_id", "text", batch="second"), "id", "kept") == [(7, False), (8, True)]
    assert tuples(index.deduplicate(second, "doc_id", "text", batch="third"), "id", "kept") == [(7, False), (8, False)]


def test_small_sources_get_their_targets_to_the_word(spark):
    sizes = {"a": 10, "b": 20, "c": 70, "d": 63, "e": 64, "f": 65, "g": 5000}
    rows = [(n, "w " * size, "en", source, 1) for n, (source, size) in enumerate(sizes.items())]
    taken = mix_sources(spark.createDataFrame(rows, DOCS), in_words=True).taken().collect()
    for row in taken:
        assert abs(row.taken - row.target) <= 0.5 and row.taken <= 3 * row.size


# The pipeline


def test_stages_return_columns_as_they_were(spark):
    docs = odd_rows(spark).drop("ids").withColumns(
        {"score": F.lit(0.5), "n_words": F.lit(-7), "_row": F.lit("r"), "size": F.lit("s"), "key": F.lit(None).cast("int")}
    )
    before = Counter(map(repr, tuples(docs)))
    expected = {
        # Copies go: the repeated row, and of NULL, empty and blank texts all but the first.
        "simhash_near_dedup": {4, 5, 11, 12, 13, None},
        "benchmark_decontamination": {4, 5, 6, 7, 11, 12, 13, None},
    }
    for name, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, docs, "/root/testdata/sf0.001")
        assert found.columns == docs.columns
        after = Counter(map(repr, tuples(found)))
        # Mixing repeats rows, the other stages only drop some.
        assert set(after) <= set(before) if name == "mixing" else after <= before
        if name in expected:
            assert {row.doc_id for row in found.collect()} == expected[name]
    sharded = corpus_pipeline.shard(spark, docs, "/root/testdata/sf0.001")
    assert sharded.count() == len(ODD)
    for shard, slots in sharded.groupBy("shard").agg(F.sort_array(F.collect_list("slot"))).collect():
        assert slots == list(range(len(slots))), shard
    assert set(docs.columns) <= set(sharded.columns)
