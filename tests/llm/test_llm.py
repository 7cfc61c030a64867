"""The operators for training data against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sparktally.llm import decontamination, html_extraction, line_dedup, mixing, queries, toxicity
from sparktally.llm.common import stored
from sparktally.llm.exact_dedup import new_index
from sparktally.llm.line_dedup import (
    frequency_classes,
    line_sets,
    lines_of,
    pairs_by_prefix,
    repeated_lines,
    without_lines,
)
from sparktally.llm.oracles import LLM_ORACLES
from sparktally.llm.quality import isotonic, score_quality, statistics
from sparktally.llm.sharding import best_shard, fisher_yates, shard_records
from sparktally.llm.simhash import hierarchy, near_duplicates, neighbours
from sparktally.llm.warc import new_archive

TABLES = os.environ.get("TESTDATA_DIR", "/root/testdata") + "/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = (
    "the quick brown fox jumps over a lazy dog while seven wizards brew potions under the old "
    "bridge and nobody in the village knows why the river runs backwards on cold winter mornings "
    "although several scholars wrote long letters about it to the king who never answered them"
)
# NULLs, empty and long texts, repeats, one document alike to another.
ODD = [
    (5, "a b c d", "en", "s1", 1),
    (3, "a b c d", "en", "s2", None),
    (4, None, None, None, None),
    (6, "", "en", "s1", 0),
    (7, "   \n\t ", "en", None, 3),
    (None, "x y z", "en", "s1", 3),
    (8, "word " * 30_000, "en", "s2", 1),
    (9, PROSE, "en", "s2", 1),
    (10, PROSE.replace("lazy", "sleepy"), "en", "s2", 1),
    (9, PROSE, "en", "s2", 1),
    (11, "Größe ñandú 東京 " * 40, "de", "s3", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*row, "clash", 1.5, 7) for row in ODD]
    schema = DOCS + ", digest string, score double, slot int"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, name):
    found = queries.LLM_QUERIES[name](spark, TABLES)
    names = sorted(found.columns)
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    expected = connection.execute(f"SELECT {', '.join(names)} FROM ({LLM_ORACLES[name]})").fetchall()
    assert sorted(map(repr, rows_of(found, *names))) == sorted(map(repr, expected))


# WARC


def test_archive_round_trip(spark):
    big = "<p>" + "x" * 200 + "</p>"
    pages = [(3, "http://c", big), (1, "http://a", big), (2, None, "tiny"), (4, "http://d\r\nX: y", "tiny"), (5, "http://e", None), (None, "http://n", big), (6, "http://f", "é" * 60)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    archive = new_archive(spark)
    archive.write(table, "page_id", "url", "html")
    records = {r.id: r for r in archive.records().collect()}
    assert len(records) == 7
    for key, _, html in pages:
        assert bytes(records[key].payload) == (html or "").encode()
        assert f"sha256:{hashlib.sha256((html or '').encode()).hexdigest()}" in records[key].header
    assert {k: (r.record_type, r.refers_to) for k, r in records.items()} == {
        1: ("response", None), 3: ("revisit", 1), None: ("revisit", 1),
        2: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None),
    }
    assert "\r\nX: y" not in records[4].header
    assert archive.payloads().count() == 4
    raw = {r.id: bytes(r.record) for r in archive.record_bytes().collect()}
    head, body = raw[1].split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and body == big.encode() + b"\r\n\r\n"
    assert b"Content-Length: 0" in raw[3] and raw[3].endswith(b"\r\n\r\n\r\n\r\n")


def test_damaged_payloads_are_found(spark):
    archive = new_archive(spark)
    archive.write(spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string"), "page_id", "url", "html")
    spark.sql(f"INSERT INTO {archive.name} SELECT unhex('00'), 1L, 1L, CAST('z' AS BINARY)")
    with pytest.raises(Exception, match="damaged payload"):
        archive.payloads().collect()


def test_archive_of_two_batches(spark):
    schema = "page_id long, url string, html string"
    long, other = "x" * 200, "y" * 200
    archive = new_archive(spark)
    archive.write(spark.createDataFrame([(5, "a", long), (7, "b", "tiny")], schema), "page_id", "url", "html")
    later = spark.createDataFrame([(1, "c", long), (2, "d", other), (3, "e", other), (4, "f", "tiny")], schema)
    archive.write(later, "page_id", "url", "html")
    assert archive.payloads().count() == 3
    assert rows_of(archive.records(), "id", "record_type", "refers_to") == [
        (1, "revisit", 5), (2, "response", None), (3, "revisit", 2),
        (4, "response", None), (5, "response", None), (7, "response", None),
    ]


def test_an_interrupted_archive(spark):
    """A write that stored payloads but no headers, repeated."""
    page = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    archive = new_archive(spark)
    spark.sql(f"INSERT INTO {archive.name} SELECT unhex(sha2('text', 256)), 4L, 1L, CAST('text' AS BINARY)")
    archive.write(page, "page_id", "url", "html")
    assert archive.payloads().count() == 1 and archive.records().count() == 1


def test_an_empty_archive(spark):
    archive = new_archive(spark)
    archive.write(spark.createDataFrame([], "page_id long, url string, html string"), "page_id", "url", "html")
    assert archive.records().count() == 0


# Exact dedup


def test_index_over_two_batches(spark, odd, empty):
    index = new_index(spark)
    found = rows_of(index.deduplicate(odd, "doc_id", "text"), "id", "keep_id", "group_size", "kept")
    assert (5, 5, 2, True) in found and (3, 5, 2, False) in found
    assert (4, 6, 2, False) in found and (6, 6, 2, True) in found
    assert found.count((9, 9, 2, True)) == 2 and (None, None, 1, True) in found
    later = spark.createDataFrame([(99, "a b c d"), (98, "new")], "doc_id long, text string")
    assert rows_of(index.deduplicate(later, "doc_id", "text"), "id", "keep_id", "kept") == [
        (98, 98, True), (99, 5, False),
    ]
    assert index.deduplicate(empty, "doc_id", "text").count() == 0
    plan = later.selectExpr("unhex(sha2(text, 256)) AS digest").join(index.table().hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[1]
    assert text.count("Exchange hashpartitioning") == 1  # the index side is not shuffled


def test_a_hot_text(spark):
    rows = spark.range(6000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS text")
    found = new_index(spark).deduplicate(rows, "doc_id", "text")
    assert found.filter("kept").count() == 4001
    assert rows_of(found.filter("id % 3 = 0").select("keep_id", "group_size").distinct()) == [(5997, 2000)]


# Sharding


def test_sharding_law(spark, odd, empty):
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('x', CAST(id % 50 AS INT)) AS text")
    for table in (docs, odd):
        found = shard_records(table, shards=5, bucket_bytes=4000).collect()
        assert len(found) == table.count()
        for shard, rows in itertools.groupby(sorted(found, key=lambda r: r.shard), key=lambda r: r.shard):
            assert sorted(r.slot for r in rows) == list(range(sum(r.shard == shard for r in found)))
        assert all(r.grown_shard in (r.shard, 5) for r in found)
        assert all(r.size == len((r.text or "").encode()) + 8 for r in found)
        assert all(r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in found)
    again = {(r.doc_id, r.shard, r.slot) for r in shard_records(docs.repartition(7), shards=5, bucket_bytes=4000).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in shard_records(docs, shards=5, bucket_bytes=4000).collect()}
    assert shard_records(empty).count() == 0
    moved = docs.select(best_shard(F.col("doc_id"), 6, 7).alias("s")).groupBy("s").count().collect()
    assert all(250 < r["count"] < 420 for r in moved)


def test_fisher_yates_is_a_uniform_permutation():
    seen = [tuple(fisher_yates(3, [s])) for s in range(3000)]
    assert all(sorted(s) == [0, 1, 2] for s in seen)
    assert all(400 < seen.count(p) < 600 for p in itertools.permutations(range(3)))


# SimHash


def reference_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id reachable, by brute force over (id, fingerprint)."""
    label = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for (i, a), (j, b) in itertools.combinations(prints, 2):
            if (a ^ b).bit_count() <= 3 and label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return label


@pytest.mark.parametrize("group_limit", [20_000, 3])
def test_simhash_against_brute_force(spark, group_limit):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    words = "alpha beta gamma delta eps zeta".split()
    texts += [(1000 + k, " ".join(words * 40 + [f"tail{k}"])) for k in range(30)]
    texts += [(2000, None), (2001, ""), (2002, "one"), (2003, "one two"), (2004, "ONE TWO")]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    found = near_duplicates(table, group_limit=group_limit).collect()
    expected = [(i, reference_fingerprint(t)) for i, t in texts]
    label = components(expected)
    assert {(r.id, r.fp & (2**64 - 1), r.component_id) for r in found} == {(i, fp, label[i]) for i, fp in expected}
    assert len({label[1000 + k] for k in range(30)}) < 30


def test_simhash_of_odd_rows(odd, empty):
    found = near_duplicates(odd).collect()
    assert len(found) == len(ODD)
    ids = {r.id: r.component_id for r in found}
    assert ids[4] == ids[6] == ids[7] == 4 and ids[3] == ids[5] == 3 and ids[None] is None
    assert near_duplicates(empty).count() == 0


def test_hierarchy_finds_all_neighbours():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (3, 200)).astype(np.uint64)
    fp = np.unique(np.concatenate([base, np.repeat(base, 5) ^ flips[0] ^ flips[1] ^ flips[2]]))
    group = np.zeros(len(fp), np.int64)
    a, b = neighbours(fp, group, np.arange(len(fp)), hierarchy(fp, group), 3)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    assert set(zip(a.tolist(), b.tolist())) == {(i, j) for i, j in zip(*np.nonzero(near)) if j < i}


# Lines


def test_lines_of_odd_rows(spark, odd, empty):
    long_line = " ".join(f"t{k}" for k in range(20))
    near = long_line.replace("t7 ", "other ")
    extra = spark.createDataFrame([(20, f"{long_line}\n\nfirst"), (21, f"second\n{near}\n"), (22, "first\nthird")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(extra)
    removed = rows_of(repeated_lines(docs))
    assert (21, 1, "similar") in removed and (22, 0, "same") in removed and (5, 0, "same") in removed
    assert not any(r[:2] in {(20, 0), (20, 1), (21, 0), (21, 2), (3, 0), (6, 0), (7, 0)} for r in removed)
    kept = {r.doc_id: r.text for r in without_lines(extra, repeated_lines(extra)).collect()}
    assert kept == {20: f"{long_line}\n\nfirst", 21: "second\n", 22: "third"}
    assert repeated_lines(empty).count() == 0


def near_lines(seed):
    """Lines of 1 to 60 of 90 words, most of them with a few words changed in an earlier one."""
    rng = np.random.default_rng(seed)
    lines = []
    for _ in range(150):
        words = rng.choice(90, rng.integers(1, 60), replace=False).tolist()
        if lines and rng.random() < 0.7:
            words = list(lines[rng.integers(len(lines))])
            for place in rng.integers(0, len(words), rng.integers(0, 6)).tolist():
                words[place] = int(rng.integers(90))
        lines.append(words)
    spaces = [" ", "  ", "\t", "\x0b", "\r ", "\x0c"]
    return [rng.choice(spaces).join(f"w{w}" for w in words) for words in lines]


def alike(x, y):
    return 9 * len(x & y) >= 4 * (len(x) + len(y))


def test_lines_against_all_pairs(spark):
    lines = near_lines(3)
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    sets = [frozenset(re.findall(r"[^\x20\x09-\x0D]+", line)) for line in lines]
    firsts = {}
    for i, words in enumerate(sets):
        firsts.setdefault(words, i)
    similar = {x for x in firsts if any(firsts[y] < firsts[x] and alike(x, y) for y in firsts if y != x)}
    expected = {(i, 0, "similar" if x in similar else "same") for i, x in enumerate(sets) if x in similar or firsts[x] != i}
    assert len(similar) > 20 and {tuple(r) for r in repeated_lines(docs).collect()} == expected


def test_prefix_words_of_lines_are_shuffled_once(spark):
    docs = spark.createDataFrame(list(enumerate(near_lines(4))), "doc_id long, text string")
    lines = line_sets(docs, "doc_id", "text", frequency_classes(lines_of(docs, "doc_id", "text")))
    sets = stored(lines.withColumn("set", F.monotonically_increasing_id()), "sets")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = pairs_by_prefix(sets, sets.select("set").limit(0))
        found = {tuple(r) for r in pairs.collect()}
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan
    # Filters lose no pair of lines that match.
    words = {r.set: frozenset(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in sets.join(docs, F.col("id") == F.col("doc_id")).collect()}
    expected = {(x, y) for x in words for y in words if x < y and alike(words[x], words[y])}
    assert len(expected) > 20 and expected <= found


def test_lines_need_no_counters_and_keep_no_shuffles(spark, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen = []
    # Nothing of the size of a vocabulary goes through the driver.
    monkeypatch.setattr(line_dedup, "frequency_classes", None)
    monkeypatch.setattr(line_dedup, "stored", lambda rows, label: seen.append(spark.conf.get(name, None)) or stored(rows, label))
    before = spark.conf.get(name, None)
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "f a b c d e"), (3, "e d c b a")], "doc_id long, text string")
    assert {tuple(r) for r in repeated_lines(docs).collect()} == {(2, 0, "similar"), (3, 0, "same")}
    assert set(seen) == {"true"} and spark.conf.get(name, None) == before


def test_lines_meet_one_earliest_line_first(spark):
    met = spark.createDataFrame([(7, 2), (7, 1), (7, 1), (8, 2), (9, None)], "set long, pivot long")
    assert {tuple(r) for r in line_dedup.pairs_with_first(met).collect()} == {(7, 1), (8, 2)}


def test_long_lines_that_share_a_link_but_little_else_do_not_meet(spark):
    rng = random.Random(5)
    rare = "x" * 40 + " " + "y" * 40 + " "
    lines = [(i, rare + " ".join(f"w{rng.randrange(10**9)}" for _ in range(160))) for i in range(10)]
    lines.append((10, lines[3][1] + " end"))
    docs = spark.createDataFrame(lines, "doc_id long, text string")
    sets = line_sets(docs, "doc_id", "text").withColumn("set", F.col("id"))
    met = line_dedup.sharing_rows(line_dedup.prefix_rows(sets)).collect()
    assert {r.set for r in met} == {10} and {other.set for r in met for other in r.others} == {3}


# HTML


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><p>Site name and a motto.</p></header>
    <nav><ul><li><a href=x>Home</a></ul></nav><div class="cookie-notice">We use cookies, a long sentence indeed.</div>
    <main><article><h1>Heading</h1><p>One &amp; two<br>three <b>bold</b>.<p>Next &lt;one&gt;<script>var t = "</p>";</script>
    <div class="ad banner">Buy this now.</div><ul><li>first<li>second</ul></article>
    <section id="comments"><p>A reader says that this is great and long.</p></section></main>
    <aside><p>Related things in a long sentence of the side bar.</p></aside><form><p>Subscribe</p></form><footer>&copy;</footer>"""
    assert html_extraction.main_blocks(page) == ["Heading", "One & two three bold.", "Next <one>", "first", "second"]
    bare = "<div><p>" + "Plain words of a page without any article element. " * 3 + "</p><p>And more.</p></div><footer>x</footer>"
    assert html_extraction.main_blocks(bare)[-1] == "And more."
    assert html_extraction.main_blocks(None) == html_extraction.main_blocks("") == html_extraction.main_blocks("<nav>x</nav>") == []
    assert html_extraction.main_blocks("<p>unclosed " + "text " * 40) == ["unclosed " + ("text " * 40).strip()]


def test_names_of_wrappers_do_not_drop_a_page():
    text = "Plain words of an article that somebody wrote. " * 6
    body, kept = f"<h1>Heading</h1><p>{text}</p><p>{text}</p>", ["Heading", text.strip(), text.strip()]
    around = '<nav><a href=x>Home</a></nav><div class="sidebar"><p>Other things to read on this site.</p></div>'
    for page in (
        f"<div class='layout has-sidebar'><article>{body}</article></div>{around}",
        f"<article class='post tag-social comments-open'>{body}</article>{around}",
        f"<div class='search-page'><div id=header-banner>{around}<main>{body}</main></div></div>",
        f"<form id=aspnetForm>{around}<article>{body}</article></form>",
        f"<form><div>{around}<div>{body}</div></div></form>",
        f"<div class='page with-sidebar'><div class=related-share>{body}</div></div>{around}",
        f"<article>{body}</article><div id=comments><article class=comment><p>{text * 2}</p></article></div>",
        f"<form><article>{body}</article><div class=related><article><p>Another one.</p></article></div></form>",
    ):
        assert html_extraction.main_blocks(page) == kept, page


LONG = "Words of the article that somebody wrote about a thing. " * 3


@pytest.mark.parametrize(
    ("page", "kept"),
    [
        ("<article title='The hidden gem' class='overflow hidden x'><p>Seen.</p></article>", ["Seen."]),
        ("<article><p>Seen.</p><p hidden>a</p><p style='color:red; display : none'>b</p><p aria-hidden=true>c</p></article>", ["Seen."]),
        ("<article><p data-x=don't>First</p><p>It's second</p></article>", ["First", "It's second"]),
        ("<article><p data-x=don't>First</p></article>", ["First"]),
        ('<article><p title="a > b" lang=en/>First</p><p x = \'"\'>Second</p></article>', ["First", "Second"]),
        ('<article><p>One <a href="x>two</a> three</p></article>', ["One two three"]),
        ("<article><p>1 < 2 and <3</p></article><p", ["1 < 2 and <3"]),
        (f"<div><p>{LONG}</p></div><div class=comments><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>", [LONG.strip()]),
        (f"<article><p>{LONG}</p><ul><li><a href=a>One link</a><li><a href=b>Two</a></ul></article>", [LONG.strip(), "One link", "Two"]),
        ("<article><SCRIPT type='x'>a < b; '</p>'</ScRiPt ><p>Seen.</p><style>p", ["Seen."]),
    ],
)
def test_pages_as_they_are_written(page, kept):
    assert [" ".join(t.split()) for t in html_extraction.main_blocks(page)] == [" ".join(t.split()) for t in kept]


@pytest.mark.parametrize("piece", ["<a ", "<a b=\">\" ", "<script ", "<!-- ", "<p x='", "<a b=' c=\"", "</", "<p   =", "<p>x"])
def test_reading_takes_linear_time(piece):
    def seconds(times):
        start = time.perf_counter()
        html_extraction.blocks_of("<p>" + piece * times)
        return time.perf_counter() - start

    assert min(seconds(64_000) for _ in range(2)) < 20 * max(seconds(8_000), 0.02)


def test_minimum_cut_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        scores = rng.normal(0, 2, n).round(2).tolist()
        edges = [(i, j, float(rng.uniform(0, 2).__round__(2))) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(kept, scores=scores, edges=edges):
            lost = sum(max(0, s) if not k else max(0, -s) for s, k in zip(scores, kept))
            return lost + sum(w for i, j, w in edges if kept[i] != kept[j])

        best = min(cost(k) for k in itertools.product([False, True], repeat=n))
        assert cost(html_extraction.source_side(scores, edges)) == pytest.approx(best)


def test_pages_keep_their_keys(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<article>x</article>"), (1, "u", "")], "page_id long, url string, html string")
    assert rows_of(html_extraction.extract_text(pages)) == [(1, "u", ""), (1, None, ""), (None, "u", "x")]
    assert html_extraction.extract_text(pages.limit(0)).count() == 0


# Quality and toxicity


def labelled(spark, name):
    return spark.read.parquet(f"{TABLES.replace('0.001', '0.01')}/{name}.parquet")


def test_quality_on_held_out_rows(spark, odd, empty):
    docs, labels = labelled(spark, "documents"), labelled(spark, "labels")
    found = score_quality(docs, labels)
    judged = found.filter("held_out").join(labels, F.col("id") == labels.doc_id)
    assert judged.select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.9
    assert found.filter("score < 0 OR score > 1").isEmpty() and found.count() == docs.count()
    none = labels.limit(0)
    assert {r.score for r in score_quality(odd, none).collect()} == {0.0}
    assert score_quality(odd, labels).count() == len(ODD)
    assert score_quality(empty, labels).count() == 0


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs, labels = labelled(spark, "documents"), labelled(spark, "labels")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first = toxicity.score_toxicity(docs, labels, keep=["doc_id"]).select("doc_id", "score")
    second = toxicity.score_toxicity(docs, turned, keep=["doc_id"]).select("doc_id", "score")
    assert rows_of(first) == rows_of(second)


def test_toxicity_on_held_out_rows(spark, odd, empty):
    docs, labels = labelled(spark, "documents"), labelled(spark, "labels")
    judged = toxicity.score_toxicity(docs, labels).filter("held_out").join(labels, "doc_id")
    assert judged.select(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0] > 0.85
    found = toxicity.score_toxicity(odd, labels)
    assert found.count() == len(ODD) and {"digest", "slot", "held_out", "predicted"} <= set(found.columns)
    assert {r.score for r in toxicity.score_toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_statistics_and_isotonic():
    assert statistics(None) == statistics("") == [0.0] * len(statistics("a b"))
    curve = isotonic(np.array([0.0, 500.0, 1000.0]), np.array([2.0, 1.0, 9.0]), np.array([10.0, 10.0, 10.0]))
    assert np.all(np.diff(curve) >= 0) and curve[0] == pytest.approx(0.15) and curve[-1] == pytest.approx(0.9)


# Mixing


def test_targets_stop_at_three_times_the_size(spark):
    sizes = {"a": 10, "b": 1000, "c": 5000, "d": 0, None: 400}
    table = spark.createDataFrame([(k or "n", k, v) for k, v in sizes.items()], "key string, source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(table, 64).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, left, target = set(sizes), float(sum(sizes.values())), {}
    while True:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    target.update({s: level * weights[s] for s in free})
    assert found == pytest.approx(target)


def test_mix_takes_no_document_too_often(spark, odd, empty):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    mix = mixing.mix_sources(docs)
    taken = mix.taken().collect()
    assert len(taken) == docs.count() and all(0 <= r.taken <= 3 * r.size for r in taken)
    for key in {r.key for r in taken}:
        target = next(r.target for r in taken if r.key == key)
        assert abs(sum(r.taken for r in taken if r.key == key) - target) <= 4 * mixing.BLOCK_WORDS
    again = mixing.mix_sources(docs.repartition(5)).taken()
    assert rows_of(again, "id", "taken") == sorted(((r.id, r.taken) for r in taken), key=repr)
    assert mixing.mix_sources(odd).taken().count() == len(ODD)
    assert mixing.mix_sources(empty).taken().count() == 0
    shards = mixing.slot_counts(mix).groupBy("shard").sum("slots").count()
    assert shards == mixing.SHARDS


def test_repeated_documents_meet_the_targets(spark):
    """Long documents of a rate below a half as well: the words of each source and its long part."""
    rows = [(k, "w " * (1500 if k % 3 else 40), f"s{k % 8 // 3}") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    taken = mixing.mix_sources(docs).taken().cache()
    mixed = corpus_pipeline.mix(spark, docs, TABLES)
    size = F.size(F.split(F.trim("text"), " "))
    out = {(r.source, r.long): r.words for r in mixed.groupBy("source", (size > 640).alias("long")).agg(F.sum(size).alias("words")).collect()}
    for r in taken.groupBy("source", "target").agg(F.sum(F.when(F.col("size") > 640, F.col("taken"))).alias("long")).collect():
        assert out[r.source, True] + out[r.source, False] == pytest.approx(r.target, rel=0.05)
        assert out[r.source, True] == pytest.approx(r.long, rel=0.05)
    assert mixed.groupBy("doc_id").count().filter("count > 3").isEmpty()
    again = corpus_pipeline.mix(spark, docs.repartition(5), TABLES)
    assert rows_of(again, "doc_id") == rows_of(mixed, "doc_id")


def test_mixing_keeps_rows_without_an_id(spark):
    rows = [(k if k % 3 else None, f"{k} " * 64, "s0", k) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    # A single source has its own size as its target: every document once.
    assert rows_of(corpus_pipeline.mix(spark, docs, TABLES)) == sorted(rows, key=repr)


def test_targets_are_dealt_to_the_word(spark, odd, empty):
    sizes = {"s0": [10], "s1": [20], "s2": [70], "s3": [200, 37], "s4": [3000, 2000], "s5": [1, 2], "s6": [20_000], "s7": [64]}
    rows = [(None, "w " * n, s) for s, parts in sizes.items() for n in parts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for table in (docs, odd):
        for r in mixing.mix_sources(table, in_words=True).taken().groupBy("key").agg(F.sum("taken").alias("n"), F.max("target").alias("target"), F.max(F.expr("taken / nullif(size, 0)")).alias("most")).collect():
            assert r.n == round(r.target) and (r.most or 0) <= 3
    assert mixing.mix_sources(empty, in_words=True).taken().count() == 0
    copied = corpus_pipeline.mix(spark, odd, TABLES)
    assert rows_of(copied.filter("doc_id IS NULL"), "text") == [("x y z",)] * 3


# Decontamination


def brute_hits(text, items):
    words_of = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = words_of(text), set(), set()
    for key, item in items:
        own = words_of(item)
        size = min(10, len(own))
        for start in range(len(own) - size + 1) if own else ():
            for place in range(len(words) - size + 1):
                if words[place : place + size] == own[start : start + size]:
                    hit.update(range(place, place + size))
                    found.add(key)
    return len(words), len(hit), sorted(str(f) for f in found if f is not None)


@pytest.mark.parametrize(("shingle", "bits"), [(3, 24), (1, 15), (10, 15)])
def test_hits_against_brute_force(spark, odd, empty, shingle, bits):
    items = [(1, "quick brown fox"), (2, PROSE), (None, "seven wizards"), (3, ""), (4, None), (10, "QUICK Brown fox"), (5, "東京")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_hits(odd, table, keep=["doc_id", "text"], shingle_words=shingle, bitmap_bits=bits)
    for row in found.withColumn("n_hit", decontamination.hit_words()).collect():
        assert (row.n_words, row.n_hit, row.hit_items) == brute_hits(row.text, items)
    assert decontamination.find_hits(empty, table).count() == 0
    assert decontamination.find_hits(odd, table.limit(0)).filter("size(hit_from) > 0").count() == 0
    clean = decontamination.clean_documents(odd, table)
    assert clean.columns == odd.columns and clean.filter("doc_id IN (9, 10, 11)").isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_hits_in_few_words_and_hot_windows(spark, seed):
    """Texts of few words, so that windows repeat and overlap, with one window in a third of the rows."""
    draw = random.Random(seed)
    some = lambda n: " ".join(draw.choices("a b c é".split(), k=n))
    hot = some(12)
    texts = [None, "", "a"] + [hot if n % 3 == 0 else some(draw.randrange(60)) for n in range(150)] + [some(4000)]
    items = [(n % 20, some(draw.choice([1, 2, 3, 9, 10, 11, 14]))) for n in range(6, 40)] + [(99, hot)]
    items = [i for i in items if len(i[1].split()) > seed]  # one-word items hit nearly everything
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_hits(docs, table).withColumn("n_hit", decontamination.hit_words()).collect()
    assert len(found) == len(texts)
    for row in found:
        assert (row.n_words, row.n_hit, row.hit_items) == brute_hits(row.text, items)


def test_hits_are_found_by_joins(spark):
    docs, table = (spark.read.parquet(f"{TABLES}/{name}.parquet") for name in ("documents", "benchmark"))
    index = decontamination.find_hits(docs, table, keep=["doc_id"])
    assert "Join" in index._jdf.queryExecution().toString()
    with_clash = docs.withColumns({"_row": F.lit("mine"), "n_words": F.lit(-7), "places": F.lit(0.5)})
    clean = decontamination.clean_documents(with_clash, table)
    assert clean.columns == with_clash.columns
    expected = index.filter(F.size("hit_from") == 0).count()
    assert 0 < expected < docs.count()
    assert clean.filter("_row = 'mine' AND n_words = -7 AND places = 0.5").count() == clean.count() == expected


# Pipeline


def test_stored_texts_are_smaller_than_by_default(spark, tmp_path):
    docs = corpus_pipeline.table(spark, TABLES, "documents")
    again = stored(docs, "texts")
    docs.write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))

    def size(rows):
        return sum(os.path.getsize(f.removeprefix("file://")) for f in rows.inputFiles())

    assert rows_of(again) == rows_of(docs) and size(again) < 0.8 * size(plain)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, TABLES)
        if name == "simhash_near_dedup":
            label = components([(r.doc_id, reference_fingerprint(r.text)) for r in docs.collect()])
            assert len(set(label.values())) < len(label)
            assert rows_of(result, "doc_id") == sorted(((k,) for k in set(label.values())), key=repr)
        if name == "benchmark_decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
            clean = [(r.doc_id,) for r in docs.collect() if not brute_hits(r.text, items)[1]]
            assert rows_of(result, "doc_id") == sorted(clean, key=repr)
        if name == "sharding":
            assert result.count() == docs.count()
        else:
            assert result.columns == columns
        docs = result
    assert corpus_pipeline.run(spark, TABLES).count() == docs.count()


def test_rows_with_one_id_and_different_texts_stay(spark):
    apart = [f"{k}{k + 1} ".join("abcdefghijklmnopq") for k in range(3)]
    rows = [(1, apart[0]), (1, apart[1]), (1, apart[0]), (2, apart[1]), (0, apart[2]), (None, apart[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = [(0, apart[2]), (1, apart[0]), (1, apart[1]), (None, apart[0])]
    assert rows_of(corpus_pipeline.drop_near_duplicates(spark, docs, TABLES)) == sorted(expected, key=repr)


def test_pipeline_of_odd_rows(spark, odd, empty):
    columns = DOCS.replace(" long", "").replace(" string", "").split(", ")
    for docs in (odd.select(*columns), empty):
        before = Counter(map(tuple, docs.collect()))
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, TABLES)
            after = Counter(map(tuple, docs.select(*columns).collect()))
            # Mixing repeats rows, sharding keeps all, the others only drop some.
            assert set(after) <= set(before) if name == "mixing" else after <= before
            assert name != "sharding" or after == before
            before = after
