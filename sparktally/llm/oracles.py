"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from sparktally.llm.mixing import BLOCK_WORDS, MAX_REPEATS, PRIMES, WEIGHTS

OP1 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id
       THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""

OP2 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (
  SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
  sha256(t) AS text_sha256
FROM g
"""

UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
LOWER = "'abcdefghijklmnopqrstuvwxyz'"
# Words once A-Z are in lower case.
WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), "
    r"'[0-9a-z\x{80}-\x{10FFFF}]+')"
)

OP9 = rf"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, list_slice(w, i, i + least(len(w), 10) - 1) AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
places AS (
  SELECT r, size, i, list_slice(w, i, i + size - 1) AS words
  FROM (
    SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM docs, (SELECT DISTINCT size FROM windows) AS sizes WHERE len(w) >= size
  )
),
found AS (SELECT r, i, places.size AS size, item_id FROM places JOIN windows USING (size, words)),
hit AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS place FROM found) GROUP BY r
),
listed AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    coalesce(string_agg(item_id, ',' ORDER BY item_id), '') AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""

OP5 = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(0, len(parts))) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)
),
keyed AS (
  SELECT doc_id, line_no,
    list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS words
  FROM lines
),
sets AS (
  SELECT words, len(words) AS n, min(row(coalesce(doc_id, -1), line_no)) AS first
  FROM keyed WHERE len(words) > 0 GROUP BY words
),
numbered AS (SELECT row_number() OVER () AS r, * FROM sets),
counted AS (SELECT word, count(*) AS c FROM (SELECT unnest(words) AS word FROM sets) GROUP BY word),
-- Sets that match share one of their rarest words.
placed AS (
  SELECT r, n, first, word, row_number() OVER (PARTITION BY r ORDER BY c, word) AS place
  FROM (SELECT r, n, first, unnest(words) AS word FROM numbered) JOIN counted USING (word)
),
rare AS (SELECT * FROM placed WHERE 5 * (place - 1) <= n),
pairs AS (
  SELECT DISTINCT x.r AS xr, y.r AS yr FROM rare x JOIN rare y
    ON x.word = y.word AND x.first < y.first AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
),
later AS (
  SELECT DISTINCT y.words AS words
  FROM pairs JOIN numbered x ON x.r = xr JOIN numbered y ON y.r = yr
  WHERE 9 * len(list_intersect(x.words, y.words)) >= 4 * (x.n + y.n)
)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
  CASE WHEN later.words IS NOT NULL THEN 'similar' ELSE 'same' END AS reason
FROM keyed JOIN sets USING (words) LEFT JOIN later USING (words)
WHERE later.words IS NOT NULL OR row(coalesce(doc_id, -1), line_no) <> first
"""

# The steps of the mix as views: words, places, targets, slots. {documents} is a relation.
MIX = rf"""
sized AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(concat_ws('|', '11', CAST(doc_id AS VARCHAR))) AS h
  FROM {{documents}}
),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY key ORDER BY h, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized
),
ranked AS (
  SELECT key, source, source_size, {MAX_REPEATS} * source_size AS cap,
    list_extract([{", ".join(map(str, WEIGHTS))}],
      CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS BIGINT)) AS weight
  FROM (SELECT key, any_value(source) AS source, sum(size) AS source_size FROM sized GROUP BY key)
),
leveled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / CAST(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ranked
),
common AS (
  SELECT *, arg_min(level, cap / weight) FILTER (WHERE level * weight <= cap) OVER () AS shared
  FROM leveled
),
targets AS (
  SELECT key, CAST(source_size AS BIGINT) AS source_size,
    least(CAST(cap AS DOUBLE), shared * weight) AS target,
    CAST(ceil(source_size / {BLOCK_WORDS}) AS BIGINT) AS blocks,
    -- Whole passes over the source, and the words that are left of the target for one more.
    CAST(round(least(CAST(cap AS DOUBLE), shared * weight)) AS BIGINT) // nullif(CAST(source_size AS BIGINT), 0) AS passes,
    CAST(round(least(CAST(cap AS DOUBLE), shared * weight)) AS BIGINT) % nullif(CAST(source_size AS BIGINT), 0) AS rest
  FROM common
),
dealt AS (
  SELECT *, passes * blocks + CAST(ceil(rest / {BLOCK_WORDS}) AS BIGINT) AS slots FROM targets WHERE source_size > 0
),
visits AS (
  SELECT key, CAST((CASE {" ".join(f"WHEN blocks % {p} <> 0 THEN {p}" for p in PRIMES)} END
      * (slot % blocks + 1) + blocks - 1) % blocks AS BIGINT) AS block,
    CASE WHEN slot = slots - 1 AND rest % {BLOCK_WORDS} > 0 THEN rest % {BLOCK_WORDS} ELSE {BLOCK_WORDS} END AS room,
    count(*) AS times
  FROM (SELECT *, unnest(range(0, slots)) AS slot FROM dealt WHERE slots > 0) GROUP BY ALL
),
pieces AS (
  SELECT key, start, block, greatest(start, block * {BLOCK_WORDS}) - block * {BLOCK_WORDS} AS off,
    least(size, (block + 1) * {BLOCK_WORDS} - start) - greatest(0, block * {BLOCK_WORDS} - start) AS words
  FROM (SELECT *, unnest(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1)) AS block
    FROM (SELECT key, size, CAST(start AS BIGINT) AS start FROM placed WHERE size > 0))
),
takes AS (
  SELECT key, start, sum(greatest(0, least(words, room - off)) * times) AS taken
  FROM pieces JOIN visits USING (key, block) GROUP BY ALL
),
mixed AS (
  SELECT doc_id, size, source_size, target,
    CAST(CASE WHEN size > 0 THEN coalesce(taken, 0) ELSE 0 END AS BIGINT) AS taken
  FROM placed JOIN targets USING (key) LEFT JOIN takes USING (key, start)
)
"""

OP8 = "WITH " + MIX.format(documents="documents") + "SELECT * FROM mixed"

OP11 = rf"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {UPPER}, {LOWER}) AS t FROM documents
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
phrases AS (
  SELECT lang, size, words, count(*) AS a FROM (
    SELECT lang, size, list_slice(w, i, i + size - 1) AS words
    FROM places, (SELECT unnest(range(1, 6)) AS size) AS sizes WHERE i + size - 1 <= len(w)
  ) GROUP BY ALL
),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM phrases WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM phrases WHERE a >= 100 AND size > 1),
cuts AS (
  SELECT c.lang, c.words, c.size, c.a, k, x.a AS l, y.a AS r, n,
    CAST(CAST(1000 AS HUGEINT) * c.a * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) AS c
  JOIN phrases AS x ON x.lang = c.lang AND x.words = list_slice(c.words, 1, k)
  JOIN phrases AS y ON y.lang = c.lang AND y.words = list_slice(c.words, k + 1, c.size)
  JOIN totals ON totals.lang = c.lang
),
weakest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, k) AS place FROM cuts)
  WHERE place = 1
),
covered AS (
  SELECT DISTINCT lang, list_slice(words, s, s + len - 1) AS words, a
  FROM (SELECT lang, words, a, size, len, unnest(range(1, size - len + 2)) AS s
    FROM candidates, (SELECT unnest(range(2, 5)) AS len) AS lens WHERE len < size)
),
ranked AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score
  FROM weakest AS c WHERE NOT EXISTS (
    SELECT 1 FROM covered WHERE covered.lang = c.lang AND covered.words = c.words AND 100 * covered.a >= 100 * c.a
  )
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM ranked
) WHERE rank <= 2000
"""

# Levels above the leaves of a source and above the sources' roots: up to a million documents
# of a source, up to 4,096 sources.
SOURCE_LEVELS, TOP_LEVELS = 5, 3


def _written(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_written, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


def _levels(name: str, levels: int) -> str:
    """The runs and nodes of each level above the relation ``name`` 0, and the way of each row."""
    steps = []
    for k in range(levels):
        steps.append(f"""
{name}_runs{k} AS (
  SELECT tree, pos // 16 AS run, list(d ORDER BY pos) AS ds FROM {name}{k} WHERE n > 1 GROUP BY tree, pos // 16
),
{name}{k + 1} AS (
  SELECT tree, run AS pos, sha256(array_to_string(ds, '')) AS d, count(*) OVER (PARTITION BY tree) AS n
  FROM {name}_runs{k} UNION ALL SELECT tree, pos, d, n FROM {name}{k} WHERE n = 1
),
{name}_way{k + 1} AS (
  SELECT r, tree, pos // 16 AS pos,
    CASE WHEN ds IS NULL THEN cur ELSE sha256(before || cur || after) END AS cur,
    proof || before || after AS proof
  FROM (
    SELECT w.*, ds, coalesce(array_to_string(ds[1:w.pos % 16], ''), '') AS before,
      coalesce(array_to_string(ds[w.pos % 16 + 2:], ''), '') AS after
    FROM {name}_way{k} AS w LEFT JOIN {name}_runs{k} AS u ON u.tree = w.tree AND u.run = w.pos // 16
  )
),""")
    return "".join(steps)


# CRC-32, one bit after the other, as the unsigned number.
CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: list_transform(range(0, 8), lambda j: (ascii(c) >> j) & 1)))),
    lambda s, b: xor(xor(s, b) >> 1, 3988292384 * (xor(s, b) & 1))))"""

OP13 = f"""
WITH leaves AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
    CASE WHEN {CRC} % 5 = 0 THEN {_leaf(f"translate(text, {UPPER}, {LOWER})")} END AS offered
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
),
s0 AS (SELECT tree, pos, leaf AS d, n FROM placed),
s_way0 AS (SELECT r, tree, pos, coalesce(offered, leaf) AS cur, '' AS proof FROM placed),
{_levels("s", SOURCE_LEVELS)}
subroots AS (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS pos FROM s{SOURCE_LEVELS}),
t0 AS (SELECT '' AS tree, pos, d, count(*) OVER () AS n FROM subroots),
t_way0 AS (
  SELECT r, '' AS tree, u.pos AS pos, cur, proof FROM s_way{SOURCE_LEVELS} AS w JOIN subroots AS u ON u.tree = w.tree
),
{_levels("t", TOP_LEVELS)}
ended AS (SELECT d AS root FROM t{TOP_LEVELS})
SELECT doc_id, leaf, u.d AS subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM placed AS p JOIN subroots AS u ON u.tree = p.tree JOIN t_way{TOP_LEVELS} AS w ON w.r = p.r, ended
"""

LLM_ORACLES = {
    "op1_warc": OP1,
    "op2_exact_dedup": OP2,
    "op5_line_dedup": OP5,
    "op8_mixing": OP8,
    "op9_decontamination": OP9,
    "op11_collocations": OP11,
    "op13_merkle": OP13,
}
