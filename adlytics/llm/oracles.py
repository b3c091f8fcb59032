"""SQL for the operators' queries, where SQL can say it.

Mixing, packing, token files, approximate search and whitening have none (random draws,
tokenizers, recall, eigenvectors); sharding has none, as a checksum of whole texts is too
slow in SQL. Their tests compare with plain Python, round trips or recall.
"""

from __future__ import annotations

import re

from adlytics.llm import license_scan, line_rules

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


def _words(text: str, separators: str = r"[\x20\x09-\x0D]+") -> str:
    return f"list_filter(string_split_regex({text}, '{separators}'), lambda x: x <> '')"


_LINES = """
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
"""

LINE_DEDUP = f"""
WITH lines AS ({_LINES}),
keyed AS (SELECT *, trim({_lower('line')}, {_SPACES}) AS key FROM lines),
judged AS (
    SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_STOCK = " OR ".join(f"contains(lower(line), '{phrase}')" for phrase in line_rules.BOILERPLATE)
_MARKS = line_rules.SENTENCE_MARKS

LINE_RULES = f"""
WITH lines AS ({_LINES}),
counted AS (SELECT *, len({_words('line')}) AS n FROM lines),
judged AS (
    SELECT *,
           length(line) - length(regexp_replace(line, '[{line_rules.SEPARATORS}]', '', 'g'))
               >= greatest(2, n * {line_rules.MENU_SHARE})
           OR length(line) - length(regexp_replace(line, '[{line_rules.SYMBOLS}]', '', 'g'))
               > n * {line_rules.MARKUP_SHARE}
           OR n <= {line_rules.BOILERPLATE_WORDS} AND ({_STOCK})
           OR NOT regexp_matches(line, '{_MARKS}')
               AND (n < {line_rules.FRAGMENT_WORDS} OR n > {line_rules.RUN_WORDS}) AS failed
    FROM counted WHERE n > 0
),
by_line AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
           coalesce(sum(n) FILTER (failed), 0) AS n_lost_words
    FROM judged GROUP BY doc_id
),
worded AS (SELECT doc_id, coalesce(text, '') AS text, {_words("coalesce(text, '')")} AS w FROM documents),
windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM worded
),
repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM repeated
    ) GROUP BY doc_id
),
base AS (
    SELECT doc_id, len(w) AS n_words,
           length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
           length(text) - length(regexp_replace(text, '[{line_rules.SYMBOLS}]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
           coalesce(n_lost_words, 0) AS n_lost_words,
           len(w) < {line_rules.MIN_WORDS} OR 100 * coalesce(covered.n, 0) > 50 * len(w) AS base_failed
    FROM worded LEFT JOIN by_line USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND n_lost_words <= {line_rules.MAX_LOST} * n_words AS kept,
       n_lost_words::BIGINT AS n_lost_words
FROM base
"""

_TEMPLATES = ", ".join(
    f"({i}, '{label}', {str(exact).lower()}, {re.findall('[0-9a-z]+', wording)})"
    for i, (exact, label, wording) in enumerate(
        [(True, *x) for x in license_scan.PHRASES] + [(False, *x) for x in license_scan.NOTICES]
    )
)

LICENSE_SCAN = f"""
WITH worded AS (
    SELECT doc_id, {_words(_lower("coalesce(text, '')"), license_scan.SEPARATORS)} AS w FROM documents
),
templates(template, label, exact, t) AS (VALUES {_TEMPLATES}),
spots AS (
    SELECT template, label, exact, len(t) - 2 AS windows, unnest(range(1, len(t) - 1)) AS spot,
           t[spot] AS a, t[spot + 1] AS b, t[spot + 2] AS c
    FROM templates
),
windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM worded
),
votes AS (
    SELECT doc_id, template, label, exact, windows, i - spot AS diagonal, count(DISTINCT spot) AS n,
           list(DISTINCT spot) AS spots_hit, min(i) AS first_i, max(i) AS last_i
    FROM windows JOIN spots USING (a, b, c) GROUP BY ALL
),
alone AS (
    SELECT doc_id, label, exact, diagonal AS start, (n / windows)::DOUBLE AS coverage
    FROM votes
    WHERE n / windows >= CASE WHEN exact OR windows <= {license_scan.SHORT} THEN 1.0
                              ELSE {license_scan.COVERAGE} END
),
fresh AS (
    SELECT *, coalesce(diagonal - lag(diagonal) OVER near > {license_scan.DRIFT}, true)::INT AS begins
    FROM votes WHERE NOT exact WINDOW near AS (PARTITION BY doc_id, template ORDER BY diagonal)
),
spans AS (
    SELECT *, sum(begins) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM fresh
),
merged AS (
    SELECT doc_id, template, label, windows, span, len(list_distinct(flatten(list(spots_hit)))) AS held,
           min(first_i) AS first_i, max(last_i) AS last_i
    FROM spans GROUP BY ALL
),
notices AS (
    SELECT doc_id, label, false AS exact, first_i AS start, (held / windows)::DOUBLE AS coverage
    FROM merged
    WHERE held / windows >= CASE WHEN windows <= {license_scan.SHORT} THEN 1.0
                                 ELSE {license_scan.COVERAGE} END
      AND last_i - first_i + 1 <= {license_scan.STRETCH} * windows + 1
),
every AS (SELECT * FROM alone UNION ALL SELECT * FROM notices)
SELECT doc_id, any_value(len(w))::BIGINT AS n_words, count(start) FILTER (exact) AS n_base,
       (min(start) FILTER (exact))::BIGINT AS first_word,
       (max(start) FILTER (exact))::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (exact)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (label IS NOT NULL)), ','), '')
           AS labels,
       coalesce(max(coverage), 0.0)::DOUBLE AS score
FROM worded LEFT JOIN every USING (doc_id) GROUP BY doc_id
"""

SIGNATURE_TREES = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, {_words(_lower("coalesce(text, '')"))} AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE
            WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])
            WHEN len(w) > 0 THEN [w] ELSE [] END) AS s
        FROM worded
    )
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(x.n) + any_value(y.n) - count(*))
),
reached(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
)
SELECT reached.a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM reached LEFT JOIN sizes ON sizes.doc_id = reached.a GROUP BY reached.a
"""


def _leaf_sql(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(
        f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')"
        for f in fields
    ) + ")"


# CRC-32 of a number's digits: each byte is mixed in, then shifted out bit by bit.
_CRC_SQL = """
    xor(4294967295, list_reduce(
        [4294967295] || flatten(list_transform(
            string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                            ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END))
"""

MERKLE = f"""
WITH RECURSIVE given AS (
    SELECT *, {_leaf_sql("n_chars")} AS leaf,
           CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")}
                ELSE {_leaf_sql("n_chars")} END AS seen
    FROM documents),
leaves AS (
    SELECT doc_id, leaf, seen,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS nodes,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM given),
up AS (
    SELECT tree, 0 AS level, nodes, place, leaf AS h FROM leaves
    UNION ALL
    SELECT tree, level + 1, (nodes + 1) // 2, place // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM up WHERE nodes > 1 GROUP BY tree, level, nodes, place // 2),
crown AS (
    SELECT 0 AS level, (SELECT count(*) FROM up WHERE nodes = 1) AS nodes, tree AS place, h
    FROM up WHERE nodes = 1
    UNION ALL
    SELECT level + 1, (nodes + 1) // 2, place // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM crown WHERE nodes > 1 GROUP BY level, nodes, place // 2),
inner_walk AS (
    SELECT doc_id, leaf, tree, nodes, place AS start, 0 AS level, place, '' AS proof, seen AS folded
    FROM leaves
    UNION ALL
    SELECT w.doc_id, w.leaf, w.tree, (w.nodes + 1) // 2, w.start, w.level + 1, w.place // 2,
           w.proof || coalesce(s.h, ''),
           sha256(CASE WHEN s.h IS NULL THEN w.folded
                       WHEN w.place % 2 = 1 THEN s.h || w.folded ELSE w.folded || s.h END)
    FROM inner_walk w
    LEFT JOIN up s ON s.tree = w.tree AND s.level = w.level AND s.place = xor(w.place, 1)
    WHERE w.nodes > 1),
outer_walk AS (
    SELECT doc_id, leaf, tree, start, 0 AS level, tree AS place, proof, folded,
           (SELECT count(*) FROM up WHERE nodes = 1) AS nodes
    FROM inner_walk WHERE nodes = 1
    UNION ALL
    SELECT w.doc_id, w.leaf, w.tree, w.start, w.level + 1, w.place // 2,
           w.proof || coalesce(s.h, ''),
           sha256(CASE WHEN s.h IS NULL THEN w.folded
                       WHEN w.place % 2 = 1 THEN s.h || w.folded ELSE w.folded || s.h END),
           (w.nodes + 1) // 2
    FROM outer_walk w
    LEFT JOIN crown s ON s.level = w.level AND s.place = xor(w.place, 1)
    WHERE w.nodes > 1)
SELECT w.doc_id, w.leaf, t.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256,
       w.folded AS folded_root, w.folded = r.h AS verified
FROM outer_walk w
JOIN up t ON t.tree = w.tree AND t.nodes = 1
CROSS JOIN (SELECT h FROM crown WHERE nodes = 1) r
WHERE w.nodes = 1
"""


# Sums of products of whole numbers are exact in doubles here.
PIVOT_SEARCH = """
WITH valid AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x,
           row_number() OVER () AS row
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, q.row AS query, c.vec_id, c.row,
           list_inner_product(q.x, c.x)::BIGINT AS score
    FROM valid q JOIN valid c ON c.row <> q.row AND len(c.x) = len(q.x)
    WHERE q.vec_id % 50 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, row) AS rank
    FROM scored
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op4_signature_trees": SIGNATURE_TREES,
    "op5_line_dedup": LINE_DEDUP,
    "op6_license_scan": LICENSE_SCAN,
    "op9_line_rules": LINE_RULES,
    "op11_merkle_manifest": MERKLE,
    "op12_pivot_search": PIVOT_SEARCH,
}
