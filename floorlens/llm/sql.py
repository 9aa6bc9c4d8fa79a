"""DuckDB SQL for the rows of the operators that SQL can express."""

from __future__ import annotations

from floorlens.llm.curve_clusters import CLUSTERS, DIMENSIONS, ROUNDS, SCALE
from floorlens.llm.interleave import SEED, SHARDS
from floorlens.llm.prefix_trie import EMPTY, GROUP, HEAD
from floorlens.llm.quality import CURRENT, POLICIES, RULES

PAGES = """
WITH sized AS (
    SELECT page_id, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size FROM pages
),
firsts AS (SELECT digest, min(page_id) AS first FROM sized WHERE size >= 100 GROUP BY digest),
marked AS (
    SELECT sized.*, CASE WHEN size >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM sized LEFT JOIN firsts USING (digest)
)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM marked
"""

_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << bit} ELSE 0 END" for bit, rule in enumerate(RULES.values()))
_FAILS = {policy: " OR ".join(f"({RULES[r]})" for r in rules) for policy, rules in POLICIES.items()}

QUALITY = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
split AS (
    SELECT r, doc_id,
        regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
        length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        list_filter(string_split(body, chr(10)), lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM texts
),
tokens AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
windows AS (
    SELECT r, i, word AS a, lead(word) OVER own AS b, lead(word, 2) OVER own AS c
    FROM tokens WINDOW own AS (PARTITION BY r ORDER BY i)
),
met AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows WHERE c IS NOT NULL),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM met, (VALUES (0), (1), (2)) AS place(k) WHERE n > 1 GROUP BY r
),
measured AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(lines) AS n_lines
    FROM split LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_FAILS["base"]} AS base_failed,
    NOT ({_FAILS["base"]} OR {_FAILS[CURRENT]}) AS kept, CAST({_BITS} AS BIGINT) AS fails
FROM measured
"""

#: CRC-32 byte by byte: the table of 256 remainders follows from the reversed polynomial.
SHARDED = f"""
WITH remainders AS (
    SELECT list_transform(range(256), lambda n: list_reduce(
        [n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    )) AS remainder
),
bodies AS (
    SELECT doc_id, 's' || source AS stratum, strlen(coalesce(text, '')) AS bytes, hex(encode(coalesce(text, ''))) AS digits,
        md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS mark
    FROM documents
),
summed AS (
    SELECT doc_id, coalesce(stratum, '') AS stratum, bytes + 1 AS size, mark,
        xor(4294967295, list_reduce(
            [4294967295] || list_transform(range(bytes), lambda k: CAST('0x' || substr(digits, 2 * k + 1, 2) AS BIGINT)),
            lambda c, b: xor(c >> 8, remainder[1 + (xor(c, b) & 255)])
        )) AS text_crc32
    FROM bodies, remainders
),
ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY mark, doc_id, text_crc32) - 0.5::DOUBLE)
        / count(*) OVER (PARTITION BY stratum) AS place
    FROM summed
),
placed AS (
    SELECT *, row_number() OVER (ORDER BY place, stratum, mark, doc_id, text_crc32) - 1 AS position, count(*) OVER () AS total
    FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(position * {SHARDS} // total AS INTEGER) AS shard,
    position - (position * {SHARDS} // total * total + {SHARDS - 1}) // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""


def _assigned(round_: int) -> str:
    """Vectors with their nearest centroid of a round, and the centroids that follow from it."""
    return f"""
assigned{round_} AS MATERIALIZED (
    SELECT row, vec_id, cells, number, distance FROM (
        SELECT kept.*, number, list_sum(list_transform(list_zip(kept.cells, c.cells), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance,
            row_number() OVER (PARTITION BY row ORDER BY distance, number) AS place
        FROM kept, centroids{round_} AS c
    ) WHERE place = 1
)"""


def _moved(round_: int) -> str:
    return f"""
sums{round_} AS (
    SELECT number, d, CAST(sum(cell) AS HUGEINT) AS total, count(*) AS n
    FROM (SELECT number, unnest(cells) AS cell, generate_subscripts(cells, 1) AS d FROM assigned{round_}) GROUP BY number, d
),
centroids{round_ + 1} AS MATERIALIZED (
    SELECT c.number, coalesce(m.cells, c.cells) AS cells
    FROM centroids{round_} AS c LEFT JOIN (
        SELECT number, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY d) AS cells FROM sums{round_} GROUP BY number
    ) AS m USING (number)
)"""


CLUSTERED = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS cells
    FROM embeddings
    WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
),
centroids0 AS MATERIALIZED (
    SELECT place - 1 AS number, cells
    FROM (SELECT cells, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, cells) AS place FROM kept)
    WHERE place <= {CLUSTERS}
),{",".join(_assigned(r) + "," + _moved(r) for r in range(ROUNDS))},{_assigned(ROUNDS)}
SELECT vec_id, CAST(number AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
    CAST(sum(distance) OVER (PARTITION BY number) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.cells, ',')) AS centroid_sha256
FROM assigned{ROUNDS} JOIN centroids{ROUNDS} AS c USING (number)
"""

#: Paths are lists of turns; a node is a distinct path, and a subtree the nodes whose path starts with it.
PREFIXES = f"""
WITH remainders AS (
    SELECT list_transform(range(256), lambda n: list_reduce(
        [n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    )) AS remainder
),
turns AS (
    SELECT conv_id, turn, coalesce(text, '') AS body,
        CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || body AS content,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(content)) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % {GROUP} AS base, xor(4294967295, list_reduce(
        [4294967295] || list_transform(range(length(CAST(conv_id AS VARCHAR))), lambda k: CAST(ascii(substr(CAST(conv_id AS VARCHAR), k + 1, 1)) AS BIGINT)),
        lambda c, b: xor(c >> 8, remainder[1 + (xor(c, b) & 255)])
    )) % {HEAD} AS h
    FROM (SELECT DISTINCT conv_id FROM turns), remainders
),
rebuilt AS (
    SELECT convs.conv_id, 0 AS part, pos, content, body FROM convs JOIN turns ON turns.conv_id = base AND pos < h
    UNION ALL
    SELECT conv_id, 1, pos, content, body FROM convs JOIN turns USING (conv_id) WHERE pos >= h
),
paths AS (
    SELECT conv_id, coalesce(list(content ORDER BY part, pos) FILTER (content IS NOT NULL), []) AS path,
        coalesce(list(length(body) ORDER BY part, pos) FILTER (content IS NOT NULL), []) AS sizes
    FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
),
prefixes AS (SELECT conv_id, path, sizes, unnest(range(len(path) + 1)) AS depth FROM paths),
nodes AS MATERIALIZED (
    SELECT path[:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(any_value(sizes[depth]), 0) AS saved,
        coalesce(sha256(string_agg(CASE WHEN len(prefixes.path) = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id)), '{EMPTY}') AS ends_sha256
    FROM prefixes GROUP BY prefixes.path[:depth], depth
),
children AS (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
whole AS MATERIALIZED (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
sums AS (
    SELECT upper.path, sum(lower.saved) AS saved_tokens, sum((lower.n_children = 0)::INT) AS n_leaves
    FROM (SELECT path[:up] AS path, saved, n_children FROM (SELECT *, unnest(range(depth + 1)) AS up FROM whole)) AS lower
    JOIN whole AS upper USING (path) GROUP BY upper.path
)
SELECT whole.conv_id, whole.depth, parent.conv_id AS parent_conv_id, whole.n_convs, whole.n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, whole.ends_sha256
FROM whole JOIN sums USING (path) LEFT JOIN whole AS parent ON parent.path = whole.path[:whole.depth - 1] AND whole.depth = parent.depth + 1
"""
