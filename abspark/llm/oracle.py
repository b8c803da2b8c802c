"""DuckDB SQL for the operators that SQL can express; written for checking, not speed."""

from __future__ import annotations

from abspark.llm.heap_kmeans import CENTROIDS, DIM, ROUNDS, SCALE, SEED
from abspark.llm.line_dedup import MIN_CHARS, MIN_DOCS
from abspark.llm.nn_descent import THRESHOLD
from abspark.llm.prefix_trie import GROUP, MOST_SHARED
from abspark.llm.warc_bundles import REVISIT_BYTES

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, {_WHITE}), '{_UPPER}', '{_UPPER.lower()}') AS k FROM lines
), common AS (
    SELECT k FROM keyed WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
)
SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k
GROUP BY doc_id
"""

WARC = f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages
), firsts AS (
    SELECT *, CASE WHEN n >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY body) ELSE page_id END AS response FROM payloads
)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM firsts
"""

NEAR_VECTORS = f"""
WITH RECURSIVE good AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, r.c AS component_id, e.vec_id = r.c AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = e.vec_id
"""

# The patterns of the contract, letters of the keywords in either case.
_KEYWORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_PATTERNS = (
    ("assign", f"""({_KEYWORDS})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
)
_KINDS = "\nUNION ALL\n".join(
    f"""SELECT doc_id, {order} AS o, '{kind}' AS kind, {least} AS least, string_split_regex(t, '{p}') AS gaps,
       regexp_extract_all(t, '{p}', 0) AS whole, regexp_extract_all(t, '{p}', {group}) AS value FROM texts"""
    for order, (kind, p, group, least) in enumerate(_PATTERNS)
)
SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
kinds AS ({_KINDS}),
found AS (
    SELECT doc_id, o, kind, least, unnest(gaps[1:len(whole)]) AS gap, unnest(whole) AS w, unnest(value) AS v, generate_subscripts(whole, 1) AS i
    FROM kinds WHERE len(whole) > 0
), spans AS (
    SELECT *, sum(length(gap) + length(w)) OVER (PARTITION BY doc_id, o ORDER BY i) AS stop FROM found
), kept AS (
    SELECT doc_id, o, kind, (stop - length(w))::BIGINT AS start, stop::BIGINT AS stop FROM spans WHERE length(v) >= least
), listed AS (
    SELECT doc_id, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access, count(*) FILTER (WHERE o = 2) AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans
    FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts d LEFT JOIN listed USING (doc_id)
"""


def _kmeans() -> str:
    """Lloyd's rounds unrolled; integers up to 2**53 in doubles, so every product and sum is exact."""
    steps = [f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
    WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
        SELECT sha256('{SEED}:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {CENTROIDS})
)"""]
    near = """a{r} AS MATERIALIZED (
    SELECT i, min(d * 64 + c) % 64 AS c, min(d * 64 + c) // 64 AS d FROM (
        SELECT i, c, (list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, m.v) + list_inner_product(m.v, m.v))::BIGINT AS d
        FROM kept k CROSS JOIN c{r} m) GROUP BY i
)"""
    mean = """c{n} AS MATERIALIZED (
    SELECT m.c, coalesce(n.v, m.v) AS v FROM c{r} m LEFT JOIN (
        SELECT c, list(floor(s / n) ORDER BY place) AS v FROM (
            SELECT c, place, sum(x) AS s, count(*) AS n
            FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{r} JOIN kept USING (i)) GROUP BY c, place
        ) GROUP BY c) n ON n.c = m.c
)"""
    for r in range(ROUNDS):
        steps += [near.format(r=r), mean.format(r=r, n=r + 1)]
    steps.append(near.format(r=ROUNDS))
    return ", ".join(steps) + f"""
SELECT k.vec_id, a.c::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(m.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN kept k USING (i) JOIN c{ROUNDS} m ON m.c = a.c
"""


HEAP_KMEANS = _kmeans()

# CRC-32 by its definition: reflected, polynomial 0xEDB88320, start and end inverted.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(conv_id::VARCHAR, '.'), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

PREFIX_TRIE = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({{'turn': md5(json_array(role, text)::VARCHAR), 'bytes': strlen(text)}} ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM turns GROUP BY conv_id
), convs AS (
    SELECT conv_id, turns, conv_id - ((conv_id % {GROUP}) + {GROUP}) % {GROUP} AS base, {_CRC32} % {MOST_SHARED + 1} AS h FROM own
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS path FROM convs c LEFT JOIN own b ON b.conv_id = c.base
), steps AS (
    SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM rebuilt
), keyed AS (
    SELECT conv_id, depth, len(path) = depth AS ends, list_transform(path[1:depth], lambda t: t.turn) AS node, coalesce(path[depth].bytes, 0) AS bytes FROM steps
), nodes AS MATERIALIZED (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
           string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends) AS ends
    FROM keyed GROUP BY node, depth
), children AS (
    SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), facts AS MATERIALIZED (
    SELECT n.*, coalesce(c.n, 0) AS n_children, p.conv_id AS parent FROM nodes n
    LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
), ancestors AS (
    SELECT node[1:up] AS node, n_children = 0 AS leaf, (n_convs - 1) * bytes AS saved FROM (SELECT *, unnest(range(depth + 1)) AS up FROM facts)
), below AS (
    SELECT node, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM ancestors GROUP BY node
)
SELECT f.conv_id, f.depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, b.saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM facts f JOIN below b ON b.node = f.node
"""
