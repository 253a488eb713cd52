"""DuckDB SQL for the queries of this subpackage that SQL can express.

Tokenizers, fitted models, fingerprints and edit distances are beyond it; those queries
are tested against the public library, brute force or held-out labels in ``tests/llm``.
"""

from __future__ import annotations

_PAGES = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
    SELECT page_id, html, array_to_string(list_transform(range(1, 41), lambda k: right('0000' || bin(instr('0123456789abcdef', hex[k]) - 1), 4)), '') AS bits
    FROM payloads
), digests AS (
    SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS best,
        array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + 16 * bits[5 * k + 1]::INT + 8 * bits[5 * k + 2]::INT + 4 * bits[5 * k + 3]::INT + 2 * bits[5 * k + 4]::INT + bits[5 * k + 5]::INT, 1)), '') AS digest
    FROM bits
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> best THEN best END AS refers_to, true AS intact
FROM digests
"""

_NEAR = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
), shingles AS (
    SELECT doc_id, unnest(s) AS g FROM sets
), common AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
    FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT u, v FROM common JOIN sets a ON a.doc_id = u JOIN sets b ON b.doc_id = v
    WHERE 100 * c >= 80 * (len(a.s) + len(b.s) - c)
), steps AS MATERIALIZED (
    SELECT u, v FROM links UNION SELECT v, u FROM links
), reached(doc_id, c) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT steps.v, reached.c FROM reached JOIN steps ON steps.u = reached.doc_id WHERE steps.v > reached.c
), least AS (
    SELECT doc_id, min(c) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""

_REPEATS = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), blocks AS (
    SELECT doc_id, start, least(1000, n - 399 - start) AS m, substr(h, 2 * start + 1, 2 * 1399) AS part
    FROM (SELECT doc_id, h, n, unnest(range(0, greatest(n - 399, 0), 1000)) AS start FROM texts)
), strings AS MATERIALIZED (
    SELECT doc_id, start + q AS p, md5(substr(part, 2 * q + 1, 800)) AS k
    FROM (SELECT doc_id, start, part, unnest(range(0, m)) AS q FROM blocks)
), repeated AS (
    SELECT doc_id, p FROM strings WHERE k IN (SELECT k FROM strings GROUP BY k HAVING count(*) > 1)
), numbered AS (
    SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
        SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 400 THEN 0 ELSE 1 END AS fresh FROM repeated)
), runs AS (
    SELECT doc_id, min(p) AS a, max(p) + 400 AS b FROM numbered GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
), cut AS (
    SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
        string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
    sha256(unhex(CASE WHEN last IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""


# The checksum is taken bit by bit over the digits of the id. The trees grow level by level until one node is left;
# a proof is the siblings of the leaf's ancestors in the tree of its language, then of that language in the upper tree.
_MERKLE = """
WITH RECURSIVE sums AS (
    SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, bit: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))) AS crc FROM documents
), fields AS (
    SELECT *, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(crc, 4294967295::BIGINT) % 3 END AS third,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM sums
), digests AS MATERIALIZED (
    SELECT doc_id, lang, third, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(octet_length(encode(lowered)) || ':' || lowered, '-')) AS tampered
    FROM (SELECT *, concat(coalesce(length(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
        coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head FROM fields)
), leaves AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS total FROM digests
), inner_nodes AS (
    SELECT lang, 0 AS level, idx, total AS width, leaf AS digest FROM leaves
    UNION ALL
    SELECT lang, any_value(level) + 1, idx // 8, (any_value(width) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM inner_nodes WHERE width > 1 GROUP BY lang, idx // 8
), nodes AS MATERIALIZED (SELECT * FROM inner_nodes
), subroots AS MATERIALIZED (
    SELECT lang, digest, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS idx, count(*) OVER () AS total FROM nodes WHERE width = 1
), upper_inner AS (
    SELECT 0 AS level, idx, total AS width, digest FROM subroots
    UNION ALL
    SELECT any_value(level) + 1, idx // 8, (any_value(width) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM upper_inner WHERE width > 1 GROUP BY idx // 8
), upper_nodes AS MATERIALIZED (SELECT * FROM upper_inner
), steps AS MATERIALIZED (
    SELECT a.lang, a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
        coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
    FROM nodes a JOIN nodes b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.idx // 8 = b.idx // 8 AND a.width > 1 GROUP BY ALL
), upper_steps AS MATERIALIZED (
    SELECT a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
        coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
    FROM upper_nodes a JOIN upper_nodes b ON a.level = b.level AND a.idx // 8 = b.idx // 8 AND a.width > 1 GROUP BY ALL
), path AS (
    SELECT l.lang, l.idx AS place, false AS upper, s.level, s.before, s.after FROM leaves l JOIN steps s
        ON s.lang IS NOT DISTINCT FROM l.lang AND s.idx = l.idx // pow(8, s.level)::BIGINT
    UNION ALL
    SELECT l.lang, l.idx, true, s.level, s.before, s.after FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN upper_steps s
        ON s.idx = r.idx // pow(8, s.level)::BIGINT
), proofs AS (
    SELECT lang, place, string_agg(before || after, '' ORDER BY upper, level) AS proof, list([before, after] ORDER BY upper, level) AS steps FROM path GROUP BY ALL
), whole AS (
    SELECT l.doc_id, l.leaf, r.digest AS subroot, (SELECT digest FROM upper_nodes WHERE width = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
        list_reduce(list_prepend([CASE WHEN third = 0 THEN tampered ELSE leaf END, ''], coalesce(steps, [])),
            lambda own, s: [sha256(s[1] || own[1] || s[2]), ''])[1] AS folded_root
    FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.place = l.idx
)
SELECT *, folded_root = root AS verified FROM whole
"""


def _mixing(rounds: int = 3, end: int = 1 << 60) -> str:
    """The mix with its thresholds found by running sums over all documents in order of their places."""
    cuts = []
    for k in range(1, rounds + 1):
        cuts.append(f"""
), offered{k} AS (
    SELECT key, place, sum(size) AS words, any_value(lft) AS lft FROM sized JOIN now{k - 1} USING (key)
    WHERE lft > 0 AND place >= start AND size BETWEEN 1 AND lft GROUP BY key, place
), running{k} AS (
    SELECT *, coalesce(sum(words) OVER (PARTITION BY key ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM offered{k}
), found{k} AS (
    SELECT key, min(place) FILTER (before + words > lft) AS threshold, min(lft - before) FILTER (before <= lft AND before + words > lft) AS part,
        min(before + words - lft) FILTER (before <= lft AND before + words > lft) AS over, any_value(lft) - sum(words) AS spare FROM running{k} GROUP BY key
), now{k} AS MATERIALIZED (
    SELECT n.key, coalesce(f.threshold, {end}) AS start, CASE WHEN f.key IS NULL THEN n.lft ELSE coalesce(f.part, f.spare) END AS lft,
        CASE WHEN n.lft > 0 THEN n.lft ELSE -1 END AS most, coalesce(f.over, 'infinity') AS over
    FROM now{k - 1} n LEFT JOIN found{k} f USING (key)""")
    each = range(1, rounds + 1)
    overs = ", ".join(f"now{k}.over" for k in each)
    best = f"CASE WHEN least({overs}) < now{rounds}.lft THEN list_position([{overs}], least({overs})) ELSE {rounds + 1} END"
    kept = ", ".join(f"now{k}.start AS start{k}, now{k}.most AS most{k}" for k in each)
    admitted = " OR ".join(f"(best >= {k} AND size <= most{k} AND place < start{k} + (best = {k})::INT)" for k in each)
    joins = " ".join(f"JOIN now{k} USING (key)" for k in each)
    return rf"""
WITH sized AS MATERIALIZED (
    SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
        len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS place
    FROM documents
), sources AS (
    SELECT key, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS most,
        [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY any_value(source) NULLS LAST) - 1) % 3)]::DOUBLE AS weight FROM sized GROUP BY key
), filling AS (
    SELECT *, row_number() OVER w AS turn, coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS most_before,
        coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS weight_before,
        (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget, sum(weight) OVER () AS weights
    FROM sources WINDOW w AS (ORDER BY most / weight, key)
), level AS (
    SELECT arg_min(budget - most_before, turn) AS level_left, arg_min(weights - weight_before, turn) AS level_weight
    FROM filling WHERE (budget - most_before) * weight <= most * (weights - weight_before)
), targets AS (
    SELECT key, source_size, least(coalesce(level_left * weight / level_weight, 0), most::DOUBLE) AS target FROM filling, level
), passes AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM targets
), now0 AS MATERIALIZED (
    SELECT key, 0::BIGINT AS start, target - passes * source_size AS lft FROM passes{"".join(cuts)}
), plan AS (
    SELECT doc_id, size, place, source_size, target, passes, {kept}, {best} AS best FROM sized JOIN passes USING (key) {joins}
)
SELECT doc_id, size, source_size, target, (size * (passes + CASE WHEN {admitted} THEN 1 ELSE 0 END))::BIGINT AS taken FROM plan
"""


ORACLE: dict[str, str] = {
    "op3_arc_to_warc": _PAGES,
    "op7_near_duplicates": _NEAR,
    "op10_repeated_passages": _REPEATS,
    "op11_mixing": _mixing(),
    "op13_merkle": _MERKLE,
}
