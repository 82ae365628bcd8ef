"""SQL twins of those training-data queries that SQL can express."""

OP4 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
    FROM range(2) r(i)
),
sized AS (
    SELECT *,
        replace(replace(role, '\', '\b'), '<|', '<\p') AS role_e,
        replace(replace(text, '\', '\b'), '<|', '<\p') AS text_e,
        row_number() OVER o AS k, count(*) OVER (PARTITION BY conv_id) AS n
    FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
summed AS (
    SELECT *,
        sum(12 + length(replace(role_e, chr(10), '\n')) + 1 + length(text_e) + 11)
            OVER (PARTITION BY conv_id ORDER BY k) AS upto
    FROM sized
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(upto) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""

OP8 = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+'), lambda w: w <> '') AS w
    FROM documents
),
shingled AS (
    SELECT doc_id, CASE WHEN len(w) >= 5
            THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM texts
),
classes AS (
    SELECT min(doc_id) AS rep, count(*) AS copies, s, len(s) AS n
    FROM (SELECT doc_id, list_sort(s) AS s FROM shingled WHERE len(s) > 0) GROUP BY s
),
members AS (
    SELECT d.doc_id, c.rep, c.copies
    FROM (SELECT doc_id, list_sort(s) AS s FROM shingled) d JOIN classes c ON d.s = c.s
),
items AS (SELECT rep, n, copies, unnest(s) AS x FROM classes),
shared AS (
    SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, b.copies AS copies, count(*) AS k
    FROM items a JOIN items b ON a.x = b.x AND a.rep <> b.rep AND a.n <= b.n * 1.25 + 1e-9 AND b.n <= a.n * 1.25 + 1e-9
    GROUP BY ALL
),
links AS (SELECT a, b, copies FROM shared WHERE k >= 0.8 * (na + nb - k) - 1e-9),
reach(v, r) AS (SELECT rep, rep FROM classes UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.v),
roots AS (SELECT v, min(r) AS root FROM reach GROUP BY v),
counts AS (SELECT a, sum(copies) AS k FROM links GROUP BY a)
SELECT d.doc_id, coalesce(m.rep, d.doc_id) AS class_id,
    CAST(coalesce(m.copies - 1 + coalesce(c.k, 0), 0) AS BIGINT) AS n_links,
    coalesce(r.root, d.doc_id) AS component_id,
    coalesce(r.root = d.doc_id, true) AS kept
FROM documents d LEFT JOIN members m ON m.doc_id = d.doc_id
LEFT JOIN roots r ON r.v = m.rep LEFT JOIN counts c ON c.a = m.rep
"""

OP5 = """
WITH RECURSIVE usual AS (
    SELECT len(embedding) AS d FROM embeddings WHERE embedding IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, d DESC LIMIT 1
),
valid AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings, usual
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) = d
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
),
reach(v, r) AS (SELECT vec_id, vec_id FROM valid UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.v),
roots AS (SELECT v, min(r) AS root FROM reach GROUP BY v),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(root, e.vec_id) AS component_id,
    coalesce(root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN roots ON v = e.vec_id LEFT JOIN counts ON a = e.vec_id
"""

OP6 = """
WITH sized AS (
    SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
    FROM pages
),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM sized)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM kept
"""

OP13 = r"""
WITH RECURSIVE digests AS (
    SELECT row_number() OVER () AS rid, doc_id, source,
        sha256(field_id || field_source || field_lang || field_chars || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN doc_id IS NOT NULL AND crc % 2 = 0
            THEN sha256(field_id || field_source || field_lang || field_chars
                || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS tampered
    FROM (
        SELECT *,
            coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS field_id,
            coalesce(strlen(source) || ':' || source, '-') AS field_source,
            coalesce(strlen(lang) || ':' || lang, '-') AS field_lang,
            coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS field_chars,
            xor(list_reduce(
                list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, o: xor(x >> 1, (x & 1) * 3988292384))
            ), 4294967295) AS crc
        FROM documents
    )
),
placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
    FROM digests
),
lower_levels(tree, lvl, pos, digest, n) AS (
    SELECT tree, 0, pos, leaf, n FROM placed
    UNION ALL
    SELECT tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
    FROM lower_levels WHERE n > 1 GROUP BY tree, lvl, pos // 3, n
),
subroots AS MATERIALIZED (SELECT tree, digest AS subroot, lvl AS height, max(tree) OVER () + 1 AS n FROM lower_levels WHERE n = 1),
upper_levels(tree, lvl, pos, digest, n) AS (
    SELECT -1, 0, tree, subroot, n FROM subroots
    UNION ALL
    SELECT -1, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
    FROM upper_levels WHERE n > 1 GROUP BY lvl, pos // 3, n
),
nodes AS MATERIALIZED (SELECT * FROM lower_levels UNION ALL SELECT * FROM upper_levels),
flanks AS MATERIALIZED (
    SELECT a.tree, a.lvl, a.pos,
        coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
        coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
    FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3
    WHERE a.n > 1 GROUP BY ALL
),
path AS MATERIALIZED (
    SELECT p.rid, f.lvl AS step, f.l, f.r
    FROM placed p JOIN flanks f ON f.tree = p.tree AND f.pos = p.pos // CAST(3 ** f.lvl AS BIGINT)
    UNION ALL
    SELECT p.rid, s.height + f.lvl, f.l, f.r
    FROM placed p JOIN subroots s ON s.tree = p.tree
    JOIN flanks f ON f.tree = -1 AND f.pos = p.tree // CAST(3 ** f.lvl AS BIGINT)
),
folds(rid, step, digest) AS (
    SELECT rid, 0, coalesce(tampered, leaf) FROM placed
    UNION ALL
    SELECT f.rid, f.step + 1, sha256(p.l || f.digest || p.r) FROM folds f JOIN path p ON p.rid = f.rid AND p.step = f.step
),
proofs AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM path GROUP BY rid),
root AS (SELECT digest AS root FROM upper_levels WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (tree) CROSS JOIN root LEFT JOIN proofs USING (rid)
JOIN (SELECT rid, arg_max(digest, step) AS folded_root FROM folds GROUP BY rid) USING (rid)
"""

ORACLES = {
    "op4_chat": OP4,
    "op5_embedding_dedup": OP5,
    "op6_warc": OP6,
    "op8_jaccard": OP8,
    "op13_merkle": OP13,
}
