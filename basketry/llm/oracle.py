"""DuckDB text of the queries that SQL can express."""

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_CRC = """
    xor(list_reduce(list_transform(range(0, length(key)), lambda i: CAST(ord(key[i + 1]) AS BIGINT)),
        lambda crc, byte: list_reduce(range(0, 8),
            lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
            xor(crc, byte)), 4294967295), 4294967295)"""
_STRIP = r"'^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$'"

# A row is a document; a null id is below all others.
LINE_DEDUP = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
lines AS (SELECT row, doc_id, unnest(all_lines) AS line, unnest(range(len(all_lines))) AS place FROM texts),
keyed AS (SELECT *, translate(regexp_replace(line, {_STRIP}, '', 'g'), {_UPPER}, {_LOWER}) AS key FROM lines),
repeated AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
             GROUP BY key HAVING count(DISTINCT row) >= 3),
judged AS (SELECT k.row, k.doc_id, k.line, k.place, r.key IS NOT NULL AND r.keeper IS DISTINCT FROM k.doc_id AS gone
           FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row"""

DECONTAMINATION = rf"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS phrase, least(len(w), 10) AS size
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes),
phrases AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM places),
hits AS (SELECT doc_id, item_id, p.size, i FROM phrases p JOIN windows USING (phrase, size)),
words AS (SELECT doc_id, count(DISTINCT place) AS n FROM
    (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM
    (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

TOPK_SEARCH = """
WITH vectors AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM vectors q, vectors c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM pairs)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 10"""

# A turn's mark is the MD5 of its role's length, role and text; a path's name that of its marks.
PREFIX_TRIE = f"""
WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) AS place, mark, size
    FROM (SELECT *, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS mark,
                 strlen(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL)),
plan AS (SELECT conv_id, conv_id - conv_id % 5 AS head_of, {_CRC} % 9 AS h
    FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS key FROM conversations WHERE conv_id IS NOT NULL)),
laid AS (SELECT p.conv_id, 0 AS part, t.place, t.mark, t.size FROM plan p JOIN turns t ON t.conv_id = p.head_of AND t.place <= p.h
    UNION ALL SELECT p.conv_id, 1, t.place, t.mark, t.size FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.place > p.h),
paths AS (SELECT conv_id, list(mark ORDER BY part, place) AS marks, list(size ORDER BY part, place) AS sizes
    FROM laid GROUP BY conv_id),
whole AS (SELECT plan.conv_id, coalesce(marks, []) AS marks, coalesce(sizes, []) AS sizes FROM plan LEFT JOIN paths USING (conv_id)),
steps AS (SELECT conv_id, d AS depth, md5(array_to_string(marks[1:d], ',')) AS node,
        CASE WHEN d > 0 THEN md5(array_to_string(marks[1:d - 1], ',')) END AS parent, coalesce(sizes[d], 0) AS size,
        d = len(marks) AS last
    FROM (SELECT *, unnest(range(0, len(marks) + 1)) AS d FROM whole)),
nodes AS (SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '') AS ends
    FROM steps GROUP BY node, depth),
born AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY ALL),
known AS (SELECT nodes.*, coalesce(born.n, 0) AS n_children FROM nodes
    LEFT JOIN born ON born.parent = nodes.node AND born.depth = nodes.depth),
above AS (SELECT a.node, a.depth, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.size) AS saved
    FROM known v JOIN steps s ON s.conv_id = v.conv_id AND s.depth <= v.depth JOIN known a ON a.node = s.node AND a.depth = s.depth
    GROUP BY a.node, a.depth)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, a.n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens,
       sha256(k.ends) AS ends_sha256
FROM known k JOIN above a ON a.node = k.node AND a.depth = k.depth
LEFT JOIN known p ON p.node = k.parent AND p.depth = k.depth - 1"""

PHRASE_COLLOCATIONS = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, unnest(range(1, 6)) s(size) WHERE len(w) >= size),
counts AS (SELECT lang, CAST(size AS BIGINT) AS size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS a
    FROM places GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, size, a, string_split(phrase, ' ') AS p, unnest(range(1, size)) AS k FROM counts WHERE size > 1),
scored AS (SELECT c.lang, c.phrase, c.size, c.a, k, l.a AS l, r.a AS r, n,
        CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
    FROM cuts c JOIN totals USING (lang)
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(p[1:k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(p[k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (SELECT lang, a, string_split(phrase, ' ') AS p, len, unnest(range(1, size - len + 2)) AS i
    FROM counts, unnest(range(2, 5)) s(len) WHERE size > len),
inside AS (SELECT lang, array_to_string(p[i:i + len - 1], ' ') AS phrase, max(a) AS most FROM parts GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE i.phrase IS NULL OR 100 * i.most < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000"""

ORACLE = {
    "op1_line_dedup": LINE_DEDUP,
    "op5_decontamination": DECONTAMINATION,
    "op6_topk_search": TOPK_SEARCH,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_phrase_collocations": PHRASE_COLLOCATIONS,
}
