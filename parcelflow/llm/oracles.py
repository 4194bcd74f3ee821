"""SQL that gives the same rows in DuckDB, for the operators that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op7_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
p AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS pos FROM d WHERE len(w) >= 35
), hashed AS (
    SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 34], ' ')) AS h FROM p
), repeated AS (
    SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM hashed) WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 35)) AS pos FROM repeated
), each AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d
), kept AS (
    SELECT e.doc_id, count(g.pos) AS n_removed,
        coalesce(string_agg(word, ' ' ORDER BY e.pos) FILTER (WHERE g.pos IS NULL), '') AS rest
    FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos GROUP BY e.doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op8_exact_dedup": r"""
WITH d AS (
    SELECT doc_id, coalesce(length(text), 0) AS size,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
)
SELECT doc_id,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY size DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size,
    doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY size DESC, doc_id) AS kept,
    sha256(norm) AS text_sha256
FROM d
""",
    "op12_phrase_collocations": r"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS piece, regexp_extract_all(s, '[^\x20\x09]+') AS words
    FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
            coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
        ), '[.,;:!?\x0A-\x0D]')) AS s
        FROM documents
    )
), w AS (
    SELECT lang, piece, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM pieces
), totals AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
grams AS (
    SELECT lang, word AS w1, lead(word) OVER p AS w2, lead(word, 2) OVER p AS w3
    FROM w WINDOW p AS (PARTITION BY piece ORDER BY i)
), f AS (
    SELECT lang, 1 AS m, w1 AS phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10
    UNION ALL
    SELECT lang, 2, w1 || ' ' || w2, count(*) FROM grams
    WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
    UNION ALL
    SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM grams
    WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
    SELECT lang, m, phrase, f AS a, k, string_split(phrase, ' ') AS p
    FROM f, (VALUES (1), (2)) AS places(k) WHERE k < m
), scores AS (
    SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
        (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(p[1:k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(p[k + 1:], ' ')
), best AS (
    SELECT * FROM scores
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + 1], ' ') AS phrase,
        max(f) AS largest
    FROM f, (VALUES (1), (2)) AS starts(i) WHERE m = 3 GROUP BY ALL
), kept AS (
    SELECT b.* FROM best b LEFT JOIN longer USING (lang, phrase)
    WHERE b.m = 3 OR largest IS NULL OR 100 * largest < 50 * b.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM kept JOIN totals USING (lang)
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
""",
    "op13_conversation_trie": """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST,
        md5(strlen(role)::VARCHAR || ':' || role || text)) AS turns
    FROM t GROUP BY conv_id
), planned AS (
    SELECT conv_id, turns, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(
            string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384)
            ELSE a // 2 END)) % 6 AS h
    FROM own
), rebuilt AS (
    SELECT p.conv_id, list_concat(coalesce(b.turns, [])[1:h], p.turns[h + 1:]) AS turns
    FROM planned p LEFT JOIN own b ON b.conv_id = p.conv_id - p.conv_id % 100
), members AS (
    SELECT conv_id, len(turns) AS length, d AS depth, turns[1:d] AS node, turns[1:d - 1] AS above
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE length = depth), ''))
            AS ends_sha256,
        CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * length(node[depth].text) END AS weight
    FROM members GROUP BY depth, node
), children AS (
    SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), described AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (depth, node)),
below AS (
    SELECT d AS depth, node[1:d] AS node, sum(weight) AS saved_tokens,
        count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM described) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
    b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM described n JOIN below b ON b.depth = n.depth AND b.node = n.node
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.above AND n.depth > 0
""",
}
