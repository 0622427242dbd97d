"""The same results in DuckDB's SQL, for the queries that SQL can express."""

from __future__ import annotations

from reportarium.llm import license_rules

TOOL_CALLS = r"""
WITH RECURSIVE calls AS (
    SELECT conv_id, turn, text, length(text) AS size, 'call_' || turn AS call_id,
           ['search', 'lookup', 'count', 'render'][(turn + length(text)) % 4 + 1] AS tool
    FROM conversations WHERE role = 'assistant'
), parsed AS (
    SELECT *, CASE
        WHEN size % 7 = 0 THEN NULL
        WHEN tool = 'search' AND size % 5 = 0 THEN to_json({'limit': 'all', 'query': text})
        WHEN tool = 'search' THEN to_json({'limit': size % 10, 'query': text})
        WHEN tool = 'lookup' THEN to_json({'exact': size % 2 = 0, 'key': string_split(text, ' ')[1]})
        ELSE to_json({'terms': [size, len(string_split(text, ' '))]}) END AS arguments
    FROM calls
), edges AS (
    SELECT c.conv_id, c.turn, p.turn AS below
    FROM calls c JOIN calls p ON p.conv_id = c.conv_id
        AND (p.turn = c.turn - 2 OR (c.turn % 3 = 0 AND p.turn = c.turn - 4))
), paths AS (
    SELECT conv_id, turn, 0 AS level FROM calls
    UNION
    SELECT e.conv_id, e.turn, p.level + 1
    FROM edges e JOIN paths p ON p.conv_id = e.conv_id AND p.turn = e.below
), levels AS (
    SELECT conv_id, turn, max(level) AS level FROM paths GROUP BY ALL
)
SELECT p.conv_id, p.call_id,
       row_number() OVER (PARTITION BY p.conv_id ORDER BY l.level, p.turn, p.call_id) AS place,
       l.level::BIGINT AS level, p.tool,
       CASE WHEN p.tool = 'render' THEN 'unknown tool'
            WHEN p.arguments IS NULL THEN 'not JSON'
            WHEN p.tool = 'lookup' THEN 'missing scope'
            WHEN p.tool = 'search' AND json_type(p.arguments, '$.limit') = 'VARCHAR' THEN 'not integer limit'
            ELSE '' END AS errors,
       1::BIGINT AS n_calls,
       CASE WHEN r.text IS NULL THEN 0 ELSE 1 END::BIGINT AS n_results,
       '{' || coalesce('"arguments":' || p.arguments || ',', '')
           || '"id":' || to_json(p.call_id) || ',"name":' || to_json(p.tool)
           || coalesce(',"result":' || to_json(r.text), '') || '}' AS message
FROM parsed p
JOIN levels l ON l.conv_id = p.conv_id AND l.turn = p.turn
LEFT JOIN conversations r ON r.role = 'user' AND r.conv_id = p.conv_id AND r.turn = p.turn + 1
"""


def license_sql() -> str:
    known = ", ".join(f"('{sentence}', '{code}')" for code, sentence in license_rules.SENTENCES.items())
    rules = " ".join(
        f"WHEN regexp_full_match(m, '{license_rules.rule_pattern(codes)}') THEN '{name}'"
        for name, codes in license_rules.RULES
    )
    between = license_rules.SENTENCE_END.replace("\\t", "\t").replace("\\r", "\r").replace("\\n", "\n")
    return f"""
WITH known(sentence, code) AS (VALUES {known}),
pieces AS (
    SELECT doc_id, rowid_, trim(regexp_replace(p, '[^a-z0-9]+', ' ', 'g')) AS sentence, place
    FROM (
        SELECT doc_id, row_number() OVER () AS rowid_,
               string_split_regex(translate(coalesce(text, ''), '{license_rules.UPPER}',
                                            '{license_rules.LOWER}'), '{between}') AS parts
        FROM documents
    ), unnest(parts) WITH ORDINALITY AS u(p, place)
), coded AS (
    SELECT rowid_, any_value(p.doc_id) AS doc_id,
           coalesce(string_agg(coalesce(code, '.'), '' ORDER BY place)
                        FILTER (p.sentence <> ''), '') AS identifiers
    FROM pieces p LEFT JOIN known k ON k.sentence = p.sentence
    GROUP BY rowid_
), matched AS (
    SELECT *, regexp_extract_all(identifiers, '{license_rules.any_rule()}') AS matches FROM coded
)
SELECT doc_id, length(identifiers)::BIGINT AS n_sentences,
       length(replace(identifiers, '.', ''))::BIGINT AS n_known,
       len(matches)::BIGINT AS n_licences,
       array_to_string(list_transform(matches, lambda m: CASE {rules} END), ',') AS licences,
       array_to_string(matches, ',') AS matches
FROM matched
"""


def near_sql(size: int, more: str = "") -> str:
    """Groups of documents by shingles of ``size`` words, with further columns."""
    return rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'),
                                      '[^ \t\n\x0B\f\r]+') AS words
    FROM documents
), shingled AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
        WHEN len(words) < {size} THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - {size} + 2), lambda i: array_to_string(words[i:i + {size} - 1], ' '))
        END) AS shingle
    FROM worded
), sizes AS (
    SELECT doc_id, count(shingle) AS n FROM documents LEFT JOIN shingled USING (doc_id) GROUP BY 1
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT doc_id, n AS n_shingles, component_id{more}
FROM sizes JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) USING (doc_id)
"""


EXACT_TOPK = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
    SELECT lang, sum(len(words))::HUGEINT AS n FROM worded GROUP BY lang
), placed AS (
    SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS start
    FROM worded, range(1, 6) AS sizes(size)
), counted AS (
    SELECT lang, size, words[start:start + size - 1] AS phrase, count(*)::HUGEINT AS f
    FROM placed GROUP BY ALL HAVING count(*) >= 100
), inside AS (
    SELECT DISTINCT lang, f, phrase[start:start + part - 1] AS phrase
    FROM (SELECT *, unnest(range(1, size - part + 2)) AS start
          FROM counted, range(2, 5) AS parts(part) WHERE part < size)
), kept AS (
    SELECT c.* FROM counted c ANTI JOIN inside i
        ON i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.f >= 100 * c.f
    WHERE c.size > 1
), cut AS (
    SELECT k.lang, k.phrase, k.f AS a, place, x.f AS l, y.f AS r, n, (1000 * k.f * n) // (x.f * y.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS place FROM kept) k
    JOIN counted x ON x.lang = k.lang AND x.phrase = k.phrase[1:place]
    JOIN counted y ON y.lang = k.lang AND y.phrase = k.phrase[place + 1:]
    JOIN totals t ON t.lang = k.lang
), worst AS (
    SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score FROM cut
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1
)
SELECT lang, row_number() OVER w AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM worst WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER w <= 2000
"""

RANKED_SEARCH = r"""
WITH worded AS (
    SELECT doc_id, row_number() OVER () AS row_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), totals AS (
    SELECT count(*) AS big_n, sum(len(terms))::BIGINT AS big_l FROM worded WHERE len(terms) > 0
), occurring AS (
    SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM worded) GROUP BY ALL
), weighed AS (
    SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM occurring, totals GROUP BY term
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL
), scored AS (
    SELECT item_id, doc_id, row_id, sum(w * ((1000000000 * tf)
        // (1000 * tf + 8 * (100 - 90 + (90 * len(terms) * big_n) // big_l))))::BIGINT AS score
    FROM wanted JOIN weighed USING (term) JOIN occurring USING (term) JOIN worded USING (row_id), totals
    WHERE doc_id IS NOT NULL
    GROUP BY item_id, doc_id, row_id
)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER w <= 10
"""


def sql() -> dict[str, str]:
    return {
        "op1_tool_calls": TOOL_CALLS,
        "op4_super_minhash": near_sql(4, ", doc_id = component_id AS kept"),
        "op7_license_rules": license_sql(),
        "op9_exact_topk": EXACT_TOPK,
        "op11_collocations": COLLOCATIONS,
        "op12_partition_join": near_sql(5),
        "op13_best_position": RANKED_SEARCH,
    }
