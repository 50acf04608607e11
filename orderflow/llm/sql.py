"""DuckDB SQL with the rows of those queries that SQL can express."""

# Distinct word shingles of {table}, by {key}: {size} words, or all words of a shorter text.
_SHINGLES = r"""
{name}_words AS (
    SELECT {key} AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM {table} WHERE {key} IS NOT NULL
),
{name} AS (
    SELECT DISTINCT id, array_to_string(words[k : k + {size} - 1], ' ') AS shingle
    FROM (
        SELECT id, words, unnest(range(1, greatest(len(words) - {size} + 1, 1) + 1)) AS k
        FROM {name}_words WHERE len(words) > 0
    )
),
{name}_sizes AS (SELECT id, count(*) AS n FROM {name} GROUP BY id)"""


def _shingles(name: str, table: str, key: str, size: int) -> str:
    return _SHINGLES.format(name=name, table=table, key=key, size=size)


OP2 = f"""
WITH {_shingles("item", "benchmark", "item_id", 5)},
lengths AS (SELECT DISTINCT least(len(words), 5) AS size FROM item_words WHERE len(words) > 0),
doc_words AS (
    SELECT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents WHERE doc_id IS NOT NULL
),
doc AS (
    SELECT DISTINCT id, array_to_string(words[k : k + size - 1], ' ') AS shingle
    FROM (
        SELECT id, size, words, unnest(range(1, len(words) - size + 2)) AS k
        FROM doc_words, lengths WHERE len(words) >= size
    )
)
SELECT doc.id AS doc_id, item.id AS item_id, item_sizes.n AS n_shingles, count(*) AS n_common
FROM doc
JOIN item USING (shingle)
JOIN item_sizes ON item_sizes.id = item.id
GROUP BY ALL
HAVING 100 * count(*) >= 80 * item_sizes.n
"""

OP6 = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT one.vec_id AS a, two.vec_id AS b
    FROM vectors AS one JOIN vectors AS two ON one.vec_id <> two.vec_id AND len(one.v) = len(two.v)
    WHERE list_cosine_similarity(one.v, two.v) >= 0.95
),
reach AS (
    SELECT vec_id AS id, vec_id AS seen FROM embeddings
    UNION
    SELECT links.b, reach.seen FROM reach JOIN links ON links.a = reach.id
),
least AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings AS e
JOIN least ON least.id = e.vec_id
LEFT JOIN counts ON counts.a = e.vec_id
"""

OP7 = r"""
WITH split AS (
    SELECT page_id, html, page_id // 64 AS version, page_id % 10 IN (0, 4, 7) AS whole,
        regexp_replace(url, '(://[^/]*/[a-z]+)/[^?#]*', '\1') AS url
    FROM pages
),
captures AS (
    SELECT *,
        regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\.', '')
        || regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/+$', '') AS section,
        array_to_string(list_sort(list_filter(
            string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
            lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')
        )), '&') AS query
    FROM split
),
named AS (
    SELECT *, section || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical_url
    FROM captures
),
pairs AS (
    SELECT r.page_id AS record_id, r.canonical_url, s.page_id AS response,
        r.version AS version, s.version AS stored, s.html
    FROM (SELECT * FROM named WHERE NOT whole) AS r
    ASOF LEFT JOIN (SELECT * FROM named WHERE whole) AS s
        ON r.canonical_url = s.canonical_url AND r.page_id > s.page_id
),
judged AS (
    SELECT *, CASE
        WHEN response IS NULL THEN 'missing'
        WHEN record_id % 7 = 0 THEN 'unvalidated'
        WHEN version = stored THEN 'resolved'
        ELSE 'changed' END AS outcome
    FROM pairs
)
SELECT record_id, canonical_url, outcome,
    CASE WHEN good THEN response END AS response_id,
    CASE WHEN good THEN md5(html) END AS digest,
    CASE WHEN good THEN 'cache-control=max-age=' || record_id || ';content-length=' || strlen(html)
        || ';etag=' || CASE WHEN record_id % 7 = 0 OR record_id % 5 = 0 THEN 'W/' ELSE '' END
        || '"v' || stored || '";last-modified=' || stored END AS headers
FROM (SELECT *, outcome IN ('resolved', 'unvalidated') AS good FROM judged)
"""

OP8 = f"""
WITH RECURSIVE {_shingles("doc", "documents", "doc_id", 4)},
pairs AS (
    SELECT one.id AS a, two.id AS b, count(*) AS shared
    FROM doc AS one JOIN doc AS two ON one.shingle = two.shingle AND one.id <> two.id
    GROUP BY ALL
),
links AS (
    SELECT a, b FROM pairs
    JOIN doc_sizes AS p ON p.id = a
    JOIN doc_sizes AS q ON q.id = b
    WHERE 100 * shared >= 80 * (p.n + q.n - shared)
),
reach AS (
    SELECT doc_id AS id, doc_id AS seen FROM documents
    UNION
    SELECT links.b, reach.seen FROM reach JOIN links ON links.a = reach.id
),
least AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id)
SELECT
    d.doc_id, coalesce(s.n, 0) AS n_shingles, least.component_id,
    least.component_id = d.doc_id AS kept
FROM documents AS d
JOIN least ON least.id = d.doc_id
LEFT JOIN doc_sizes AS s ON s.id = d.doc_id
"""

OP10 = r"""
WITH split AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '(?s)://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
),
ruled AS (
    SELECT *, '.' || host AS dotted,
        CASE
            WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/en/1')
                THEN 'example.org/en/1'
            WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/es/')
                THEN 'example.org/es/'
            WHEN ends_with(dotted, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN ends_with(dotted, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN ends_with(dotted, '.org') AND starts_with(path, '/') THEN 'org/'
        END AS rule,
        regexp_matches(host, '(^|[.-])(adult|bets|casino|porn|spam)([.-]|$)') AS listed
    FROM split
)
SELECT page_id, host, path, rule, listed,
    CASE
        WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
        WHEN rule IS NOT NULL OR listed THEN 'block'
        ELSE 'allow'
    END AS verdict
FROM ruled
"""

# The unsigned crc32 of {text} in UTF-8; its table is made by the rule, once for a query.
_CRC_TABLE = """
crc_table AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::UBIGINT, range(8)::UBIGINT[]),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS steps
)"""


def _crc32(text: str) -> str:
    code = "instr('0123456789ABCDEF', substr(hex({0}), {1}, 1))::UBIGINT - 1"
    byte = f"16 * ({code.format(text, '2 * k - 1')}) + ({code.format(text, '2 * k')})"
    data = f"list_transform(range(1, strlen({text}) + 1), lambda k: {byte})"
    start = f"list_prepend(4294967295::UBIGINT, {data})"
    step = "lambda c, b: xor(c >> 8, steps[((xor(c, b) & 255) + 1)::BIGINT])"
    return f"xor(list_reduce({start}, {step}), 4294967295::UBIGINT)"


def _add(cost: str, extra: str, letter: str) -> str:
    """A cost in nine digits and the letters after it, with one edit more."""
    return f"lpad((left({cost}, 9)::INTEGER + {extra})::VARCHAR, 9, '0') || substr({cost}, 10) || '{letter}'"


_ALTERNATE = {"u": ("b0", "bs", "ba"), "a": ("bu",)}


def _turns(to: str) -> str:
    ways = [_add("b" + to, "2", "D")]
    for state in _ALTERNATE[to]:
        ways.append(f"CASE WHEN c = '{to}' THEN {_add(state, 'extra', 'K')} END")
        ways.append(_add(state, "extra + 1", "R"))
    return f"CASE WHEN gone THEN {_add('b' + to, '2', 'D')} ELSE least({', '.join(ways)}) END AS b{to}"


def _inserted(source: str) -> str:
    """The costs of {source} with insertions where they are cheaper."""
    user = ", ".join(_add(state, "5", "I") for state in _ALTERNATE["u"])
    return f"""
        SELECT * REPLACE (least(ba, {_add("bu", "5", "I")}) AS ba)
        FROM (SELECT * REPLACE (least(bu, {user}) AS bu) FROM {source})"""


OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
places AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
    FROM conversations
),
faults AS (SELECT *, {_crc32("place")} % 20 AS f FROM places, crc_table),
damaged AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
        CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM faults
),
ordered AS (
    SELECT *, row_number() OVER in_order AS k, left(role, 1) AS c,
        lag(left(role, 1)) OVER in_order || left(role, 1) AS pair,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
        rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS seen
    FROM damaged
    WINDOW in_order AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
),
marked AS (
    SELECT *, CASE WHEN seen = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
        WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra
    FROM ordered
),
best AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS k, repeat('0', 9) AS b0, NULL::VARCHAR AS bs,
        NULL::VARCHAR AS bu, NULL::VARCHAR AS ba
    FROM marked
    UNION ALL
    SELECT one.conv_id, m.k, {_add("b0", "2", "D")} AS b0,
        CASE WHEN c = 's' AND NOT gone THEN least({_add("bs", "2", "D")}, {_add("b0", "extra", "K")})
            ELSE {_add("bs", "2", "D")} END AS bs,
        {_turns("u")}, {_turns("a")}
    FROM ({_inserted("best")}) AS one
    JOIN marked AS m ON m.conv_id IS NOT DISTINCT FROM one.conv_id AND m.k = one.k + 1
),
ended AS (
    SELECT conv_id, least(b0, ba) AS found FROM ({_inserted("best")})
    QUALIFY k = max(k) OVER (PARTITION BY conv_id)
),
edited AS (
    SELECT m.*, substr(found, 9 + k, 1) AS edit FROM marked AS m
    JOIN ended AS e ON e.conv_id IS NOT DISTINCT FROM m.conv_id
),
kept AS (
    SELECT *, row_number() OVER stays - max(CASE WHEN edit = 'K' AND c = 's' THEN 1 ELSE 0 END) OVER
        (PARTITION BY conv_id) AS nth_turn
    FROM edited WHERE edit <> 'D' WINDOW stays AS (PARTITION BY conv_id ORDER BY k)
),
hashes AS (
    SELECT conv_id, sha256(string_agg(
        CASE WHEN edit = 'K' THEN role WHEN nth_turn % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY k)) AS repaired_sha256
    FROM kept GROUP BY conv_id
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(left(found, 9)::BIGINT, 0) AS cost,
    coalesce(substr(found, 10), '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS every
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN hashes ON hashes.conv_id IS NOT DISTINCT FROM every.conv_id
"""

# Near words share a text that is left without one character of both, at one place, or of the longer.
OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
found AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
),
runs AS (SELECT id || ':' || run AS place, run, count(*) AS n FROM found GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32("place")} AS h FROM runs, crc_table),
words AS (
    SELECT CASE WHEN h % 97 = 0
            THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
            ELSE run END AS word,
        sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5
),
parts AS (
    SELECT word, n, length(word) AS size, k, left(word, k::BIGINT) || substr(word, k::BIGINT + 2) AS part
    FROM (SELECT word, n, unnest(range(length(word) + 1)) AS k FROM words)
),
near AS (
    SELECT DISTINCT one.word, two.word AS other, two.n AS other_n
    FROM parts AS one JOIN parts AS two ON one.part = two.part AND one.word <> two.word
    WHERE (one.size = two.size AND one.k = two.k)
        OR (one.size = two.size + 1 AND two.k = two.size)
        OR (two.size = one.size + 1 AND one.k = one.size)
),
best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS most,
        arg_min(other, (-other_n, other)) AS form
    FROM near GROUP BY word
),
judged AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN most >= 2 * n THEN form END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
    FROM words AS w LEFT JOIN best ON best.word = w.word
),
chain AS (
    SELECT word, word AS root, form AS further FROM judged
    UNION ALL
    SELECT chain.word, judged.word, judged.form FROM chain JOIN judged ON judged.word = chain.further
)
SELECT judged.word, judged.form, chain.root, n, n_near, form_n
FROM judged JOIN chain ON chain.word = judged.word AND chain.further IS NULL
"""
