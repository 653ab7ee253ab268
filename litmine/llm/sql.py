"""The queries' results in SQL, by plain methods that need no scale."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '{WORD}') AS words FROM documents
), s AS (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [list_reduce(words, lambda x, y: x || ' ' || y)]
        ELSE list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] for i in range(1, len(words) - 2)])
        END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id
        JOIN n AS p ON p.doc_id = a.doc_id JOIN n AS q ON q.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS at FROM documents
    UNION
    SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.at = links.x
)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.at) AS component_id
FROM reach AS r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

SUBSTRING = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
place AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS g FROM place WHERE i + 19 <= len(words)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM ranked WHERE r > 1),
kept AS (
    SELECT p.doc_id, string_agg(words[p.i], ' ' ORDER BY p.i) AS text, count(*) AS n
    FROM place AS p ANTI JOIN gone ON p.doc_id = gone.doc_id AND p.i = gone.i GROUP BY p.doc_id
)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

QUALITY = f"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM documents
), gram AS (
    SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, unnest([array_to_string(words[k:k + 4], ' ') for k in range(1, len(words) - 3)]) AS g FROM d
), again AS (
    SELECT doc_id, count(DISTINCT pos) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM gram) WHERE c > 1
    ) GROUP BY doc_id
), base AS (
    SELECT d.doc_id, source, text, lines, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words
    FROM d LEFT JOIN again ON d.doc_id = again.doc_id
), each AS (
    SELECT doc_id, source, text, len(regexp_extract_all(line, '{WORD}')) AS n,
        array_to_string(regexp_extract_all(regexp_replace({LOWER.replace("text", "line")}, '[0-9]', '0', 'g'), '{WORD}'), ' ') AS line
    FROM (SELECT doc_id, source, text, unnest(lines) AS line FROM base)
), hosts AS (SELECT source, count(DISTINCT text) AS c FROM base GROUP BY source),
above AS (
    SELECT e.source, line FROM each AS e JOIN hosts AS h ON e.source IS NOT DISTINCT FROM h.source
    GROUP BY e.source, line, h.c HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > 0.05 * h.c
), removed AS (
    SELECT e.doc_id, sum(n)::BIGINT AS n FROM each AS e SEMI JOIN above AS a ON e.source IS NOT DISTINCT FROM a.source AND e.line = a.line GROUP BY e.doc_id
), judged AS (
    SELECT base.*, coalesce(removed.n, 0) AS removed_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
    FROM base LEFT JOIN removed ON base.doc_id = removed.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed,
    NOT base_failed AND n_words - removed_words >= 10 AND n_words - removed_words >= 0.3 * n_words AS kept FROM judged
"""

MIX = f"""
WITH s AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size, md5('mix ' || coalesce(doc_id::VARCHAR, 'null')) AS h
    FROM documents
), c AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM s GROUP BY source
), w AS (SELECT *, [3, 1, 2][place % 3 + 1]::DOUBLE AS weight, (source_size * 2)::DOUBLE AS cap FROM c),
l AS (
    SELECT *, cap / weight AS reached,
        (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
    FROM w WINDOW o AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), free AS (SELECT level FROM l WHERE level <= reached ORDER BY reached, place LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM free) * weight, cap)) AS target FROM l),
p AS (
    SELECT doc_id, size, source_size, target, coalesce(sum(size) OVER (
        PARTITION BY s.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos, floor(target + 0.5) AS stop
    FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (greatest(least(pos + size, stop) - pos, 0) + greatest(least(source_size + pos + size, stop) - source_size - pos, 0))::BIGINT AS taken FROM p
"""

_RULES = "(VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))"


def _level(name: str, keys: list[str], above: str) -> str:
    """The posteriors of one level of hosts from those above it."""
    by = ", ".join(keys)
    prior = f"a.mean AS prior FROM counts AS c JOIN {above} AS a ON {' AND '.join(f'c.{k} = a.{k}' for k in keys[:-1]) or 'true'}"
    return f"""
{name}_n AS (SELECT {', '.join('c.' + k for k in keys)}, sum(c.n) AS n, sum(c.k) AS k, {prior} GROUP BY ALL),
{name}_v AS (
    SELECT sum((k - n * prior) * (k - n * prior)) AS square, sum(n * prior * (1 - prior)) AS plain,
        sum(n * prior * (1 - prior) * (n - 1)) AS pairs FROM {name}_n
), {name}_r AS (
    SELECT CASE WHEN coalesce(pairs, 0) = 0 THEN 0.5::DOUBLE ELSE least(greatest((square - plain) / pairs, 1e-3::DOUBLE), 0.9::DOUBLE) END AS rho FROM {name}_v
), {name}_w AS (SELECT (1 - rho) / rho AS weight FROM {name}_r),
{name} AS (
    SELECT {by}, (k + weight * prior) / (n + weight) AS mean, mean - 2 * sqrt(mean * (1 - mean) / (n + weight + 1)) AS bound FROM {name}_n, {name}_w
)"""


HOSTS = rf"""
WITH parts AS (
    SELECT page_id, url, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
), p AS (
    SELECT *, string_split(host, '.') AS labels, labels[-1] AS suffix, array_to_string(labels[-2:], '.') AS domain FROM parts
), outcomes AS (
    SELECT suffix, domain, host, (quality = 0 OR toxic = 1)::INT AS bad
    FROM p JOIN labels AS l ON l.doc_id = try_cast(regexp_extract(path, '^/[a-z]+/([0-9]+)', 1) AS BIGINT)
), counts AS (SELECT suffix, domain, host, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS k FROM outcomes WHERE bad IS NOT NULL GROUP BY ALL),
overall AS (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean, mean - 2 * sqrt(mean * (1 - mean) / (coalesce(sum(n), 0) + 3)) AS bound FROM counts),
{_level('s', ['suffix'], 'overall')},
{_level('d', ['suffix', 'domain'], 's')},
{_level('h', ['suffix', 'domain', 'host'], 'd')},
rules AS (SELECT col0 AS rhost, col1 AS rpath, col2 AS rverdict FROM {_RULES}),
fit AS (
    SELECT page_id, url, first(rhost || rpath ORDER BY length(rhost || rpath) DESC) AS rule, first(rverdict ORDER BY length(rhost || rpath) DESC) AS rverdict
    FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id, url
)
SELECT p.page_id, p.host, p.path, fit.rule,
    coalesce(fit.rverdict, CASE WHEN coalesce(h.bound, d.bound, s.bound, o.bound) > 0.25 THEN 'block' ELSE 'allow' END) AS verdict
FROM p CROSS JOIN overall AS o LEFT JOIN h ON p.host = h.host LEFT JOIN d ON p.domain = d.domain LEFT JOIN s ON p.suffix = s.suffix
    LEFT JOIN fit ON p.page_id = fit.page_id AND p.url = fit.url
"""

CRC_TABLE = """
crc AS (SELECT [list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) FOR n IN range(256)] AS crc_table)"""


def crc32(value: str) -> str:
    """The unsigned crc32 of a number's decimal text, with ``crc`` among the tables."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split({value}::VARCHAR, '')]),
        lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


_LEAF = " || ".join(map(_framed, ["doc_id", "source", "lang", "n_chars"]))


def _levels(name: str, start: str) -> str:
    """All nodes of the trees of ``start (tree, i, h, n)``, level by level."""
    return f"""{name} AS (
    SELECT tree, 0 AS l, i, h, n FROM {start}
    UNION ALL
    SELECT tree, l + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, l, i // 3, n
)"""


MERKLE = f"""
WITH RECURSIVE {CRC_TABLE},
leaf AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({_LEAF} || {_framed("text")}) AS h,
        CASE WHEN doc_id IS NOT NULL AND {crc32("coalesce(doc_id, 0)")} % 2 = 0 THEN sha256({_LEAF} || {_framed("replace(text, chr(10), '')")}) END AS changed FROM documents, crc
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaf
), {_levels("inner_nodes", "placed")},
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM inner_nodes WHERE n = 1),
tops AS (SELECT 'all' AS tree, i, subroot AS h, n FROM subroots),
{_levels("outer_nodes", "tops")},
steps AS (
    SELECT tree, l, i, coalesce(string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
        coalesce(string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt, tree AS tree2, l + 1 AS l2, i // 3 AS i2
    FROM (SELECT * FROM inner_nodes UNION ALL SELECT * FROM outer_nodes) WHERE n > 1 WINDOW r AS (PARTITION BY tree, l, i // 3 ORDER BY i)
    UNION ALL
    SELECT n.tree, n.l, n.i, NULL, NULL, 'all', 0, s.i FROM inner_nodes AS n JOIN subroots AS s ON s.tree = n.tree WHERE n.n = 1
), fold AS (
    SELECT tree AS own, i AS place, tree, 0 AS l, i, coalesce(changed, h) AS h, '' AS proof FROM placed
    UNION ALL
    SELECT own, place, tree2, l2, i2, CASE WHEN lft IS NULL THEN h ELSE sha256(lft || h || rgt) END, proof || coalesce(lft || rgt, '')
    FROM fold JOIN steps USING (tree, l, i)
), ends AS (SELECT own AS tree, place AS i, h AS folded_root, sha256(proof) AS proof_sha256 FROM fold ANTI JOIN steps USING (tree, l, i)),
top AS (SELECT h AS root FROM outer_nodes WHERE n = 1)
SELECT doc_id, h AS leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (tree) JOIN ends ON ends.tree = placed.tree AND ends.i = placed.i CROSS JOIN top
"""

NEAR = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '{WORD}') AS words FROM documents
), s AS (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
        ELSE list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id
        JOIN n AS p ON p.doc_id = a.doc_id JOIN n AS q ON q.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS at FROM documents
    UNION
    SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.at = links.x
), found AS (SELECT doc_id, min(reach.at) AS component_id FROM reach GROUP BY doc_id)
SELECT f.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, f.doc_id = component_id AS kept FROM found AS f LEFT JOIN n ON n.doc_id = f.doc_id
"""

TRIE = f"""
WITH {CRC_TABLE},
t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), c AS (SELECT conv_id, {crc32("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
r AS (
    SELECT c.conv_id, 0 AS own, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
    UNION ALL
    SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
), p AS (
    SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars, list({{'r': role, 't': text}}) OVER w AS key
    FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
    UNION ALL
    SELECT conv_id, 0, 0, []::STRUCT(r VARCHAR, t VARCHAR)[] FROM c
), lens AS (SELECT conv_id, max(depth) AS size FROM p GROUP BY conv_id),
nodes AS (
    SELECT key, depth, min(p.conv_id) AS conv_id, count(*) AS n, max(chars) AS chars,
        sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (depth = size), '')) AS ends_sha256
    FROM p JOIN lens USING (conv_id) GROUP BY key, depth
), kids AS (SELECT key[1:depth - 1] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
own AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (key)),
under AS (
    SELECT a.key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n - 1) * u.chars)::BIGINT AS saved_tokens
    FROM own AS u JOIN p AS a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.key
)
SELECT o.conv_id, o.depth, m.conv_id AS parent_conv_id, o.n AS n_convs, o.n_children, n_leaves, saved_tokens, o.ends_sha256
FROM own AS o JOIN under USING (key) LEFT JOIN nodes AS m ON o.depth > 0 AND m.key = o.key[1:o.depth - 1]
"""
