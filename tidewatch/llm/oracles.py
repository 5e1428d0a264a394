"""The same queries in SQL, where SQL can express them."""

ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
              FROM documents)
        WINDOW same AS (PARTITION BY body)""",
    "op10_decontaminate": r"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        item AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM win),
        pos AS (
            SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size)),
        hit AS (SELECT doc_id, item_id, i, size FROM pos JOIN win USING (size, words)),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY 1),
        items AS (
            SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
        FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_prefix_trie": """
        WITH turns AS (
            SELECT conv_id AS c, length(role) || ':' || role || text AS k, length(text) AS chars,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS p
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                  FROM conversations WHERE conv_id IS NOT NULL)),
        own AS (SELECT c, c - c % 100 AS b, count(*) AS n FROM turns GROUP BY c),
        conv AS (
            SELECT own.c, own.b, h, coalesce(least(h, base.n), 0) AS nb
            FROM (SELECT *, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
                      lambda crc, byte: list_reduce(range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, byte)),
                      4294967295), 4294967295) % 6 AS h FROM own) AS own LEFT JOIN own AS base ON base.c = own.b),
        rebuilt AS (
            SELECT conv.c, p AS q, k, chars FROM conv JOIN turns ON turns.c = conv.b AND p <= h
            UNION ALL
            SELECT conv.c, p - h + nb, k, chars FROM conv JOIN turns ON turns.c = conv.c AND p > h),
        path AS (
            SELECT c, q AS depth, list(k) OVER (PARTITION BY c ORDER BY q) AS path, chars FROM rebuilt
            UNION ALL SELECT c, 0, [], 0 FROM conv),
        node AS (SELECT depth, path, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM path GROUP BY depth, path),
        member AS (SELECT c, depth, conv_id FROM path JOIN node USING (depth, path)),
        edge AS (
            SELECT node.conv_id, node.depth, n_convs, chars, member.conv_id AS parent
            FROM node LEFT JOIN member ON member.c = node.conv_id AND member.depth = node.depth - 1),
        kids AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n FROM edge WHERE depth > 0 GROUP BY ALL),
        below AS (
            SELECT member.conv_id, member.depth, sum((n_convs - 1) * chars) AS saved, count_if(kids.n IS NULL) AS leaves
            FROM edge LEFT JOIN kids USING (conv_id, depth)
            JOIN member ON member.c = edge.conv_id AND member.depth <= edge.depth GROUP BY ALL),
        ends AS (
            SELECT conv_id, depth, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
            FROM member JOIN (SELECT c, max(depth) AS depth FROM path GROUP BY c) USING (c, depth) GROUP BY ALL)
        SELECT conv_id, depth, parent AS parent_conv_id, n_convs, coalesce(kids.n, 0) AS n_children, leaves AS n_leaves,
               CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM edge JOIN below USING (conv_id, depth) LEFT JOIN kids USING (conv_id, depth) LEFT JOIN ends USING (conv_id, depth)""",
    "op8_url_filters": r"""
        WITH url AS (
            SELECT page_id, url, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
                   list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
                               lambda s: s <> '') AS path,
                   CAST('0x' || md5(page_id || ':fetched')[1:8] AS BIGINT) % 31622400 AS fetched,
                   CAST('0x' || md5(page_id || ':listed')[1:8] AS BIGINT) % 31622400 AS listed,
                   CAST('0x' || md5(page_id || ':kind')[1:8] AS BIGINT) % 4 AS kind,
                   CAST('0x' || md5(page_id || ':act')[1:8] AS BIGINT) % 3 AS act
            FROM pages),
        list AS (
            SELECT page_id AS entry_id, listed AS valid_from, ['block', 'allow', 'remove'][act + 1] AS action,
                   CASE WHEN kind = 0 OR len(path) = 0 THEN host WHEN kind = 1 THEN regexp_replace(host, '^[^.]*\.', '')
                        ELSE host || '/' || array_to_string(path[1:kind - 1], '/') END AS pattern
            FROM url WHERE host <> ''),
        valid AS (
            SELECT *, lead(valid_from, 1, 1000000000) OVER (PARTITION BY pattern ORDER BY valid_from, entry_id) AS valid_to FROM list),
        key AS (
            SELECT page_id, fetched, unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
                lambda k: array_to_string(string_split(host, '.')[k:], '.'))) AS pattern FROM url WHERE host <> ''
            UNION ALL
            SELECT page_id, fetched, unnest(list_transform(range(1, len(path) + 1),
                lambda k: host || '/' || array_to_string(path[1:k], '/'))) FROM url WHERE host <> ''),
        best AS (
            SELECT page_id, pattern, entry_id, action FROM key JOIN valid USING (pattern)
            WHERE fetched >= valid_from AND fetched < valid_to AND action <> 'remove'
            QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY contains(pattern, '/') DESC, length(pattern) DESC) = 1)
        SELECT page_id AS capture_id, url, fetched AS at, entry_id, pattern, action, coalesce(action = 'block', false) AS blocked
        FROM url LEFT JOIN best USING (page_id)""",
}
