"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations


def mix_sql(documents: str = "documents", seed: int = 17) -> str:
    """CTEs that end in ``mixed``: doc_id, size, source_size, target, copies."""
    return f"""
    sized AS (
        SELECT doc_id, coalesce('s' || source, 'n') AS skey, source,
               CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
               md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
        FROM {documents}),
    src AS (SELECT skey, source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY ALL),
    ranked AS (
        SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w,
               CAST(3 * source_size AS DOUBLE) AS cap FROM src),
    levels AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, skey
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(w) OVER (ORDER BY cap / w, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own
        FROM ranked),
    targets AS (
        SELECT skey, source_size, least(cap, w * max(own) OVER ()) AS target,
               CAST(CAST('0x' || substr(md5('{seed}:' || skey), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS u
        FROM levels),
    placed AS (
        SELECT s.*, t.source_size, t.target, t.u,
               CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
               row_number() OVER (PARTITION BY skey
                   ORDER BY lpad(CAST(len(bin(size)) AS VARCHAR), 2, '0') || substr(bin(size), 1, 4), digest) AS rank
        FROM sized s JOIN targets t USING (skey)),
    mixed AS (
        SELECT doc_id, size, source_size, target,
               CAST(floor(rate * rank + u) - floor(rate * (rank - 1) + u) AS BIGINT) AS copies FROM placed)"""


OP1 = f"WITH {mix_sql()} SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed"

OP3 = r"""
    WITH w AS (
        SELECT doc_id, source, coalesce(text, '') AS body,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    g AS (
        SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS gram
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
    twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) >= 2),
    covered AS (
        SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS p FROM twice, range(0, 5) t(k)) GROUP BY 1),
    lines AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS n
        FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM w)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
    base AS (
        SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words,
               CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
               CAST(len(regexp_extract_all(body, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
               CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
               len(ws) < 10 OR 100 * coalesce(c.n, 0) > 20 * len(ws) AS base_failed
        FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id LEFT JOIN lines l ON l.doc_id = w.doc_id),
    hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM base GROUP BY 1),
    prior AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM hosts),
    strength AS (
        SELECT m, CASE WHEN v > 1e-12 THEN least(greatest(m * (1 - m) / v - 1, 1), 1e6) ELSE 1e6 END AS s FROM prior)
    SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND (f + m * s) / (n + s) <= 0.5 AS kept
    FROM base b JOIN hosts h ON h.source IS NOT DISTINCT FROM b.source, strength"""

OP11 = r"""
    WITH d AS (
        SELECT doc_id, row_number() OVER () AS row,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
    i AS (
        SELECT item_id, row_number() OVER () AS query,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
    wanted AS (SELECT query, item_id, t, count(*) AS repeats FROM i GROUP BY ALL),
    whole AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
    postings AS (
        SELECT doc_id, row, CAST(n AS BIGINT) AS n, t, CAST(count(*) AS BIGINT) AS tf
        FROM (SELECT doc_id, row, len(ts) AS n, unnest(ts) AS t FROM d) GROUP BY ALL),
    weights AS (
        SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM postings, whole GROUP BY t, n_docs),
    scored AS (
        SELECT query, item_id, doc_id, row,
               CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
        FROM wanted JOIN postings USING (t) JOIN weights USING (t), whole GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW best AS (PARTITION BY query ORDER BY score DESC, doc_id NULLS FIRST, row)
    QUALIFY row_number() OVER best <= 10"""

OP13 = r"""
    WITH t AS (
        SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    sized AS (
        SELECT conv, count(*) AS own, xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
                   lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                       lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
        FROM t GROUP BY conv),
    convs AS (
        SELECT s.conv, s.h, least(s.h, coalesce(f.own, 0)) AS taken
        FROM sized s LEFT JOIN sized f ON f.conv = s.conv - s.conv % 20),
    seq AS (
        SELECT c.conv, t.place AS depth, role, text FROM convs c JOIN t ON t.conv = c.conv - c.conv % 20 AND t.place <= c.h
        UNION ALL
        SELECT c.conv, t.place - c.h + c.taken, role, text FROM convs c JOIN t ON t.conv = c.conv AND t.place > c.h),
    named AS (
        SELECT conv, depth, text, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
               OVER (PARTITION BY conv ORDER BY depth)) AS node FROM seq
        UNION ALL SELECT conv, 0, '', '' FROM convs),
    path AS (
        SELECT *, lag(node) OVER (PARTITION BY conv ORDER BY depth) AS parent,
               depth = max(depth) OVER (PARTITION BY conv) AS ends FROM named),
    nodes AS (
        SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv) AS conv_id, count(*) AS n_convs,
               (count(*) - 1) * any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS own,
               sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (ends), '')) AS ends_sha256
        FROM path GROUP BY node),
    kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
    below AS (SELECT DISTINCT a.node AS top, b.node FROM path a JOIN path b ON b.conv = a.conv AND b.depth >= a.depth),
    totals AS (
        SELECT top AS node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum(own) AS saved_tokens
        FROM below b JOIN nodes n ON n.node = b.node LEFT JOIN kids k ON k.node = b.node GROUP BY top)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
           coalesce(k.n, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN totals t ON t.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes p ON p.node = n.parent"""

SQL = {
    "op1_mix": OP1,
    "op3_host_rules": OP3,
    "op11_ranked_search": OP11,
    "op13_prefix_trie": OP13,
}
