"""SQL for the queries of this package that SQL can express."""

from __future__ import annotations

QUALITY = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), win AS (
    SELECT r, i, list_slice(w, i, i + 7) AS g
    FROM (SELECT r, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)
), again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1
), covered AS (
    SELECT r, count(DISTINCT p) AS n
    FROM (SELECT r, unnest(generate_series(i, i + 7)) AS p FROM again) GROUP BY r
), m AS (
    SELECT doc_id, len(w) AS n_words, coalesce(length(array_to_string(w, '')), 0) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(l) - len(list_distinct(l)) AS n_dup_lines,
           coalesce(n, 0) AS n_repeat_words,
           length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
           len(l) AS n_lines
    FROM d LEFT JOIN covered USING (r)
), b AS (
    SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
              + 4 * (10 * n_symbols > 5 * n_words)::BIGINT
              + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
              + 16 * (100 * n_capitals > 60 * word_chars)::BIGINT
              + 32 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::BIGINT AS failed_bits
    FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits::BIGINT AS failed_bits
FROM b
"""

# The rules of policy full-1, each by its bit.
ABLATION = f"""
WITH ledger AS ({QUALITY}), rules(rule, bit) AS (VALUES
    ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8), ('capitals', 16), ('word_length', 32))
SELECT rule, coalesce(sum((failed_bits & bit <> 0)::BIGINT), 0)::BIGINT AS n_failed,
       coalesce(sum((failed_bits = bit)::BIGINT), 0)::BIGINT AS n_only
FROM rules, ledger GROUP BY rule
"""


CHAT = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), s AS (
    SELECT *, (length(text) + 3) // 4 + 4 AS size,
           length(text) + (length(text) - length(replace(text, '\', '')))
               + (length(text) - length(replace(text, '<|', ''))) // 2
               + (length(text) - length(replace(text, '|>', ''))) // 2
               + length(role) + (role = 'end' OR role LIKE '%<')::BIGINT + 5 + 8 AS chars,
           row_number() OVER w AS place
    FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), t AS (
    SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) - size AS start,
           first_value(CASE WHEN role = 'system' THEN size END) OVER v AS sys_size,
           first_value(CASE WHEN role = 'system' THEN chars END) OVER v AS sys_chars
    FROM s WINDOW v AS (PARTITION BY conv_id ORDER BY place)
), h AS (
    SELECT *, greatest(1, greatest(1, 1024 - 256 - coalesce(sys_size, 0)) // 2) AS half FROM t
), k AS (
    SELECT *, CASE WHEN size > half OR place = 1
                        OR start // half <> lag(start // half) OVER (PARTITION BY conv_id ORDER BY place)
                   THEN 1 ELSE 0 END AS begins FROM h
), n AS (
    SELECT *, min(CASE WHEN begins = 1 THEN start END) OVER (
                  PARTITION BY conv_id ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next
    FROM k
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(chars) + sum(CASE WHEN next - start <= 256 AND NOT (place = 1 AND role = 'system') THEN chars ELSE 0 END)
        + sum(CASE WHEN begins = 1 AND place > 1 THEN coalesce(sys_chars, 0) ELSE 0 END))::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""


def licenses(templates: dict[str, list[list[str]]], threshold: float) -> str:
    """`templates`: the bigrams of every template, by licence."""
    rows = ", ".join(
        "('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in grams))
        for name, listed in sorted(templates.items())
        for grams in listed
        if grams
    )
    return f"""
WITH t(license, known) AS (VALUES {rows}), d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_distinct(list_transform(string_split(
               regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\\n]+', ' ', 'g'), chr(10)), lambda x: trim(x))) AS l,
           trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) AS whole
    FROM documents
), u AS (
    SELECT DISTINCT r, unnest(list_append(l, whole)) AS unit FROM d
), w AS (
    SELECT r, unit, string_split(unit, ' ') AS ws FROM u
), g AS (
    SELECT r, unit, list_distinct(list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1])) AS grams
    FROM w WHERE len(ws) > 1
), s AS (
    SELECT r, unit, license, 2.0 * len(list_intersect(grams, known)) / (len(grams) + len(known)) AS dice
    FROM g CROSS JOIN t
), b AS (
    SELECT r, unit, license, dice,
           row_number() OVER (PARTITION BY r, unit ORDER BY dice DESC, license) AS k
    FROM s WHERE dice >= {threshold} - 1e-12
), f AS (
    SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
           first(license ORDER BY dice DESC, license) AS best, max(dice) AS dice
    FROM b WHERE k = 1 GROUP BY r
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_notices, coalesce(licenses, '') AS licenses,
       best AS best_license, round(dice, 6) AS best_dice
FROM d LEFT JOIN f USING (r)
"""


LEAKS = r"""
WITH words AS (
    SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id,
           list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
    UNION ALL
    SELECT 'i', row_number() OVER (), item_id,
           list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda x: x <> '')
    FROM benchmark
), widths AS (
    SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE side = 'i' AND len(w) > 0
), item AS (
    SELECT DISTINCT r, id, least(len(w), 5) AS k, list_slice(w, p, p + least(len(w), 5) - 1) AS g
    FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM words WHERE side = 'i' AND len(w) > 0)
), doc AS (
    SELECT DISTINCT r, id, list_slice(w, p, p + k - 1) AS g
    FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS p
          FROM words, widths WHERE side = 'd' AND len(w) >= k)
), size AS (SELECT r, count(*) AS n FROM item GROUP BY r)
SELECT doc.id AS doc_id, item.id AS item_id, count(*)::BIGINT AS n_shared, any_value(size.n)::BIGINT AS n_item
FROM item JOIN doc USING (g) JOIN size ON size.r = item.r
GROUP BY item.r, doc.r, item.id, doc.id
HAVING 100 * count(*) >= 80 * any_value(size.n)
"""


DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), o AS (
    SELECT lang, source, r, unnest(w) AS term FROM d
), k AS (
    SELECT lang, term, count(*) AS n FROM o GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10
), v AS (
    SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY 1
), g AS (
    SELECT DISTINCT lang, source FROM d
), c AS (
    SELECT lang, source, term, count(*) AS n FROM o GROUP BY 1, 2, 3
), e AS (
    SELECT g.lang, g.source, k.term, k.n AS n_lang, coalesce(c.n, 0) AS n
    FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), s AS (
    SELECT lang, source, sum(n) AS n FROM e GROUP BY 1, 2
), p AS (
    SELECT e.lang, e.source, e.term, e.n,
           1 + (1000000000::HUGEINT * (e.n + 2)) // (s.n + 2 * v.v) AS p,
           1 + (1000000000::HUGEINT * (e.n_lang + 2)) // (v.n + 2 * v.v) AS q
    FROM e JOIN s ON s.lang = e.lang AND s.source = e.source JOIN v ON v.lang = e.lang
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
    FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
         LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
         LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY 1, 2, 3
), terms AS (
    SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value, rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
    WHERE rank <= 10
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""


# The lambdas compute the CRC-32 of a decimal number, a byte and then a bit at a time.
TRIE = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
    SELECT conv_id AS c, list({'r': role, 'x': text}
               ORDER BY turn NULLS FIRST, sha256(concat(length(role), ':', role, text))) AS own
    FROM t GROUP BY 1
), h AS (
    SELECT c, own, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END))) % 6 AS h
    FROM o
), s AS (
    SELECT a.c, list_concat(list_slice(coalesce(b.own, []), 1, a.h), list_slice(a.own, a.h + 1, len(a.own))) AS seq
    FROM h a LEFT JOIN o b ON b.c = a.c - a.c % 100
), k AS (
    SELECT c, d, list_slice(seq, 1, d) AS node, CASE WHEN d > 0 THEN length(seq[d].x) ELSE 0 END AS size, d = len(seq) AS stops
    FROM (SELECT c, seq, unnest(generate_series(0, len(seq))) AS d FROM s)
), n AS (
    SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (stops), '')) AS ends_sha256
    FROM k GROUP BY 1, 2
), kids AS (
    SELECT list_slice(node, 1, d - 1) AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1
), f AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.node = n.node
), sub AS (
    SELECT list_slice(node, 1, j) AS node, sum((n_convs - 1) * size) AS saved, sum((n_children = 0)::BIGINT) AS leaves
    FROM (SELECT *, unnest(generate_series(0, d)) AS j FROM f) GROUP BY 1
)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN sub ON sub.node = f.node LEFT JOIN n up ON f.d > 0 AND up.node = list_slice(f.node, 1, f.d - 1)
"""
