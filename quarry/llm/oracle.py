"""DuckDB SQL with the same rows as the queries of this subpackage, where SQL expresses them."""

from __future__ import annotations

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP6 = r"""
WITH k AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM k GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM k JOIN g USING (text_sha256)
"""

OP9 = f"""
WITH l AS (SELECT doc_id, i, line, translate(trim(line, {_WS}), {_AZ}) AS key
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
g AS (SELECT key, min(doc_id) AS owner FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT l.*, g.owner IS NOT NULL AND g.owner <> doc_id AS gone FROM l LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, len({_WORDS}) AS n, len(list_distinct({_WORDS})) AS u,
             doc_id > min(doc_id) OVER (PARTITION BY t) AS copy FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN n < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * u < 80 * n THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN copy THEN 'E' ELSE '' END AS mask
      FROM w LEFT JOIN l USING (doc_id)),
h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM s a, s b, s c, s d, s e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
f AS (SELECT h.*, filter_order, least({", ".join(f"CASE WHEN contains(mask, '{x}') THEN strpos(filter_order, '{x}') END" for x in "ABCDE")}) AS first
      FROM h, o),
g AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
             sum(n) FILTER (mask = '' OR first > step) AS kept, sum(n) FILTER (mask <> '' AND first = step) AS removed,
             sum(n) FILTER (contains(mask, substr(filter_order, step, 1)) AND first < step) AS redundant,
             sum(n) FILTER (mask = substr(filter_order, step, 1)) AS unique_fails,
             sum(good) FILTER (mask <> '' AND first = step) AS good_lost,
             sum(toxic) FILTER (mask <> '' AND first = step) AS toxic_lost
      FROM f, (SELECT unnest([1, 2, 3, 4, 5]) AS step) GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM g
"""

_TERMS = r"regexp_extract_all(translate(text, {az}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(az=_AZ)

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest({_TERMS}) AS term FROM documents),
n AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM d GROUP BY r),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs),
x AS (SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n.n * docs) // total))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN n USING (r), s GROUP BY item_id, r),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
      FROM x JOIN n USING (r) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 50
"""

ORACLE: dict[str, str] = {
    "op6_exact_dedup": OP6,
    "op9_line_dedup": OP9,
    "op11_filter_interaction_audit": OP11,
    "op12_ranked_lexical_search": OP12,
}
