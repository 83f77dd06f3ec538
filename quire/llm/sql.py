"""DuckDB SQL for the queries that SQL can express."""

OP7 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM t
"""


def op9() -> str:
    """Diagonal voting: the templates are literals made from the operator's own lists."""
    from .license_scan import BASE, LOWER, MIN_COVER, MOST_SLACK, NOTICES, SLACK, TEXTS, UPPER

    rows = [(label, phrase, True) for phrase, label in BASE.items()] + [(label, phrase, False) for phrase, label in NOTICES.items()] + [(label, phrase, False) for label, phrase in TEXTS.items()]
    values = ", ".join(f"({n}, '{label}', {str(base).lower()}, '{' '.join(phrase.split())}')" for n, (label, phrase, base) in enumerate(rows))
    return rf"""
WITH t AS (SELECT *, len(w) AS size, least(len(w), 3) AS k, least(len(w) // {SLACK}, {MOST_SLACK}) AS slack FROM (SELECT tmpl, label, base, string_split(phrase, ' ') AS w FROM (VALUES {values}) v(tmpl, label, base, phrase)) x),
g AS (SELECT tmpl, label, base, size, k, slack, spot - 1 AS spot, array_to_string(w[spot:spot + k - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, size - k + 2)) AS spot FROM t) x),
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, pos - 1 AS pos, w[pos] || ' ' || w[pos + 1] AS two, w[pos] || ' ' || w[pos + 1] || ' ' || w[pos + 2] AS three FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS pos FROM w) q),
h AS (SELECT p.doc_id, p.pos, p.pos - g.spot AS diag, g.* FROM p JOIN g ON g.k = 2 AND g.gram = p.two UNION ALL SELECT p.doc_id, p.pos, p.pos - g.spot, g.* FROM p JOIN g ON g.k = 3 AND g.gram = p.three),
v AS (SELECT doc_id, tmpl, diag, any_value(slack) AS slack, any_value(size) AS size, count(*) AS n FROM h WHERE NOT base GROUP BY 1, 2, 3),
i AS (SELECT a.doc_id, a.tmpl, a.diag, any_value(a.slack) AS slack, any_value(a.size) AS size, sum(b.n) AS inside FROM v a JOIN v b ON a.doc_id = b.doc_id AND a.tmpl = b.tmpl AND b.diag BETWEEN a.diag AND a.diag + a.slack GROUP BY 1, 2, 3),
r AS (SELECT h.*, i.diag AS start, max(spot) OVER (PARTITION BY h.doc_id, h.tmpl, i.diag ORDER BY h.pos, h.spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i JOIN h ON h.doc_id = i.doc_id AND h.tmpl = i.tmpl AND h.diag BETWEEN i.diag AND i.diag + i.slack WHERE i.inside * 3 >= i.size * {MIN_COVER}),
m AS (SELECT *, least(k, coalesce(spot - lag(spot) OVER (PARTITION BY doc_id, tmpl, start ORDER BY spot), k)) AS more FROM r WHERE before IS NULL OR spot > before),
c AS (SELECT doc_id, any_value(label) AS label, false AS base, NULL::BIGINT AS pos, sum(more)::DOUBLE / any_value(size) AS cover FROM m GROUP BY doc_id, tmpl, start
  UNION ALL SELECT doc_id, label, base, pos, 1.0::DOUBLE FROM h WHERE base),
f AS (SELECT doc_id, count(pos) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score FROM c WHERE base OR cover >= {MIN_COVER} GROUP BY 1)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score FROM w LEFT JOIN f ON f.doc_id = w.doc_id
"""


OP12 = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
g AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS N, sum(len(w))::BIGINT AS L FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) x WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
wt AS (SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, g),
p AS (SELECT tf.r, tf.term, wt.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * len(d.w)::BIGINT * g.N) // g.L)))) AS s FROM tf JOIN wt USING (term) JOIN d ON d.r = tf.r, g),
s AS (SELECT q.item_id, p.r, sum(p.s)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY 1, 2 HAVING sum(p.s) > 0),
o AS (SELECT item_id, d.doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, d.doc_id, s.r) AS rank FROM s JOIN d USING (r))
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 50
"""

OP13 = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
lab AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END) || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
  || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS bad
  FROM d LEFT JOIN lab USING (doc_id)),
n AS (SELECT part, bad, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
o AS (SELECT '' AS o UNION ALL SELECT o.o || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) l WHERE NOT contains(o.o, x)),
k AS (SELECT o, step, o[step] AS f, o[1:step - 1] AS before FROM (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM o WHERE length(o) = 5) z),
h AS (SELECT part, o, step, f, n, good, toxic, bad, contains(bad, f) AS fails, regexp_matches(bad, '[' || CASE WHEN before = '' THEN '-' ELSE before END || ']') AS gone FROM k, n),
r AS (SELECT part, o, step, f, sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (fails AND NOT gone) AS removed, sum(n) FILTER (fails AND gone) AS redundant,
  sum(n) FILTER (bad = f) AS unique_fails, sum(good) FILTER (fails AND NOT gone) AS good_lost, sum(toxic) FILTER (fails AND NOT gone) AS toxic_lost FROM h GROUP BY 1, 2, 3, 4)
SELECT part, o AS filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_exact_dedup": OP7, "op9_license_scan": op9(), "op12_maxscore": OP12, "op13_filter_audit": OP13}
