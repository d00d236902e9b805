"""DuckDB twins of the llm queries that SQL can express, written apart from
the Spark code, with their own literals."""

from __future__ import annotations

from burnlens.llm.licenses import TEMPLATES

OP4 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (
  SELECT k, i, (words[i], words[i + 1], words[i + 2]) AS g
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
rep AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY k),
m AS (
  SELECT doc_id, t, words, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (k)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR n_symbols > 0.1::DOUBLE * n_words
            OR word_chars < 2 * n_words OR word_chars > 14 * n_words
            OR n_dup_lines > 0.5::DOUBLE * len(string_split(t, chr(10)))
            OR length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) > 0.3::DOUBLE * (length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) + 10)
            OR length(t) - length(regexp_replace(t, '[!?]', '', 'g')) > 0.3::DOUBLE * n_words
            OR len(list_distinct(words)) < 0.05::DOUBLE * n_words
            OR length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) > 0.4::DOUBLE * length(t)) AS kept
FROM b
"""

OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT a AS id, a AS other FROM edge
  UNION
  SELECT reach.id, edge.b FROM reach JOIN edge ON edge.a = reach.other),
part AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component, documents.doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN part ON part.id = documents.doc_id
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND newest IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND newest IS DISTINCT FROM page_id THEN newest END AS refers_to
FROM d
"""


def op10(threshold: float = 0.8) -> str:
    """The templates as VALUES; the rest in SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    listed = ((name, notice) for name, notices in TEMPLATES.items() for notice in notices)
    rows = ", ".join(f"({k}, {quote(name)}, {quote(notice)})" for k, (name, notice) in enumerate(listed))
    words = r"list_filter(string_split_regex(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    return rf"""
WITH t AS (SELECT template, license, {words.format('notice')} AS w FROM (VALUES {rows}) AS v(template, license, notice)),
tb AS (SELECT DISTINCT template, license, w[i] || ' ' || w[i + 1] AS bigram FROM (SELECT template, license, w, unnest(range(1, len(w))) AS i FROM t)),
ts AS (SELECT template, count(*) AS size, ceil({threshold} * count(*) - 0.000000001) AS need FROM tb GROUP BY template),
x AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
d AS (SELECT row_number() OVER () AS k, doc_id, {words.format('text')} AS w FROM x),
hit AS (SELECT k, doc_id, template, license, size, need, i - 1 AS pos, bigram
        FROM (SELECT k, doc_id, i, w[i] || ' ' || w[i + 1] AS bigram FROM (SELECT k, doc_id, w, unnest(range(1, len(w))) AS i FROM d))
        JOIN tb USING (bigram) JOIN ts USING (template)),
win AS (SELECT a.k, a.doc_id, a.template, a.license, a.size, a.need, a.pos, count(DISTINCT b.bigram) AS shared
        FROM hit a JOIN hit b ON a.k = b.k AND a.template = b.template AND b.pos >= a.pos AND b.pos < a.pos + a.size GROUP BY ALL),
best AS (SELECT * FROM win WHERE shared >= need
         QUALIFY row_number() OVER (PARTITION BY k, template ORDER BY shared DESC, pos) = 1),
place AS (SELECT *, shared::DOUBLE / size AS dice FROM best
          QUALIFY row_number() OVER (PARTITION BY k, pos ORDER BY shared::DOUBLE / size DESC, size DESC, license) = 1)
SELECT doc_id, license, dice, pos AS start_word, (size + 1)::INTEGER AS n_words FROM place
QUALIFY row_number() OVER (PARTITION BY k, license ORDER BY dice DESC, pos, size DESC) = 1
"""


def op11(rounds: int = 2) -> str:
    """Codebooks and assignments round by round."""
    ctes = ["""
k AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, vec_id, label, pos, q[pos * len(q) // 16 + 1:(pos + 1) * len(q) // 16] AS v FROM k, range(16) AS t(pos)),
c0 AS (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS e, v FROM p
       WHERE vec_id IN (SELECT DISTINCT vec_id FROM k ORDER BY vec_id LIMIT 64))"""]
    for t in range(rounds + 1):
        ctes.append(f"""
d{t} AS (SELECT r, vec_id, label, p.pos, e, p.v, list_sum(list_transform(list_zip(p.v, c{t}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM p JOIN c{t} ON p.pos = c{t}.pos),
a{t} AS (SELECT * FROM d{t} QUALIFY row_number() OVER (PARTITION BY r, pos ORDER BY d, e) = 1)""")
        if t < rounds:
            ctes.append(f"""
m{t} AS (SELECT pos, e, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
        FROM (SELECT pos, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{t}) GROUP BY pos, e, i),
u{t} AS (SELECT pos, e, list(x ORDER BY i) AS v FROM m{t} GROUP BY pos, e),
c{t + 1} AS (SELECT pos, e, coalesce(u{t}.v, c{t}.v) AS v FROM c{t} LEFT JOIN u{t} USING (pos, e))""")
    return "WITH" + ",".join(ctes) + f""",
f AS (SELECT r, vec_id, label, string_agg(printf('%02x', e), '' ORDER BY pos) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r, vec_id, label),
b AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY pos, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM f, b
"""


OP12 = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             concat(CASE WHEN len(words) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
                    CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' END,
                    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails
      FROM w LEFT JOIN l USING (doc_id)),
n AS (SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM m GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT part, filter_order, step, filter_order[step] AS own, fails, n, good, toxic, contains(fails, filter_order[step]) AS hit,
             translate(filter_order[1:step - 1], fails, '') <> filter_order[1:step - 1] AS gone FROM n, o, range(1, 6) AS t(step)),
r AS (SELECT part, filter_order, step::INTEGER AS step, own, coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (WHERE hit AND gone), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (WHERE fails = own), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS toxic_lost
      FROM s GROUP BY part, filter_order, step, own)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
"""


ORACLE_SQL = {"op4_quality_rules": OP4, "op6_ngram_jaccard_join": OP6, "op9_warc_archive": OP9, "op10_license_scan": op10(),
              "op11_vector_codes": op11(), "op12_filter_audit": OP12}
