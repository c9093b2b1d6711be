"""The same results as SQL, for the queries of this subpackage that SQL can express at whole-table size.

Entities are decoded by replacement, which covers those that the payloads hold; the queries decode all.
"""

from __future__ import annotations

_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#101;", "e"), ("&ndash;", "–"), ("&nbsp;", " "), ("&amp;", "&"))


def _decoded(text: str) -> str:
    for name, sign in _ENTITIES:  # the ampersand comes last, so that nothing is decoded twice in one pass
        text = f"replace({text}, '{name}', '{sign}')"
    return text


_BODIES = f"""
bodies AS (
    SELECT id, ats, board_token, regexp_replace({_decoded(_decoded('b'))}, '<[^>]+>', '', 'g') AS body
    FROM (SELECT DISTINCT ON (id) id, ats, board_token, coalesce(nullif(raw_json ->> '$.content', ''), nullif(raw_json ->> '$.description', ''), nullif(raw_json ->> '$.descriptionHtml', ''), '') AS b FROM pipeline_jobs WHERE id IS NOT NULL)
)"""

_REPEATED = f"""
{_BODIES},
filled AS (SELECT * FROM bodies WHERE regexp_matches(body, '[^\\s\\p{{Z}}]')),
lines AS (SELECT id, ats, board_token, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM (SELECT id, ats, board_token, string_split(body, chr(10)) AS l FROM filled)),
keyed AS (
    SELECT id, ats, board_token, line_no, array_to_string(regexp_extract_all(regexp_replace(lower(line), 'https?://[^\\s\\p{{Z}}]*', ' ', 'g'), '[\\p{{L}}\\p{{Nl}}\\p{{No}}]+'), ' ') AS k
    FROM lines WHERE length(regexp_replace(line, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) >= 30
),
boards AS (SELECT ats, board_token, count(*) AS n FROM filled GROUP BY ALL HAVING count(*) >= 5),
often AS (
    SELECT k.ats, k.board_token, k.k FROM keyed k JOIN boards b ON b.ats IS NOT DISTINCT FROM k.ats AND b.board_token IS NOT DISTINCT FROM k.board_token
    WHERE k.k <> '' GROUP BY ALL HAVING count(DISTINCT id) > 0.4 * any_value(b.n)
),
gone AS (SELECT k.id, CAST(k.line_no AS INTEGER) AS line_no FROM keyed k JOIN often o ON o.k = k.k AND o.ats IS NOT DISTINCT FROM k.ats AND o.board_token IS NOT DISTINCT FROM k.board_token)"""

P1_FOUND = f"WITH {_REPEATED} SELECT id, line_no FROM gone"

P1_BODIES = f"""
WITH {_REPEATED},
kept AS (
    SELECT l.id, string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.id IS NULL) AS text, count(g.id) AS lines_removed
    FROM (SELECT id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM (SELECT id, string_split(body, chr(10)) AS l FROM bodies)) l LEFT JOIN gone g ON g.id = l.id AND g.line_no = l.line_no GROUP BY l.id
)
SELECT id, coalesce(text, '') AS text, CAST(lines_removed AS INTEGER) AS lines_removed FROM kept"""

_PAIRS = f"""
{_BODIES},
words AS (SELECT id, regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}]+') AS w FROM bodies),
triples AS (SELECT DISTINCT id, hash(w[i], w[i + 1], w[i + 2]) AS t FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
sizes AS (SELECT id, count(*) AS n FROM triples GROUP BY id),
shared AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS n FROM triples a JOIN triples b ON a.t = b.t AND a.id < b.id GROUP BY ALL),
pairs AS (SELECT id_a, id_b FROM shared s JOIN sizes a ON a.id = id_a JOIN sizes b ON b.id = id_b WHERE s.n >= 0.6 * (a.n + b.n - s.n))"""

P3_FOUND = f"WITH {_PAIRS} SELECT id_a, id_b FROM pairs"

P3_GROUPS = f"""
WITH RECURSIVE {_PAIRS},
texts AS (SELECT id, md5(string_agg(CAST(t AS VARCHAR), ',' ORDER BY t)) AS class FROM triples GROUP BY id),
edges AS (SELECT id_a AS a, id_b AS b FROM pairs UNION SELECT id_b, id_a FROM pairs),
reach AS (SELECT id AS a, id AS b FROM sizes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
groups_ AS (SELECT a AS id, min(b) AS group_id, count(*) AS group_size FROM reach GROUP BY a),
links AS (SELECT e.a AS id, count(DISTINCT y.class) AS links FROM edges e JOIN texts x ON x.id = e.a JOIN texts y ON y.id = e.b WHERE x.class <> y.class GROUP BY e.a)
SELECT g.id, group_id, group_size, coalesce(links, 0) AS links FROM groups_ g LEFT JOIN links l ON l.id = g.id"""

_SPANS = """
texts AS (SELECT doc_id, any_value(text) AS text FROM documents WHERE length(text) >= 200 GROUP BY doc_id),
windows AS (SELECT doc_id, i, hash(substr(text, i + 1, 200)) AS h FROM (SELECT doc_id, text, unnest(range(length(text) - 199)) AS i FROM texts)),
hit AS (SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id))),
marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM marked),
spans AS (SELECT doc_id, CAST(min(i) AS INTEGER) AS span_start, CAST(max(i) + 200 AS INTEGER) AS span_end FROM numbered GROUP BY doc_id, k)"""

P9_FOUND = f"WITH {_SPANS} SELECT doc_id, span_start, span_end FROM spans"

P9_SHARES = f"""
WITH {_SPANS}
SELECT d.doc_id, coalesce(n, 0) AS n_spans, coalesce(chars, 0) AS shared_chars, CASE WHEN length(d.text) > 0 THEN coalesce(chars, 0) / length(d.text) ELSE 0.0 END AS share
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n, sum(span_end - span_start) AS chars FROM spans GROUP BY doc_id) s ON s.doc_id = d.doc_id"""

#: Nothing is lost, overfull or split without need: what every packing must keep.
P7_KEPT = "SELECT limit_name, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0 AS lost_tokens, 0 AS overfull, 0 AS needless_splits, 0 AS unnecessary FROM (SELECT DISTINCT limit_name FROM pack_limits WHERE limit_name IS NOT NULL AND capacity_tokens > 0)"

#: No text is used too often or chosen for a source that isn't its own, and every share is within a slot of what is possible.
P8_KEPT = "SELECT source, 0 AS overused, 0 AS foreign_texts, true AS on_target FROM (SELECT source FROM mix_targets WHERE source IS NOT NULL AND weight > 0 AND NOT isnan(weight) GROUP BY source)"
