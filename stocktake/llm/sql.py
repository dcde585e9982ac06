"""SQL for operators whose results SQL can express, by other means than the operators use."""

from stocktake.llm.licenses import NOTICES, PHRASES, templates

_CHARS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (CAST('0x' || substr(h, {5 * k + 1}, 5) AS BIGINT) >> {s} & 31) + 1, 1)" for k in range(8) for s in (15, 10, 5, 0)
)

#: The header of a record, with % for line ends.
_HTTP = "'HTTP/1.1 200 OK%Content-Type: text/html; charset=utf-8%Content-Length: ' || strlen(body) || '%%'"
_HEADER = f"""'WARC/1.1%WARC-Type: ' || record_type || '%WARC-Record-ID: <urn:page:' || page_id || ':' || copy || '>%WARC-Date: 1970-01-01T00:00:00Z%'
  || CASE WHEN coalesce(url, '') = '' THEN '' ELSE 'WARC-Target-URI: ' || replace(url, '%', chr(1)) || '%' END || 'WARC-Payload-Digest: sha1:' || digest || '%'
  || CASE WHEN r > 1 THEN 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest%WARC-Refers-To: <urn:page:' || first_id || ':1>%' ELSE '' END
  || 'Content-Type: application/http; msgtype=response%Content-Length: ' || (strlen({_HTTP}) + (length({_HTTP}) - length(replace({_HTTP}, '%', '')))
    + CASE WHEN r > 1 THEN 0 ELSE strlen(body) END) || '%%' || {_HTTP}"""

OP1 = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id, row_number() OVER (PARTITION BY body ORDER BY page_id, url) AS r,
  row_number() OVER (PARTITION BY body, page_id, url) AS copy FROM p),
d AS (SELECT *, {_CHARS} AS digest, CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type FROM f)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, digest AS payload_digest, record_type, CASE WHEN r > 1 THEN first_id END AS refers_to, url,
  sha256(replace(replace({_HEADER}, '%', chr(13) || chr(10)), chr(1), '%') || body) AS record_sha256
FROM d
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, a AS r FROM both_ways UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON l.a = reach.r)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.c, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT a, min(r) AS c FROM reach GROUP BY a) c ON c.a = w.doc_id
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ROWS = ", ".join(f"('{label}', {own!r}, {need})" for _, label, own, need in templates(NOTICES))


def _starts(phrase: str) -> str:
    parts = phrase.split(" ")
    test = " AND ".join(f"ws[i + {k}] = '{p}'" for k, p in enumerate(parts, start=1))
    return f"list_filter(range(0, greatest(len(ws) - {len(parts) - 1}, 0)), lambda i: {test})"


_PLACES = ", ".join(f"{_starts(p)} AS at_{label}" for p, label in PHRASES.items())
_ALL = "list_concat(list_concat(at_mit, at_apache), at_gpl)"

OP10 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
w AS (SELECT doc_id, id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
p AS (SELECT doc_id, id, len(ws) AS n_words, {_PLACES} FROM w),
a AS (SELECT *, {_ALL} AS places FROM p),
lines AS (SELECT id, list_distinct(regexp_extract_all(unnest(string_split(t, chr(10))), '{_WORD}')) AS b FROM d),
notices(label, own, need) AS (VALUES {_ROWS}),
matches AS (
  SELECT id, b, label, own, list_intersect(b, own) AS ws, len(list_intersect(b, own)) / CAST(len(own) AS DOUBLE) AS share
  FROM (SELECT DISTINCT * FROM lines), notices WHERE len(list_intersect(b, own)) >= need
), held AS (
  SELECT id, label, share FROM matches x WHERE NOT EXISTS (
    SELECT 1 FROM matches y WHERE y.id = x.id AND y.b = x.b AND y.share > x.share AND list_has_all(y.ws, x.ws))
), named AS (
  SELECT id, label, CAST(1 AS DOUBLE) AS share, true AS base FROM (
    SELECT id, unnest(list_concat(list_concat(CASE WHEN len(at_mit) > 0 THEN ['mit'] ELSE [] END, CASE WHEN len(at_apache) > 0 THEN ['apache'] ELSE [] END),
      CASE WHEN len(at_gpl) > 0 THEN ['gpl'] ELSE [] END)) AS label FROM a)
  UNION ALL SELECT id, label, share, false FROM held
), told AS (
  SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM named GROUP BY id
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM a LEFT JOIN told USING (id)
"""

OP4 = """
WITH d AS (SELECT doc_id, row_number() OVER () AS id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT id, k, md5(substr(h, 2 * k + 1, 400)) AS g
  FROM (SELECT id, h, unnest(range(0, greatest(CAST(len(h) / 2 AS BIGINT) - 199, 0))) AS k FROM d)),
r AS (SELECT id, k FROM (SELECT id, k, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1),
s AS (SELECT id, k, CASE WHEN k <= lag(k) OVER (PARTITION BY id ORDER BY k) + 200 THEN 0 ELSE 1 END AS begins FROM r),
i AS (SELECT id, k, sum(begins) OVER (PARTITION BY id ORDER BY k) AS run FROM s),
runs AS (SELECT id, min(k) AS low, max(k) + 200 AS high FROM i GROUP BY id, run),
gaps AS (SELECT *, coalesce(lag(high) OVER (PARTITION BY id ORDER BY low), 0) AS after FROM runs),
cut AS (
  SELECT d.id, sum(high - low) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * after + 1, 2 * (low - after)), '' ORDER BY low) || substr(any_value(h), 2 * max(high) + 1) AS kept
  FROM gaps JOIN d ON d.id = gaps.id GROUP BY d.id
)
SELECT doc_id, CAST(len(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (id)
"""

#: The main text of pages like those of the table `pages`: one article element of headings and paragraphs. The operator takes
#: any page; for these, this says what it has to find.
OP7 = r"""
WITH a AS (SELECT page_id, url, row_number() OVER () AS id, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
b AS (SELECT id, unnest(string_split_regex(body, '</?(?:p|h1)[^>]*>')) AS piece, unnest(range(0, len(string_split_regex(body, '</?(?:p|h1)[^>]*>')))) AS place FROM a),
c AS (SELECT id, place, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(piece,
    '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS piece FROM b),
d AS (SELECT id, place, trim(regexp_replace(piece, '\s+', ' ', 'g')) AS piece FROM c),
e AS (SELECT id, string_agg(piece, chr(10) ORDER BY place) AS text FROM d WHERE piece <> '' GROUP BY id)
SELECT page_id, url, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM a LEFT JOIN e USING (id)
"""
