"""DuckDB twins of those queries of this subpackage that SQL can express.

Written from the contracts, not from the Spark code: no inverted index, no
ranges, no event log."""

from __future__ import annotations

OP7 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), p AS (
  SELECT *, '### ' || replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c') || ': '
    || replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') || '</turn>' || chr(10) AS piece
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(piece)) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    -ln((CAST(('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || t), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
        / 4503599627370496.0::DOUBLE)
      / greatest(0.1::DOUBLE, 1.0::DOUBLE - 4.0::DOUBLE * (length(t) - length(translate(t, '#*$%&|<>', '')))
                 / greatest(1, length(t))) AS key
  FROM d
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap,
    sum(source_size) OVER () AS budget
  FROM src
), l AS (
  SELECT *, cap / weight <= (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped
  FROM w
), t AS (
  SELECT *, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE weight
      * (budget - coalesce(sum(cap) FILTER (capped) OVER (), 0)) / (sum(weight) FILTER (NOT capped) OVER ()) END AS target
  FROM l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t
), k AS (
  SELECT s.doc_id, s.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key) - sum(s.size) OVER (PARTITION BY s.source, s.key) / 2.0 AS middle
  FROM s JOIN e ON s.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST(size * (epochs + CASE WHEN middle <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM k
"""

OP10 = r"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM win
), occ AS (
  SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw, sizes WHERE len(w) >= size)
), hit AS (
  SELECT o.rid, o.i, o.size, v.item_id FROM occ o JOIN win v ON o.phrase = v.phrase AND o.size = v.size
), spot AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hit) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN spot USING (rid) LEFT JOIN items USING (rid)
"""

_LOG = r"""
WITH p AS (
  SELECT page_id AS i, url, html, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag,
    strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(page_id AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS day,
    strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(page_id + 1440 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS day2,
    CASE WHEN page_id % 2 = 0 THEN url || '#top' ELSE url END AS url2
  FROM pages
), c AS (
  SELECT *, regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^[hH][tT][tT][pP][sS]?://([^/?]+)([^?]*)(.*)$',
                           ['host', 'path', 'query']) AS u
  FROM p
), k AS (
  SELECT *, regexp_replace(lower(u.host), '^www\.|:(80|443)$', '', 'g') || CASE WHEN u.path = '' THEN '/' ELSE u.path END
    || CASE WHEN len(params) = 0 THEN '' ELSE '?' || array_to_string(params, '&') END AS key
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_replace(u.query, '^\?', ''), '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|fbclid|gclid)='))) AS params FROM c)
), r AS (
  SELECT i, key, 'full-' || i AS id, i AS minute, CASE WHEN i % 7 = 0 THEN NULL ELSE tag END AS tag, day, html FROM k
), v AS (
  SELECT i, key, 'later-' || i AS id, i + 1440 AS minute, tag, day, day2 FROM k
  UNION ALL SELECT i, key, 'early-' || i, i - 1, tag, day, day2 FROM k WHERE i % 6 = 1
)
"""

OP6 = _LOG + r"""
, m AS (
  SELECT v.*, r.id AS response_id, r.tag AS r_tag, r.day AS r_day, r.html AS r_html,
    CASE WHEN r.id IS NULL THEN 'no_response'
         WHEN v.i % 6 <= 1 THEN CASE WHEN r.tag IS NOT NULL AND r.tag = v.tag THEN 'resolved' ELSE 'validator_mismatch' END
         WHEN v.i % 6 = 2 THEN 'validator_mismatch'
         WHEN v.i % 6 = 3 THEN CASE WHEN r.day = v.day THEN 'resolved' ELSE 'validator_mismatch' END
         WHEN v.i % 6 = 4 THEN 'resolved' ELSE 'validator_mismatch' END AS status
  FROM v LEFT JOIN r ON r.key = v.key AND r.minute < v.minute
  QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY r.minute DESC NULLS LAST, r.id DESC) = 1
), h AS (
  SELECT *, CASE WHEN status = 'resolved' THEN array_to_string(list_filter([
      'HTTP/1.1 200 OK', 'content-type: text/html',
      CASE WHEN i % 6 <> 3 THEN 'last-modified: ' || r_day END,
      CASE WHEN i % 6 > 1 THEN 'etag: ' || r_tag END,
      'cache-control: max-age=120', 'date: ' || day2,
      CASE WHEN i % 6 = 0 THEN 'etag: W/' || tag WHEN i % 6 = 1 THEN 'etag: ' || tag
           WHEN i % 6 = 3 THEN 'last-modified: ' || day END],
      lambda x: x IS NOT NULL), chr(13) || chr(10)) END AS head
  FROM m
)
SELECT id AS record_id, key AS url, status, response_id, md5(head) AS head_md5,
  CASE WHEN status = 'resolved' THEN CAST(length(r_html) AS BIGINT) END AS payload_chars,
  CASE WHEN status = 'resolved' THEN md5(r_html) END AS payload_md5
FROM h
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30
), cuts AS (
  SELECT c.*, cut, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * a // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), parts AS (
  SELECT lang, a, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, k, w, a, size, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM c WHERE k > 2))
), longest AS (
  SELECT lang, phrase, max(a) AS most FROM parts GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN totals USING (lang) LEFT JOIN longest USING (lang, phrase)
WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a
QUALIFY rank <= 2000
"""

OP12 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
), damage AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295::BIGINT],
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                       lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM conversations, crc_table
), kept AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM damage WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS said
  FROM kept
), r AS (
  SELECT *, CASE WHEN said = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated'
                 ELSE 'sound' END AS fault, left(role, 1) AS initial,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
), ins(a, b, n, said) AS (
  VALUES (0, 0, 0, []::VARCHAR[]), (0, 2, 1, ['user:']), (0, 3, 2, ['user:', 'assistant:']), (1, 1, 0, []), (1, 2, 1, ['user:']),
    (1, 3, 2, ['user:', 'assistant:']), (2, 2, 0, []), (2, 3, 1, ['assistant:']), (3, 3, 0, []), (3, 2, 1, ['user:'])
), ed(letter, b, c, initial, price) AS (
  VALUES ('D', 0, 0, '', 2), ('D', 1, 1, '', 2), ('D', 2, 2, '', 2), ('D', 3, 3, '', 2), ('K', 0, 1, 's', 0), ('K', 0, 2, 'u', 0),
    ('K', 1, 2, 'u', 0), ('K', 3, 2, 'u', 0), ('K', 2, 3, 'a', 0), ('R', 0, 2, '', 1), ('R', 1, 2, '', 1), ('R', 3, 2, '', 1),
    ('R', 2, 3, '', 1)
), best(conv_id, pos, state, cost, audit, said) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), CAST('' AS VARCHAR), CAST([] AS VARCHAR[]) FROM counted
  UNION ALL
  SELECT best.conv_id, r.pos, ed.c,
    best.cost + 5 * ins.n + ed.price + CASE WHEN ed.letter <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END AS new_cost,
    best.audit || repeat('I', ins.n) || ed.letter AS new_audit,
    list_concat(list_concat(best.said, ins.said), CASE ed.letter WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text]
      ELSE [CASE ed.c WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || r.text] END)
  FROM best JOIN r ON r.conv_id IS NOT DISTINCT FROM best.conv_id AND r.pos = best.pos + 1
    JOIN ins ON ins.a = best.state JOIN ed ON ed.b = ins.b
  WHERE (ed.letter = 'D' OR r.fault IN ('truncated', 'sound')) AND (ed.letter <> 'K' OR ed.initial = r.initial)
  QUALIFY row_number() OVER (PARTITION BY best.conv_id, ed.c ORDER BY new_cost, new_audit) = 1
), last AS (
  SELECT best.conv_id, cost + 5 * m AS cost, audit || repeat('I', m) AS audit,
    list_concat(said, CASE m WHEN 0 THEN [] WHEN 1 THEN ['assistant:'] ELSE ['user:', 'assistant:'] END) AS said
  FROM (SELECT *, CASE state WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS m FROM best) best
  JOIN counted ON counted.conv_id IS NOT DISTINCT FROM best.conv_id AND counted.n = best.pos
  QUALIFY row_number() OVER (PARTITION BY best.conv_id ORDER BY cost + 5 * m, audit || repeat('I', m)) = 1
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN last ON last.conv_id IS NOT DISTINCT FROM e.conv_id
"""

OP13 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), p AS (
  SELECT x.rid AS a, y.rid AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.rid < y.rid GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), reach AS (
  SELECT rid AS a, rid AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a
), c AS (
  SELECT reach.a AS rid, min(doc_id) AS component_id FROM reach JOIN d ON d.rid = reach.b GROUP BY 1
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN c USING (rid) LEFT JOIN n USING (rid)
"""

ORACLE: dict[str, str] = {
    "op6_warc_revisits": OP6,
    "op7_chat_formatting": OP7,
    "op9_mixing": OP9,
    "op10_decontamination": OP10,
    "op11_collocations": OP11,
    "op12_turn_repair": OP12,
    "op13_minhash": OP13,
}
