"""The answers of the queries in DuckDB SQL, where SQL expresses them."""

ORACLE: dict[str, str] = {}

ORACLE["op3_url_rules"] = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
    regexp_extract(coalesce(url, ''), '^.*?://[^?#]*(.*)', 1, 's') AS tail
  FROM pages
), judged AS (
  SELECT *, host || path || tail AS subject,
    '.' || host AS dotted
  FROM parts
), ruled AS (
  SELECT *, CASE
      WHEN dotted LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN dotted LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN dotted LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN dotted LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN dotted LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
    regexp_matches(subject, '^([^/?#]*\.)?(ads|ads-track|casino-win|free-bets)\.|/ads/|/banner/|/wp-login|/cart([^A-Za-z0-9_.%-]|$)|\?page=.*&ref=|\.exe$|\.zip$', 's') AS listed
  FROM judged
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

ORACLE["op2_warc_revisits"] = r"""
WITH cut AS (
  SELECT page_id,
    1600000000 + (page_id * 7919) % 2592000 AS start,
    regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '', 's') AS rest
  FROM pages
), named AS (
  SELECT page_id, start,
    start + 86400 * (1 + page_id % 5) AS later,
    regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
      || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
      lambda p: p <> '' AND split_part(p, '=', 1) NOT IN
        ('utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'ref'))) AS query
  FROM cut
), visits AS (
  SELECT *, place || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical,
    later + 3600 * (1 + page_id % 7) AS last
  FROM named
), full_answers AS (
  SELECT canonical, page_id * 4 AS record_id, start AS ts, '"' || page_id || '-1"' AS etag
  FROM visits WHERE page_id % 10 <> 0 AND canonical <> ''
), revisits AS (
  SELECT page_id, page_id * 4 + 1 AS record_id, canonical, later AS ts, 'W/"' || page_id || '-1"' AS etag,
    'max-age=600' AS cache_control
  FROM visits
  UNION ALL
  SELECT page_id, page_id * 4 + 2, canonical, last,
    CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 4 = 0 THEN '"' || page_id || '-2"'
         ELSE '"' || page_id || '-1"' END,
    NULL
  FROM visits
), found AS (
  SELECT v.*, (SELECT max({'ts': f.ts, 'record_id': f.record_id, 'etag': f.etag}) FROM full_answers f
               WHERE f.canonical = v.canonical AND f.ts < v.ts) AS answer
  FROM revisits v
), judged AS (
  SELECT *, CASE WHEN answer IS NULL THEN 'missing' WHEN etag IS NULL THEN 'unchecked'
    WHEN replace(etag, 'W/', '') = answer.etag THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM found
)
SELECT page_id, record_id, nullif(canonical, '') AS canonical,
  CASE WHEN outcome = 'resolved' THEN answer.record_id END AS response_id, outcome,
  CASE WHEN outcome = 'resolved' THEN etag END AS etag,
  CASE WHEN outcome = 'resolved' THEN coalesce(cache_control, 'max-age=60') END AS cache_control,
  CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type,
  CASE WHEN outcome = 'resolved' THEN ts::VARCHAR END AS date
FROM judged
"""

ORACLE["op9_preference_format"] = r"""
WITH turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
), shapes AS (
  SELECT conv_id, count(*) AS n, max(place) FILTER (role = 'assistant') AS answered,
    arg_min(text, place) AS opening,
    list(text ORDER BY place DESC) FILTER (role = 'assistant') AS answers
  FROM turns GROUP BY conv_id
), pairs AS (
  SELECT *, CASE WHEN len(answers) > 1 THEN answers[2] ELSE opening END AS other FROM shapes
), split AS (
  SELECT *, CASE WHEN answered IS NULL THEN n WHEN answers[1] IS NOT DISTINCT FROM other THEN answered
    ELSE answered - 1 END AS shared
  FROM pairs
)
SELECT s.conv_id, s.shared::INTEGER AS n_prompt_turns,
  coalesce(string_agg('<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10), ''
    ORDER BY t.place) FILTER (t.place <= s.shared), '') AS prompt,
  CASE WHEN s.shared < s.answered THEN '<|assistant|>' || chr(10) || coalesce(s.answers[1], '') || '<|end|>' || chr(10) ELSE '' END AS chosen,
  CASE WHEN s.shared < s.answered THEN '<|assistant|>' || chr(10) || coalesce(s.other, '') || '<|end|>' || chr(10) ELSE '' END AS rejected,
  CASE WHEN s.shared < s.answered THEN '14-' || (14 + length(coalesce(s.answers[1], ''))) ELSE '' END AS chosen_mask,
  CASE WHEN s.shared < s.answered THEN '14-' || (14 + length(coalesce(s.other, ''))) ELSE '' END AS rejected_mask
FROM split s JOIN turns t USING (conv_id)
GROUP BY ALL
"""
