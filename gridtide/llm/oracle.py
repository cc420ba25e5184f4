"""SQL twins of the training-data queries that SQL can express.

The others depend on a fitted model, a tokenizer, a packing order or chains of
links; tests/llm compares them with brute-force versions.
"""

SQL: dict[str, str] = {}

SQL["op1_topk_search"] = """
WITH codes AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings),
  pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS id,
      len(list_filter(list_zip(q.bits, c.bits), lambda p: p[1] <> p[2])) AS distance
    FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(place AS INTEGER) AS rank, id, CAST(distance AS INTEGER) AS distance
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY distance, id) AS place FROM pairs)
WHERE place <= 10"""

SQL["op2_warc"] = """
WITH hashed AS (SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex
    FROM pages),
  numbers AS (SELECT *, list_transform(range(8), lambda n: list_reduce(list_transform(range(1, 6),
      lambda i: CAST(strpos('0123456789abcdef', hex[5 * n + i]) - 1 AS BIGINT)), lambda a, b: a * 16 + b))
      AS parts FROM hashed),
  spelled AS (SELECT *, list_aggregate(list_transform(parts, lambda v: list_aggregate(list_transform(
      [15, 10, 5, 0], lambda s: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> s) & 31) + 1]),
      'string_agg', '')), 'string_agg', '') AS digest,
      MAX(page_id) OVER (PARTITION BY payload) AS original FROM numbers)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  digest AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to, url AS target_uri,
  CAST(NULL AS VARCHAR) AS problem
FROM spelled"""

SQL["op9_url_filter"] = """
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES ('net', '/', 'block'),
    ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
  rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
      THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
  parts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM rests),
  places AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts),
  fits AS (SELECT page_id, rule_host || rule_path AS rule, rule_verdict, ROW_NUMBER() OVER (
      PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
    FROM places JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
      AND starts_with(path, rule_path))
SELECT p.page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM places p LEFT JOIN fits f ON p.page_id = f.page_id AND place = 1"""
