"""The results of the queries stated in SQL, by plainer ways than the operators take."""

from __future__ import annotations

import public_tokenizers

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('42:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT max((total - coalesce(caps, 0)) / weights) AS level, any_value(total) AS total
  FROM (SELECT sum(source_size) OVER ()::DOUBLE AS total,
               sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::DOUBLE AS caps,
               sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS weights
        FROM sources)),
targets AS (
  SELECT source, source_size, total, least((3 * source_size)::DOUBLE, weight * level) AS target
  FROM sources, levels),
sized_blocks AS (
  SELECT *, greatest(1, least(64, coalesce(floor(
              min(target) FILTER (target > 0) OVER () / 64), 1)))::BIGINT AS block,
         greatest(1, ceil(source_size / greatest(50000, total / 50000)))::BIGINT AS shards
  FROM targets),
seats AS (SELECT *, round(total / block)::BIGINT AS seats FROM sized_blocks),
source_quota AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, seats, row_number() OVER (
             ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS place
    FROM seats, LATERAL (SELECT unnest(generate_series(0, seats)) AS k) WHERE target > 0)
  WHERE place <= seats GROUP BY source),
dealt AS (
  SELECT d.*, s.source_size, s.target, s.block, coalesce(q.quota, 0) AS quota,
         ('0x' || substr(d.place, 1, 8))::BIGINT % s.shards AS shard
  FROM sized d JOIN seats s ON d.source IS NOT DISTINCT FROM s.source
  LEFT JOIN source_quota q ON d.source IS NOT DISTINCT FROM q.source),
shard_sizes AS (
  SELECT source, shard, sum(size)::BIGINT AS words, any_value(quota) AS seats,
         any_value(block) AS block
  FROM dealt GROUP BY source, shard HAVING sum(size) > 0),
shard_quota AS (
  SELECT source, shard, any_value(words) AS words, any_value(block) AS block,
         count(*) FILTER (place <= seats) AS won FROM (
    SELECT *, row_number() OVER (PARTITION BY source
             ORDER BY words::DOUBLE / (2 * k + 1) DESC, shard, k) AS place
    FROM shard_sizes, LATERAL (SELECT unnest(generate_series(0, seats)) AS k))
  GROUP BY source, shard),
passes AS (
  SELECT source, shard, block, ceil(words / block)::BIGINT AS blocks,
         least(won, 3 * ceil(words / block)::BIGINT) AS quota FROM shard_quota),
laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM dealt)
SELECT l.doc_id, l.size, l.source_size, l.target,
       coalesce(p.quota // p.blocks * l.size
                + greatest(0, least(l.size, p.quota % p.blocks * p.block - l.before)), 0)::BIGINT
         AS taken
FROM laid l LEFT JOIN passes p
  ON l.source IS NOT DISTINCT FROM p.source AND l.shard = p.shard
"""

URL_RULES = r"""
WITH parted AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, url, CASE WHEN position('://' IN url) > 0
          THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages)),
given(rule, domain, start, says) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
numbered AS (SELECT *, row_number() OVER () AS row FROM parted),
ruled AS (
  SELECT n.*, r.rule, r.says FROM numbered n LEFT JOIN given r
    ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(r.rule) DESC NULLS LAST) = 1),
baskets AS (
  SELECT *, list_sort(list_distinct(
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''),
                   lambda x: 'host:' || x)
    || list_transform(list_filter(string_split(regexp_replace(path, '[0-9]+', '0', 'g'), '/'),
                                  lambda x: x <> ''), lambda x: 'path:' || x)
    || list_transform(list_filter(list_transform(string_split(regexp_extract(
         coalesce(url, ''), '\?([^#]*)', 1), '&'), lambda x: string_split(x, '=')[1]),
         lambda x: x <> ''), lambda x: 'query:' || x))) AS tokens
  FROM ruled),
labelled AS (SELECT count(*) AS n FROM baskets WHERE rule IS NOT NULL),
frequent AS (
  SELECT list(token) AS those FROM (
    SELECT token FROM (SELECT unnest(tokens) AS token FROM baskets WHERE rule IS NOT NULL)
    GROUP BY token HAVING count(*) >= (SELECT ceil(0.01 * n) FROM labelled))),
subsets AS (
  SELECT says, list_filter(held, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items
  FROM (SELECT says, list_sort(list_intersect(tokens, those)) AS held FROM baskets, frequent
        WHERE rule IS NOT NULL),
    LATERAL (SELECT unnest(generate_series(1, (1::BIGINT << len(held)) - 1)) AS mask)),
mined AS (
  SELECT items, verdict, hits, whole
  FROM (SELECT s.items, s.says AS verdict, count(*) AS hits,
               sum(count(*)) OVER (PARTITION BY s.items) AS whole
        FROM subsets s GROUP BY s.items, s.says)),
rules AS (
  SELECT items, verdict, hits::DOUBLE / whole AS confidence, hits::DOUBLE / n AS support
  FROM mined, labelled WHERE hits >= ceil(0.01 * n) AND hits::DOUBLE / whole >= 0.8),
pruned AS (
  SELECT * FROM rules r WHERE NOT EXISTS (
    SELECT 1 FROM rules s WHERE s.verdict = r.verdict AND len(s.items) < len(r.items)
      AND s.confidence >= r.confidence AND list_has_all(r.items, s.items))),
learned AS (
  SELECT b.row, r.verdict FROM baskets b JOIN pruned r ON list_has_all(b.tokens, r.items)
  WHERE b.rule IS NULL
  QUALIFY row_number() OVER (PARTITION BY b.row ORDER BY r.confidence DESC, r.support DESC,
                             len(r.items) DESC, r.items DESC, r.verdict DESC) = 1)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(says, l.verdict, 'allow') AS verdict
FROM baskets LEFT JOIN learned l USING (row)
"""

TOPK_SEARCH = r"""
WITH vectors AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(
    list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
  GROUP BY vec_id)
SELECT q.vec_id AS query_id, row_number() OVER (
         PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id)::INT AS rank,
       c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
QUALIFY rank <= 5
"""

WARC = r"""
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
last AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM original
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM original
            THEN original END AS refers_to
FROM last
"""

# Bytes are written as two hexadecimal digits; byte symbols from 256 on are the others in order.
TOKEN_COUNTS = r"""
WITH RECURSIVE tokens AS (
  SELECT unnest(json_keys(content, '$.model.vocab')) AS token FROM read_text('{path}')),
written AS (
  SELECT array_to_string(list_transform(string_split(token, ''), lambda c: format('{{:02X}}',
           CASE WHEN unicode(c) < 256 THEN unicode(c) WHEN unicode(c) < 289 THEN unicode(c) - 256
                WHEN unicode(c) < 323 THEN unicode(c) - 162 ELSE 173 END)), '') AS token
  FROM tokens),
vocabulary AS (
  SELECT token FROM written
  WHERE NOT regexp_matches(substring(token, 3), '^(..)*(20|09|0A|0B|0C|0D)')),
longest AS (SELECT max(length(token)) // 2 AS n FROM vocabulary),
numbered AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
words AS (
  SELECT row, hex(encode(' ' || word)) AS word FROM (
    SELECT row, unnest(regexp_split_to_array(text, '[\x09-\x0D\x20]+')) AS word FROM numbered)
  WHERE word <> ''),
taken AS (
  SELECT DISTINCT word, word AS rest, 0 AS n FROM words
  UNION ALL
  SELECT word, substring(any_value(rest), 2 * max(k) + 1), any_value(t.n) + 1
  FROM (SELECT word, rest, taken.n, unnest(range(1, least(longest.n, length(rest) // 2) + 1)) AS k
        FROM taken, longest WHERE rest <> '') t
  JOIN vocabulary ON token = substring(rest, 1, 2 * k)
  GROUP BY word),
counts AS (SELECT word, max(n) AS n FROM taken GROUP BY word)
SELECT any_value(doc_id) AS doc_id, coalesce(sum(n), 0)::BIGINT AS n_tokens
FROM numbered LEFT JOIN words USING (row) LEFT JOIN counts USING (word) GROUP BY row
""".format(path=public_tokenizers.path("byte_bpe_50k.json"))

ORACLES = {"op1_mixing": MIXING, "op4_topk_search": TOPK_SEARCH, "op5_warc": WARC,
           "op6_token_counts": TOKEN_COUNTS,
           "op10_url_rules": URL_RULES}
