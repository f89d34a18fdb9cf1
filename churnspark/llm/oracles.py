"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = "'[^\\x20\\x09-\\x0D]+'"

OP9 = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line, len(ls) AS n
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT *, translate(trim(line, {_WS}), {_AZ}) AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.first_id AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP3 = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS size FROM documents),
by_source AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS k
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST(k % 3 AS INT) + 1] AS weight, 2.0::DOUBLE * source_size AS cap,
         1.5::DOUBLE * sum(source_size) OVER () AS budget FROM by_source),
levels AS (
  SELECT *, cap / weight AS ratio,
         (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
water AS (SELECT arg_min(level, ratio) AS water FROM levels WHERE ratio > level),
targets AS (
  SELECT source, source_size, CASE WHEN water IS NULL OR ratio <= water THEN cap ELSE water * weight END AS target
  FROM levels, water),
quotas AS (
  SELECT r.k, t.*, CAST(floor(least(t.target, 2 * t.source_size)) AS BIGINT) AS quota,
         CAST(greatest(1, least(4096, floor(t.target / 64))) AS BIGINT) AS block
  FROM targets t JOIN ranked r ON t.source IS NOT DISTINCT FROM r.source),
needed AS (
  SELECT *, CAST(ceil(source_size / block) AS BIGINT) AS n_blocks,
         CASE WHEN source_size > 0 THEN (quota // source_size) * CAST(ceil(source_size / block) AS BIGINT)
              + CAST(ceil((quota % source_size) / block) AS BIGINT) ELSE 0 END AS slots FROM quotas),
shares AS (
  SELECT *, sum(slots) OVER () AS all_slots,
         coalesce(sum(slots) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           / greatest(sum(slots) OVER (), 1) AS lo,
         sum(slots) OVER (ORDER BY k) / greatest(sum(slots) OVER (), 1) AS hi FROM needed),
n_slots AS (
  SELECT CASE WHEN max(all_slots) > 0 THEN CAST(floor(max(all_slots) * 1.125::DOUBLE) AS BIGINT) + 64 ELSE 0 END AS n FROM shares),
points AS (SELECT i AS slot, ((i + 1) * 0.6180339887498949::DOUBLE) % 1.0::DOUBLE AS u
           FROM (SELECT unnest(range(CAST(n AS BIGINT))) AS i FROM n_slots)),
drawn AS (
  SELECT p.slot, s.k, row_number() OVER (PARTITION BY s.k ORDER BY p.slot) - 1 AS rank
  FROM points p JOIN shares s ON p.u >= s.lo AND p.u < s.hi),
slots AS (
  SELECT d.k, d.slot, d.rank FROM drawn d JOIN shares s ON s.k = d.k AND d.rank < s.slots
  UNION ALL
  SELECT k, n + CAST(round(lo * all_slots) AS BIGINT) + rank AS slot, rank
  FROM (SELECT s.k, s.lo, s.all_slots, unnest(range(CAST(g.got AS BIGINT), CAST(s.slots AS BIGINT))) AS rank
        FROM shares s JOIN (SELECT s.k, count(d.slot) AS got FROM shares s LEFT JOIN drawn d ON d.k = s.k GROUP BY s.k) g
          ON g.k = s.k), n_slots),
starts AS (
  SELECT s.doc_id, s.size, q.*, coalesce(sum(s.size) OVER (PARTITION BY s.source
           ORDER BY md5(CAST(s.doc_id AS VARCHAR)), CAST(s.doc_id AS VARCHAR)
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, row_number() OVER () AS row_nr
  FROM sized s JOIN shares q ON s.source IS NOT DISTINCT FROM q.source),
firsts AS (
  -- the words of a slot: block rank % n_blocks of the stream, cut at the quota
  SELECT t.row_nr, min(s.slot) AS first_slot
  FROM starts t JOIN slots s ON s.k = t.k AND s.rank % t.n_blocks BETWEEN t.start // t.block AND (t.start + t.size - 1) // t.block
  WHERE t.size > 0
    AND least(t.source_size, (s.rank % t.n_blocks + 1) * t.block, t.quota - (s.rank // t.n_blocks) * t.source_size) > t.start
  GROUP BY t.row_nr)
SELECT t.doc_id, CAST(t.size AS BIGINT) AS size, CAST(t.source_size AS BIGINT) AS source_size, t.target,
       CAST(CASE WHEN t.size = 0 THEN 0 ELSE (t.quota // t.source_size) * t.size
            + greatest(0, least(t.size, (t.quota % t.source_size) - t.start)) END AS BIGINT) AS taken, f.first_slot
FROM starts t LEFT JOIN firsts f ON f.row_nr = t.row_nr
"""

OP5 = f"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_AZ}) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
keyed AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(\\.html|/)$', '') END
         AS canonical FROM parts),
listed AS (
  SELECT DISTINCT canonical FROM keyed
  WHERE regexp_extract(host, '^(?:(?:www|m|blog)\\.)?([^.]*)', 1)
        IN ('ads-track', 'casino-win', 'spam-farm', 'adult-x', 'cheap-pills', 'free-bets')),
rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT k.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM keyed k JOIN rules r ON (k.host = r.host OR k.host LIKE '%.' || r.host) AND starts_with(k.path, r.path)
  GROUP BY k.page_id)
SELECT k.page_id, k.host, k.path, f.rule,
       coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       l.canonical IS NOT NULL AS listed
FROM keyed k LEFT JOIN fits f ON k.page_id = f.page_id LEFT JOIN listed l ON k.canonical = l.canonical
"""


def oracles() -> dict[str, str]:
    return {"op3_source_mix": OP3, "op5_url_filter": OP5, "op9_line_dedup": OP9}
