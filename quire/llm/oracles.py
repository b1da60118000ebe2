"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

REPUTATION = r"""
WITH parts AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
named AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM split),
labelled AS (SELECT page_id, count(*) AS n, count(*) FILTER (quality > 0) AS s
             FROM pages JOIN labels ON doc_id = try_cast(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) WHERE quality IS NOT NULL GROUP BY page_id),
h AS (SELECT name, list_reverse(string_split(name, '.')) AS l, coalesce(sum(n), 0) AS n, coalesce(sum(s), 0) AS s FROM named LEFT JOIN labelled USING (page_id) GROUP BY name),
hosts AS (SELECT name, n, s, l[1] AS suffix, CASE WHEN len(l) > 1 THEN l[2] || '.' || l[1] ELSE l[1] END AS domain FROM h),
root AS (SELECT (sum(s) + 1) / (sum(n) + 2) AS m FROM hosts),
s1 AS (SELECT suffix AS name, sum(n) AS n, sum(s) AS s, any_value(m) AS m0 FROM hosts, root GROUP BY suffix),
k1 AS (SELECT sum(n * (s / n - m0) ^ 2 - m0 * (1 - m0)) / sum((n - 1) * m0 * (1 - m0)) AS rho FROM s1 WHERE n > 0),
s2 AS (SELECT name, (k * m0 + s) / (k + n) AS m FROM s1, (SELECT least(10000, greatest(1, CASE WHEN rho > 0 THEN 1 / greatest(rho, 1e-9) - 1 ELSE 10000 END)) AS k FROM k1)),
d1 AS (SELECT domain AS name, sum(hosts.n) AS n, sum(hosts.s) AS s, any_value(m) AS m0 FROM hosts JOIN s2 ON s2.name = suffix GROUP BY domain),
k2 AS (SELECT sum(n * (s / n - m0) ^ 2 - m0 * (1 - m0)) / sum((n - 1) * m0 * (1 - m0)) AS rho FROM d1 WHERE n > 0),
d2 AS (SELECT name, (k * m0 + s) / (k + n) AS m FROM d1, (SELECT least(10000, greatest(1, CASE WHEN rho > 0 THEN 1 / greatest(rho, 1e-9) - 1 ELSE 10000 END)) AS k FROM k2)),
h1 AS (SELECT hosts.name, hosts.n, hosts.s, m AS m0 FROM hosts JOIN d2 ON d2.name = domain),
k3 AS (SELECT sum(n * (s / n - m0) ^ 2 - m0 * (1 - m0)) / sum((n - 1) * m0 * (1 - m0)) AS rho FROM h1 WHERE n > 0),
h2 AS (SELECT name, n, k, (k * m0 + s) / (k + n) AS m FROM h1, (SELECT least(10000, greatest(1, CASE WHEN rho > 0 THEN 1 / greatest(rho, 1e-9) - 1 ELSE 10000 END)) AS k FROM k3)),
earned AS (SELECT name, CASE WHEN least(1, m + 1.96 * sqrt(m * (1 - m) / (k + n + 1))) < 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM h2),
rules(verdict, rule) AS (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')),
fits AS (SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
         FROM (SELECT DISTINCT page_id, host, path FROM split), rules
         WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, position('/' IN rule)))
         GROUP BY page_id, host, path)
SELECT named.page_id, named.host, named.path, fits.rule, coalesce(fits.verdict, earned.verdict) AS verdict
FROM named JOIN earned USING (name) LEFT JOIN fits ON fits.page_id = named.page_id AND fits.host = named.host AND fits.path = named.path
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
grown AS (SELECT *, len(regexp_extract_all(text, '<!*\|')) + len(regexp_extract_all(role, '<!*\|')) + length(role) - length(replace(replace(role, '\', ''), chr(10), '')) AS more FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(role) + 1 + length(text) + length('<|im_end|>') + 1 + more) AS BIGINT) AS formatted_chars
FROM grown GROUP BY conv_id
"""

WARC = r"""
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT page_id, payload_bytes, string_agg(lpad(bin(('0x' || substr(hex, k, 2))::INT), 8, '0'), '' ORDER BY k) AS b
         FROM payloads, (SELECT unnest(range(1, 40, 2)) AS k) GROUP BY page_id, payload_bytes, hex),
codes AS (SELECT page_id, payload_bytes, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(b, k, 1)::INT + 8 * substr(b, k + 1, 1)::INT
            + 4 * substr(b, k + 2, 1)::INT + 2 * substr(b, k + 3, 1)::INT + substr(b, k + 4, 1)::INT, 1), '' ORDER BY k) AS payload_digest
          FROM bits, (SELECT unnest(range(1, 161, 5)) AS k) GROUP BY page_id, payload_bytes, b),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM codes)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""
