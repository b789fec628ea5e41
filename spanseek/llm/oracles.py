"""SQL (DuckDB) that returns the rows of operator queries where SQL can express them."""

from __future__ import annotations

from . import secret_scan

_LETTERS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"


def _spans(number: int, rule: secret_scan.Rule) -> str:
    """Matches of one rule with their places: text between matches and matches take turns."""
    pattern = rule.pattern.replace("(?ai:password|passwd|secret|token|api_?key)", _LETTERS).replace("'", "''")
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {number} AS number, starts - 1 AS start, starts - 1 + length(m) AS stop FROM (
    SELECT doc_id, m, g, 1 + sum(length(gap)) OVER w + sum(length(m)) OVER w - length(m) AS starts FROM (
      SELECT doc_id, i, ms[i] AS m, gs[i] AS g, gaps[i] AS gap FROM (
        SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {rule.group}) AS gs,
          string_split_regex(t, '{pattern}') AS gaps FROM d
      ), unnest(range(1, len(ms) + 1)) AS r(i)
    ) WINDOW w AS (PARTITION BY doc_id ORDER BY i)
  ) WHERE length(g) >= {rule.least}"""


def op8_secret_scan() -> str:
    kinds = [rule.kind for rule in secret_scan.BASE]
    counts = ",\n  ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in kinds)
    one = "kind || ':' || start || ':' || stop"
    spans = "\n  UNION ALL".join(_spans(n, rule) for n, rule in enumerate(secret_scan.RULES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({spans}
)
SELECT d.doc_id,
  {counts},
  sha256(coalesce(string_agg({one}, ',' ORDER BY start, number) FILTER (number < {len(kinds)}), '')) AS base_sha256,
  coalesce(string_agg({one}, ',' ORDER BY start, number) FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN (SELECT doc_id, kind, number, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM s) s USING (doc_id)
GROUP BY d.doc_id
"""


def op9_substring_dedup(window: int = 35) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(words[i:i + {window - 1}], ' ') AS k FROM d, unnest(range(1, len(words) - {window - 2})) AS r(i)
), again AS (
  SELECT doc_id, i FROM w JOIN (SELECT k FROM w GROUP BY k HAVING count(*) > 1) USING (k)
), covered AS (
  SELECT DISTINCT doc_id, i + j AS p FROM again, unnest(range(0, {window})) AS r(j)
), kept AS (
  SELECT doc_id, string_agg(words[p], ' ' ORDER BY p) AS kept FROM (
    SELECT doc_id, words, p FROM d, unnest(range(1, len(words) + 1)) AS r(p)
  ) ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM covered GROUP BY doc_id) USING (doc_id)
"""


OP3_WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), best AS (
  SELECT payload_digest, max(page_id) AS stored FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < stored AND payload_bytes >= 1000 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < stored AND payload_bytes >= 1000 THEN stored END AS refers_to
FROM p LEFT JOIN best USING (payload_digest)
"""


def op13_filter_audit() -> str:
    """Masks per document, orders by joining letters with each other, counts per part, order and step."""
    word = r"[^\x20\x09-\x0D]+"
    letters = "(VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS {0}(l, b)"
    orders = f"""
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM {letters.format('a')}, {letters.format('b')}, {letters.format('c')}, {letters.format('d')}, {letters.format('e')}
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b & b.b = 0 AND (a.b | b.b) & c.b = 0 AND (a.b | b.b | c.b) & d.b = 0"""
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{word}') AS words FROM t),
m AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END AS mask
  FROM w
),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
),
o AS ({orders}
),
s AS (
  SELECT filter_order, i AS step, bits[i] AS own, CASE WHEN i > 1 THEN list_sum(bits[1 : i - 1]) ELSE 0 END::INTEGER AS before
  FROM o, unnest(range(1, 6)) AS r(i)
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (mask & own > 0 AND mask & before = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & own > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (mask & own > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (mask & own > 0), 0)::BIGINT AS shapley
FROM c CROSS JOIN s GROUP BY part, filter_order, step
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": OP3_WARC, "op8_secret_scan": op8_secret_scan(), "op9_substring_dedup": op9_substring_dedup(), "op13_filter_audit": op13_filter_audit()}
