"""DuckDB SQL that states the result of the queries that SQL can express."""

from __future__ import annotations

# Space and the controls 9 to 13, as a DuckDB string.
_SPACES = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = f"""
SELECT doc_id, text, unnest(ls) AS line, generate_subscripts(ls, 1) AS place
FROM (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM {{documents}})
"""

MARKED = f"""
WITH keyed AS (
    SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM ({LINES})
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, line, place, coalesce(doc_id <> keeper, false) AS lost FROM keyed LEFT JOIN shared USING (key)
"""

LINE_DEDUP = f"""
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '') AS kept
FROM ({MARKED}) GROUP BY doc_id
"""


_BARE = "regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
_HOST = "lower(regexp_replace(regexp_extract(bare, '^[^/?]*'), '^.*@', ''))"
_PARTS = "string_split(regexp_extract(bare, '^[^?]*\\?(.*)$', 1), '&')"
_KEPT = f"list_sort(list_filter({_PARTS}, lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|gclid|fbclid)(=|$)')))"

REVISITS = f"""
WITH made AS (
    SELECT page_id * 3 AS record_id, url, 1700000000 + page_id * 60 AS captured_at, 'response' AS kind,
           md5(coalesce(html, '')) AS etag, coalesce(html, '') AS payload FROM pages
    UNION ALL
    SELECT page_id * 3 + 1, url || '#again', 1700000000 + page_id * 60 + 604800, 'revisit',
           CASE WHEN page_id % 5 = 0 THEN 'other' WHEN page_id % 7 = 0 THEN NULL ELSE md5(coalesce(html, '')) END, NULL
    FROM pages
    UNION ALL
    SELECT page_id * 3 + 2, upper(regexp_extract(url, '^([a-z]+://[^/]*)', 1)) || '/', 1700000000 + page_id * 60,
           CASE WHEN page_id % 4 = 0 THEN 'response' ELSE 'revisit' END, 'v' || page_id // 400,
           CASE WHEN page_id % 4 = 0 THEN regexp_extract(url, '^([a-z]+://[^/]*)', 1) || 'v' || page_id // 400 END
    FROM pages
), split AS (
    SELECT *, {_BARE} AS bare FROM made
), named AS (
    SELECT *, regexp_replace(regexp_replace({_HOST}, '^www[0-9]*\\.', ''), ':(80|443)$', '')
              || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
              || CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END AS page
    FROM split
), met AS (
    SELECT a.record_id, a.page, a.captured_at, a.etag, b.record_id AS response_id, b.etag AS old, b.payload
    FROM (SELECT * FROM named WHERE kind = 'revisit') a LEFT JOIN (SELECT * FROM named WHERE kind = 'response') b
      ON a.page = b.page AND b.captured_at < a.captured_at
    QUALIFY row_number() OVER (PARTITION BY a.record_id ORDER BY b.captured_at DESC NULLS LAST, b.record_id DESC) = 1
), judged AS (
    SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN etag IS NULL THEN 'unchecked'
                   WHEN etag = old THEN 'resolved' ELSE 'changed' END AS status FROM met
)
SELECT record_id, page, status, CASE WHEN taken THEN response_id END AS response_id,
       CASE WHEN taken THEN 'content-length: ' || strlen(payload) || chr(10) || 'content-type: text/html' || chr(10)
                            || 'date: ' || captured_at || chr(10) || 'etag: ' || old
            ELSE 'content-length: 0' || chr(10) || 'date: ' || captured_at || chr(10) || 'set-cookie: id' END AS headers,
       CASE WHEN taken THEN sha256(payload) END AS payload_sha256
FROM (SELECT *, status IN ('resolved', 'unchecked') AS taken FROM judged)
"""


def oracle_sql() -> dict[str, str]:
    lines = LINE_DEDUP.format(documents="documents")
    return {
        "op1_line_dedup": f"SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ({lines})",
        "op5_warc_revisits": REVISITS,
    }
