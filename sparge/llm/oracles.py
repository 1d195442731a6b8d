"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from sparge.llm.collocations import COLLOCATIONS_SQL
from sparge.llm.filter_audit import AUDIT_SQL
from sparge.llm.licenses import scan_sql

OP3 = r"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

OP4 = r"""
WITH u AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                      ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (SELECT page_id, r.host || r.path AS rule, r.verdict,
                row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC, r.host || r.path) AS n
         FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
listed AS (SELECT DISTINCT host || path AS key FROM p WHERE regexp_matches(url, '^[^#]*[?&]utm_'))
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.verdict, CASE WHEN p.host || p.path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits f ON p.page_id = f.page_id AND f.n = 1
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_license_scan": scan_sql(), "op3_exact_dedup": OP3, "op4_url_filter": OP4, "op11_filter_audit": AUDIT_SQL,
        "op13_collocations": COLLOCATIONS_SQL,
    }
