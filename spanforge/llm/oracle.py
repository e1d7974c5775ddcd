"""DuckDB twins of the operator queries that SQL can express."""

from .k2_treap import ORACLE as TREAP
from .license_scan import ORACLE as LICENSE
from .merkle_manifest import ORACLE as MERKLE
from .poisson_mix import ORACLE as MIX
from .va_file import ORACLE as VA

ORACLE_SQL = {
    "op2_warc_index_merge": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
        t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM t""",
    "op6_license_scan": LICENSE,
    "op9_poisson_mix": MIX,
    "op11_merkle_manifest": MERKLE,
    "op12_va_file_search": VA,
    "op13_k2_treap_search": TREAP,
}
