"""The queries of this subpackage and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, gif, lm, minhash, pii, sharding, substring, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring": substring.op1_substring,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op2_lm": lm.op2_lm,
        "op3_warc": warc.op3_warc,
        "op4_sharding": sharding.op4_sharding,
        "op5_pii": pii.op5_pii,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_bpe": bpe.op7_bpe,
        "op8_minhash": minhash.op8_minhash,
        "op9_gif": gif.op9_gif,
    }


#: Bare upper-case base32 of SHA-1: each five hex digits are four characters.
_DIGIT = "(strpos('0123456789abcdef', substr(h, {}, 1)) - 1)"
_FIVE = " + ".join(f"({_DIGIT.format(f'5 * (i // 4) + {k + 1}')} << {16 - 4 * k})" for k in range(5))

_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({_FIVE}) >> (15 - 5 * (i % 4))) & 31) + 1, 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM p JOIN firsts f ON p.html = f.html"""

#: All pairs of documents that share a shingle, then the transitive closure of the links.
_NEAR = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, reach.r FROM reach JOIN both_ways e ON e.x = reach.doc_id),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept FROM documents d JOIN least l USING (doc_id) LEFT JOIN n USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """Twins of the queries that SQL can express; the others learn or keep state, and have brute-force tests."""
    return {"op3_warc": _WARC, "op8_minhash": _NEAR}
