"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

OP2 = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t
"""

OP7 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
  WHERE 100 * p.both >= 75 * (m.n + n.n - p.both)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r.other) AS component_id,
       d.doc_id = min(r.other) AS kept
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
GROUP BY d.doc_id
"""

OP8 = """
WITH t AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
u AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
            ELSE page_id END AS first_id
  FROM t)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM u
"""


_FIELDS = "concat_ws('', " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    for c in ("doc_id", "source", "lang", "n_chars")) + ", CASE WHEN {text} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END)"

# the checksum of the id is folded byte by byte, eight shifts each
OP11 = r"""
WITH RECURSIVE sums AS (
  SELECT *, xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
    lambda sum, byte: list_reduce([xor(sum, byte)] || [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
      lambda x, skip: xor(x >> 1, 3988292384::UBIGINT * (x & 1::UBIGINT)))), 4294967295::UBIGINT) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, sha256(@original@) AS leaf,
         CASE WHEN crc % 2 = 0 THEN sha256(@tampered@) ELSE sha256(@original@) END AS present,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s
  FROM sums),
placed AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
own(s, level, i, digest, n) AS (
  SELECT s, 0, place, leaf, count(*) OVER (PARTITION BY s) FROM placed
  UNION ALL
  SELECT s, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (n + 2) // 3
  FROM own WHERE n > 1 GROUP BY s, level, i // 3, n),
subroots AS (SELECT s, digest FROM own WHERE n = 1),
above(level, i, digest, n) AS (
  SELECT 0, s, digest, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (n + 2) // 3
  FROM above WHERE n > 1 GROUP BY level, i // 3, n),
steps AS (
  SELECT p.s, p.place, o.level, coalesce(string_agg(o.digest, '' ORDER BY o.i) FILTER (o.i < p.place // (3 ** o.level)::BIGINT), '') AS l,
         coalesce(string_agg(o.digest, '' ORDER BY o.i) FILTER (o.i > p.place // (3 ** o.level)::BIGINT), '') AS r
  FROM placed p JOIN own o ON o.s = p.s AND o.n > 1 AND o.i // 3 = p.place // (3 ** o.level)::BIGINT // 3
  GROUP BY ALL
  UNION ALL
  SELECT p.s, p.place, 1000 + o.level, coalesce(string_agg(o.digest, '' ORDER BY o.i) FILTER (o.i < p.s // (3 ** o.level)::BIGINT), ''),
         coalesce(string_agg(o.digest, '' ORDER BY o.i) FILTER (o.i > p.s // (3 ** o.level)::BIGINT), '')
  FROM placed p JOIN above o ON o.n > 1 AND o.i // 3 = p.s // (3 ** o.level)::BIGINT // 3
  GROUP BY ALL),
proofs AS (
  SELECT s, place, list(l || '|' || r ORDER BY level) AS sides, string_agg(l || r, '' ORDER BY level) AS siblings
  FROM steps GROUP BY s, place),
ends AS (
  SELECT p.doc_id, p.leaf, u.digest AS subroot, (SELECT digest FROM above WHERE n = 1) AS root,
         sha256(coalesce(f.siblings, '')) AS proof_sha256,
         list_reduce([p.present] || coalesce(f.sides, []),
           lambda d, e: sha256(split_part(e, '|', 1) || d || split_part(e, '|', 2))) AS folded_root
  FROM placed p JOIN subroots u ON u.s = p.s LEFT JOIN proofs f ON f.s = p.s AND f.place = p.place)
SELECT *, folded_root = root AS verified FROM ends
""".replace("@original@", _FIELDS.format(text="text")).replace("@tampered@", _FIELDS.format(text="replace(text, chr(10), '')"))


def oracle() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op7_near_dedup": OP7, "op8_warc": OP8, "op11_merkle_manifest": OP11}
