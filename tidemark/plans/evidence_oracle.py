"""SQL for DuckDB that gives the same rows as the queries on evidence."""

from __future__ import annotations

from tidemark.functions import domains as D
from tidemark.plans import evidence as Q
from tidemark.plans.oracle import BASE, PARTS, raw, sha

ORACLE: dict[str, str] = {}

FACTS = """'{"class_":"Exact","content":"' || sha || '","manifest":"' || digest || '","nodes":' || nodes || '}'"""
REPORT = sha(raw(D.VERIFICATION), f"encode({FACTS})")
PROOF = f"""'{{"artifact_kind":"wal_segment","bytes":' || bytes || ',"content_sha256":"' || sha || '","covering_manifest_digest":"' || digest || '","covering_manifest_key":"snapshots/' || name || '-' || nodes || '.json","grace_not_before_unix_ms":' || (seen + {Q.GRACE_MS})
  || ',"limits":{{"max_manifest_nodes":{Q.LIMITS["max_manifest_nodes"]},"max_proof_bytes":{Q.LIMITS["max_proof_bytes"]},"max_proof_objects":{Q.LIMITS["max_proof_objects"]}}},"observed_wall_time_unix_ms":' || seen || ',"proof_version":"retention-proof-v1","remote_observation":{{"bytes":' || bytes
  || ',"class":"Exact","full_key":"immutable/objects/' || name || '","sha256":"' || sha || '"}},"replay_identity":null,"scope_config_hash":"' || sha256(symbol) || '","trusted_relative_path":"sealed/' || name || '","verification_report_digest":"' || {REPORT}
  || '","wal_range":{{"end_chain_root":"' || sha256('end/' || name) || '","end_sequence":' || e || ',"start_chain_root":"' || CASE WHEN s = 1 THEN repeat('0', 64) ELSE sha256('start/' || name) END || '","start_sequence":' || s || '}}}}'"""
ORACLE["retention_proofs"] = f"""WITH {BASE}, a AS (SELECT symbol, day, symbol || '/' || day AS name, count(*) * 60 AS bytes, min(capture_sequence) AS s, max(capture_sequence) AS e, CAST(substr(day, 9, 2) AS INTEGER) AS k FROM ticks GROUP BY symbol, day),
f AS (SELECT *, 1 + k % 3 AS nodes, sha256('object/' || name) AS sha, sha256(name || '/' || (1 + k % 3)) AS digest, CASE WHEN k % 11 = 5 THEN 0 ELSE (day::DATE - DATE '1970-01-01' + 1) * 86400 END AS closed,
        100 + bytes + (k % 7 = 2)::INTEGER AS two, k % 5 AS others FROM a),
x AS (SELECT *, greatest(closed * 1000, {Q.NOW_MS}) AS seen, two + 500 * nodes * (nodes + 1) AS three FROM f),
c AS (SELECT *, CASE WHEN bytes > {Q.LIMITS["max_proof_bytes"]} THEN 'Oversized' WHEN octet_length(encode(symbol)) % 8 = 0 THEN 'Different' WHEN k % 7 = 1 THEN 'Absent' WHEN two > {Q.LIMITS["max_proof_bytes"]} THEN 'Oversized' WHEN k % 7 = 2 THEN 'Different'
   WHEN k % 7 = 4 THEN 'Absent' WHEN nodes > {Q.LIMITS["max_manifest_nodes"]} OR 2 + nodes > {Q.LIMITS["max_proof_objects"]} OR three > {Q.LIMITS["max_proof_bytes"]} THEN 'Oversized' WHEN k % 7 = 3 OR k % 7 = 5 THEN 'Ambiguous'
   WHEN 2 + nodes + others > {Q.LIMITS["max_proof_objects"]} OR three + others * 50000 > {Q.LIMITS["max_proof_bytes"]} THEN 'Oversized' WHEN closed = 0 THEN 'Ambiguous' ELSE 'Exact' END AS class FROM x)
SELECT symbol, day, class, CASE WHEN class = 'Exact' THEN {sha(raw(D.PROOF), f'encode({PROOF})')} END AS proof_sha256 FROM c"""

KINDS = ("click", "error", "purchase", "view")
TOTALS = ", ".join(f"sum(CASE WHEN symbol = '{s}' THEN bid ELSE 0 END) OVER w AS bytes_{s}" for s in KINDS)
PASSED = " ".join(f"WHEN {c} > {n} THEN '{c}'" for c, n in [*((f"bytes_{s}", Q.KIND_BYTES) for s in KINDS), ("requests", Q.REQUESTS)])
ORACLE["shared_budget"] = f"""WITH {BASE}, c AS (SELECT event_id, capture_sequence, count(*) OVER w AS requests, {TOTALS} FROM ticks WINDOW w AS (ORDER BY capture_sequence)),
p AS (SELECT event_id, capture_sequence, CASE {PASSED} END AS passed FROM c), f AS (SELECT min((capture_sequence, passed)) AS first FROM p WHERE passed IS NOT NULL)
SELECT event_id, CASE WHEN capture_sequence >= first[1] THEN first[2] END AS stopped_by FROM p, f"""

ORACLE["bundle_faults"] = f"""WITH {PARTS}, g AS (SELECT user_id, part_sequence, CASE WHEN part_sequence = 0 THEN previous_row_chain_hash <> repeat('0', 64) ELSE previous_row_chain_hash <> lag(last_row_chain_hash) OVER (PARTITION BY user_id ORDER BY part_sequence) END AS breaks FROM parts),
u AS (SELECT user_id, user_id % 9 AS n, count(*) AS parts, bool_or(breaks) AS breaks FROM g GROUP BY user_id)
SELECT user_id, CASE WHEN n = 8 THEN 'raw_manifest' WHEN n = 1 THEN 'part_count' WHEN n = 3 THEN 'part_sequence' WHEN n = 4 THEN 'part_object' WHEN n = 2 THEN 'part_manifest' WHEN breaks THEN 'part_graph' WHEN n = 7 THEN 'predecessor'
  WHEN n IN (5, 6) THEN 'replay_manifest' WHEN parts > 5 THEN 'limits' END AS fault FROM u"""

ORACLE["application_status"] = f"""WITH {BASE}, s AS (SELECT sequence AS n, count(*) AS records, max(error) AS error FROM ticks GROUP BY sequence),
e AS (SELECT *, ['', 'remote_timeout', '', 'collision', '', 'unknown', '', 'permission'][n % 8 + 1] AS last_error_class FROM s)
SELECT n AS sequence, last_error_class, CASE WHEN n % 8 = 3 THEN 'failed' WHEN n % 13 = 5 OR n % 17 = 3 OR n % 19 = 7 THEN 'blocked'
  WHEN n % 5 = 1 OR n % 23 = 4 OR error <> 0 OR n % 8 IN (1, 7) OR n % 3 = 0 THEN 'degraded' ELSE 'healthy' END AS overall FROM e"""

ORACLE["supervisor_units"] = f"""WITH {BASE}, s AS (SELECT DISTINCT symbol FROM ticks)
SELECT sha256(symbol) AS scope_key, 'tick-gateway-' || left(sha256(symbol), 16) AS gateway_service_name, 'tick-mql-' || left(sha256(symbol), 16) AS mql_service_name,
  '127.0.0.1:' || (octet_length(encode(symbol)) + 9000) AS listen_address, symbol || '.toml' AS gateway_config_path, symbol || '.set' AS mql_config_path FROM s"""
