"""SQL for DuckDB that gives the same rows as the queries on raw days."""

from __future__ import annotations

from tidemark.functions import codec as C
from tidemark.functions import domains as D
from tidemark.plans import events as E
from tidemark.plans import raw_days as Q
from tidemark.plans.oracle import BASE, PRINTS, RECORD, cat, joined, le, raw, sha, text

ORACLE: dict[str, str] = {}

ROWS = BASE + f""", r0 AS (SELECT symbol, time_msc, time, day, capture_sequence, {RECORD} AS record, row_number() OVER (PARTITION BY symbol ORDER BY capture_sequence) - 1 AS n FROM ticks),
rows AS (SELECT *, n // {E.BATCH} + 1 AS sequence, n % {E.BATCH} AS ordinal, n // {E.BATCH * Q.OBJECT} AS object, sha256(symbol || '/' || (n // {E.BATCH * Q.OBJECT})) AS object_sha256, 'objects/raw/wal-' || sha256(symbol || '/' || (n // {E.BATCH * Q.OBJECT})) || '.rtw' AS object_key,
  CASE WHEN (n // {E.BATCH} + 1) % {Q.ERRORS} = 0 THEN {E.ERROR} ELSE 0 END AS error FROM r0)"""
STEP = sha(raw(D.WAL_ENTRY), le("f.sequence", 8), "c.own", le("f.wall", 8), le("f.sequence", 8), f"unhex({sha(raw(D.BATCH), 'f.frame')})", "f.frame")
CHAIN = ROWS + f""", frames AS (SELECT symbol, sequence, max(time) AS wall, {joined('record', 'ordinal')} AS frame FROM rows GROUP BY symbol, sequence),
c(symbol, sequence, previous, own) AS (SELECT DISTINCT symbol, 0::BIGINT, unhex(''), {raw(D.ZERO)} FROM frames
  UNION ALL SELECT f.symbol, f.sequence, c.own, unhex({STEP}) FROM c JOIN frames f ON f.symbol = c.symbol AND f.sequence = c.sequence + 1),
chain AS (SELECT symbol, sequence, lower(hex(previous)) AS previous_hash, lower(hex(own)) AS entry_hash FROM c WHERE sequence > 0),
found AS (SELECT rows.* EXCLUDE (record, n), previous_hash, entry_hash FROM rows JOIN chain USING (symbol, sequence)),
segments AS (SELECT symbol, object_key, object_sha256, count(*) * 60 AS file_bytes, min(sequence) AS start_sequence, max(sequence) AS last_sequence, min_by(previous_hash, sequence) AS chain_start, max_by(entry_hash, sequence) AS chain_root FROM found GROUP BY ALL)"""
RUNS = CHAIN + """, q AS (SELECT symbol, day, object_key, sequence, ordinal, ordinal - row_number() OVER (PARTITION BY symbol, day, object_key, sequence ORDER BY ordinal) AS run FROM found),
runs AS (SELECT symbol, day, object_key, sequence, min(ordinal) AS a, max(ordinal) AS b FROM q GROUP BY symbol, day, object_key, sequence, run)"""


def config_json() -> str:
    """The digest of a symbol's configuration, its canonical text cut where the names stand."""
    text = C.canonical_json(Q.configuration("\x01")).decode()
    return sha(raw(D.CONFIG), "encode('" + text.replace("\\u0001", "' || symbol || '") + "')")


ITEM = """'{"bytes":' || file_bytes || ',"end_ingest_sequence":' || sequence || ',"first_record_ordinal":' || a || ',"key":"' || object_key || '","last_record_ordinal":' || b || ',"sha256":"' || object_sha256 || '","start_ingest_sequence":' || sequence || '}'"""
PART = """'{"bytes":' || file_bytes || ',"end_ingest_sequence":' || last_sequence || ',"key":"' || object_key || '","sha256":"' || object_sha256 || '","start_ingest_sequence":' || start_sequence || '}'"""
SCOPE = sha(raw(D.SCOPE_KEY), le("8::BIGINT", 8), "encode('provider')", le("octet_length(encode(symbol))::BIGINT", 8), "encode(symbol)")
JSON = f"""'{{"accepted_record_count":' || accepted || ',"chain_objects":[' || chain_json || '],"chain_slice_end_root":"' || end_root || '","chain_slice_end_sequence":' || last_sequence || ',"chain_slice_start_root":"' || start_root ||
  '","chain_slice_start_sequence":' || first_sequence || ',"completeness_status":"provisional","config_hash":"' || {config_json()} || '","dataset_id":"dataset-' || symbol || '","date":"' || day || '","day_definition_id":"utc-day-v1","error_count":' || errors ||
  ',"logical_close_time_s":0,"manifest_id":"raw-' || substr({SCOPE}, 1, 16) || '-' || day || '-r1","manifest_version":"raw-day-manifest-v1","objects":[' || object_json || '],"observed_through_capture_sequence":' || capture_watermark ||
  ',"observed_through_source_msc":' || source_watermark || ',"previous_manifest_sha256":null,"protocol_version":1,"publisher_epoch":1,"publisher_id":"publisher","raw_set_root":"' || raw_set_root || '","revision":1,"settle_policy":"settle","source_schema_id":"{D.SCHEMA_ID}","terminal_sync_status":"synced","wal_schema_id":"gateway-wal-v1"}}'"""
DAYS = RUNS + f""", s AS (SELECT symbol, day, count(*) AS accepted, count(DISTINCT CASE WHEN error <> 0 THEN sequence END) AS errors, max(time_msc) AS source_watermark, max(capture_sequence) AS capture_watermark, min(sequence) AS first_sequence, max(sequence) AS last_sequence,
  min_by(previous_hash, sequence) AS start_root, max_by(entry_hash, sequence) AS end_root FROM found GROUP BY symbol, day),
o AS (SELECT symbol, day, count(*) AS ranges, string_agg({ITEM}, ',' ORDER BY sequence, a) AS object_json, {sha(raw(D.RAW_SET), le('count(*)', 4), joined(cat('unhex(object_sha256)', le('file_bytes', 8), le('sequence', 8), le('sequence', 8), le('a', 4), le('b', 4)), 'sequence, a'))} AS raw_set_root
  FROM runs JOIN segments USING (symbol, object_key) GROUP BY symbol, day),
k AS (SELECT s.symbol, s.day, count(*) AS chain, string_agg({PART.replace('last_sequence', 'g.last_sequence')}, ',' ORDER BY start_sequence) AS chain_json FROM s JOIN segments g ON g.symbol = s.symbol AND g.last_sequence >= s.first_sequence AND g.start_sequence <= s.last_sequence GROUP BY ALL),
days AS (SELECT * FROM s JOIN o USING (symbol, day) JOIN k USING (symbol, day))"""
KIND = "CAST(substr(day, 9, 2) AS INTEGER) % 6"
COMPACT = CHAIN + """, p AS (SELECT *, row_number() OVER (PARTITION BY symbol, object_key ORDER BY sequence, ordinal) AS pos FROM found),
g AS (SELECT *, pos - row_number() OVER (PARTITION BY symbol, object_key, day ORDER BY sequence, ordinal) AS run FROM p),
ranges AS (SELECT symbol, day, object_key, min((sequence, ordinal)) AS a, max((sequence, ordinal)) AS b FROM g GROUP BY symbol, day, object_key, run)"""

ORACLE["entry_chain"] = f"WITH RECURSIVE {CHAIN} SELECT symbol, sequence, previous_hash, entry_hash FROM chain"
ORACLE["raw_day_manifest"] = f"""WITH RECURSIVE {DAYS} SELECT symbol, day, accepted, errors, first_sequence, start_root, last_sequence, end_root, ranges, chain, raw_set_root, {sha(raw(D.RAW_DAY), f'encode({JSON})')} AS manifest_sha256 FROM days"""
ORACLE["incremental_days"] = ORACLE["raw_day_manifest"]
ORACLE["verify_day"] = f"""WITH RECURSIVE {CHAIN}, d AS (SELECT symbol, day, {KIND} AS k FROM found GROUP BY ALL)
SELECT symbol, day, k <> 4 AS present, true AS contiguous, k <> 2 AS anchored, k NOT IN (1, 2) AS selected, k NOT IN (3, 4) AS ranges, k IN (0, 5) AS valid FROM d"""
ORACLE["segment_coverage"] = f"""WITH RECURSIVE {DAYS}, l AS (SELECT symbol, day, min((sequence, a)) AS lost FROM runs GROUP BY symbol, day),
x AS (SELECT symbol, day, object_key FROM runs JOIN l USING (symbol, day) WHERE (sequence, a) = lost)
SELECT s.symbol, s.day, g.object_key, NOT ({KIND.replace('day', 's.day')} = 3 AND x.object_key IS NOT NULL) AS covered
FROM s JOIN segments g ON g.symbol = s.symbol AND g.last_sequence >= s.first_sequence AND g.start_sequence <= s.last_sequence LEFT JOIN x ON x.symbol = s.symbol AND x.day = s.day AND x.object_key = g.object_key"""
ORACLE["verify_scope"] = f"""WITH RECURSIVE {CHAIN}, known AS (SELECT *, octet_length(encode(symbol)) % 2 = 0 AS lossy FROM chain),
roots AS (SELECT DISTINCT symbol, lossy, CASE WHEN sequence % 50 = 25 THEN repeat('e', 64) ELSE entry_hash END AS root, CASE WHEN sequence % 50 <> 25 THEN sequence END AS pos FROM known WHERE sequence = 1 OR sequence % 5 = 0)
SELECT symbol, root, true AS from_genesis, pos IS NOT NULL AND NOT (lossy AND pos > 7) AS unbroken, pos IS NOT NULL AS reached FROM roots"""
ORACLE["restore_entries"] = f"WITH RECURSIVE {CHAIN} SELECT symbol, sequence, entry_hash FROM chain WHERE sequence BETWEEN 2 AND 9"
ORACLE["compact_ranges"] = f'WITH RECURSIVE {COMPACT} SELECT symbol, day, object_key, a[1] AS start, a[2] AS first_ordinal, b[1] AS "end", b[2] AS last_ordinal FROM ranges'
ORACLE["full_day_equivalence"] = f"""WITH RECURSIVE {COMPACT}, z AS (SELECT symbol, day, object_key, a[1] AS s, a[2] + CASE WHEN CAST(substr(day, 9, 2) AS INTEGER) % 4 = 0 THEN 1 ELSE 0 END AS f, b[1] AS e, CASE WHEN CAST(substr(day, 9, 2) AS INTEGER) % 5 = 0 THEN {E.BATCH} ELSE b[2] END AS l FROM ranges),
t AS (SELECT DISTINCT p.symbol, p.sequence, p.ordinal, p.day AS own, z.day FROM p JOIN z ON z.symbol = p.symbol AND z.object_key = p.object_key AND (p.sequence, p.ordinal) >= (z.s, z.f) AND (p.sequence, p.ordinal) <= (z.e, z.l)),
m AS (SELECT symbol, day, count(*) AS n FROM found GROUP BY ALL), y AS (SELECT symbol, day, count(*) FILTER (own = day) AS hit, count(*) FILTER (own <> day) AS extra FROM t GROUP BY ALL)
SELECT symbol, day, n - coalesce(hit, 0) AS missing, coalesce(extra, 0) AS extra, n = coalesce(hit, 0) AND coalesce(extra, 0) = 0 AS equal FROM m LEFT JOIN y USING (symbol, day)"""
ORACLE["verified_replay"] = f"WITH RECURSIVE {CHAIN} SELECT symbol, day, sequence, ordinal, capture_sequence FROM found"
ORACLE["newest_cover"] = f"""WITH RECURSIVE {DAYS}, l AS (SELECT symbol, day, min((sequence, a)) AS lost FROM runs GROUP BY symbol, day),
x AS (SELECT symbol, day, object_key FROM runs JOIN l USING (symbol, day) WHERE (sequence, a) = lost AND {KIND} = 3),
h AS (SELECT s.symbol, s.day, g.object_key FROM s JOIN segments g ON g.symbol = s.symbol AND g.last_sequence >= s.first_sequence AND g.start_sequence <= s.last_sequence ANTI JOIN x ON x.symbol = s.symbol AND x.day = s.day AND x.object_key = g.object_key),
b AS (SELECT symbol, object_key, max(day) AS day FROM h GROUP BY ALL)
SELECT symbol, object_key, day, date_diff('day', DATE '1970-01-01', day::DATE) AS revision FROM segments LEFT JOIN b USING (symbol, object_key)"""
ORACLE["only_day_objects"] = f"WITH {ROWS} SELECT symbol, object_key, count(DISTINCT day) = 1 AS only FROM rows GROUP BY ALL"
ORACLE["manifest_preflight"] = f"WITH RECURSIVE {RUNS} SELECT symbol, day, count(*) AS ranges FROM runs GROUP BY ALL"
ORACLE["overlapping_slices"] = f"WITH {ROWS} SELECT symbol, object_key, min(sequence) AS first_sequence, max(sequence) AS last_sequence FROM rows GROUP BY ALL HAVING min(sequence) <= 12 AND max(sequence) >= 3"
ORACLE["segment_rotation"] = f"""WITH RECURSIVE {ROWS}, e AS (SELECT symbol AS scope, sequence, count(*) * 60 + 140 AS bytes, max(time) AS wall_s FROM rows GROUP BY ALL),
w(scope, sequence, segment, total, opened) AS (SELECT scope, sequence, 0::BIGINT, bytes::HUGEINT, wall_s FROM e WHERE sequence = 1
  UNION ALL SELECT e.scope, e.sequence, CASE WHEN w.total >= 20000 OR e.wall_s - w.opened >= 144000 THEN w.segment + 1 ELSE w.segment END, CASE WHEN w.total >= 20000 OR e.wall_s - w.opened >= 144000 THEN e.bytes ELSE w.total + e.bytes END,
    CASE WHEN w.total >= 20000 OR e.wall_s - w.opened >= 144000 THEN e.wall_s ELSE w.opened END FROM w JOIN e ON e.scope = w.scope AND e.sequence = w.sequence + 1)
SELECT scope, sequence, segment FROM w"""
ORACLE["boundary_digest"] = f"""WITH {PRINTS}, c AS (SELECT symbol, day, max(time_msc) AS cursor FROM prints GROUP BY ALL)
SELECT c.symbol, c.day, cursor, count(*) AS records, {sha(raw(D.BOUNDARY), le('cursor', 8), raw(D.ZERO), le('count(*)', 4), joined('fingerprint', 'capture_sequence'))} AS digest
FROM c JOIN prints p ON p.symbol = c.symbol AND p.day = c.day AND p.time_msc = c.cursor GROUP BY c.symbol, c.day, cursor"""
ORACLE["segment_ids"] = f"""WITH {BASE}, f AS (SELECT symbol, day, min((sequence, ordinal)) AS at_ FROM ticks GROUP BY symbol, day), g AS (SELECT symbol, day, at_[1] AS s, at_[2] AS o FROM f)
SELECT symbol, day, {sha(raw(D.SEGMENT), text("('dataset-' || symbol)"), text("'utc-day-v1'"), text('day'), text("'replay-v1'"), text("'conversion-v1'"), text("'manifests/raw-day'"), raw(E.SCOPE['raw_day_manifest_sha256']), le('s', 8), le('o', 4), text("'SEGMENT_START'"), raw(D.ZERO))} AS segment_id FROM g"""
ORACLE["late_revisions"] = f"""WITH {BASE}, a AS (SELECT day, count(*) AS n, count(*) FILTER (sequence % 10 <> 0) AS k FROM ticks GROUP BY day)
SELECT day, n AS accepted, CASE WHEN k > 0 THEN 2 ELSE 1 END AS revision, CASE WHEN k > 0 THEN sha256(day) END AS previous FROM a WHERE n <> k"""
ORACLE["watermark_regressions"] = f"""WITH {BASE}, n AS (SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY capture_sequence) - 1) // 100 AS k FROM ticks),
m AS (SELECT symbol, k, max(time_msc) AS t, max(capture_sequence) - CASE WHEN k % 3 = 2 THEN 100000 ELSE 0 END AS c, CASE WHEN k % 3 = 2 THEN greatest(k - 2, 0) ELSE k END AS r FROM n GROUP BY symbol, k),
l AS (SELECT *, lag(t) OVER w AS bt, lag(c) OVER w AS bc, lag(r) OVER w AS br FROM m WINDOW w AS (PARTITION BY symbol ORDER BY k))
SELECT symbol, k + 1 AS revision, coalesce(t < bt OR c < bc OR r < br, false) AS regression FROM l"""
ORACLE["observation_classes"] = f"""WITH {BASE}, s AS (SELECT DISTINCT sequence FROM ticks) SELECT 'object-' || sequence AS object_id, ['Exact', 'Absent', 'Different', 'Ambiguous', 'Oversized', 'Unavailable'][sequence % 6 + 1] AS class FROM s"""
ORACLE["supplied_objects"] = f"""WITH {ROWS}, o AS (SELECT DISTINCT object_key AS key, object AS n FROM rows)
SELECT key, CASE WHEN n % 5 = 4 THEN 'absent' WHEN n % 11 = 10 THEN 'twice' WHEN n % 7 = 6 THEN 'different' ELSE 'exact' END AS state FROM o"""
