"""SQL for DuckDB that gives the same rows as the driver's queries, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from tidemark.functions import domains as D
from tidemark.operators import publication
from tidemark.plans import events as E

ORACLE: dict[str, str] = {}


def le(value: str, size: int) -> str:
    """Bytes of a non-negative integer, the lowest first."""
    return "unhex(concat(" + ", ".join(f"substr(printf('%016x', {value}), {15 - 2 * k}, 2)" for k in range(size)) + "))"


def raw(data: bytes) -> str:
    return f"unhex('{data.hex()}')"


def text(value: str) -> str:
    return f"({le(f'octet_length(encode({value}))::BIGINT', 2)} || encode({value}))"


def cat(*parts: str) -> str:
    return "(" + " || ".join(parts) + ")"


def sha(*parts: str) -> str:
    return f"sha256({cat(*parts)})"


def joined(value: str, order: str) -> str:
    """Bytes of a group's rows, one after the other."""
    return f"unhex(string_agg(hex({value}), '' ORDER BY {order}))"


BASE = f"""
t0 AS (SELECT event_id, epoch_us(ts) // 1000 AS time_msc, CAST(round(value * 100) AS BIGINT) AS bid, user_id AS volume, event_type AS symbol, row_number() OVER (ORDER BY event_id) AS capture_sequence FROM events),
t1 AS (SELECT *, (capture_sequence - 1) // {E.BATCH} + 1 AS sequence FROM t0),
ticks AS (SELECT *, time_msc // 1000 AS time, strftime(make_timestamp(time_msc * 1000), '%Y-%m-%d') AS day, (capture_sequence - 1) % {E.BATCH} AS ordinal,
  CASE WHEN sequence % {E.ERRORS} = 0 THEN {E.ERROR} ELSE 0 END AS error, sha256('entry-' || sequence) AS entry_hash, sha256('entry-' || (sequence - 1)) AS previous_hash, (sequence - 1) // {E.SEGMENT} AS segment FROM t1)"""
RECORD = cat(le("time", 8), le("bid", 8), le("bid", 8), le("bid", 8), le("volume", 8), le("time_msc", 8), le("3::BIGINT", 4), le("bid", 8))
PRINTS = BASE + f", records AS (SELECT *, {RECORD} AS record FROM ticks), prints AS (SELECT *, unhex({sha(raw(D.PAYLOAD), raw(b'\x0e\x00' + D.SCHEMA_ID.encode()), 'record')}) AS fingerprint FROM records)"
RUNS = BASE + ", runs AS (SELECT day, sequence, symbol, ordinal, ordinal - row_number() OVER (PARTITION BY day, sequence ORDER BY ordinal) AS run FROM ticks)"
SEGMENTS = BASE + """, segments AS (SELECT segment, CASE WHEN segment % 9 = 8 THEN min(sequence) + 1 ELSE min(sequence) END AS first_sequence, max(sequence) AS last_sequence, count(*) AS records FROM ticks GROUP BY segment),
linked AS (SELECT *, sha256('entry-' || (first_sequence - 1)) AS chain_start, sha256('entry-' || last_sequence) AS chain_root FROM segments)"""
REVISIONS = BASE + """, h AS (SELECT day, capture_sequence // 100 AS h, count(*) AS records, max(time_msc) AS source_watermark FROM ticks GROUP BY ALL),
r AS (SELECT day, records, source_watermark, row_number() OVER (PARTITION BY day ORDER BY h) AS revision FROM h),
revisions AS (SELECT *, sha256(day || '/' || revision) AS digest, CASE WHEN revision > 1 THEN sha256(day || '/' || (revision - 1)) END AS previous FROM r WHERE NOT (CAST(substr(day, 9, 2) AS INTEGER) % 5 = 0 AND revision = 3))"""
PARTS = BASE + """, n AS (SELECT *, row_number() OVER (PARTITION BY volume ORDER BY capture_sequence) - 1 AS n FROM ticks),
p0 AS (SELECT volume AS user_id, n // 20 AS part_sequence, min(n) AS first_stream_sequence, max(n) AS last_stream_sequence, count(*) AS row_count FROM n GROUP BY ALL),
p1 AS (SELECT *, 'part-' || user_id || '-' || part_sequence AS name FROM p0),
p2 AS (SELECT *, sha256(name) AS digest, sha256(name || '-end') AS last_row_chain_hash, 'manifests/part-' || lpad(part_sequence::VARCHAR, 8, '0') || '-' || sha256(name) || '.json' AS key FROM p1),
parts AS (SELECT *, CASE WHEN user_id % 7 = 0 AND part_sequence = 1 THEN repeat('f', 64) ELSE coalesce(lag(last_row_chain_hash) OVER (PARTITION BY user_id ORDER BY part_sequence), repeat('0', 64)) END AS previous_row_chain_hash FROM p2)"""
WORK = BASE + """, w0 AS (SELECT sequence, min(day) AS date, count(*) AS bytes, max(time) AS updated FROM ticks GROUP BY sequence),
work AS (SELECT *, ['sealed', 'spooled', 'retry_wait', 'published', 'uploading'][sequence % 5 + 1] AS state, sequence % 6 AS attempts, CASE WHEN sequence % 4 = 0 THEN 0 ELSE sequence * 10 END AS next_retry FROM w0)"""
CANDIDATES = SEGMENTS + """, candidates AS (SELECT 'artifact-' || left(sha256(segment::VARCHAR), 12) AS artifact_id, CASE WHEN segment % 10 = 9 THEN 'replay_outbox' ELSE 'wal' END AS kind, first_sequence, last_sequence,
  CASE WHEN segment = 8 THEN 'active_artifact' WHEN segment % 10 = 9 THEN 'artifact_policy_unimplemented' WHEN segment % 11 = 7 THEN 'fresh_observation_missing' WHEN segment % 6 = 5 THEN 'remote_verified_missing'
    WHEN segment % 13 = 12 THEN 'retention_proof_missing' WHEN segment = 4 THEN 'grace_not_elapsed' END AS reason FROM linked)"""
USERS = BASE + ", un AS (SELECT *, row_number() OVER (PARTITION BY volume ORDER BY capture_sequence) AS n FROM ticks), batches AS (SELECT 'session-' || volume AS session, n + n // 10 AS batch_sequence, capture_sequence AS sequence, event_id FROM un)"

ORACLE["day_selection"] = f"""WITH {BASE} SELECT day, count(*) AS accepted, count(DISTINCT CASE WHEN error <> 0 THEN sequence END) AS errors, max(time_msc) AS source_watermark, max(capture_sequence) AS capture_watermark,
  min(sequence) AS first_sequence, max(sequence) AS last_sequence, min_by(previous_hash, sequence) AS start_root, max_by(entry_hash, sequence) AS end_root FROM ticks GROUP BY day"""
ORACLE["selected_ranges"] = f"""WITH {BASE}, v AS (SELECT symbol, day, sequence, ordinal, ordinal - row_number() OVER (PARTITION BY symbol, day, sequence ORDER BY ordinal) AS run FROM ticks)
SELECT symbol, day, sequence, min(ordinal) AS first_ordinal, max(ordinal) AS last_ordinal FROM v GROUP BY symbol, day, sequence, run"""
ORACLE["selected_ranges_by_symbol"] = f"""WITH {BASE}, v AS (SELECT symbol, day, sequence, ordinal, ordinal - row_number() OVER (PARTITION BY symbol, day, sequence ORDER BY ordinal) AS run FROM ticks)
SELECT symbol, day, sequence, min(ordinal) AS first_ordinal, max(ordinal) AS last_ordinal FROM v GROUP BY symbol, day, sequence, run"""
ORACLE["payload_fingerprint"] = f"WITH {PRINTS} SELECT event_id, lower(hex(fingerprint)) AS fingerprint FROM prints"
ORACLE["observation_hash"] = f"WITH {PRINTS} SELECT event_id, {sha(raw(D.OBSERVATION), text("'producer'"), text("('session-' || volume)"), le('sequence', 8), le('ordinal', 4), le('capture_sequence', 8), 'fingerprint')} AS observation FROM prints"
ORACLE["batch_sha256"] = f"WITH {PRINTS} SELECT sequence, {sha(raw(D.BATCH), joined('record', 'ordinal'))} AS batch_sha256 FROM prints GROUP BY sequence"
ORACLE["row_chain_root"] = f"""WITH RECURSIVE {PRINTS}, c AS (SELECT volume AS user_id, record, row_number() OVER (PARTITION BY volume ORDER BY capture_sequence) - 1 AS n FROM prints),
f(user_id, n, h) AS (SELECT user_id, 0::BIGINT, unhex({sha(raw(D.ROW_CHAIN), le('0::BIGINT', 8), raw(D.ZERO), le('octet_length(record)::BIGINT', 4), 'record')}) FROM c WHERE n = 0
  UNION ALL SELECT c.user_id, c.n, unhex({sha(raw(D.ROW_CHAIN), le('c.n', 8), 'f.h', le('octet_length(c.record)::BIGINT', 4), 'c.record')}) FROM f JOIN c ON c.user_id = f.user_id AND c.n = f.n + 1)
SELECT user_id, max(n) + 1 AS rows, lower(hex(max_by(h, n))) AS root FROM f GROUP BY user_id"""
ORACLE["raw_set_root"] = f"""WITH {RUNS}, g AS (SELECT day, sequence, min(ordinal) AS a, max(ordinal) AS b FROM runs GROUP BY day, sequence, run)
SELECT day, {sha(raw(D.RAW_SET), le('count(*)', 4), joined(cat("unhex(sha256('object-' || ((sequence - 1) // " + str(E.SEGMENT) + ")))", le('sequence * 100', 8), le('sequence', 8), le('sequence', 8), le('a', 4), le('b', 4)), 'sequence, a'))} AS raw_set_root FROM g GROUP BY day"""
ORACLE["part_set_root"] = f"WITH {PARTS} SELECT user_id, {sha(raw(D.PART_SET), le('count(*)', 4), joined(cat(le('octet_length(encode(key))::BIGINT', 4), 'encode(key)', 'unhex(digest)', le('first_stream_sequence', 8), le('last_stream_sequence', 8)), 'part_sequence'))} AS part_set_root FROM parts GROUP BY user_id"
ORACLE["part_graph"] = f"""WITH {PARTS} SELECT user_id, part_sequence, CASE WHEN part_sequence = 0 THEN previous_row_chain_hash <> repeat('0', 64) ELSE previous_row_chain_hash <> lag(last_row_chain_hash) OVER (PARTITION BY user_id ORDER BY part_sequence) END AS breaks FROM parts"""
ORACLE["ordered_part_keys"] = f"WITH {PARTS} SELECT key, user_id, part_sequence::INTEGER AS part, row_count FROM parts"
ORACLE["affected_days"] = f"WITH {BASE} SELECT segment, string_agg(DISTINCT day, ',' ORDER BY day) AS days FROM ticks GROUP BY segment"
ORACLE["segment_contiguity"] = f"""WITH {SEGMENTS} SELECT segment, first_sequence, last_sequence, coalesce(first_sequence <> lag(last_sequence) OVER w + 1 OR chain_start <> lag(chain_root) OVER w, false) AS breaks FROM linked WINDOW w AS (ORDER BY first_sequence)"""
ORACLE["interval_overlap_segments"] = f"WITH {SEGMENTS} SELECT segment, first_sequence, last_sequence FROM segments WHERE last_sequence >= 20 AND first_sequence <= 75"
ORACLE["revision_gap_check"] = f"""WITH {REVISIONS}, l AS (SELECT *, lag(revision) OVER w AS b, lag(digest) OVER w AS d FROM revisions WINDOW w AS (PARTITION BY day ORDER BY revision))
SELECT day, revision, CASE WHEN b IS NULL THEN revision <> 1 OR previous IS NOT NULL ELSE revision <> b + 1 OR previous IS DISTINCT FROM d END AS breaks FROM l"""
ORACLE["latest_revision"] = f"WITH {REVISIONS} SELECT day, revision, records, digest FROM revisions QUALIFY revision = max(revision) OVER (PARTITION BY day)"
ORACLE["batch_gap_markers"] = f"WITH {USERS}, l AS (SELECT *, lag(batch_sequence) OVER (PARTITION BY session ORDER BY sequence) + 1 AS expected FROM batches) SELECT session, batch_sequence, expected FROM l WHERE batch_sequence <> expected"
ORACLE["timestamp_regressions"] = f"""WITH {BASE}, b AS (SELECT symbol, sequence, min(time_msc) - CASE WHEN sequence % 15 = 0 THEN 172800000 ELSE 0 END AS first_msc, max(time_msc) - CASE WHEN sequence % 10 = 0 THEN 86400000 ELSE 0 END AS last_msc FROM ticks GROUP BY symbol, sequence),
l AS (SELECT *, lag(last_msc) OVER (PARTITION BY symbol ORDER BY sequence) AS previous_last FROM b) SELECT symbol, sequence, first_msc, previous_last FROM l WHERE first_msc < previous_last"""
ORACLE["last_batch_per_session"] = f"WITH {USERS} SELECT session, max(batch_sequence) AS batch_sequence, max_by(event_id, batch_sequence) AS event_id FROM batches GROUP BY session"
ORACLE["duplicate_or_conflict"] = f"""WITH {BASE} SELECT 'session-' || volume AS session, capture_sequence AS batch_sequence, capture_sequence AS arrival, 'ACCEPTED' AS status FROM ticks
UNION ALL SELECT 'session-' || volume, capture_sequence, capture_sequence + 1000000, CASE WHEN capture_sequence % 15 = 0 THEN 'SOURCE_STATE_CONFLICT' ELSE 'DUPLICATE' END FROM ticks WHERE capture_sequence % 5 = 0"""
ORACLE["boundary_records"] = f"""WITH {BASE}, c AS (SELECT symbol, day, max(time) AS cursor FROM ticks GROUP BY ALL)
SELECT c.symbol, c.day, c.cursor, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS records FROM c JOIN ticks t ON t.symbol = c.symbol AND t.day = c.day AND t.time = c.cursor GROUP BY ALL"""
ORACLE["range_join_selection"] = f"""WITH {BASE}, g AS (SELECT segment, min(sequence) + 2 AS s, min(sequence) + 9 AS e FROM ticks GROUP BY segment)
SELECT event_id, sequence, ordinal FROM ticks JOIN g USING (segment) WHERE (sequence, ordinal) >= (s, 10) AND (sequence, ordinal) <= (e, 20)"""
ORACLE["exactly_one_binding"] = f"""WITH {SEGMENTS}, q AS (SELECT segment, day, sequence, ordinal, ordinal - row_number() OVER (PARTITION BY segment, day, sequence ORDER BY ordinal) AS run FROM ticks),
g AS (SELECT segment, day, sequence, min(ordinal) AS a FROM q GROUP BY segment, day, sequence, run)
SELECT day || '/' || sequence || '/' || a AS id, count(*) FILTER (sequence BETWEEN first_sequence AND last_sequence) AS matches FROM g JOIN linked USING (segment) GROUP BY ALL"""
ORACLE["journal_differences"] = f"""WITH {BASE}, b AS (SELECT sequence, count(*) AS n FROM ticks GROUP BY sequence)
SELECT sequence, CASE WHEN sequence % 19 = 0 THEN 'journal_only' WHEN sequence % 13 = 0 THEN 'log_only' ELSE 'differs' END AS difference FROM b
WHERE (sequence % 19 = 0 AND sequence % 13 <> 0) OR (sequence % 13 = 0 AND sequence % 19 <> 0) OR (sequence % 17 = 0 AND sequence % 13 <> 0 AND sequence % 19 <> 0)"""
ORACLE["raw_binding"] = f"""WITH {REVISIONS}, l AS (SELECT day, max(revision) AS m FROM revisions GROUP BY day) SELECT day, revision AS replay_revision, revision = m AS bound FROM revisions JOIN l USING (day)"""
ORACLE["raw_binding_all"] = ORACLE["raw_binding"]
ORACLE["scope_collisions"] = f"""WITH {BASE}, u AS (SELECT DISTINCT volume AS u FROM ticks),
s AS (SELECT 'scope-' || u AS scope, CASE WHEN u % 40 = 0 THEN 0 ELSE u END AS k, CASE WHEN u % 50 = 3 THEN 3 ELSE u END AS p, '/data/' || CASE WHEN u % 60 = 7 THEN '5/' || u WHEN u % 60 = 8 THEN '6/' || u ELSE u::VARCHAR END AS d,
  u // 6 AS port, CASE WHEN u % 36 = 5 OR u % 72 = 17 THEN '*' WHEN u % 6 < 3 THEN '127.0.0.1' WHEN u % 6 < 5 THEN '::1' ELSE 'host-' || u END AS host FROM u)
SELECT a.scope AS left, b.scope AS right, 'scope_key' AS shared FROM s a JOIN s b ON a.k = b.k AND a.scope < b.scope
UNION ALL SELECT a.scope, b.scope, 'publisher_id' FROM s a JOIN s b ON a.p = b.p AND a.scope < b.scope
UNION ALL SELECT a.scope, b.scope, 'listener' FROM s a JOIN s b ON a.port = b.port AND a.scope < b.scope AND (a.host = b.host OR a.host = '*' OR b.host = '*')
UNION ALL SELECT a.scope, b.scope, 'path' FROM s a JOIN s b ON a.scope < b.scope AND (starts_with(a.d || '/', b.d || '/') OR starts_with(b.d || '/', a.d || '/'))"""
ORACLE["pending_stats"] = f"""WITH {WORK} SELECT count(*) AS pending, sum(CASE WHEN sequence % 2 = 0 THEN bytes ELSE 0 END)::BIGINT AS bytes, sum(attempts)::BIGINT AS attempts, min(CASE WHEN sequence <> 1 THEN updated END) AS oldest FROM work WHERE state <> 'published'"""
ORACLE["due_manifests"] = f"WITH {WORK} SELECT sequence, date, state FROM work WHERE state IN ('spooled', 'retry_wait') AND (next_retry = 0 OR next_retry <= 700)"
ORACLE["retry_delay"] = f"WITH {WORK} SELECT sequence, least(60, 5 * (1 << greatest(attempts - 1, 0)))::BIGINT AS delay_s FROM work"
ORACLE["prune_eligibility"] = f"WITH {CANDIDATES} SELECT artifact_id, reason FROM candidates"
ORACLE["prune_plan"] = f"""WITH {CANDIDATES}, w AS (SELECT *, first_sequence <> coalesce(lag(last_sequence) OVER (ORDER BY first_sequence) + 1, 1) AS gap FROM candidates WHERE kind = 'wal'),
x AS (SELECT *, coalesce(bool_or(gap OR reason IS NOT NULL) OVER (ORDER BY first_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM w),
y AS (SELECT artifact_id, first_sequence, CASE WHEN late THEN 'wal_prefix_blocked' WHEN gap THEN 'wal_prefix_gap' ELSE reason END AS reason FROM x UNION ALL SELECT artifact_id, first_sequence, reason FROM candidates WHERE kind <> 'wal'),
z AS (SELECT artifact_id, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason IS NULL ORDER BY artifact_id) > 3 THEN 'max_prune_candidates' ELSE reason END AS reason FROM y)
SELECT artifact_id, CASE WHEN reason IS NULL THEN 'prune' ELSE 'blocked' END AS action, reason FROM z"""
ORACLE["budget_first_exceed"] = f"""WITH {BASE}, c AS (SELECT symbol, event_id, bid, sum(bid) OVER (PARTITION BY symbol ORDER BY event_id)::BIGINT AS total FROM ticks) SELECT symbol, event_id, total FROM c WHERE total > 1000000 AND total - bid <= 1000000"""
ORACLE["list_datasets"] = f"WITH {BASE} SELECT DISTINCT 'dataset-' || symbol AS dataset_id FROM ticks"
ORACLE["list_scopes"] = f"""WITH {BASE}, s AS (SELECT DISTINCT 'provider-' || (volume % 3) AS provider_id, symbol FROM ticks)
SELECT provider_id, symbol, {sha(raw(D.SCOPE_KEY), le('octet_length(encode(provider_id))::BIGINT', 8), 'encode(provider_id)', le('octet_length(encode(symbol))::BIGINT', 8), 'encode(symbol)')} AS scope_key FROM s"""
ORACLE["list_raw_snapshots"] = f"WITH {REVISIONS} SELECT day, revision, digest FROM revisions"
ORACLE["overall_status"] = f"""WITH {BASE}, s AS (SELECT DISTINCT sequence AS scope FROM ticks), x AS (SELECT scope, list_transform([1, 7, 49], lambda k: ['healthy', 'healthy', 'degraded', 'healthy', 'blocked', 'healthy', 'failed'][(scope // k) % 7 + 1]) AS states FROM s)
SELECT scope, CASE WHEN list_contains(states, 'failed') THEN 'failed' WHEN list_contains(states, 'blocked') THEN 'blocked' WHEN list_contains(states, 'degraded') THEN 'degraded' ELSE 'healthy' END AS status FROM x"""
ORACLE["disk_class"] = f"WITH {BASE} SELECT event_id, CASE WHEN bid % 700 >= 500 THEN 'normal' WHEN bid % 700 >= 250 THEN 'high' WHEN bid % 700 >= 100 THEN 'critical' ELSE 'emergency' END AS disk_class FROM ticks"
ORACLE["object_keys"] = f"""WITH {REVISIONS} SELECT day, revision, 'objects/raw/wal-' || digest || '.rtw' AS raw_key,
  'derivatives/stream=' || sha256('replay-v1') || '/format={D.FORMAT_ID}/conversion=' || sha256('conversion-v1') || '/day-definition=' || sha256('utc-day-v1') || '/date=' || day || '/replay-day-' || revision || '-' || digest || '.json' AS replay_key,
  'lease-' || substr({sha(raw(D.LEASE), raw(b'\0'), "encode('producer')", raw(b'\0'), 'encode(day)', raw(b'\0'), "encode('feed')")}, 1, 32) AS lease FROM revisions"""


def _decisions() -> str:
    """The barriers one after the other, over the class that a publication's number gives to some of its objects."""
    from zlib import crc32

    ids = {b: [f"{b}-1", *(["parquet-2"] if b == "parquet" else [])] for b, _, _ in publication.BARRIERS}
    steps = ["WHEN p % 50 = 1 THEN 'IntegrityStop:bundle_digest_mismatch:'", "WHEN p % 50 = 2 THEN 'ResourceStop:observation_budget_exhausted:'"]
    for name, must, many in publication.BARRIERS:
        places = {i: crc32(i.encode()) % 9 for i in ids[name]}
        hit = f"p % 10 IN ({', '.join(str(x) for x in sorted(set(places.values())))})"
        absent = "'IntegrityStop:" + name + "_absent:'" if must else "'Execute:" + name + "_upload:' || concat_ws(','," + ", ".join(f"CASE WHEN p % 10 = {x} THEN '{i}' END" for i, x in sorted(places.items())) + ")"
        spelled = {k: f"{name}_{k}" for k in D.OBSERVED} if many else {"Unavailable": f"{name}_unavailable", "Oversized": f"{name}_oversized", "Different": f"{name}_not_exact", "Ambiguous": f"{name}_not_exact"}
        decision = {"Unavailable": "Retry", "Oversized": "ResourceStop", "Different": "IntegrityStop", "Ambiguous": "IntegrityStop"}
        steps.append(f"WHEN {hit} AND k = 'Absent' THEN {absent}")
        steps += [f"WHEN {hit} AND k = '{c}' THEN '{d}:{spelled[c]}:'" for c, d in decision.items()]
    steps.append("WHEN p % 50 = 3 THEN 'IntegrityStop:final_observation_incomplete:'")
    return f"""WITH {BASE}, s AS (SELECT DISTINCT sequence AS p FROM ticks), c AS (SELECT p, ['Absent', 'Unavailable', 'Different', 'Ambiguous', 'Oversized'][(p // 10) % 5 + 1] AS k FROM s),
d AS (SELECT p, string_split(CASE {' '.join(steps)} ELSE 'ReadyForReceipt:complete:' END, ':') AS x FROM c) SELECT p AS publication, x[1] AS decision, x[2] AS reason, nullif(x[3], '') AS actions FROM d"""


ORACLE["reconcile_decision"] = _decisions()
ORACLE["canonical_json"] = f"""WITH {REVISIONS} SELECT day, revision, '{{"date":"' || day || '","revision":' || revision || ',"sha256":"' || digest || '"}}' AS json FROM revisions"""
#: CRC-32 of an ASCII string, bit by bit.
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"
ORACLE["orphan_missing_objects"] = f"""WITH {BASE}, o AS (SELECT DISTINCT symbol, 'object-' || event_id AS object_id FROM ticks), h AS (SELECT *, {CRC.format('object_id')} AS h FROM o)
SELECT symbol, object_id, CASE WHEN h % 7 = 0 THEN 'orphan' WHEN h % 5 = 0 THEN 'missing' ELSE 'duplicate' END AS kind FROM h WHERE (h % 7 = 0 AND h % 5 <> 0) OR (h % 7 <> 0 AND h % 5 = 0) OR (h % 7 <> 0 AND h % 5 <> 0 AND h % 11 = 0)"""
