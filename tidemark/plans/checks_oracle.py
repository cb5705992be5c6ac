"""SQL for DuckDB that gives the same rows as the queries of checks."""

from __future__ import annotations

from tidemark.plans.checks import POLICY
from tidemark.plans.oracle import BASE, PARTS, REVISIONS, SEGMENTS, WORK

ORACLE: dict[str, str] = {}

ORACLE["batch_lookup"] = f"""WITH {BASE}, a AS (SELECT DISTINCT 'session-' || (volume % 20) AS session, sequence AS batch_sequence FROM ticks)
SELECT *, CASE WHEN batch_sequence % 3 <> 0 THEN sha256('journal/' || session || '/' || batch_sequence) WHEN batch_sequence % 5 <> 0 THEN sha256('log/' || session || '/' || batch_sequence) END AS hash,
  CASE WHEN batch_sequence % 3 <> 0 THEN 'journal' WHEN batch_sequence % 5 <> 0 THEN 'log' END AS found_in FROM a"""
ORACLE["catalog_merge"] = f"""WITH {WORK}, c AS (SELECT * FROM work WHERE sequence % 4 <> 0)
SELECT w.sequence, coalesce(c.state, 'sealed') AS state, coalesce(c.attempts, 0) AS attempts, w.bytes + CASE WHEN w.sequence % 2 = 0 THEN 1 ELSE 0 END AS bytes, w.date FROM work w LEFT JOIN c USING (sequence) WHERE c.sequence IS NOT NULL OR w.sequence % 2 = 0"""
ORACLE["replay_revision_breaks"] = f"""WITH {REVISIONS}, x AS (SELECT *, (revision + 1) // 2 AS raw FROM revisions),
l AS (SELECT *, row_number() OVER w AS n, lag(revision) OVER w AS b, lag(digest) OVER w AS d, lag(raw) OVER w AS br FROM x WINDOW w AS (PARTITION BY day ORDER BY revision))
SELECT day, revision, NOT CASE WHEN n = 1 THEN revision = 1 AND previous IS NULL ELSE revision = b + 1 AND previous = d END OR coalesce(raw = br, false) AS breaks FROM l"""
ORACLE["unexpected_trash"] = f"WITH {SEGMENTS} SELECT 'segment-' || segment AS name, sha256(segment::VARCHAR) AS sha256 FROM segments WHERE segment % 4 = 1"
ORACLE["ranges_not_ascending"] = f"""WITH {BASE}, r AS (SELECT day, sequence AS start, min(ordinal) AS a, sequence + CASE WHEN sequence % 7 = 3 THEN 1 WHEN sequence % 11 = 5 THEN -1 ELSE 0 END AS fin, max(ordinal) AS b FROM ticks GROUP BY day, sequence),
l AS (SELECT *, lag(fin) OVER w AS pf, lag(b) OVER w AS pb FROM r WINDOW w AS (PARTITION BY day ORDER BY start, a, fin, b))
SELECT day, start, a AS first_ordinal, fin AS "end", b AS last_ordinal FROM l WHERE fin < start OR (fin = start AND b < a) OR coalesce(start < pf OR (start = pf AND a <= pb), false)"""
ORACLE["plannable_days"] = f"""WITH {REVISIONS}, d AS (SELECT DISTINCT day, CAST(substr(day, 9, 2) AS INTEGER) AS n FROM ticks) SELECT day FROM d WHERE n % 5 = 1 OR n % 2 = 0"""
ORACLE["ack_readiness"] = f"""WITH {BASE}, s AS (SELECT sequence AS n, count(*) * 60 AS bytes FROM ticks GROUP BY sequence)
SELECT n AS sequence, n % 13 <> 6 AND bytes + n % 3 * 700 >= {POLICY["critical"]} AND n % 17 <> 4 AND NOT (n % 7 >= {POLICY["max_pending"]} OR bytes + n % 5 * 50 >= {POLICY["max_pending_bytes"]}) AS ready FROM s"""
ORACLE["escaped_components"] = f"""WITH {BASE}, n AS (SELECT DISTINCT symbol || '/é ''' || volume || '~漢.x' AS name FROM ticks), h AS (SELECT name, hex(encode(name)) AS h FROM n)
SELECT name, array_to_string(list_transform(generate_series(0, length(h) // 2 - 1), lambda i: CASE WHEN regexp_matches(chr(('0x' || substr(h, 2 * i + 1, 2))::INTEGER), '^[A-Za-z0-9_.*''()-]$') THEN chr(('0x' || substr(h, 2 * i + 1, 2))::INTEGER) ELSE '!' || substr(h, 2 * i + 1, 2) END), '') AS component FROM h"""
ORACLE["valid_days"] = f"""WITH {BASE}, d AS (SELECT DISTINCT day FROM ticks), f AS (SELECT day, [day, substr(day, 1, 8) || '31', substr(day, 1, 5) || '02-' || substr(day, 9, 2), replace(day, '-', '/'), substr(day, 1, 9), day || ' '] AS forms FROM d),
v AS (SELECT day, generate_subscripts(forms, 1) - 1 AS form, unnest(forms) AS value FROM f)
SELECT value, form::INTEGER AS form, day, coalesce(regexp_full_match(value, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(value AS DATE) IS NOT NULL, false) AS valid FROM v"""
ORACLE["observation_rounds"] = f"WITH {PARTS} SELECT user_id, count(*) * 2 + 2 AS rounds FROM parts GROUP BY user_id"
ORACLE["affected_dates"] = f"""WITH {BASE} SELECT segment, '["' || string_agg(DISTINCT day, '","' ORDER BY day) || '"]' AS affected_dates_json FROM ticks GROUP BY segment"""
