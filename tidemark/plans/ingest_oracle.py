"""SQL for DuckDB that gives the same rows as the queries on taking frames in."""

from __future__ import annotations

from tidemark.plans import events as E
from tidemark.plans import ingest as Q
from tidemark.plans.oracle import BASE
from tidemark.streaming import leases as L

ORACLE: dict[str, str] = {}

ORACLE["lease_outcomes"] = f"""WITH RECURSIVE {BASE}, e AS (SELECT symbol AS scope, capture_sequence * {Q.PACE} AS tm, (volume % {Q.CONNECTIONS} + 1)::INTEGER AS c,
  CASE WHEN capture_sequence // 7 % 4 = 0 THEN 'HELLO' WHEN capture_sequence % 11 = 5 THEN 'CLOSE' ELSE 'FRAME' END AS kind, row_number() OVER (PARTITION BY symbol ORDER BY capture_sequence) AS k FROM ticks),
r(scope, k, tm, c, kind, prior, before_active, before_until, before_holder, before_gens, before_reads, closing, outcome, generation, active, until, holder, gens, reads) AS (
  SELECT DISTINCT scope, 0::BIGINT, 0::BIGINT, 0, '', 0::BIGINT, 0::BIGINT, 0::BIGINT, 0, [0, 0, 0]::BIGINT[], [NULL, NULL, NULL]::BIGINT[], NULL::VARCHAR, '', 0::BIGINT, 0::BIGINT, 0::BIGINT, 0, [0, 0, 0]::BIGINT[], [NULL, NULL, NULL]::BIGINT[] FROM e
  UNION ALL
  SELECT scope, k, tm, c, kind, generation, a0, u0, h0, g0, r0, closing, outcome,
    generation + (outcome = 'granted')::BIGINT, CASE WHEN outcome = 'granted' THEN generation + 1 WHEN closing = 'released' OR outcome = 'released' THEN 0 ELSE a1 END,
    CASE WHEN outcome IN ('granted', 'renewed') THEN tm + {L.LEASE_S} ELSE u0 END, CASE WHEN outcome = 'granted' THEN c ELSE h0 END,
    list_transform(g0, lambda x, i: CASE WHEN i = c AND outcome = 'granted' THEN generation + 1 ELSE x END),
    list_transform(r1, lambda x, i: CASE WHEN i <> c THEN x WHEN outcome IN ('granted', 'renewed') THEN tm ELSE NULL END)
  FROM (SELECT *, CASE WHEN kind = 'HELLO' THEN CASE WHEN a1 > 0 AND closing IS DISTINCT FROM 'released' THEN 'conflict' ELSE 'granted' END WHEN r1[c] IS NULL THEN 'closed'
               WHEN kind = 'FRAME' THEN CASE WHEN g0[c] = a1 THEN 'renewed' ELSE 'lost' END WHEN g0[c] = a1 THEN 'released' ELSE 'stale' END AS outcome
        FROM (SELECT *, CASE WHEN kind = 'HELLO' AND r1[c] IS NOT NULL THEN CASE WHEN g0[c] = a1 THEN 'released' ELSE 'stale' END END AS closing
              FROM (SELECT e.*, r.generation, r.active AS a0, r.until AS u0, r.holder AS h0, r.gens AS g0, r.reads AS r0, CASE WHEN r.active > 0 AND r.until <= e.tm THEN 0 ELSE r.active END AS a1,
                           list_transform(r.reads, lambda x: CASE WHEN x + {L.IDLE_S} <= e.tm THEN NULL ELSE x END) AS r1 FROM r JOIN e ON e.scope = r.scope AND e.k = r.k + 1)))),
z AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY scope ORDER BY k DESC) = 1),
b AS (SELECT scope, tm, before_active AS active, before_until AS until, before_holder AS holder, before_gens AS gens, before_reads AS reads FROM r WHERE k > 0 UNION ALL SELECT scope, 4611686018427387904, active, until, holder, gens, reads FROM z),
o AS (SELECT scope, tm, c, CASE WHEN outcome = 'closed' THEN 0 WHEN outcome = 'granted' THEN generation WHEN outcome = 'conflict' THEN active ELSE before_gens[c] END AS generation, outcome FROM r WHERE k > 0
  UNION ALL SELECT scope, tm, c, before_gens[c], closing FROM r WHERE closing IS NOT NULL
  UNION ALL SELECT scope, until, holder, active, 'expired' FROM b WHERE active > 0 AND until <= tm
  UNION ALL SELECT scope, reads[i] + {L.IDLE_S}, i, gens[i], 'idle' FROM (SELECT *, unnest([1, 2, 3]) AS i FROM b) WHERE reads[i] + {L.IDLE_S} <= tm)
SELECT scope, tm AS "at", 'c' || (c - 1) AS connection, 's' || (c - 1) AS session, generation, outcome FROM o"""

ORACLE["journal_divergence"] = f"""WITH {BASE}, p AS (SELECT symbol AS scope, capture_sequence, (row_number() OVER (PARTITION BY symbol ORDER BY capture_sequence) - 1) // {E.BATCH} + 1 AS sequence FROM ticks),
l AS (SELECT scope, sequence, sha256(concat_ws('/', scope, sequence, count(*), max(capture_sequence))) AS h, max(sequence) OVER (PARTITION BY scope) AS most, octet_length(encode(scope)) % 3 AS fault FROM p GROUP BY scope, sequence),
j AS (SELECT scope, sequence, CASE WHEN fault = 1 AND sequence = most // 2 + 1 THEN repeat('f', 64) ELSE h END AS h FROM l WHERE fault <> 2 OR sequence * 4 <= most * 3)
SELECT scope, min(sequence) AS sequence FROM l LEFT JOIN j USING (scope, sequence) WHERE l.h IS DISTINCT FROM j.h GROUP BY scope"""
