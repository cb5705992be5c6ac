"""The queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bitsliced, bpe, katz, langid, lexical, line_dedup, packing, simhash, token_files, toxicity, trie, vec_dedup, warc
from tidemark.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scored(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vec_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.neighbours(table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.stored(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations")).drop("preorder", "subtree_end")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (op1_line_dedup, op2_best_fit_packing, op3_katz_backoff, op4_language_id, op5_embedding_near_dedup, op6_byte_bpe, op7_simhash_near_dedup, op8_toxicity, op9_exact_top_k, op10_warc, op11_ranked_lexical_search, op12_token_files, op13_conversation_trie)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id,
             list_sum(list_transform(list_zip(q.e, r.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id),
k AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM k WHERE rank <= 10
"""

OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM p),
g AS (SELECT *, list_transform([1, 11, 21, 31], lambda i: ('0x' || substr(h, i, 10))::BIGINT) AS parts FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(parts, lambda v: array_to_string(list_transform([35, 30, 25, 20, 15, 10, 5, 0],
         lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INTEGER + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g
"""


OP1_SQL = r"""
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
w AS (SELECT doc_id, n, line, string_split(trim(regexp_replace(lower(line), '[\t\x0b-\r ]+', ' ', 'g'), ' '), ' ') AS w FROM l),
s AS (SELECT doc_id, n, CASE WHEN w = [''] THEN NULL ELSE list_sort(list_distinct(w)) END AS s FROM w),
sets AS (SELECT s, min((doc_id, n)) AS first, row_number() OVER (ORDER BY min((doc_id, n))) AS id FROM s WHERE s IS NOT NULL GROUP BY s),
t AS (SELECT id, len(s) AS size, unnest(s) AS token FROM sets),
pairs AS (SELECT a.id AS a, b.id AS b FROM t a JOIN t b ON a.token = b.token AND b.id < a.id AND a.size * 5 >= b.size * 4 AND b.size * 5 >= a.size * 4
          GROUP BY a.id, b.id, a.size, b.size HAVING count(*) * 9 >= (a.size + b.size) * 4),
near AS (SELECT p.a AS id, min(o.first) AS other FROM pairs p JOIN sets o ON o.id = p.b GROUP BY p.a),
known AS (SELECT sets.s, least(first, coalesce(other, first)) AS earliest FROM sets LEFT JOIN near ON near.id = sets.id),
judged AS (SELECT w.doc_id, w.n, l.line, k.earliest IS NOT NULL AND (w.doc_id, w.n) > k.earliest AS gone
           FROM s w JOIN l ON l.doc_id = w.doc_id AND l.n = w.n LEFT JOIN known k ON k.s = w.s),
texts AS (SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_removed,
                 coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '') AS text FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(t.text, '')) END AS text_sha256
FROM documents d LEFT JOIN texts t USING (doc_id)
"""

OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
         AND list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) / (a.norm * b.norm) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
           FROM documents WHERE text IS NOT NULL),
k AS (SELECT row, doc_id, len(terms)::BIGINT AS n, terms FROM d WHERE len(terms) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM k),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT row, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM k) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, docs),
s AS (SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))) AS s FROM p JOIN w USING (term), c),
r AS (SELECT item_id, row, doc_id, sum(s)::BIGINT AS score FROM q JOIN s USING (term) GROUP BY item_id, row, doc_id HAVING sum(s) > 0),
o AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST))::INTEGER AS rank, doc_id, score FROM r)
SELECT * FROM o WHERE rank <= 10
"""


OP13_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS n
           FROM conversations WHERE conv_id IS NOT NULL),
b AS (SELECT DISTINCT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT) AS bytes FROM t),
c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
               lambda crc, x: list_reduce(list_prepend(xor(crc, x), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 6 AS h FROM b),
r AS (SELECT c.conv_id, 0 AS part, n, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND n < h
      UNION ALL SELECT conv_id, 1, n, role, text FROM c JOIN t USING (conv_id) WHERE n >= h),
s AS (SELECT c.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, n) FILTER (part IS NOT NULL), []) AS turns FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d, list_slice(turns, 1, d) AS path, d = len(turns) AS ends FROM (SELECT *, unnest(generate_series(0, len(turns))) AS d FROM s)),
g AS (SELECT path, d, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs,
             (count(*) - 1) * (CASE WHEN d = 0 THEN 0 ELSE length(path[d].text) END) AS saved,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY path, d),
k AS (SELECT list_slice(path, 1, d - 1) AS path, count(*)::BIGINT AS n_children FROM g WHERE d > 0 GROUP BY ALL),
f AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (path)),
u AS (SELECT list_slice(path, 1, e) AS path, sum(saved)::BIGINT AS saved_tokens, (count(*) FILTER (n_children = 0))::BIGINT AS n_leaves
      FROM (SELECT *, unnest(generate_series(0, d)) AS e FROM f) GROUP BY ALL)
SELECT f.conv_id, f.d::BIGINT AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM f JOIN u USING (path) LEFT JOIN g q ON f.d > 0 AND q.path = list_slice(f.path, 1, f.d - 1)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op5_embedding_near_dedup": OP5_SQL, "op9_exact_top_k": OP9_SQL, "op10_warc": OP10_SQL, "op11_ranked_lexical_search": OP11_SQL, "op13_conversation_trie": OP13_SQL}
