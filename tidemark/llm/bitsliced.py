"""Exact top-k inner products by a bit-sliced index.

Components become integers floor(scale * x). The index of a block of rows keeps, per component, the
bitmaps of its top bits. For a query the slices, shifted by each set bit of the query's component, are
added with bitmap arithmetic; the sums are bounds of the scores. The threshold of the top k is found
from the most significant slice down, and the rows that the bounds leave open are scored exactly.

Vectors that are null, hold a null or non-finite component or one that is no long after scaling take no
part, nor do rows without an id. Scores are exact at any size; one among the results that is no long is
an error. Vectors of different lengths are padded with zeros, an empty vector scores 0; a very long one
makes its block as wide. Ties go to the smaller id. Rows that repeat an id are candidates each, but
never of a query with that id; queries that repeat an id are one query, with the smallest of their
vectors. No queries or no rows give an empty result. Only vec_id and embedding are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, written

#: Rows of a block of the index, queries of a block, blocks of queries that are sent to all tasks at a time, bits that the index keeps of a component, queries that are added at a time.
ROWS, QUERIES, SENT, BITS, LANES = 8192, 1024, 32, 6, 128
LEAST, BEYOND = -(2.0**63), 2.0**63
#: Where the sum of all products of a query may exceed this, components are multiplied in parts of LIMB bits.
SAFE, LIMB = 2.0**62, 22
RESULT = "query_id long, vec_id long, score long"


def matrix(rows: pa.Table, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer components, one row a vector."""
    lists = rows["embedding"].combine_chunks()
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    at = np.arange(out.shape[1])[None, :] < sizes[:, None]
    out[at] = np.floor(scale * values[offsets[0] : offsets[-1]]).astype(np.int64)
    return rows["vec_id"].to_numpy().astype(np.int64), out


def slices_of(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """slices[d, b, word]: bit b of (values[:, d] - low[d]) >> shift[d]."""
    low = values.min(axis=0)
    over = values.view(np.uint64) - low.view(np.uint64)  # up to 2**64 - 1
    shift = np.array([max(0, int(x).bit_length() - bits) for x in over.max(axis=0)], np.int64)
    top = over >> shift.astype(np.uint64)
    words = -(-len(values) // 64)
    packed = np.zeros((values.shape[1], bits, words * 8), np.uint8)
    for b in range(bits):
        part = np.packbits((top >> b & 1).astype(np.uint8), axis=0, bitorder="little").T
        packed[:, b, : part.shape[1]] = part
    return packed.view(np.uint64), low, shift


def add(total: list[np.ndarray], part: list[np.ndarray], at: int) -> None:
    """total += part << at, both lists of slices from the least significant; total must be long enough."""
    carry = None
    for k in range(at, len(total)):
        a = total[k]
        b = part[k - at] if k - at < len(part) else None
        if b is None:
            if carry is None or not carry.any():
                return
            total[k], carry = a ^ carry, a & carry
        elif carry is None:
            total[k], carry = a ^ b, a & b
        else:
            either = a ^ b
            total[k], carry = either ^ carry, (a & b) | (either & carry)


def products(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products as Python integers."""
    parts = lambda x: (x & (1 << LIMB) - 1, x >> LIMB & (1 << LIMB) - 1, x >> 2 * LIMB)
    out = np.zeros(len(values), object)
    for i, a in enumerate(parts(values)):
        for j, b in enumerate(parts(query)):
            out += (a @ b).astype(object) * (1 << LIMB * (i + j))
    return out


def best_rows(slices: np.ndarray, low: np.ndarray, shift: np.ndarray, values: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its id and the ids and exact scores of at least its k best rows of the block."""
    dims = max(values.shape[1], queries.shape[1])
    bits, words = slices.shape[1], slices.shape[2]
    valid = np.zeros(words * 64, np.uint8)
    valid[: len(ids)] = 1
    ones = ~np.uint64(0)
    largest = np.maximum(values.max(axis=0).astype(float), -values.min(axis=0).astype(float))
    for first in range(0, len(queries), LANES):
        q = queries[first : first + LANES]
        size = np.abs(q).view(np.uint64)
        wide = int(size.max(initial=0)).bit_length()
        sign = np.where(q < 0, ones, np.uint64(0))
        n = len(q)
        total = [np.zeros((n, words), np.uint64) for _ in range(int(shift.max(initial=0)) + bits + wide + dims.bit_length())]
        for level in sorted(set(shift.tolist())):
            own = np.flatnonzero(shift[: q.shape[1]] == level)
            for b in range(wide):
                part = [np.zeros((n, words), np.uint64) for _ in range(bits + len(own).bit_length())]
                for d in own:
                    on = (size[:, d] >> b & 1).astype(bool)
                    if on.any():
                        mask, turn = np.where(on, ones, np.uint64(0))[:, None], sign[:, d][:, None]
                        add(part, [(slices[d, s] ^ turn) & mask for s in range(bits)], 0)
                add(total, part, level + b)
        # A turned component counts the bits that are missing. What the index cut off is 0 to 2**shift - 1 of a component.
        open_by = size[:, : len(shift)].astype(object) @ ((1 << shift[: q.shape[1]]) - 1).astype(object) if len(shift) else np.zeros(n, object)
        able = np.tile(np.packbits(valid, bitorder="little").view(np.uint64), (n, 1))
        for i, query in enumerate(query_ids[first : first + LANES]):
            for row in np.flatnonzero(ids == query):
                able[i, row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
        more, equal, threshold = np.zeros((n, words), np.uint64), able.copy(), np.zeros(n, object)
        for s in range(len(total) - 1, -1, -1):  # the k-th largest sum, from the most significant slice down
            with_bit = more | (equal & total[s])
            many = np.bitwise_count(with_bit).sum(axis=1) >= k
            equal = np.where(many[:, None], equal & total[s], equal & ~total[s])
            more = np.where(many[:, None], more, with_bit)
            threshold += many.astype(object) * (1 << s)
        least = [max(0, int(t) - int(w)) for t, w in zip(threshold, open_by, strict=True)]
        above, same = np.zeros((n, words), np.uint64), able
        for s in range(len(total) - 1, -1, -1):  # the rows whose sum is at least the threshold less what is open
            bit = np.array([t >> s & 1 for t in least], bool)[:, None]
            above = np.where(bit, above, above | (same & total[s]))
            same = np.where(bit, same & total[s], same & ~total[s])
        above |= same
        for i, query in enumerate(query_ids[first : first + LANES]):
            rows = np.flatnonzero(np.unpackbits(above[i].view(np.uint8), bitorder="little"))
            wide_q = np.zeros(values.shape[1], np.int64)
            both = min(values.shape[1], q.shape[1])
            wide_q[:both] = q[i, :both]
            safe = largest @ np.abs(wide_q.astype(float)) < SAFE
            yield int(query), ids[rows], values[rows] @ wide_q if safe else products(values[rows], wide_q)


def narrow(values: np.ndarray) -> np.ndarray:
    """values in four bytes each if they fit."""
    info = np.iinfo(np.int32)
    return values.astype(np.int32) if info.min <= values.min(initial=0) and values.max(initial=0) <= info.max else values


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids and scores of the k best rows, and which scores are below any long. One above any long would be among the results for sure."""
    if scores.dtype != object:
        top = np.lexsort((ids, -scores))[:k]
        return ids[top], scores[top], np.zeros(len(top), bool)
    top = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    if len(top) and scores[top[0]] >= 2**63:
        raise OverflowError(f"score {scores[top[0]]} of row {ids[top[0]]} is no long")
    under = np.array([scores[i] < -(2**63) for i in top], bool)
    return ids[top], np.array([0 if u else scores[i] for i, u in zip(top, under, strict=True)], np.int64), under


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0) -> DataFrame:
    """query_id, rank, vec_id and score: the k rows of vectors with the largest integer inner products with each query.

    vectors and queries have vec_id and embedding. The blocks of the index are written once and stay where
    they are; the queries, which are few, come to them: SENT blocks at a time, a bounded broadcast, in as
    many rounds as that takes. Each block of rows sends k rows a query at most to the final ranking.
    """
    real = "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND x * {0}D >= {1}D AND x * {0}D < {2}D)".format(scale, LEAST, BEYOND)
    vectors, queries = (x.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(real) for x in (vectors, queries))
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    row_blocks, query_blocks = (max(1, -(-x.count() // size)) for x, size in ((vectors, ROWS), (queries, QUERIES)))

    def index(rows: pa.Table) -> pa.Table:
        ids, values = matrix(rows, scale)
        slices, low, shift = slices_of(values, BITS)
        data = narrow(values)
        return pa.table({"rb": rows["block"][:1], "ids": [ids.tobytes()], "data": [data.tobytes()], "slices": [slices.tobytes()], "low": [low.tobytes()], "shift": [shift.tobytes()], "kind": [data.dtype.str]}, schema=pa.schema([("rb", pa.int64()), *((c, pa.binary()) for c in ("ids", "data", "slices", "low", "shift")), ("kind", pa.string())]))

    def ask(rows: pa.Table) -> pa.Table:
        ids, values = matrix(rows, scale)
        data = narrow(values)
        return pa.table({"qb": rows["block"][:1], "query_ids": [ids.tobytes()], "queries": [data.tobytes()], "query_kind": [data.dtype.str]}, schema=pa.schema([("qb", pa.int64()), ("query_ids", pa.binary()), ("queries", pa.binary()), ("query_kind", pa.string())]))

    def blocks(x: DataFrame, n: int) -> DataFrame:
        return x.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(n))).groupBy("block")

    indexed = written(blocks(vectors, row_blocks).applyInArrow(index, "rb long, ids binary, data binary, slices binary, low binary, shift binary, kind string"), "index")
    asked = written(blocks(queries, query_blocks).applyInArrow(ask, "qb long, query_ids binary, queries binary, query_kind string"), "queries")

    def search(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                ids, low, shift = (np.frombuffer(x[c], np.int64) for c in ("ids", "low", "shift"))
                values = np.frombuffer(x["data"], x["kind"]).reshape(len(ids), -1).astype(np.int64)
                slices = np.frombuffer(x["slices"], np.uint64).reshape(values.shape[1], BITS, -1) if values.shape[1] else np.zeros((0, BITS, -(-len(ids) // 64)), np.uint64)
                dims = values.shape[1]
                out: list[list[np.ndarray]] = [[], [], [], []]
                for own_ids, own, kind in sent.value:
                    query_ids = np.frombuffer(own_ids, np.int64)
                    wanted = np.frombuffer(own, kind).reshape(len(query_ids), -1).astype(np.int64)
                    wanted = wanted[:, :dims] if wanted.shape[1] >= dims else np.pad(wanted, ((0, 0), (0, dims - wanted.shape[1])))
                    for query, found, score in best_rows(slices, low, shift, values, ids, wanted, query_ids, k):
                        rows = best(found, score, k)
                        for column, part in zip(out, (np.full(len(rows[0]), query), *rows), strict=True):
                            column.append(part)
                if out[0]:
                    query_id, vec_id, score, under = (np.concatenate(c) for c in out)
                    yield pa.RecordBatch.from_arrays([pa.array(query_id.astype(np.int64)), pa.array(vec_id), pa.array(score, mask=under)], names=["query_id", "vec_id", "score"])

    spark = vectors.sparkSession
    rounds = []
    for first in range(0, query_blocks, SENT):
        own = [(bytes(r["query_ids"]), bytes(r["queries"]), r["query_kind"]) for r in asked.where(F.col("qb").between(first, first + SENT - 1)).collect()]
        sent = spark.sparkContext.broadcast(own)
        spread = indexed.repartition(min(row_blocks, 4096)) if row_blocks > 1 else indexed
        rounds.append(written(spread.mapInArrow(functools.partial(search, sent=sent), RESULT), "found"))
        sent.destroy()
    found = functools.reduce(DataFrame.unionByName, rounds)
    discard(indexed)
    discard(asked)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    score = F.when(F.col("score").isNull(), F.raise_error(F.lit("a score among the best is no long")).cast("long")).otherwise(F.col("score"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", score.alias("score"))


def neighbours(embeddings: DataFrame) -> DataFrame:
    """The ten best rows of each row whose vec_id is divisible by 100."""
    return top_k(embeddings, embeddings.where("vec_id % 100 = 0"))
