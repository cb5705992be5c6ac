"""Near-duplicate vectors by p-stable hashing for the Euclidean distance, followed by exact cosine checks.

Normalised vectors are projected on random directions, and the projections, shifted and cut into
steps of a fixed width, are the vector's bucket in each of several tables. Only vectors that share a
bucket are compared, with the cosine in double precision.

Vectors that are null, zero or empty, or hold a null or non-finite component, link with nothing, nor
do rows without an id or vectors of different lengths. Copies of a vector are compared once and count
as links each. Rows that repeat an id are one node. Ties are links (>=). Empty tables give empty
results; only vec_id and embedding are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, local_components, written

#: At a cosine of 0.95 (a distance of 0.316) one projection keeps a pair together with probability 0.798; twelve keep 6.7 % of the
#: pairs in one table, and 48 tables 96 %. At a cosine of 0.99 it is all but 1 in 10 million.
WIDTH, DIRECTIONS, TABLES, SEED = 1.25, 12, 48, 20_240_501
#: Vectors of a block: a larger bucket is cut into blocks, and each pair of blocks is compared on its own.
BLOCK = 1024
KEYED = "rep long, keys array<long>"
FOUND = "rep long, links long, root long"


@functools.lru_cache(maxsize=8)
def directions(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, size])
    factors = rng.integers(0, 2**63, (TABLES, DIRECTIONS), dtype=np.uint64) | np.uint64(1)
    return rng.standard_normal((size, TABLES * DIRECTIONS)), rng.uniform(0, WIDTH, TABLES * DIRECTIONS), factors


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; each is scaled by its largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def table_keys(x: np.ndarray) -> np.ndarray:
    """The bucket of each row in each table."""
    way, shift, factors = directions(x.shape[1])
    steps = np.floor((unit(x) @ way + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(x), TABLES, DIRECTIONS)
    mixed = (steps * factors).sum(axis=2, dtype=np.uint64)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(x.shape[1])).view(np.int64)


def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 2048):
            batch = whole.slice(start, 2048)
            lists = batch.column("embedding")
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets)
            keys = np.zeros((len(sizes), TABLES), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                keys[at] = table_keys(values[offsets[at][:, None] + np.arange(size)].astype(np.float64))
            spread = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, TABLES, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), spread], names=["rep", "keys"])


def compare(table: int, side: np.ndarray, x: np.ndarray, raw: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows with a cosine of least or more, and whether no earlier table has them; between the sides, if there are two."""
    cosine = x @ x.T >= least
    two = side.min() != side.max()
    i, j = np.nonzero(np.triu(cosine, 1))
    if two:
        across = side[i] != side[j]
        i, j = i[across], j[across]
    first = np.ones(len(i), bool)
    left = np.arange(len(i))
    if table and len(i):  # the keys are not sent along: those of the rows that have a pair are made again
        some = np.unique(np.concatenate([i, j]))
        keys = np.empty((len(x), TABLES), np.int64)
        keys[some] = table_keys(raw[some])
    for t in range(table):
        if not len(left):
            break
        same = keys[i[left], t] == keys[j[left], t]
        first[left[same]] = False
        left = left[~same]
    return i, j, first


def linked(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Batches sorted by bucket and pair of blocks; a bucket's pairs come out as counts and stars, not as pairs."""
    held: pa.Table | None = None

    def runs(rows: pa.Table, last: bool) -> tuple[list[tuple[np.ndarray, ...]], pa.Table | None]:
        marks = np.stack([rows[c].to_numpy() for c in ("t", "key", "lo", "hi")])
        starts = np.concatenate([[0], np.flatnonzero((np.diff(marks) != 0).any(axis=0)) + 1, [rows.num_rows]])
        stop = len(starts) - 1 if last else len(starts) - 2
        found = []
        if stop > 0:
            done = rows.slice(0, int(starts[stop])).combine_chunks()
            rep, copies, side = (done[c].to_numpy() for c in ("rep", "copies", "side"))
            lists = done["embedding"].combine_chunks()
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for a, b in zip(starts[:stop], starts[1 : stop + 1], strict=True):
                if b - a < 2:
                    continue
                raw = values[offsets[a] : offsets[b]].reshape(b - a, -1).astype(np.float64)
                x = unit(raw)
                i, j, first = compare(int(marks[0, a]), side[a:b], x, raw, least)
                if not len(i):
                    continue
                links = np.zeros(b - a, np.int64)
                np.add.at(links, i[first], copies[a:b][j[first]])
                np.add.at(links, j[first], copies[a:b][i[first]])
                nodes, roots = local_components(rep[a:b][i], rep[a:b][j])
                found.append((rep[a:b], links, np.full(b - a, -1)))
                found.append((nodes, np.zeros(len(nodes), np.int64), roots))
        return found, None if last else rows.slice(int(starts[stop]))

    def out(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        rep, links, root = (np.concatenate(c) for c in zip(*found, strict=True))
        use = (links > 0) | ((root >= 0) & (root != rep)) | ((root < -1) & (root != rep))
        return pa.RecordBatch.from_arrays([pa.array(rep[use]), pa.array(links[use]), pa.array(np.where(links[use] > 0, rep[use], root[use]))], names=["rep", "links", "root"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        found, held = runs(held, False)
        if found:
            yield out(found)
    if held is not None and held.num_rows:
        found, _ = runs(held, True)
        if found:
            yield out(found)


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row: the pairs found with a cosine of least or more, and what they reach.

    A bucket of any size is cut into blocks of about BLOCK vectors, and each pair of blocks is compared
    in memory by one task; a pair counts in the first table that has it. What leaves a bucket is one
    count and one star edge a vector and table at most, never all pairs.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if kind == "array<float>" else "array<double>"))
    real = "vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)"
    rows = rows.withColumn("real", F.coalesce(F.expr(real), F.lit(False)))
    rows = rows.withColumn("h1", F.when(F.col("real"), F.xxhash64("embedding"))).withColumn("h2", F.when(F.col("real"), F.xxhash64(F.lit(1), "embedding")))
    distinct = rows.where("real").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    distinct = written(distinct, "vectors")
    reps = distinct.select("h1", "h2", "rep", "copies")
    keyed = written(distinct.select("rep", "embedding").mapInArrow(with_keys, KEYED), "keys")
    places = keyed.select("rep", F.posexplode("keys").alias("t", "key"))
    sizes = places.groupBy("t", "key").count().where("count > 1")
    places = places.join(sizes, ["t", "key"]).withColumn("blocks", F.ceil(F.col("count") / BLOCK)).withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    places = places.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    places = places.select("rep", "t", "key", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = places.join(distinct.select("rep", "copies", "embedding"), "rep").repartition(parts, "t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi")
    found = written(dealt.mapInArrow(lambda batches: linked(batches, least), FOUND), "linked")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.where("rep <> root").select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    per_vector = reps.join(links, "rep", "left").join(reached, reps["rep"] == reached["node"], "left")
    per_vector = per_vector.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    return rows.select("vec_id", "h1", "h2").join(per_vector, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
