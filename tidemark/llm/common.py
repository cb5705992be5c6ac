"""What the operators of this subpackage share: the shared folder, written intermediates and components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Makes Spark delete the shuffle files of a statement when the statement ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, a folder of the warehouse, or a temporary one if all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        alone = spark.sparkContext.master.split("[")[0] == "local"
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-") if alone else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tidemark-scratch"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """df written to the shared folder and read again: its lineage ends in files that survive a lost executor.

    Nothing reads the statement's shuffle files again, so they go when it ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a DataFrame that written() returned."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def trimmed() -> None:
    """Give the memory that a worker no longer uses back to the system; workers are kept for the next stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(docs: DataFrame, name: str) -> str:
    """A name that begins like name and that no column of docs has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    while any(c.startswith(name) for c in taken):
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the column has about size bytes in each, or one row."""
    for batch in batches:
        values = batch.column(column)
        lengths = np.asarray(pc.fill_null(pc.binary_length(values), 0), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // size)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links a-b and, for each, the smallest node that the links reach."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (src, dst: long): component is the smallest node that links reach.

    Alternates large-star and small-star steps until the edges are stars, about log(nodes) rounds.
    Each round ends in files of the shared folder; all work is joins and aggregates that combine
    before the shuffle, so a node with very many links is split like any skewed join. Nothing is
    collected but a count and a checksum a round. Edges with a null end and loops are ignored.
    """
    edges = edges.select(F.col("src").cast("long").alias("u"), F.col("dst").cast("long").alias("v")).where("u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, last = written(edges, "links"), None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        new = written(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        seen = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(now)
        now = new
        if seen == last:
            break
        last = seen
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
