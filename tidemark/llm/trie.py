"""The prefix trie of conversations, as a table of nodes in preorder.

Distinct sequences of turns are ranked lexicographically (by hashes of their turns, in blocks of BLOCK turns that
are ranked in turn, as many levels as the longest one needs). A node, a distinct prefix, is opened by the
first sequence that has it; sequences in their order, and the prefixes each opens by depth, are the trie's preorder.
The sequences below a node are an interval of ranks, so its subtree is the interval of places from its own to
the last node that the last of them opens: preorder and subtree_end. Leaves and savings of a subtree are
differences of running sums over the places, which are scanned in ranges (``scan.scanned``).

Prefixes are known by 128-bit hashes, running exclusive-ors of hashes of depth and turn. Copies of a
conversation are one sequence with a number from the start, and counts combine before the shuffle. Neither a
conversation nor the members of a node have to lie in one task, but for the digest of a node's ends, which SHA-256
makes of them in one order: their numbers are joined to pieces of PIECE in ranges, and one task of a node only streams the pieces.

Rows without conv_id take no part; null roles and texts are empty; turns that share a number are ordered by role and
text, repeated rows are turns of their own. An empty table has no nodes. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.scan import scanned

#: Turns, or blocks, that are ranked together; conversations that share a first one, and the most turns they share.
BLOCK, FAMILY, SHARED = 64, 100, 6
#: Numbers of conversations in a piece of a list of ends.
PIECE = 1024
NOTHING = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (place from 0), h1 and h2 (hashes of role and text) and chars of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", role, text)
    rows = rows.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return scanned(rows.select("conv_id", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2"), F.length("text").cast("long").alias("chars")), "conv_id")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conv_id of all conversations, and conv_id, depth, h1, h2 and chars of the turns they have once the first ones come from the first of their family."""
    base, share = F.col("conv_id") - F.col("conv_id") % FAMILY, F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    ids = own.where("at = 0").select("conv_id", base.alias("base"), share.alias("share"))
    firsts = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("at") < SHARED - 1))
    given = firsts.select(F.col("conv_id").alias("base"), "at", "h1", "h2", "chars")
    heads = ids.join(given, "base").where("at < share").select("conv_id", (F.col("at") + 1).alias("depth"), "h1", "h2", "chars")
    many = given.groupBy("base").agg(F.count("*").alias("there"))
    tails = own.withColumn("base", base).withColumn("share", share).where("at >= share").join(many, "base", "left")
    depth = F.col("at") - F.col("share") + F.least(F.col("share"), F.coalesce("there", F.lit(0))) + 1
    return ids.select("conv_id"), heads.union(tails.select("conv_id", depth.alias("depth"), "h1", "h2", "chars"))


def order_of(rows: DataFrame, sequences: DataFrame, block: int) -> DataFrame:
    """rep and rank, the place of each of the distinct sequences (rep) by its names in the order of i; rows are rep, i and name. A sequence without rows is first."""
    while True:
        names = F.transform(F.sort_array(F.collect_list(F.struct("i", "name"))), lambda x: x["name"])
        blocks = written(rows.groupBy("rep", F.floor(F.col("i") / block).cast("long").alias("i")).agg(names.alias("names")), "blocks")
        if not blocks.agg(F.max("i")).first()[0]:
            break
        kinds = written(blocks.select("names").distinct().withColumn("kind", F.monotonically_increasing_id()), "kinds")
        placed = scanned(kinds.orderBy("names").select("kind")).select("kind", F.col("at").alias("name"))
        rows = blocks.join(kinds.join(placed, "kind"), "names").select("rep", "i", "name")
    every = sequences.select("rep").join(blocks.select("rep", "names"), "rep", "left").orderBy(F.asc_nulls_first("names"))
    return scanned(every.select("rep")).select("rep", F.col("at").alias("rank"))


def ends(finals: DataFrame) -> DataFrame:
    """p1, p2 and ends_sha256 of the nodes where conversations end: the digest of their numbers in order, joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, some, out = None, [], []

        def put() -> None:
            if some:
                out.append((*key, some[0], ",".join(map(str, some))))
                some.clear()

        for batch in batches:
            for a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "conv_id")), strict=True):
                if (a, b) != key or len(some) == PIECE:
                    put()
                    key = (a, b)
                some.append(conv)
            if len(out) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["p1", "p2", "least", "piece"])
                out.clear()
        put()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["p1", "p2", "least", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        for batch in batches:
            for a, b, piece in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "piece")), strict=True):
                if (a, b) != key:
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (a, b), hashlib.sha256(piece.encode())
                else:
                    sha.update(b"," + piece.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["p1", "p2", "ends_sha256"])
                out = []
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], names=["p1", "p2", "ends_sha256"])

    some = finals.orderBy("p1", "p2", "conv_id").mapInArrow(pieces, "p1 long, p2 long, least long, piece string")
    return some.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "least").mapInArrow(digests, "p1 long, p2 long, ends_sha256 string")


def nodes(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, preorder and subtree_end."""
    ids, rows = rebuilt(turns(conversations))
    ids = written(ids, "conversations")
    hashes = [F.xxhash64("depth", "h1", "h2").alias("x1"), F.xxhash64(F.lit(1), "depth", "h1", "h2").alias("x2")]
    rows = scanned(rows.select("*", *hashes).orderBy("conv_id", "depth"), "conv_id", xors=("x1", "x2"))
    rows = written(rows.withColumnsRenamed({"run_x1": "p1", "run_x2": "p2"}), "prefixes")
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("p1", "p2", "depth"), "depth").alias("e")).select("conv_id", "e.*")
    finals = written(ids.join(last, "conv_id", "left").na.fill(0, ["p1", "p2", "depth"]), "finals")
    sequences = finals.groupBy("p1", "p2", "depth").agg(F.count("*").alias("n"), F.min("conv_id").alias("rep"))
    sequences = written(sequences.select("rep", "n", F.col("depth").alias("length")), "sequences")
    few = written(rows.join(sequences, F.col("conv_id") == F.col("rep")), "sequence-turns")
    ranks = written(order_of(few.select("rep", (F.col("depth") - 1).alias("i"), F.struct("h1", "h2").alias("name")), sequences, block), "ranks")

    zero = F.lit(0).cast("long")
    roots = sequences.select("rep", "n", "length", zero.alias("depth"), *(zero.alias(c) for c in ("p1", "p2", "q1", "q2", "chars")))
    prefixes = few.select("rep", "n", "length", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "chars")
    every = roots.union(prefixes).join(ranks, "rep")
    open_ = every.groupBy("p1", "p2", "depth").agg(
        F.min("rep").alias("conv_id"), F.sum("n").alias("n_convs"), F.min("rank").alias("first"), F.max("rank").alias("last"),
        F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.max("chars").alias("chars"), F.sum(F.when(F.col("length") == F.col("depth"), F.col("n")).otherwise(0)).alias("here"),
    )
    open_ = open_.withColumn("leaf", (F.col("here") == F.col("n_convs")).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    placed = written(scanned(open_.drop("chars", "here").orderBy("first", "depth"), sums=("leaf", "saved")), "nodes")
    stop = placed.groupBy(F.col("first").alias("last")).agg(F.max("at").alias("subtree_end"), F.max("run_leaf").alias("end_leaf"), F.max("run_saved").alias("end_saved"))
    parents = placed.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    below = placed.where("depth > 0").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    done = placed.join(stop, "last").join(parents, ["q1", "q2"], "left").join(below, ["p1", "p2"], "left").join(ends(finals.select("p1", "p2", "conv_id")), ["p1", "p2"], "left")
    return done.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        (F.col("end_leaf") - F.col("run_leaf") + F.col("leaf")).alias("n_leaves"),
        (F.col("end_saved") - F.col("run_saved") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        F.col("at").alias("preorder"),
        "subtree_end",
    )
