"""Ranked lexical search: the best documents of each item by a BM25-like integer score, exactly.

Terms are runs of letters and digits in ASCII and of all other characters, A to Z in lower case. A term's
weight is floor(1000 ln((2N+2)/(2df+1))); a document adds for each of the item's terms, once each, the
impact weight * ((10^9 tf) div (1000 tf + 8 m)) with m = 10 + (90 n N) div L, all in 64-bit integers.

The search is a threshold-seeded join. The table of terms stores each term's greatest impact and its kth
greatest one. An item's kth best score is at least the greatest kth impact of its terms, for the k documents that
have that term reach it by the term alone; and at least the kth best score of the documents that lead its terms'
lists, which are scored exactly. Ordered by greatest impact, an item's terms after which the rest
cannot reach this threshold together are pruned: a document that has none of the terms before cannot be among
the best. A document becomes a candidate by one of the other terms only if its impact there and the greatest
impacts of the terms that follow (its suffix bound) reach the threshold; for the first term that a document
has this always holds if its score does. Candidates are scored exactly from their stored terms.

A null text has no terms, and a document without terms is none of the N. Rows that repeat a doc_id are
documents of their own; a null doc_id comes before others of its score. Rows that share an item_id, null
included, are one item with the terms of all. Empty tables give an empty result. Only doc_id, text, item_id
and the item's text are read. Terms of more than LONG bytes are known by their SHA-256. The documents' postings
hold only terms that items have; where those are more than LISTED, postings are made by a join instead of a list
in each task, and lists of terms, weights and candidates are broadcast up to BROADCAST_ROWS rows only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, slices, trimmed, written

#: Documents an item gets.
BEST = 10
#: Distinct terms of all items up to which each task has the list of them (at most LONG + 2 bytes each), bytes of a term that is not hashed.
LISTED, LONG = 100_000, 64
#: Rows up to which tables of terms, of terms of items and of candidates are broadcast (under 100 bytes each).
BROADCAST_ROWS = 200_000
#: What each byte of UTF-8 becomes: letters in lower case, what stands between terms a blank.
BYTES = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)


def blanked(texts: pa.Array) -> pa.Array:
    """The texts with terms in lower case between blanks; null stays null. Only the bytes change, not where a text stands."""
    texts = texts.cast(pa.large_string())
    valid, offsets, data = texts.buffers()
    plain = BYTES[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(pa.large_string(), len(texts), [valid, offsets, pa.py_buffer(plain)], offset=texts.offset)


def names(terms: pa.Array) -> pa.Array:
    """The terms; long ones by a hash, which begins with a sign that no term has."""
    long = pc.greater(pc.binary_length(terms), LONG)
    if not pc.any(long).as_py():
        return terms
    return pa.array(["#" + hashlib.sha256(x.encode()).hexdigest() if far else x for x, far in zip(terms.to_pylist(), long.to_pylist(), strict=True)], terms.type)


def counted(texts: pa.Array, known: pa.Array | None) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """n (terms with repeats of each text); the terms of the batch, or known ones; and of each text's distinct ones among them: text, place in them and count."""
    cut = pc.split_pattern(pc.fill_null(blanked(texts), ""), " ")
    parts = cut.flatten().dictionary_encode()
    words, code = names(parts.dictionary), parts.indices.to_numpy()
    own = np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy(zero_copy_only=False))
    term = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    n = np.bincount(own, weights=term[code], minlength=len(texts)).astype(np.int64)
    if known is None:
        known, at = words, np.where(term, np.arange(len(words)), -1)
    else:
        at = pc.fill_null(pc.index_in(words, value_set=known.cast(words.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    at, many = at[code], max(1, len(known))
    keep = at >= 0
    pairs, tf = np.unique(own[keep] * many + at[keep], return_counts=True)
    return n, known, pairs // many, pairs % many, tf


def terms_of(docs: DataFrame, known: list[str] | None) -> DataFrame:
    """row, doc_id, n and the distinct terms of each document that has a term, with their counts (tfs): ids, places in known, or, if that is None, all as terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = None if known is None else pa.array(known, pa.large_string())
        for batch in slices(batches, "text", 4 << 20):
            n, words, own, at, tf = counted(batch.column("text"), listed)
            offsets = pa.array(np.searchsorted(own, np.arange(batch.num_rows + 1)), pa.int32())
            values = pa.array(at, pa.int32()) if listed is not None else words.take(pa.array(at)).cast(pa.string())
            arrays = [batch.column("row"), batch.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(offsets, values), pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n", "ids" if listed is not None else "terms", "tfs"]).filter(pa.array(n > 0))
        trimmed()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "row long, doc_id long, n long, " + ("terms array<string>" if known is None else "ids array<int>") + ", tfs array<int>")


def near(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its rows, which are counted, are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def exploded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns, F.explode(F.arrays_zip("ids", "tfs")).alias("x")).select(*columns, F.col("x.ids").alias("id"), F.col("x.tfs").cast("long").alias("tf"))


def indexed(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The postings, row, doc_id, n, ids and tfs of each document that has a term (null where it has none of an item), and item and id, the terms of each item, once each."""
    each = terms_of(items.select(F.col("item_id").alias("doc_id"), "text"), None)
    each = written(each.select(F.struct(F.col("doc_id").alias("item_id")).alias("item"), F.explode("terms").alias("term")).distinct(), "item-terms")
    few = [r["term"] for r in each.select("term").distinct().orderBy("term").limit(LISTED + 1).collect()]
    if len(few) <= LISTED:
        vocabulary = docs.sparkSession.createDataFrame(list(enumerate(few)), "id int, term string")
        return written(terms_of(docs, few), "postings"), each.join(F.broadcast(vocabulary), "term").select("item", "id")
    vocabulary = written(each.select("term").distinct().select(F.monotonically_increasing_id().alias("id"), "term"), "vocabulary")
    rows = written(terms_of(docs, None), "terms")
    all_terms = rows.select("row", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("row", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))
    found = all_terms.join(vocabulary, "term").groupBy("row").agg(F.collect_list("id").alias("ids"), F.collect_list("tf").alias("tfs"))
    postings = written(rows.select("row", "doc_id", "n").join(found, "row", "left"), "postings")
    discard(rows)
    return postings, each.join(vocabulary, "term").select("item", "id")


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the best documents of each item, equal scores by doc_id."""
    postings, of_items = indexed(docs, items)
    of_items = written(of_items, "of-items")
    documents, length = postings.agg(F.count("*"), F.sum("n")).first()
    weight = F.floor(1000 * F.ln(F.lit(float(2 * documents + 2)) / (2 * F.col("count") + 1))).cast("long")
    weights = near(written(exploded(postings).groupBy("id").count().select("id", weight.alias("w")), "weights"))

    def impacts(rows: DataFrame, *columns: str) -> DataFrame:
        """columns, id and s of the terms in rows of postings."""
        m = F.expr(f"10 + (90 * n * {documents}L) div {length or 1}L").alias("m")
        each = exploded(rows.where("ids IS NOT NULL").select(*columns, m, "ids", "tfs"), *columns, "m")
        return each.join(weights, "id").select(*columns, "id", F.expr("w * ((1000000000L * tf) div (1000 * tf + 8 * m))").alias("s"))

    def scores(pairs: DataFrame) -> DataFrame:
        """item, doc_id, row and score of each of the pairs (item, row)."""
        found = postings.join(near(pairs), "row")
        each = impacts(found, "item", "row", "doc_id").join(wide, ["item", "id"])
        return each.groupBy("item", "row", "doc_id").agg(F.sum("s").alias("score"))

    wide = near(of_items)
    first = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("s"), "row"))
    leaders = written(impacts(postings, "row").withColumn("place", first).where(F.col("place") <= best), "leaders")
    terms = leaders.groupBy("id").agg(F.max("s").alias("top"), F.coalesce(F.max(F.when(F.col("place") == best, F.col("s"))), F.lit(0)).alias("kth"))
    terms = of_items.join(near(written(terms, "term-table")), "id")
    seeds = scores(written(of_items.join(near(leaders), "id").select("item", "row").distinct(), "seeds"))
    seeds = seeds.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("place") == best).select("item", F.col("score").alias("reached"))
    least = terms.groupBy("item").agg(F.max("kth").alias("kth")).join(seeds, "item", "left").select("item", F.greatest(F.lit(1), "kth", "reached").alias("least"))
    after = Window.partitionBy("item").orderBy(F.desc("top"), "id").rowsBetween(1, Window.unboundedFollowing)
    bounds = terms.withColumn("rest", F.coalesce(F.sum("top").over(after), F.lit(0))).join(least, "item").where(F.col("top") + F.col("rest") >= F.col("least"))
    bounds = near(written(bounds.select("item", "id", (F.col("least") - F.col("rest")).alias("need")), "bounds"))
    pairs = impacts(postings, "row").join(bounds, "id").where(F.col("s") >= F.col("need")).select("item", "row").distinct()
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    done = scores(written(pairs, "candidates")).where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return done.select("item.item_id", "rank", "doc_id", "score")
