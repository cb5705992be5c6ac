"""Whether a replay day may be published: every local fact of its bundle, for any number of bundles in one plan.

A bundle is sealed only if its raw manifest, its part files, their manifests, the replay manifest, its predecessor and
the limits all agree. Each fact is a column of one row a bundle, made by joins and aggregates of its parts; the
first that fails, in the contract's order, is the bundle's fault.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import chains

#: What a part file says of itself when it is opened again, and its manifest must say, too.
SAME = ("digest", "row_count", "first_stream_sequence", "last_stream_sequence", "previous_row_chain_hash", "last_row_chain_hash")
#: The faults, in the order in which they are looked for.
FAULTS = ("raw_manifest", "part_count", "part_sequence", "part_object", "part_manifest", "part_graph", "predecessor", "replay_manifest", "limits")


def part_facts(parts: DataFrame, manifests: DataFrame, by: list[str]) -> DataFrame:
    """Per bundle: parts, manifests, rows and bytes, and whether all parts are counted from 0, opened, named by equal manifests, and one chain."""
    own = chains.part_graph(parts, by).withColumn("_own", F.struct("key", *SAME))
    said = manifests.select(*by, "part_sequence", F.struct("key", *SAME).alias("_said"))
    both = own.join(said, [*by, "part_sequence"], "full_outer")
    there = F.col("_own").isNotNull()
    return both.groupBy(*by).agg(
        F.count(F.when(there, 1)).alias("parts"), F.count(F.when(F.col("_said").isNotNull(), 1)).alias("named"), F.sum("row_count").alias("rows"), F.sum("bytes").alias("part_bytes"),
        (F.max(F.when(there, F.col("part_sequence"))) == F.count(F.when(there, 1)) - 1).alias("counted"), F.min(F.when(there, F.col("verified"))).alias("opened"), F.min(F.coalesce(F.col("_own") == F.col("_said"), F.lit(False))).alias("equal"), (~F.max(F.when(there, F.col("breaks")))).alias("chained"),
    )


def bundle_faults(bundles: DataFrame, parts: DataFrame, manifests: DataFrame, raws: DataFrame, replays: DataFrame, limits: dict[str, int], *scopes: str) -> DataFrame:
    """bundles with fault, null for one that may be sealed.

    bundles have scopes, revision, previous (the predecessor's digest), raw_digest, row_count and part_set_root, as their replay manifests
    say; parts what the files say (part_sequence, key, SAME, bytes, and verified: they were opened and are what their keys say); manifests
    the same of the part manifests; raws the verified raw manifests (scopes, raw_digest); replays the revisions known
    before (scopes, revision, digest). limits are max_parts and max_total_parquet_bytes.
    """
    by = list(scopes)
    known = raws.select(*by, "raw_digest").distinct().withColumn("_raw", F.lit(True))
    before = replays.select(*by, (F.col("revision") + 1).alias("revision"), F.col("digest").alias("_before"))
    roots = chains.part_set_root(manifests, by).withColumnRenamed("part_set_root", "_root")
    rows = bundles.join(known, [*by, "raw_digest"], "left").join(part_facts(parts, manifests, by), by, "left").join(roots, by, "left").join(before, [*by, "revision"], "left")
    follows = F.when(F.col("revision") == 1, F.col("previous").isNull()).otherwise(F.col("previous") == F.col("_before"))
    within = (F.col("parts") <= limits["max_parts"]) & (F.col("part_bytes") <= limits["max_total_parquet_bytes"])
    good: tuple[Column, ...] = (
        F.col("_raw"), (F.col("parts") == F.col("named")) & (F.col("parts") > 0), F.col("counted"), F.col("opened"), F.col("equal"), F.col("chained"), follows,
        (F.col("row_count") == F.col("rows")) & (F.col("part_set_root") == F.col("_root")), within,
    )
    fault = F.coalesce(*(F.when(~F.coalesce(g, F.lit(False)), name) for g, name in zip(good, FAULTS, strict=True)))
    return rows.select(*bundles.columns, fault.alias("fault"))
